"""Reading and writing of flat tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import materialise, scratch_path


def read_dimension(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; a bare carriage return ends a line as well.

    Without a schema the types are inferred.  With one the columns are found by their header names, whatever
    their order and case, and other columns are left out; a column that is not there is an error, a
    value that does not fit its type is null.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    raw = reader.csv(path)
    found: dict[str, list[str]] = {}
    for name in raw.columns:
        found.setdefault(name.strip().lower(), []).append(name)
    wanted = {f.name: found.get(f.name.lower(), []) for f in schema.fields}
    if missing := [name for name, columns in wanted.items() if not columns]:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {raw.columns}")
    return raw.select(*[F.col(f"`{wanted[f.name][0]}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_json_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or an empty one of the same schema on the first run."""
    try:
        return read_json(spark, whole_json_path(spark, path), schema)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return empty_like(spark, schema)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make tables known to SQL text."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_table(df: DataFrame, path: str, json_twin: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Parquet, replacing what is there; with ``json_twin`` also as JSON next to it."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}.parquet")
    if json_twin:
        df.write.mode("overwrite").json(f"{path}.json")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False, side_header: bool = False) -> None:
    """CSV; ``single_file`` is for small exports only.

    With ``side_header`` the parts have no header and the column names stand in one line at ``path.header``.
    """
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", header and not side_header).csv(path)
    if side_header:
        names = df.sparkSession.createDataFrame([(",".join(df.columns),)], "value string")
        names.coalesce(1).write.mode("overwrite").text(f"{path}.header")


def write_lines(df: DataFrame, path: str, columns: Sequence[str], order: Sequence, separator: str = "\t") -> None:
    """Separator-joined lines in a global order."""
    line = F.concat_ws(separator, *[F.col(c).cast("string") for c in columns])
    df.orderBy(*order).select(line.alias("value")).write.mode("overwrite").text(path)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def whole_json_path(spark: SparkSession, path: str) -> str:
    """Where the table is whole: the copy beside it if a replacement was cut short, else the table."""
    beside = f"{path}.next"
    return beside if _exists(spark, f"{beside}/_SUCCESS") else path


def replace_json(df: DataFrame, path: str) -> None:
    """Overwrite a JSON table that ``df`` itself was read from.

    The new content is first written whole beside the table, then the table is written from it, then the copy
    goes.  At any moment the table or the copy is whole, and readers take the copy while there is one.
    """
    spark, beside = df.sparkSession, f"{path}.next"
    if whole_json_path(spark, path) == beside:
        # ``df`` may read the copy of a replacement that was cut short
        df = materialise(df, "replace")
    df.write.mode("overwrite").json(beside)
    spark.read.schema(df.schema).json(beside).write.mode("overwrite").json(path)
    _remove(spark, beside)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole versions of a table, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(hadoop):
        return []
    names = [entry.getPath().getName() for entry in store.listStatus(hadoop)]
    return sorted(n for n in names if n.startswith("version-") and _exists(spark, f"{path}/{n}/_SUCCESS"))


def read_version(spark: SparkSession, path: str, schema: T.StructType, back: int = 0) -> DataFrame:
    """The newest whole version of a table, or the one ``back`` versions before; an empty table if there is none."""
    names = _versions(spark, path)
    if len(names) <= back:
        return empty_like(spark, schema)
    return spark.read.schema(schema).parquet(f"{path}/{names[-1 - back]}")


def replace_version(df: DataFrame, path: str, keep: int = 2) -> str:
    """Replace a table by a new version beside the old one; ``df`` may read the table itself.

    A version is a folder of its own that counts once its success marker is there, which is the last file written and
    appears at once.  So readers see the old version or the new one, a writer that dies leaves the old one as it
    was, and nothing is overwritten.  Versions older than the newest ``keep`` (2 at least) go afterwards; a reader
    that began before the last replacement can finish.  One writer at a time.
    """
    spark = df.sparkSession
    names = _versions(spark, path)
    number = int(names[-1].split("-")[1]) + 1 if names else 1
    name = f"version-{number:010d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{name}")
    for old in _versions(spark, path)[: -max(2, keep)]:
        _remove(spark, f"{path}/{old}")
    return name


def round_trip(df: DataFrame, kind: str) -> DataFrame:
    """Write a table in a format and read it back with its schema."""
    spark = df.sparkSession
    path = scratch_path(spark, f"trip-{kind}")
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).option("nullValue", "\\N").option("escape", '"').csv(path)
        return spark.read.option("header", True).option("nullValue", "\\N").option("escape", '"').schema(df.schema).csv(path)
    getattr(writer, kind)(path)
    return getattr(spark.read.schema(df.schema), kind)(path)
