"""Category dictionaries: distinct values in order, numbered from 0, null first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import number_rows

UNSEEN = -1


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType | T.BooleanType)


def fit_codes(df: DataFrame, columns: Sequence[str], rows_per_segment: int | None = None) -> DataFrame:
    """Dictionary rows ``(column, value, code)`` for all columns, from one scan.

    Each row unpivots into (column, value) pairs that are de-duplicated before the shuffle; numbering them samples and
    deals out the distinct pairs.  Numbers sort as numbers, text as text.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = []
    for c in dict.fromkeys(columns):
        number = F.col(c).cast("double") if _is_number(types[c]) else F.lit(None).cast("double")
        pairs.append(
            F.struct(F.lit(c).alias("column"), number.alias("as_number"), F.col(c).cast("string").alias("value"))
        )
    distinct = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct()
    numbered = number_rows(distinct, ["column"], ["as_number", "value"], "__rn", rows_per_segment)
    return numbered.select("column", "value", (F.col("__rn") - 1).alias("code"))


def cardinalities(dictionary: DataFrame) -> DataFrame:
    """Number of codes per column; null counts as a value."""
    return dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n_values"))


def apply_codes(df: DataFrame, columns: Sequence[str], dictionary: DataFrame, keep: bool = False) -> DataFrame:
    """Replace values by codes (or add ``<column>_code`` with ``keep``); unseen values get -1.

    A dictionary below the broadcast limit is broadcast by Spark; a larger one is joined by shuffle.
    """
    out = df
    for c in dict.fromkeys(columns):
        part = dictionary.filter(F.col("column") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        out = out.join(part, F.col(c).cast("string").eqNullSafe(F.col("__value")), "left")
        coded = F.coalesce("__code", F.lit(UNSEEN)).cast("bigint")
        out = out.withColumn(f"{c}_code" if keep else c, coded).drop("__value", "__code")
    return out


def invert_codes(df: DataFrame, columns: dict[str, str], dictionary: DataFrame) -> DataFrame:
    """Values (as text) for codes; ``columns`` maps a code column to the dictionary column it came from."""
    out = df
    for code_column, c in columns.items():
        part = dictionary.filter(F.col("column") == c).select(F.col("code").alias("__code"), F.col("value").alias("__value"))
        out = out.join(part, F.col(code_column) == F.col("__code"), "left")
        out = out.withColumn(f"{code_column}_value", F.col("__value")).drop("__value", "__code")
    return out
