"""Ranking, numbering and "one row per key" operators."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import number_rows


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rn") -> DataFrame:
    """First ``k`` rows of each group.

    The filter sits directly on the row number, so Spark limits each group before the shuffle and a
    large group sends at most ``k`` rows per map task.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, number).filter(F.col(rank) <= k)


def top_k_by_group(
    df: DataFrame, group: str, keys: Sequence[str], order: Sequence[Column], k: dict, default_k: int = 1, rank: str = "rn"
) -> DataFrame:
    """:func:`top_k` with a different ``k`` for some values of ``group``."""
    widest = max([default_k, *k.values()])
    allowed = F.lit(default_k)
    for value, size in k.items():
        allowed = F.when(F.col(group) == F.lit(value), F.lit(size)).otherwise(allowed)
    return top_k(df, keys, order, widest, rank).filter(F.col(rank) <= allowed)


def mark_first(df: DataFrame, keys: Sequence[str], order: str, flag: str, ties: Sequence[str] = ()) -> DataFrame:
    """Flag the row with the smallest ``order`` value of its group, nulls last; ``ties`` decide among equals.

    The minimum is combined before the shuffle.  The join back is on all of these columns, so the rows of a large
    group spread over many tasks, which a window over the group would not allow.  Rows that agree in all of them
    are flagged together.
    """
    place = [F.col(order).isNull().alias("__late"), F.col(order).alias("__order"), *[F.col(c).alias(f"__tie_{c}") for c in ties]]
    firsts = df.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(F.min(F.struct(*place)).alias("__first"))
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys] + [F.col(order).eqNullSafe(F.col("__first.__order"))]
    same += [F.col(c).eqNullSafe(F.col(f"__first.__tie_{c}")) for c in ties]
    joined = df.join(firsts.withColumn(flag, F.lit(True)), functools.reduce(lambda a, b: a & b, same), "left")
    return joined.select(*df.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest order value per key, as an aggregation with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def batches(
    df: DataFrame, order: Sequence[str], size: int, name: str = "batch", rows_per_segment: int | None = None
) -> DataFrame:
    """Number consecutive rows in batches of a fixed size."""
    numbered = number_rows(df, [], order, "__rn", rows_per_segment)
    return numbered.withColumn(name, F.floor((F.col("__rn") - 1) / F.lit(size)).cast("bigint")).drop("__rn")


def joined_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    separator: str,
    per_line: int,
    name: str = "joined",
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Values of each group joined in order, ``per_line`` values to a line.

    A group of any size becomes as many lines as it needs, so no single row grows with the group.
    """
    numbered = number_rows(df, keys, order, "__rn", rows_per_segment)
    lined = numbered.withColumn("line", F.floor((F.col("__rn") - 1) / F.lit(per_line)).cast("bigint"))
    entries = F.array_sort(F.collect_list(F.struct("__rn", F.col(value).alias("v"))))
    return lined.groupBy(*keys, "line").agg(
        F.array_join(F.transform(entries, lambda e: e["v"]), separator).alias(name)
    )
