"""Ordered work on keys of any size.

A window keyed by an entity puts all rows of that entity into one task.  When one entity may hold a third of the
table that task never ends, so the helpers here deal the rows out by ranges of (key, order) and store them, sorted, with
the number of their segment and their place in it.  A window then runs per key and segment, and what it needs from
the segments before comes from a small table with one row per segment edge.  There is one form for tables of any size.

One sampled pass cuts the ranges and one writes them.  Nothing is counted first: there are as many ranges as the session has shuffle partitions,
fewer where adaptive execution puts small ones together, so they are as large as any other partition.  A range is one segment
or, where smaller ones are asked for, several by place; so the number of tasks does not depend on their size.  Rows with equal
keys and order are cut like others, by their place in the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

SEGMENT, PLACE = "__segment", "__place"
_PLACE_BITS = 33
_WITHIN = (1 << _PLACE_BITS) - 1


def segmented(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_segment: int | None = None) -> DataFrame:
    """The rows with the number of their segment and their place in it, stored.  Segments follow (keys, order), nulls first.

    Storing fixes the cuts: every later branch and every repeated task sees the same ones.  ``df`` is read twice, to
    sample the ranges and to deal it out, so it should be a stored table where it is dear to compute.  With
    ``rows_per_segment`` each range is cut into segments of that many rows and one of the rest.
    """
    by = [*[F.col(c) for c in dict.fromkeys([*keys, *order])], F.col("__tie")]
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie")
    # the number of the range above the place in it
    number = dealt.withColumn(PLACE, F.monotonically_increasing_id())
    segment, place = F.shiftright(PLACE, _PLACE_BITS), F.col(PLACE).bitwiseAND(_WITHIN)
    if rows_per_segment is not None:
        cut = F.floor(place / F.lit(rows_per_segment)).cast("long")
        segment, place = F.col(PLACE) - place + cut, place % rows_per_segment
    return materialise(number.withColumns({SEGMENT: segment, PLACE: place}), "segments")


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` with the columns ``__r_<key>`` of the right side."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"__r_{k}"])
    return condition


def renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in df.columns if c not in keys])


def crossing_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (as ``__r_<key>``) with rows in more than one segment: at most one per cut."""
    edges = rows.groupBy(*keys).agg(F.min(SEGMENT).alias("__lo"), F.max(SEGMENT).alias("__hi"))
    return renamed_keys(edges.filter("__lo < __hi").select(*keys), keys)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn", rows_per_segment: int | None = None
) -> DataFrame:
    """``row_number()`` by ascending order (nulls first) for keys of any size, or over the whole table.

    ``keys`` may be empty.  A row's number in the table is its place in the segment and the rows of the segments
    before; its number in the key is that less the number of the key's first row.  No window runs over the rows.
    """
    keys = list(keys)
    rows = segmented(df, keys, order, rows_per_segment)
    sizes = rows.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("__n"))
    # one row per segment
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(SEGMENT, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    numbered = rows.join(F.broadcast(starts), SEGMENT).withColumn("__number", F.col(PLACE) + F.col("__start"))
    if not keys:
        return numbered.select(*df.columns, (F.col("__number") + 1).alias(name))
    firsts = renamed_keys(numbered.groupBy(*keys).agg(F.min("__number").alias("__first")), keys)
    joined = numbered.join(firsts, same_keys(numbered, firsts, keys))
    return joined.select(*df.columns, (F.col("__number") - F.col("__first") + 1).alias(name))
