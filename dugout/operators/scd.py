"""Type-2 histories and joins to the version that is valid at a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegeo import OPEN_END
from ..session import materialise
from .skew import PLACE, SEGMENT, crossing_keys, renamed_keys, same_keys, segmented

START, STOP = "effective_start_dt", "effective_stop_dt"


def build_history(
    df: DataFrame,
    key: str,
    at: str,
    tracked: Sequence[str],
    tie_break: Sequence[str] = (),
    start: str = START,
    stop: str = STOP,
    bounded: bool = False,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """One row per run of unchanged tracked columns of a key, as a half-open interval.

    A run starts at its first observation and stops where the next one starts; the last run is open
    (9999-01-01).  Other columns keep the value of the last observation of the run.  Runs that start
    and stop at the same moment are dropped.  Null is a value of its own for the comparison.

    ``bounded`` says that no key can have many rows (one per calendar day, say), so that its rows need
    no segments.
    """
    order = [at, *tie_break]
    state = F.struct(*[F.col(c) for c in tracked])
    rows = df.withColumn(SEGMENT, F.lit(0)) if bounded else segmented(df, [key], order, rows_per_segment)
    rows = rows.withColumn("__state", state)
    within = Window.partitionBy(key, SEGMENT).orderBy(*(order if bounded else [PLACE]))
    rows = rows.select(
        "*",
        F.lag("__state").over(within).alias("__before"),
        F.lead("__state").over(within).alias("__after"),
        F.lead(at).over(within).alias("__next_at"),
    )
    if not bounded:
        edges = renamed_keys(_segment_edges(rows, key, at), [key, SEGMENT])
        rows = rows.join(edges, same_keys(rows, edges, [key, SEGMENT]), "left").withColumns(
            {
                "__before": F.coalesce("__before", "__edge_before"),
                "__after": F.coalesce("__after", "__edge_after"),
                "__next_at": F.coalesce("__next_at", "__edge_next_at"),
            }
        )
        carried = F.col("__edge_start")
    else:
        carried = F.lit(None).cast(df.schema[at].dataType)
    opens = F.col("__before").isNull() | ~F.col("__before").eqNullSafe(F.col("__state"))
    closes = F.col("__after").isNull() | ~F.col("__after").eqNullSafe(F.col("__state"))
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    began = F.last(F.when(opens, F.col(at)), ignorenulls=True).over(so_far)
    end = F.lit(OPEN_END).cast(df.schema[at].dataType)
    return (
        rows.withColumn(start, F.coalesce(began, carried))
        .filter(closes)
        .withColumn(stop, F.coalesce("__next_at", end))
        .filter(F.col(start) < F.col(stop))
        .select(*[c for c in df.columns if c not in (start, stop)], start, stop)
    )


def _segment_edges(rows: DataFrame, key: str, at: str) -> DataFrame:
    """What the neighbouring segments of a key contribute; one row per key and segment of keys that cross a cut."""
    inner_open = F.col("__before").isNotNull() & ~F.col("__before").eqNullSafe(F.col("__state"))
    crossing = crossing_keys(rows, [key])
    summary = (
        rows.join(crossing, same_keys(rows, crossing, [key]), "left_semi")
        .groupBy(key, SEGMENT)
        .agg(
            F.min_by("__state", PLACE).alias("__first"),
            F.max_by("__state", PLACE).alias("__last"),
            F.min(at).alias("__first_at"),
            F.max(F.when(inner_open, F.col(at))).alias("__inner_start"),
        )
    )
    by_segment = Window.partitionBy(key).orderBy(SEGMENT)
    linked = summary.withColumn("__edge_before", F.lag("__last").over(by_segment))
    first_opens = F.col("__edge_before").isNull() | ~F.col("__edge_before").eqNullSafe(F.col("__first"))
    last_start = F.coalesce("__inner_start", F.when(first_opens, F.col("__first_at")))
    earlier = by_segment.rowsBetween(Window.unboundedPreceding, -1)
    return linked.select(
        key,
        SEGMENT,
        "__edge_before",
        F.lead("__first").over(by_segment).alias("__edge_after"),
        F.lead("__first_at").over(by_segment).alias("__edge_next_at"),
        F.last(last_start, ignorenulls=True).over(earlier).alias("__edge_start"),
    )


def valid_at(history: DataFrame, moment, start: str = START, stop: str = STOP) -> DataFrame:
    """Versions valid at one moment (half-open interval)."""
    return history.filter((F.col(start) <= moment) & (F.col(stop) > moment))


def fan_out_sides(df: DataFrame, sides: dict[str, str], side: str = "side", member: str = "member") -> DataFrame:
    """One row per side of a record; when both sides name the same member it appears once."""
    entries, earlier = [], []
    for label, column in sides.items():
        entry = F.struct(F.lit(label).alias(side), F.col(column).alias(member))
        repeated = F.lit(False)
        for c in earlier:
            repeated = repeated | F.col(column).eqNullSafe(F.col(c))
        entries.append(F.when(~repeated, entry))
        earlier.append(column)
    return df.withColumn("__side", F.explode(F.array_compact(F.array(*entries)))).select(
        *df.columns, F.col(f"__side.{side}").alias(side), F.col(f"__side.{member}").alias(member)
    )


def as_of_versions(
    facts: DataFrame,
    history: DataFrame,
    at: str,
    sides: dict[str, str],
    member: str,
    start: str = START,
    stop: str = STOP,
    bounded: bool = False,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Facts with the version of each side's member that is valid at the fact's moment, where versions of a member do not overlap.

    The distinct (member, moment) pairs of the facts and the starts of the versions are put in one order, and the last
    version is carried forward: nothing is multiplied by the length of a version.  The pairs collapse before the
    shuffle, so a member with many facts at a moment comes once; the facts then join by (member, moment).
    The ordered rows of a member are cut into segments, with the version carried over each cut as one row.
    ``bounded`` says that a member cannot have many moments and versions (one per calendar day, say), so that they need none.
    Of versions with the same start the greatest one counts.
    """
    spread = fan_out_sides(facts, sides, side="side", member=member)
    others = [c for c in history.columns if c != member]
    clash = [c for c in others if c in spread.columns]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    version = F.struct(*others)
    moments = spread.select(member, F.col(at).alias("__at")).filter(F.col(member).isNotNull() & F.col("__at").isNotNull()).distinct()
    starts = history.filter(F.col(member).isNotNull()).select(member, F.col(start).cast(facts.schema[at].dataType).alias("__at"), version.alias("__version"))
    lines = starts.unionByName(moments, allowMissingColumns=True)
    # a version counts from its start on, so it comes before a fact of the same moment
    order = ["__at", "__late", "__version"]
    lines = lines.withColumn("__late", F.col("__version").isNull())
    rows = lines.withColumn(SEGMENT, F.lit(0)) if bounded else segmented(lines, [member], order, rows_per_segment)
    so_far = Window.partitionBy(member, SEGMENT).orderBy(*(order if bounded else [PLACE])).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__valid", F.last("__version", ignorenulls=True).over(so_far))
    if not bounded:
        crossing = crossing_keys(rows, [member])
        ends = rows.join(crossing, same_keys(rows, crossing, [member]), "left_semi").groupBy(member, SEGMENT).agg(
            F.max_by("__version", F.when(~F.col("__late"), F.col(PLACE))).alias("__end")
        )
        earlier = Window.partitionBy(member).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(member, SEGMENT, F.last("__end", ignorenulls=True).over(earlier).alias("__carried"))
        carried = renamed_keys(carried, [member, SEGMENT])
        rows = rows.join(carried, same_keys(rows, carried, [member, SEGMENT]), "left").withColumn("__valid", F.coalesce("__valid", "__carried"))
    valid = rows.filter(F.col("__late")).select(F.col(member).alias("__member"), "__at", "__valid.*")
    valid = valid.filter(F.col("__at") < F.col(stop))
    return spread.join(valid, (spread[member] == valid["__member"]) & (spread[at] == valid["__at"])).drop("__member", "__at")


# ranges of 8 ** 0 to 8 ** 6 buckets; a week's buckets reach over 5,000 years
_LEVELS = 7


def _covering(first: F.Column, last: F.Column) -> F.Column:
    """The fewest aligned ranges (level, number) that make up the buckets from ``first`` to ``last``."""

    def run(lo, hi):
        return F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<int>"))

    def named(level, found):
        return F.transform(found, lambda n: F.struct(F.lit(level).alias("level"), n.alias("number")))

    low = [F.shiftright(first + F.lit(8**level - 1), 3 * level) for level in range(_LEVELS)]
    high = [F.shiftright(last + 1, 3 * level) for level in range(_LEVELS)]
    pieces = []
    for level in range(_LEVELS):
        found = run(low[level], high[level])
        if level + 1 < _LEVELS:
            up_lo, up_hi = low[level + 1], high[level + 1]
            found = F.when(up_lo < up_hi, F.concat(run(low[level], up_lo * 8), run(up_hi * 8, high[level]))).otherwise(found)
        pieces.append(named(level, found))
    return F.concat(*pieces)


def join_valid_versions(
    facts: DataFrame,
    history: DataFrame,
    at: str,
    sides: dict[str, str],
    member: str,
    bucket_days: int = 7,
    start: str = START,
    stop: str = STOP,
) -> DataFrame:
    """Facts with every version that belongs to one of the fact's sides and is valid at the fact's date; versions may overlap.

    The "home or away" condition becomes one row per side.  A version's time is made up of a few aligned ranges of buckets, of
    8 ** n buckets each, and a fact lies in one range of every level, so the join is an equi-join on (member, level, range):
    a version open for ever has a few dozen rows, not one per bucket.  A pair meets in exactly one range, and fails the
    exact test only if the version changes inside the fact's bucket.
    """
    spread = fan_out_sides(facts, sides, side="side", member=member)
    clash = [c for c in history.columns if c in spread.columns and c != member]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")

    def bucket(moment):
        return F.floor(F.unix_date(F.col(moment).cast("date")) / F.lit(bucket_days)).cast("int")

    within = [F.struct(F.lit(level).alias("level"), F.shiftright(bucket(at), 3 * level).alias("number")) for level in range(_LEVELS)]
    spread = spread.withColumn("__range", F.explode(F.array(*within)))
    versions = history.withColumn("__range", F.explode(_covering(bucket(start), bucket(stop))))
    joined = spread.join(versions, [member, "__range"])
    return joined.filter((F.col(start) <= F.col(at)) & (F.col(at) < F.col(stop))).drop("__range")


def advance_history(
    opened: DataFrame, rows: DataFrame, key: str, at: str, tracked: Sequence[str], tie_break: Sequence[str] = (), start: str = START, stop: str = STOP, bounded: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Versions that new rows close, and the open versions after them.

    ``opened`` has the open version of each key, as :func:`build_history` makes it; ``rows`` are later than all that made it.  An open
    version counts as one observation at its start, so only the keys of ``rows`` are ordered anew; the other open versions
    pass through.  Closed versions never change again and can be appended where they are kept.
    """
    keys = rows.select(key).distinct()
    again = opened.join(keys, opened[key].eqNullSafe(keys[key]), "left_semi")
    seen = again.withColumn(at, F.col(start)).select(*rows.columns).union(rows)
    versions = materialise(build_history(seen, key, at, tracked, tie_break, start, stop, bounded), "advance")
    still = F.col(stop) == F.lit(OPEN_END).cast(versions.schema[stop].dataType)
    columns = [c for c in opened.columns]
    others = opened.join(keys, opened[key].eqNullSafe(keys[key]), "left_anti")
    return versions.filter(~still).select(*columns), others.unionByName(versions.filter(still).select(*columns))
