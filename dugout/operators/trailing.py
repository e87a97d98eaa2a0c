"""Trailing statistics that never look at the as-of day or past the turn of the year."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.baseball import FIP_CONSTANT, WOBA_WEIGHTS
from ..functions.score import guarded_ratio, ratio

AGGREGATES = ("avg", "std", "var", "l1norm", "l2norm", "cov")


_NEEDS = {"avg": "s", "std": "sq", "var": "sq", "l1norm": "a", "l2norm": "q", "cov": "sq"}


def daily_moments(
    facts: DataFrame, key: str, day: str, stats: Sequence[str], moments: str = "sqa", extra: Sequence[Column] = (), scales: Mapping[str, float] | None = None
) -> DataFrame:
    """Count and the wanted moments (s: sum, q: sum of squares, a: sum of magnitudes) per key and day, all of integers.

    A measure in ``scales`` is a decimal that times its scale is an integer (3 for thirds, 100 for cents).

    This runs before any window, so the window sees at most one row per key and calendar day however
    many facts a key has.  ``extra`` are further aggregates of the same pass.
    """
    parts = [F.count(F.lit(1)).alias("__n")]
    for s in stats:
        x = F.round(F.col(s) * F.lit(float(scales[s]))).cast("bigint") if scales and s in scales else F.col(s).cast("bigint")
        # sums of cents fit a long; sums of their squares do not
        wide = x.cast("decimal(19,0)")
        made = {"s": F.sum(x), "q": F.sum((wide * wide).cast("decimal(38,0)")).cast("decimal(38,0)"), "a": F.sum(F.abs(x))}
        parts += [made[m].alias(f"__{m}_{s}") for m in moments]
    return facts.groupBy(key, day).agg(*parts, *extra)


def with_as_of_days(daily: DataFrame, calendar: DataFrame, key: str, day: str) -> DataFrame:
    """Daily rows plus an empty row for every calendar day after the key's first fact of the year.

    The calendar has at most 366 days per year, so it travels as one array per year and is broadcast.
    The rows it adds come out of the first daily row of each key and year, so the daily table is
    read and shuffled once, and the rows are already where the window over (key, year) needs them.
    """
    years = (
        calendar.select(F.col(day).alias("__d"))
        .distinct()
        .groupBy(F.year("__d").alias("__year"))
        .agg(F.collect_set("__d").alias("__days"))
    )
    measures = [c for c in daily.columns if c not in (key, day)]
    by_year = Window.partitionBy(key, "__year").orderBy(day)
    ranked = daily.withColumn("__year", F.year(day)).withColumn("__rn", F.row_number().over(by_year))

    def row(d, added: bool):
        return F.struct(d.alias("d"), F.lit(added).alias("asof"))

    later = F.transform(F.filter("__days", lambda d: d > F.col(day)), lambda d: row(d, True))
    own = F.array(row(F.col(day), False))
    out = F.when(F.col("__rn") == 1, F.concat(own, later)).otherwise(own)
    opened = ranked.join(F.broadcast(years), "__year").withColumn("__row", F.explode(out))
    is_added = F.col("__row.asof")
    return opened.select(
        key, "__year", F.col("__row.d").alias(day), is_added.alias("__asof"),
        *[F.when(~is_added, F.col(m)).alias(m) for m in measures],
    )


def trailing_sums(
    daily: DataFrame, key: str, day: str, windows: Sequence[int | str], calendar: DataFrame
) -> DataFrame:
    """Moments of each window for every as-of day, all from one sort per key and year."""
    measures = [c for c in daily.columns if c not in (key, day)]
    both = with_as_of_days(daily, calendar, key, day).withColumn("__t", F.unix_date(day))
    ordered = Window.partitionBy(key, "__year").orderBy("__t")
    before = ordered.rangeBetween(Window.unboundedPreceding, -1)
    columns = []
    for w in windows:
        if w == "SEASON":
            columns += [F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}@{w}") for m in measures]
        else:
            # a difference of two running sums takes one step per row for any window length
            older = ordered.rangeBetween(Window.unboundedPreceding, -int(w) - 1)
            for m in measures:
                total = F.coalesce(F.sum(m).over(before), F.lit(0)) - F.coalesce(F.sum(m).over(older), F.lit(0))
                columns.append(total.alias(f"{m}@{w}"))
    return both.select(key, day, "__asof", *columns).filter("__asof").drop("__asof")


def moment_columns(stat: str, window: int | str, scale: float, cov_mode: str) -> dict[str, Column]:
    """The six statistics of one measure from its moments; an empty window gives 0 everywhere."""
    n = F.col(f"`__n@{window}`")
    s, q, a = (F.col(f"`__{m}_{stat}@{window}`") for m in ("s", "q", "a"))
    unit = F.lit(float(scale))
    count = n.cast("double")
    wide = s.cast("decimal(19,0)")
    spread = (n.cast("decimal(19,0)") * q - wide * wide).cast("double")
    variance = F.coalesce(F.try_divide(spread, count * count), F.lit(0.0))
    mean = F.coalesce(F.try_divide(s.cast("double"), count), F.lit(0.0))
    std = F.sqrt(variance)
    if cov_mode == "literal":
        cov = F.when(std > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    else:
        cov = F.coalesce(F.try_divide(std, mean), F.lit(0.0))
    return {
        "avg": mean / unit,
        "std": std / unit,
        "var": variance / (unit * unit),
        "l1norm": a.cast("double") / unit,
        "l2norm": F.sqrt(q.cast("double")) / unit,
        "cov": cov,
    }


def trailing_stats(
    facts: DataFrame,
    key: str,
    day: str,
    stats: Sequence[str],
    windows: Sequence[int | str],
    calendar: DataFrame | None = None,
    aggregates: Sequence[str] = AGGREGATES,
    ratios=None,
    scales: Mapping[str, float] | None = None,
    scaled: bool = True,
    cov_mode: str = "ratio",
) -> DataFrame:
    """One wide row per key and as-of day: ``mv_<window>_<aggregate>_<stat>`` and ratio columns.

    A window is a number of days before the as-of day or ``"SEASON"`` (everything earlier in the same
    year).  Sums are of integers, so the result does not depend on the order of addition: measures are integers, or
    decimals that are integers times their ``scales``; with ``scaled`` they are scaled up already.
    ``ratios`` is a function from a dict of window sums to a dict of named columns.
    """
    calendar = facts.select(day) if calendar is None else calendar.select(day)
    moments = moments_for(aggregates, ratios)
    daily = daily_moments(facts, key, day, stats, moments, scales=None if scaled else scales)
    return trailing_from_daily(daily, key, day, stats, windows, calendar, aggregates, ratios, scales, cov_mode)


def moments_for(aggregates: Sequence[str], ratios=None) -> str:
    """The moments that statistics and ratios need."""
    needed = {m for a in aggregates for m in _NEEDS[a]} | ({"s"} if ratios is not None else set())
    return "".join(m for m in "sqa" if m in needed)


def trailing_from_daily(
    daily: DataFrame,
    key: str,
    day: str,
    stats: Sequence[str],
    windows: Sequence[int | str],
    calendar: DataFrame,
    aggregates: Sequence[str] = AGGREGATES,
    ratios=None,
    scales: Mapping[str, float] | None = None,
    cov_mode: str = "ratio",
) -> DataFrame:
    """:func:`trailing_stats` of moments that are already there, one row per key and day."""
    scales = scales or {}
    wanted = ["__n", *[f"__{m}_{s}" for s in stats for m in moments_for(aggregates, ratios)]]
    sums = trailing_sums(daily.select(key, day, *wanted), key, day, windows, calendar.select(day))
    columns = []
    for w in windows:
        for s in stats if aggregates else ():
            made = moment_columns(s, w, scales.get(s, 1.0), cov_mode)
            columns += [made[a].alias(f"mv_{w}_{a}_{s}") for a in aggregates]
        if ratios is not None:
            totals = {s: F.col(f"`__s_{s}@{w}`").cast("double") / F.lit(float(scales.get(s, 1.0))) for s in stats}
            columns += [c.alias(f"mv_{w}_{name}") for name, c in ratios(totals).items()]
    return sums.select(key, day, *columns)


def hitter_ratios(t: Mapping[str, Column]) -> dict[str, Column]:
    """Slugging, on-base, on-base plus slugging and weighted on-base from window sums."""
    bases = t["_1b"] + t["_2b"] * 2 + t["_3b"] * 3 + t["hr"] * 4
    slugging = guarded_ratio(bases, t["ab"])
    chances = t["ab"] + t["bb"] + t["hbp"]
    obp = guarded_ratio(t["_1b"] + t["_2b"] + t["_3b"] + t["hr"] + t["bb"] + t["hbp"], chances)
    weighted = sum((t[k] * F.lit(w) for k, w in WOBA_WEIGHTS.items()), F.lit(0.0))
    return {"slugging": slugging, "obp": obp, "ops": obp + slugging, "woba": ratio(weighted, chances)}


def pitcher_ratios(t: Mapping[str, Column]) -> dict[str, Column]:
    """Walks plus hits, balls in play, per-nine rates, fielding-independent pitching, shares of batters."""
    innings, faced = t["innings_pitched"], t["batters_faced"]
    independent = t["hr"] * 13.0 + t["num_walks"] * 3.0 - t["strikeouts"] * 2.0
    return {
        "whip": guarded_ratio(t["num_walks"] + t["num_hits"], innings),
        "babip": guarded_ratio(t["num_hits"] - t["hr"], faced - t["strikeouts"] - t["hr"]),
        "k_per_nine": guarded_ratio(t["strikeouts"] * 9.0, innings),
        "bb_per_nine": guarded_ratio(t["num_walks"] * 9.0, innings),
        "fip": F.when(innings > 0, independent / innings + F.lit(FIP_CONSTANT)).otherwise(F.lit(0.0)),
        "k_percent": guarded_ratio(t["strikeouts"], faced),
        "k_bb": guarded_ratio(t["num_walks"], faced),
    }


def interval_join_sums(
    facts: DataFrame, key: str, day: str, stats: Sequence[str], windows: Sequence[int], as_of: DataFrame, moment: str | None = None
) -> DataFrame:
    """Window sums for a few as-of days only, without a spine: each fact goes to the days it counts for.

    Meant for a forecast run, where the as-of days are one or two dates.  Only facts within the longest window
    of those days are read; ``moment`` names the stored timestamp that ``day`` was made of, so that the scan can
    skip the others.
    """
    horizon = max(int(w) for w in windows)
    first, last = as_of.agg(F.min(day), F.max(day)).first()
    if first is None:
        first = last = date(1970, 1, 1)
    lower, upper = first - timedelta(days=horizon), last
    if moment:
        kind = facts.schema[moment].dataType
        facts = facts.filter((F.col(moment) >= F.lit(str(lower)).cast(kind)) & (F.col(moment) < F.lit(str(upper)).cast(kind)))
    daily = daily_moments(facts.filter(F.col(day).between(F.lit(lower), F.lit(upper))), key, day, stats)
    days = as_of.select(F.col(day).alias("__asof")).distinct()
    reach = days.select("__asof", F.explode(F.sequence(F.date_sub("__asof", horizon), F.date_sub("__asof", 1))).alias(day))
    hit = daily.join(reach, day).filter(F.year(day) == F.year("__asof"))
    sums = []
    for w in windows:
        inside = F.datediff("__asof", day) <= F.lit(int(w))
        for s in stats:
            sums.append(F.coalesce(F.sum(F.when(inside, F.col(f"__s_{s}"))), F.lit(0)).alias(f"sum_{w}_{s}"))
    return hit.groupBy(key, F.col("__asof").alias(day)).agg(*sums)


def sweep_sums(
    facts: DataFrame, key: str, day: str, stats: Sequence[str], windows: Sequence[int], first: date, last: date, moment: str | None = None
) -> DataFrame:
    """Window sums for every as-of day from ``first`` to ``last``, for keys with a fact in the longest window of the same year.

    A fact adds its value on the day after it and takes it away again a day after the window, or at the turn of the
    year.  One running sum over these changes gives all days: no fact meets an as-of day, and a key and year have a few
    rows per calendar day however many facts there are.  Between two changes the sums stand still, so days come out of
    a step only at the end.  ``moment`` names the stored timestamp that ``day`` was made of, so that the scan can skip others.
    """
    lower = max(first - timedelta(days=max(int(w) for w in windows)), date(first.year, 1, 1))
    if moment:
        kind = facts.schema[moment].dataType
        facts = facts.filter((F.col(moment) >= F.lit(str(lower)).cast(kind)) & (F.col(moment) < F.lit(str(last)).cast(kind)))
    daily = daily_moments(facts.filter((F.col(day) >= F.lit(lower)) & (F.col(day) < F.lit(last))), key, day, stats, "s")
    names = ["n", *[f"{w}_{s}" for w in windows for s in stats]]
    values = {"n": F.col("__n")} | {f"{w}_{s}": F.col(f"__s_{s}") for w in windows for s in stats}
    turn = F.make_date(F.year(day) + 1, F.lit(1), F.lit(1))

    def change(at, sign: int, window: int | None):
        longest = window == max(windows)
        own = [n for n in names if window is None or n.startswith(f"{window}_") or n == "n" and longest]
        zero = F.lit(0).cast("bigint")
        return F.struct(at.alias("at"), *[(values[n].cast("bigint") * sign if n in own else zero).alias(n) for n in names])

    changes = [change(F.date_add(day, 1), 1, None)] + [change(F.least(F.date_add(day, int(w) + 1), turn), -1, w) for w in windows]
    moved = daily.select(key, F.year(day).alias("__year"), F.explode(F.array(*changes)).alias("c")).select(key, "__year", "c.*")
    moved = moved.groupBy(key, "__year", "at").agg(*[F.sum(n).alias(n) for n in names])
    order = Window.partitionBy(key, "__year").orderBy("at")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    steps = moved.select(key, "at", F.lead("at").over(order).alias("until"), *[F.sum(n).over(running).alias(n) for n in names]).filter("n > 0")
    begin, end = F.greatest("at", F.lit(first)), F.least(F.date_sub("until", 1), F.lit(last))
    steps = steps.withColumn(day, F.explode(F.when(begin <= end, F.sequence(begin, end))))
    return steps.select(key, day, *[F.col(f"{w}_{s}").alias(f"sum_{w}_{s}") for w in windows for s in stats])
