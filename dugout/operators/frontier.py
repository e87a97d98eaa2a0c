"""Selections by total cost and by team without listing them.

The number of selections of a few players from a pool explodes, but their costs lie on a grid.  A dynamic program over
(picks so far, last player, cost) carries the best selection of each state and the number of selections it stands for, so its rows
are bounded by picks x costs x players.  Counting under a team limit works team by team: a team's players alone
give a small table of counts by (picks per position, cost), and two such tables multiply into one; teams are merged
in pairs, so the number of rounds is the logarithm of the number of teams.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .roster import number_candidates

_CODE_BITS = 60


def _pool(candidates: DataFrame, slots: Sequence[str]) -> DataFrame:
    """Numbered candidates of the slots with ``name``, the rank of their players among those of the position."""
    by_name = Window.partitionBy("position").orderBy("players")
    pool = number_candidates(candidates.filter(F.col("position").isin(*set(slots))))
    # pruning leaves a fixed number of rows per position and cost
    return materialise(pool.withColumn("name", F.row_number().over(by_name).cast("bigint")), "pool")


def cost_frontier(candidates: DataFrame, slots: Sequence[str], cap: int) -> DataFrame:
    """Per total cost: the best selection (most points, then smallest players in slot order) and how many there are.

    Columns cost, points, players (array), n.  Slots of one position must be next to each other and take different
    candidates; the candidates must be pruned ones.  A state's selection is one number, the ranks of its players in
    slot order, so best and count are kept by plain sums and maxima; players are joined at the end.
    """
    slots = list(slots)
    pool = _pool(candidates, slots)
    counts = {r["position"]: r["n"] for r in pool.groupBy("position").agg(F.count(F.lit(1)).alias("n")).collect()}
    bits = _CODE_BITS // len(slots)
    if max(counts.values(), default=0) >= 1 << bits:
        raise ValueError(f"{len(slots)} picks are coded in {bits} bits each, too few for {max(counts.values())} candidates")
    shift, full = 1 << bits, (1 << _CODE_BITS) - 1
    wide = "decimal(38,0)"
    states = None
    for i, slot in enumerate(slots):
        offers = pool.filter(F.col("position") == slot).select("cid", F.col("cost").alias("c"), F.col("points").alias("p"), "name")
        if states is None:
            made = offers.select("cid", F.col("c").alias("cost"), F.col("p").alias("points"), F.col("name").alias("code"), F.lit(1).cast("bigint").alias("n"))
        else:
            after = F.col("cid") + 1 if slot == slots[i - 1] else F.lit(1)
            following = F.when(after <= counts.get(slot, 0), F.sequence(after, F.lit(counts.get(slot, 0))))
            made = states.withColumn("cid", F.explode(following)).join(offers, "cid").select(
                "cid", (F.col("cost") + F.col("c")).alias("cost"), (F.col("points") + F.col("p")).alias("points"), (F.col("code") * shift + F.col("name")).alias("code"), "n"
            )
        # a smaller code is a larger rest, so one maximum decides by points and then by players
        rank = F.col("points").cast(wide) * F.lit(full + 1).cast(wide) + (F.lit(full) - F.col("code")).cast(wide)
        last = i + 1 == len(slots) or slots[i + 1] != slot
        grouped = made.filter(F.col("cost") <= cap).groupBy(*([] if last else ["cid"]), "cost")
        best = grouped.agg(F.sum("n").alias("n"), F.max("points").alias("points"), F.max(rank.cast(wide)).alias("rank"))
        rest = F.col("rank") - F.col("points").cast(wide) * F.lit(full + 1).cast(wide)
        states = best.withColumn("code", F.lit(full) - rest.cast("bigint")).drop("rank")
        if last:
            states = states.withColumn("cid", F.lit(0))
    names = [(F.shiftright("code", bits * (len(slots) - 1 - i)).bitwiseAND(shift - 1)).alias("name") for i in range(len(slots))]
    out = states.select("cost", "points", "n", *[F.struct(F.lit(slot).alias("position"), name).alias(f"k{i}") for i, (slot, name) in enumerate(zip(slots, names))])
    for i in range(len(slots)):
        out = out.join(pool.select(F.struct("position", "name").alias(f"k{i}"), F.col("players").alias(f"players{i}")), f"k{i}")
    return out.select("cost", "points", F.concat(*[f"players{i}" for i in range(len(slots))]).alias("players"), "n")


def _digits(code: Column, positions: Sequence[str], radix: dict[str, int], place: dict[str, int]) -> list[Column]:
    return [F.floor(code / F.lit(place[p])).cast("bigint") % F.lit(radix[p]) for p in positions]


def count_rosters(candidates: DataFrame, slots: Sequence[str], cap: int, team_limit: int) -> DataFrame:
    """One row: how many selections there are, are over the cap, break the team limit, or are legal (n_total, ...).

    Candidates are single players with a team, pruned.  Selections within the cap and the team limit are counted by merging teams.
    """
    slots = list(slots)
    need = {p: slots.count(p) for p in slots}
    positions = list(need)
    pool = _pool(candidates, slots).withColumn("team", F.col("teams")[0])
    # digits twice as large as needed, so that adding two codes never carries
    radix = {p: 2 * need[p] + 1 for p in positions}
    place, at = {}, 1
    for p in positions:
        place[p], at = at, at * radix[p]
    unit_of = functools.reduce(lambda other, p: F.when(F.col("position") == p, F.lit(place[p])).otherwise(other), positions, F.lit(0))
    allowed = functools.reduce(lambda a, b: a & b, [d <= need[p] for d, p in zip(_digits(F.col("code"), positions, radix, place), positions)])
    by_team = Window.partitionBy("team").orderBy("position", "cid")
    teams = pool.select("team").distinct()
    numbered = teams.select("team", (F.row_number().over(Window.orderBy("team")) - 1).alias("t"))
    members = pool.filter(F.col("cost") <= cap).withColumns({"g": F.row_number().over(by_team), "own": unit_of.cast("bigint")}).join(numbered, "team")
    members = materialise(members.select("t", "g", "own", F.col("cost").alias("c")), "members")
    n_teams = teams.count()

    zero = F.lit(0).cast("bigint")
    empty = numbered.select("t", zero.alias("code"), zero.alias("cost"), F.lit(1).cast("bigint").alias("n"))
    states, tables = empty.withColumn("g", F.lit(0)), [empty]
    for _ in range(min(team_limit, len(slots))):
        other = members.select("t", F.col("g").alias("next"), "own", "c")
        more = states.join(other, "t").filter((F.col("next") > F.col("g")) & (F.col("cost") + F.col("c") <= cap))
        more = more.select("t", F.col("next").alias("g"), (F.col("code") + F.col("own")).alias("code"), (F.col("cost") + F.col("c")).alias("cost"), "n").filter(allowed)
        states = more.groupBy("t", "g", "code", "cost").agg(F.sum("n").alias("n"))
        tables.append(states.select("t", "code", "cost", "n"))
    merged = functools.reduce(lambda a, b: a.union(b), tables).groupBy("t", "code", "cost").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    while n_teams > 1:
        merged = materialise(merged, "teams")
        half = F.shiftright("t", 1).alias("t")
        one = merged.filter("t % 2 = 0").select(half, "code", "cost", "n")
        two = merged.filter("t % 2 = 1").select(half, F.col("code").alias("code2"), F.col("cost").alias("cost2"), F.col("n").alias("n2"))
        if n_teams % 2:  # the last team has no partner and meets an empty choice
            two = two.union(numbered.limit(1).select(F.lit(n_teams // 2).alias("t"), zero, zero, F.lit(1).cast("decimal(38,0)")))
        met = one.join(two, "t").filter(F.col("cost") + F.col("cost2") <= cap)
        met = met.select("t", (F.col("code") + F.col("code2")).alias("code"), (F.col("cost") + F.col("cost2")).alias("cost"), (F.col("n") * F.col("n2")).cast("decimal(38,0)").alias("n"))
        merged = met.filter(allowed).groupBy("t", "code", "cost").agg(F.sum("n").cast("decimal(38,0)").alias("n"))
        n_teams = (n_teams + 1) // 2
    whole = sum(need[p] * place[p] for p in positions)
    legal = merged.filter(F.col("code") == whole).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_legal"))
    every = cost_frontier(candidates, slots, 2**62).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_total"), F.coalesce(F.sum(F.when(F.col("cost") > cap, F.col("n"))), F.lit(0)).alias("n_over_cap")
    )
    names = ("n_total", "n_over_cap", "n_legal")
    both = every.unionByName(legal, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in names])
    return both.select("n_total", "n_over_cap", (F.col("n_total") - F.col("n_over_cap") - F.col("n_legal")).alias("n_illegal"), "n_legal")
