"""Best selections under a budget and a per-team limit.

The candidate set of a search is small by construction: :func:`prune_candidates` keeps a fixed number
of players per (position, cost).  What explodes is the number of combinations.  A search makes one exact pass:

* The best candidate per position and cost comes to the driver: positions x cap / unit rows.  They give upper bounds for each
  budget, and a beam over them, a few legal partial rosters per cost, finds enough legal rosters to set a score floor.
* The slots are divided into two halves.  Each half is built slot by slot, dropping every partial roster that cannot reach the
  floor with the best of all other slots within the budget left.
* A half roster meets those of the other half under the budget it leaves, and only where the best it
  can meet there reaches the floor.

The tests are exact, so nothing that belongs to the result is lost.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import baseball as rules
from ..session import materialise
from .joins import lookup
from .rollup import best_per_cost
from .topk import top_k_by_group

# legal partial rosters a beam keeps per cost
BEAM = 8
_IMPOSSIBLE = np.iinfo(np.int64).min // 4


def with_points(eligible: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Eligible players with their points; a player without statistics has 0."""
    return lookup(eligible, stats, keys, {"points": 0})


def prune_candidates(
    players: DataFrame, k: Mapping[str, int] | None = None, tie_break: Sequence = (), default_k: int = 1
) -> DataFrame:
    """The best players per (position, cost), by points, then the tie-break columns, then player."""
    order = [F.desc("points"), *tie_break, F.asc("player")]
    return top_k_by_group(players, "position", ["position", "cost"], order, dict(k or {}), default_k).drop("rn")


def search_space(candidates: DataFrame, slots: Sequence[str]) -> DataFrame:
    """Candidates and number of choices per position; the product of the choices is the search space."""
    need = {p: slots.count(p) for p in slots}
    n = F.col("n_candidates").cast("decimal(38,0)")
    choices = None
    for position, picks in need.items():
        ways, divisor = F.lit(1).cast("decimal(38,0)"), 1
        for i in range(picks):
            ways = (ways * (n - F.lit(i))).cast("decimal(38,0)")
            divisor *= i + 1
        ways = (ways / F.lit(divisor)).cast("bigint")
        choices = (F if choices is None else choices).when(F.col("position") == position, ways)
    return (
        candidates.filter(F.col("position").isin(*need))
        .groupBy("position")
        .agg(F.count(F.lit(1)).alias("n_candidates"))
        .withColumn("n_choices", choices)
    )


def search_total(candidates: DataFrame, slots: Sequence[str]) -> DataFrame:
    """One row: the number of combinations, as the product of the choices; 0 if a position has no candidate."""
    choices = search_space(candidates, slots).agg(F.product(F.col("n_choices").cast("double")).alias("p"), F.count(F.lit(1)).alias("n"))
    return choices.select(F.when(F.col("n") == len(set(slots)), F.col("p")).otherwise(F.lit(0.0)).alias("total"))


def as_groups(candidates: DataFrame) -> DataFrame:
    """Candidates with arrays of players and teams: a single player is a group of one."""
    if "players" in candidates.columns:
        return candidates.select("position", "players", "teams", "cost", "points")
    return candidates.select("position", F.array("player").alias("players"), F.array("team").alias("teams"), "cost", "points")


def number_candidates(candidates: DataFrame) -> DataFrame:
    """Rank inside each position (``cid``), by points; stored, as a search reads it often.  The candidates must be pruned ones."""
    # pruning leaves a fixed number of rows per position and cost
    rank = F.row_number().over(Window.partitionBy("position").orderBy(F.desc("points"), "players"))
    return materialise(as_groups(candidates).withColumn("cid", rank), "candidates")


_PICK = ("players", "teams", "cost", "points", "cid")


def _with_budget(picks: DataFrame, cap: int, unit: int) -> DataFrame:
    """Partial rosters with the budget they have left, in units; those over the cap are dropped."""
    left = ((F.lit(cap) - F.col("cost")) / F.lit(unit)).cast("int")
    return picks.filter(F.col("cost") <= cap).select(*_PICK, left.alias("left"))


def _menu(pool: DataFrame, cap: int, unit: int, reach: np.ndarray | None = None) -> DataFrame:
    """What each budget can buy: a candidate appears under every budget that pays for it.

    This turns "fits into the budget" into an equality, so partial rosters only meet candidates they
    can pay.  With ``reach`` (most points for each budget left afterwards) a row also tells the most
    points the roster can gain from here on.
    """
    grid = cap // unit
    price = (F.col("cost") / F.lit(unit)).cast("int")
    rows = pool.filter(F.col("cost") <= cap).withColumn("left", F.explode(F.sequence(price, F.lit(grid))))
    gain = F.lit(None).cast("bigint")
    if reach is not None:
        later = F.from_json(F.lit(json.dumps(reach.tolist())), "array<bigint>")
        gain = F.col("points") + F.get(later, F.col("left") - price)
    return rows.select("left", gain.alias("gain"), price.alias("price"), *[F.col(c).alias(f"n_{c}") for c in _PICK])


def _extend(out: DataFrame, menu: DataFrame, cap: int, wanted=None) -> DataFrame:
    """Add one affordable candidate to each partial roster where ``wanted`` holds.

    Units round down, so the join never misses a candidate; the exact cost decides.  How to join is left to Spark, which
    knows the size of the menu and splits the rosters with the same money left.
    """
    fits = F.col("cost") + F.col("n_cost") <= cap
    joined = out.join(menu, "left")
    return joined.filter(fits if wanted is None else fits & wanted).select(
        F.concat("players", "n_players").alias("players"),
        F.concat("teams", "n_teams").alias("teams"),
        (F.col("cost") + F.col("n_cost")).alias("cost"),
        (F.col("points") + F.col("n_points")).alias("points"),
        F.col("n_cid").alias("cid"),
        (F.col("left") - F.col("price")).alias("left"),
    )


def combinations(candidates: DataFrame, position: str, picks: int, cap: int, unit: int = 100) -> DataFrame:
    """Unordered selections of ``picks`` different candidates of one position that the cap pays for.

    Built by extension in rank order; the candidate table must be a pruned one.
    """
    pool = number_candidates(candidates.filter(F.col("position") == position))
    menu = _menu(pool, cap, unit)
    out = _with_budget(pool, cap, unit)
    for _ in range(picks - 1):
        out = _extend(out, menu, cap, F.col("n_cid") > F.col("cid"))
    return out.drop("left")


def join_position(groups: DataFrame, candidates: DataFrame, position: str, cap: int, unit: int = 100) -> DataFrame:
    """Groups with one more candidate of a position, as far as the cap pays for both."""
    pool = number_candidates(candidates.filter(F.col("position") == position))
    menu = _menu(pool, cap, unit)
    return _extend(_with_budget(groups, cap, unit), menu, cap).drop("left", "cid")


def precombine(
    candidates: DataFrame, single: str, repeated: str, picks: int, cap: int, name: str, unit: int = 100
) -> DataFrame:
    """One candidate of a position with several of another as new candidates, only the best per total cost.

    This ignores the team limit, so a legal roster may hide behind one that is not; use it only where
    that shortcut is wanted.  ``n_skipped`` counts the groups a kept one stands for.
    """
    groups = join_position(combinations(candidates, repeated, picks, cap, unit), candidates, single, cap, unit)
    return best_per_cost(groups, ["cost"], "points", ["players"]).withColumn("position", F.lit(name))


def largest_team(teams) -> F.Column:
    """Number of members the most frequent team has."""
    return F.array_max(F.transform(teams, lambda t: F.size(F.filter(teams, lambda u: u == t))))


def roster_counters(rosters: DataFrame, cap: int, team_limit: int) -> DataFrame:
    """How many rosters there are, are over the cap, break the team limit, or are legal."""
    over = F.col("cost") > cap
    crowded = largest_team(F.col("teams")) > team_limit
    return rosters.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(over).alias("n_over_cap"),
        F.count_if(~over & crowded).alias("n_illegal"),
        F.count_if(~over & ~crowded).alias("n_legal"),
    )


@dataclass(frozen=True)
class _Offer:
    """The best candidate of a position and cost, in units."""

    cost: int
    points: int
    teams: tuple


@dataclass(frozen=True)
class _Bounds:
    """Most points the slots from a given one on can add for each remaining budget."""

    table: list[np.ndarray]
    unit: int
    offers: Mapping[str, list[_Offer]]

    @property
    def best(self) -> int:
        return int(self.table[0][-1])

    def turned(self, slots: Sequence[str]) -> _Bounds:
        """The bounds for other slots or another order of them."""
        return _suffix_bounds(self.offers, slots, len(self.table[0]) - 1, self.unit)


def _suffix_bounds(offers: Mapping[str, list[_Offer]], slots: Sequence[str], grid: int, unit: int) -> _Bounds:
    tables = [np.zeros(grid + 1, dtype=np.int64)]
    for slot in reversed(slots):
        after = tables[0]
        here = np.full(grid + 1, _IMPOSSIBLE, dtype=np.int64)
        for offer in offers.get(slot, []):
            here[offer.cost :] = np.maximum(here[offer.cost :], np.maximum(after[: grid + 1 - offer.cost] + offer.points, _IMPOSSIBLE))
        tables.insert(0, here)
    return _Bounds(tables, unit, offers)


def _bounds(candidates: DataFrame, slots: Sequence[str], cap: int, unit: int) -> _Bounds:
    """Suffix bounds from the best candidate per (position, cost).

    Costs lie on a grid below the cap, so the collected table has at most ``positions * cap / unit`` rows.
    """
    rows = (
        candidates.filter((F.col("cost") <= cap) & F.col("position").isin(*set(slots)))
        .groupBy("position", "cost")
        .agg(F.max("points").alias("points"), F.min_by("teams", "cid").alias("teams"))
        .collect()
    )
    offers: dict[str, list[_Offer]] = {}
    for r in rows:
        if r["cost"] % unit or r["cost"] < 0:
            raise ValueError(f"cost {r['cost']} is not a multiple of {unit}")
        offers.setdefault(r["position"], []).append(_Offer(r["cost"] // unit, r["points"], tuple(r["teams"])))
    return _suffix_bounds(offers, slots, cap // unit, unit)


def _beam_points(bounds: _Bounds, slots: Sequence[str], team_limit: int, width: int) -> list[int]:
    """Points of some legal rosters, best first: of partial ones, slot by slot, the best few per cost are kept."""
    grid = len(bounds.table[0]) - 1
    states = [(0, 0, -1, ())]
    for i, slot in enumerate(slots):
        again = i > 0 and slots[i - 1] == slot
        per_cost: dict[int, list] = {}
        for points, cost, last, teams in states:
            for at, offer in enumerate(bounds.offers.get(slot, [])):
                left = grid - cost - offer.cost
                if again and at <= last or left < 0 or bounds.table[i + 1][left] <= _IMPOSSIBLE // 2:
                    continue
                kept = per_cost.setdefault(grid - left, [])
                gained = points + offer.points
                if len(kept) == width and gained <= kept[-1][0]:
                    continue
                together = teams + offer.teams
                if all(together.count(t) <= team_limit for t in offer.teams):
                    kept.append((gained, grid - left, at, together))
                    kept.sort(key=lambda state: -state[0])
                    del kept[width:]
        states = [state for kept in per_cost.values() for state in kept]
    return sorted((state[0] for state in states), reverse=True)


def _half(
    candidates: DataFrame, slots: Sequence[str], picked: int, cap: int, team_limit: int, floor: int | None, bounds: _Bounds
) -> DataFrame:
    """Legal picks for the first ``picked`` slots that can still reach the floor; all of them without a floor.

    ``candidates`` must be numbered.  Each step is an equi-join on the budget left with the menu of the next slot.
    """
    unit = bounds.unit

    def reaches(points, left, after):
        best = F.get(F.from_json(F.lit(json.dumps(after.tolist())), "array<bigint>"), left)
        return points + best >= F.lit(_IMPOSSIBLE // 2 if floor is None else floor)

    out = _with_budget(candidates.filter(F.col("position") == slots[0]), cap, unit)
    out = out.filter(reaches(F.col("points"), F.col("left"), bounds.table[1]) & (largest_team(F.col("teams")) <= team_limit))
    for i, slot in enumerate(slots[1:picked], start=1):
        menu = _menu(candidates.filter(F.col("position") == slot), cap, unit, bounds.table[i + 1])
        wanted = F.col("points") + F.col("gain") >= F.lit(_IMPOSSIBLE // 2 if floor is None else floor)
        wanted = wanted & (largest_team(F.concat("teams", "n_teams")) <= team_limit)
        if slot == slots[i - 1]:
            wanted = wanted & (F.col("n_cid") > F.col("cid"))
        out = _extend(out, menu, cap, wanted)
    return out


def _middle(slots: Sequence[str]) -> int:
    """Where to divide the slots: near the middle, between two positions; all in one half if there is one position."""
    cuts = [i for i in range(1, len(slots)) if slots[i] != slots[i - 1]]
    return min(cuts, key=lambda i: abs(2 * i - len(slots)), default=len(slots))


def rosters_at_least(
    candidates: DataFrame, slots: Sequence[str], cap: int, team_limit: int, floor: int, bounds: _Bounds
) -> DataFrame:
    """All legal rosters with at least ``floor`` points, put together from two halves.

    ``candidates`` must be numbered.  The second half is built first of all slots, so its bound is the best of the
    others as well.  A second half is listed under a budget only where the best first half that leaves this budget
    reaches the floor with it, so few pairs meet that fail.
    """
    slots, unit = list(slots), bounds.unit
    cut = _middle(slots)
    first = _half(candidates, slots, cut, cap, team_limit, floor, bounds)
    if cut == len(slots):
        return first.select("players", "teams", "cost", "points")
    turned = slots[cut:] + slots[:cut]
    second = _half(candidates, turned, len(slots) - cut, cap, team_limit, floor, bounds.turned(turned))
    # the most points of a first half by the budget it leaves
    reach = bounds.turned(slots[:cut]).table[0][::-1]
    there = F.from_json(F.lit(json.dumps(reach.tolist())), "array<bigint>")
    price = (F.lit(cap // unit) - F.col("left")).cast("int")
    budgets = F.filter(F.sequence(price, F.lit(cap // unit)), lambda b: F.get(there, b) + F.col("points") >= F.lit(floor))
    listed = second.withColumn("left", F.explode(budgets)).select("left", *[F.col(c).alias(f"n_{c}") for c in ("players", "teams", "cost", "points")])
    fits = (F.col("cost") + F.col("n_cost") <= cap) & (F.col("points") + F.col("n_points") >= F.lit(floor))
    met = first.join(listed, "left").filter(fits & (largest_team(F.concat("teams", "n_teams")) <= team_limit))
    return met.select(
        F.concat("players", "n_players").alias("players"), F.concat("teams", "n_teams").alias("teams"),
        (F.col("cost") + F.col("n_cost")).alias("cost"), (F.col("points") + F.col("n_points")).alias("points"),
    )


def _search(candidates, slots, cap, team_limit, unit, enough: int, scores: bool = False, beam: int = BEAM) -> DataFrame:
    """All legal rosters as good as the ``enough``-th best one, or, with ``scores``, as the ``enough``-th best score.

    Rosters of the beam are legal, so what they set is never above the true floor; when they are too few, all are searched.
    """
    slots = list(slots)
    for a, b in zip(slots, slots[1:], strict=False):
        if a != b and b in slots[: slots.index(a)]:
            raise ValueError("slots of one position must be next to each other")
    pool = number_candidates(candidates)
    bounds = _bounds(pool, slots, cap, unit)
    if bounds.best <= _IMPOSSIBLE // 2:
        return _half(pool, slots, 1, cap, team_limit, None, bounds).select("players", "teams", "cost", "points").limit(0)
    known = _beam_points(bounds, slots, team_limit, beam)
    known = sorted(set(known), reverse=True) if scores else known
    floor = known[enough - 1] if len(known) >= enough else _IMPOSSIBLE // 2
    return rosters_at_least(pool, slots, cap, team_limit, floor, bounds)


def top_rosters(
    candidates: DataFrame,
    slots: Sequence[str] = rules.ROSTER_SLOTS,
    cap: int = rules.SALARY_CAP,
    team_limit: int = rules.TEAM_LIMIT,
    keep: int = rules.KEEP_ROSTERS,
    unit: int = 100,
) -> DataFrame:
    """The ``keep`` best legal rosters of the candidates, exact, ties broken by the player ids.

    Columns of ``candidates``: position, player (string), team, cost and points (integers; scale
    decimals up), or arrays ``players`` and ``teams`` for candidates that are groups.  Points may be
    negative.
    """
    found = _search(candidates, slots, cap, team_limit, unit, keep)
    ids = F.array_join("players", ",")
    ranked = found.select(ids.alias("players"), "cost", "points").orderBy(F.desc("points"), "players").limit(keep)
    place = Window.orderBy(F.desc("points"), "players")  # at most `keep` rows
    return ranked.withColumn("rank", F.row_number().over(place))


def top_score_histogram(
    candidates: DataFrame, slots: Sequence[str], cap: int, team_limit: int, scores: int = rules.KEEP_ROSTERS, unit: int = 100
) -> DataFrame:
    """Number of legal rosters for each of the highest scores, exact."""

    found = _search(candidates, slots, cap, team_limit, unit, scores, scores=True)
    return found.groupBy("points").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("points")).limit(scores)
