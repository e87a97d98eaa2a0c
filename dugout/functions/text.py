"""Text helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PAGE = 256
_LINEUP = r"^(\d+)\. (.+) \(([^)]*)\) (\S+)$"


def count_matches(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("bigint")


def decode_base64(text: Column) -> Column:
    return F.unbase64(text).cast("string")


def magnitude(number: Column) -> Column:
    """Three decimals and a unit letter: 1500 becomes ``1.500k``; above the last unit it is null."""
    value = number.cast("double")
    chain = None
    for power, unit in enumerate(("", "k", "M", "B", "T")):
        scale = 1000.0**power
        shown = F.format_string("%.3f" + unit, value / F.lit(scale))
        chain = (F if chain is None else chain).when(value < F.lit(scale * 1000.0), shown)
    return chain


def parse_lineup(line: Column) -> Column:
    """``8. First Last (L) 2B`` as a struct of order, name, side and position; null when it is no such line."""
    fields = F.struct(
        F.regexp_extract(line, _LINEUP, 1).cast("int").alias("order"),
        F.regexp_extract(line, _LINEUP, 2).alias("name"),
        F.regexp_extract(line, _LINEUP, 3).alias("side"),
        F.regexp_extract(line, _LINEUP, 4).alias("position"),
    )
    return F.when(line.rlike(_LINEUP), fields)


def replacement_candidates(name: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """The name itself followed by one spelling per replacement pair, in order."""
    return F.array(name, *[F.replace(name, F.lit(old), F.lit(new)) for old, new in pairs])


def splice_starts(items: Column, budget: int) -> Column:
    """Start indexes of greedy runs of consecutive items whose total length fits the budget.

    Breaks are gathered in pages of ``_PAGE``, so a break copies one page at most and the cost stays linear.
    """
    def state(pages, page, used, at):
        return F.struct(pages.alias("pages"), page.alias("page"), used.alias("used"), at.alias("at"))

    def step(acc, item):
        size, following = F.length(item), acc["at"] + F.lit(1)
        full = F.size(acc["page"]) >= F.lit(_PAGE)
        return (
            F.when(acc["used"] + size <= F.lit(budget), state(acc["pages"], acc["page"], acc["used"] + size, following))
            .when(full, state(F.concat(acc["pages"], F.array(acc["page"])), F.array(acc["at"]), size, following))
            .otherwise(state(acc["pages"], F.concat(acc["page"], F.array(acc["at"])), size, following))
        )

    start = state(F.array().cast("array<array<int>>"), F.array(F.lit(0)), F.lit(0), F.lit(0))
    return F.aggregate(items, start, step, lambda acc: F.concat(F.flatten(acc["pages"]), acc["page"]))


def splice(items: Column, budget: int) -> Column:
    """Index runs of a greedy split of an array of texts by a character budget.

    An item longer than the budget stands alone; if it is the first one, an empty run precedes it.
    """
    starts = splice_starts(items, budget)
    stops = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(items)))
    return F.zip_with(
        starts,
        stops,
        lambda a, b: F.when(b > a, F.sequence(a, b - F.lit(1))).otherwise(F.array().cast("array<int>")),
    )
