"""Exact arithmetic helpers and weighted linear scores."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(column: Column | str, factor: int = 100) -> Column:
    """A fixed-point integer of a decimal-like double (cents by default).

    Sums of these are exact, so they do not depend on the order in which tasks add them.
    """
    return F.round(F.col(column) * factor if isinstance(column, str) else column * factor).cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` with 0 for a zero or missing denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """As :func:`ratio`, but also 0 when the denominator is negative."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double")).otherwise(F.lit(0.0))


def linear_score(weights: Mapping[str, float], available: list[str] | None = None) -> Column:
    """Weighted sum of columns; columns missing from ``available`` count as 0."""
    terms = [
        F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(weight))
        for name, weight in weights.items()
        if available is None or name in available
    ]
    return reduce(lambda a, b: a + b, terms, F.lit(0.0)) if terms else F.lit(0.0)


def win_pct(won: Column, lost: Column) -> Column:
    return ratio(won, won + lost)


def innings(outs: Column) -> Column:
    return outs.cast("double") / F.lit(3.0)
