"""Aggregations of classified events and of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import baseball as rules
from ..functions.rules import counter
from ..functions.score import linear_score
from ..functions.text import count_matches


def sum_counters(
    df: DataFrame, keys: Sequence[str], code: str, counters: Mapping[str, Mapping[str | None, int]], extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Per-key totals of per-code increments; partial sums are built before the shuffle."""
    sums = [F.sum(counter(F.col(code), table)).alias(name) for name, table in counters.items()]
    sums += [F.sum(c).alias(name) for name, c in (extra or {}).items()]
    return df.groupBy(*keys).agg(*sums)


def batting_rollup(events: DataFrame, keys: Sequence[str] = ("game_id", "batter"), code: str = "fd_batter_event", text: str = "des") -> DataFrame:
    """Counters and scores per game and batter.  A code without a rule is an error.

    All scores are linear in the counters, so they are computed once per row of the result.
    """
    name = F.col(code)
    known = name.isNull() | name.isin(*rules.KNOWN_BATTING_CODES)
    at_bat = F.when(name.isin(*rules.AT_BAT_EXEMPT), F.lit(0)).when(known, F.lit(1)).otherwise(
        F.raise_error(F.concat(F.lit("unhandled event code: "), name)).cast("int")
    )
    batted_in = counter(name, rules.RUN_BATTED_IN) + count_matches(F.col(text), rules.SCORING_PATTERN)
    totals = sum_counters(
        events.filter(F.col("batter") > 0),
        keys,
        code,
        rules.COUNTERS,
        {"ab": at_bat.cast("bigint"), "rbi": batted_in, "unclassified": name.isNull().cast("bigint")},
    )
    totals = totals.withColumn("out", F.col("ab") - F.col("total_hits"))
    scores = {"fd_points": linear_score(rules.BATTING_WEIGHTS)}
    scores |= {part: linear_score(weights) for part, weights in rules.BATTING_PART_WEIGHTS.items()}
    return totals.withColumns(scores)


def pitching_scores(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "fd_points": linear_score(rules.PITCHING_WEIGHTS),
            "non_win_fd_points": linear_score(rules.PITCHING_NON_WIN_WEIGHTS),
        }
    )


def played_hitters(df: DataFrame) -> DataFrame:
    """Drop empty stat lines."""
    return df.filter(~((F.col("ab") == 0) & (F.col("bb") == 0) & (F.col("fd_points") == 0)))


def played_pitchers(df: DataFrame) -> DataFrame:
    return df.filter(F.col("num_pitches") > 0)


def regression_error(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean squared and mean absolute error; a missing actual counts as 0."""
    miss = F.coalesce(F.col(actual).cast("double"), F.lit(0.0)) - F.col(predicted)
    return df.groupBy(*keys).agg(
        F.avg(miss * miss).alias("mse"), F.avg(F.abs(miss)).alias("mae"), F.count(F.lit(1)).alias("n")
    )


def exact_regression_error(df: DataFrame, actual: str, predicted: str, scale: float, keys: Sequence[str] = ()) -> DataFrame:
    """As :func:`regression_error` for scaled integers; sums are exact."""
    miss = (F.coalesce(F.col(actual), F.lit(0)) - F.col(predicted)).cast("decimal(19,0)")
    n = F.count(F.lit(1))
    squares = F.sum((miss * miss).cast("decimal(38,0)")).cast("double")
    return df.groupBy(*keys).agg(
        (squares / n.cast("double") / F.lit(scale * scale)).alias("mse"),
        (F.sum(F.abs(miss)).cast("double") / n.cast("double") / F.lit(scale)).alias("mae"),
        n.alias("n"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fetch_totals(log: DataFrame, keys: Sequence[str], ok: Column) -> DataFrame:
    """Fetched and failed counts per key and, with all keys null, in total."""
    return log.rollup(*keys).agg(
        F.sum(F.when(ok, 1).otherwise(0)).alias("n_ok"), F.sum(F.when(ok, 0).otherwise(1)).alias("n_failed")
    )


def fetch_failures(log: DataFrame, ok: Column) -> DataFrame:
    """The failed entries as rows; a list of them would grow without bound."""
    return log.filter(~ok)


def score_histogram(df: DataFrame, points: str, top: int, scale: float = 1.0) -> DataFrame:
    """Number of rows per score shown with two decimals, for the highest scores."""
    shown = F.format_string("%.2f", F.col(points).cast("double") / F.lit(float(scale)))
    return (
        df.groupBy(shown.alias("score"), F.col(points).alias("__p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("score")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.col("score").cast("double").desc())
        .limit(top)
    )


def best_per_cost(df: DataFrame, keys: Sequence[str], points: str, order: Sequence[str]) -> DataFrame:
    """Best row per key (points, then smallest order columns) and how many rows it stands for."""
    rest = [c for c in df.columns if c not in keys]
    negated = F.struct((-F.col(points)).alias("p"), *[F.col(c) for c in order])
    packed = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), negated).alias("__row"), (F.count(F.lit(1)) - 1).alias("n_skipped")
    )
    return packed.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest], "n_skipped")
