"""Weather rows per game: work list, fallbacks, wind direction relative to the field."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import baseball as rules
from ..functions.timegeo import in_opposite_sector, in_sector
from .joins import missing_keys


def fill_fields(
    df: DataFrame, covered: Column, constants: Mapping[str, object], no_fallback: Sequence[str] = (), keep_when_covered: Sequence[str] = ()
) -> DataFrame:
    """Constants for covered places; elsewhere the observed value, or the constant where it is missing.

    ``no_fallback`` fields stay null when not observed; ``keep_when_covered`` fields keep an observed value.
    """
    out = {}
    for name, value in constants.items():
        seen, fixed = F.col(name), F.lit(value)
        outside = seen if name in no_fallback else F.coalesce(seen, fixed)
        inside = F.coalesce(seen, fixed) if name in keep_when_covered else fixed
        out[name] = F.when(covered, inside).otherwise(outside)
    return df.withColumns(out)


def wind_flags(df: DataFrame, bearing: str, axis: str, covered: Column) -> DataFrame:
    """Wind from the named bearing blows in or out along the axis; never under a cover."""
    flags = {
        "blowing_out": in_sector(F.col(bearing), F.col(axis), rules.SECTOR_HALF_WIDTH),
        "blowing_in": in_opposite_sector(F.col(bearing), F.col(axis), rules.SECTOR_HALF_WIDTH),
    }
    return df.withColumns({n: F.coalesce(~covered & c, F.lit(False)) for n, c in flags.items()})


def work_list(games: DataFrame, stadium: DataFrame, weather: DataFrame | None, now: Column, first_run: int | None = None) -> DataFrame:
    """Games to fetch weather for: those without any and today's games that have not begun.

    Without a weather table all games are listed, or the ``first_run`` latest ones if a number is given.
    """
    columns = ["game_id", "game_time_et", "latitude", "longitude", "has_dome", "center_azimuth"]
    placed = games.join(stadium, "stadium_id")
    if weather is None:
        listed = placed.select(*columns)
        return listed if first_run is None else listed.orderBy(F.desc("game_time_et"), "game_id").limit(first_run)
    fresh = placed.filter((F.col("game_time_et") > now) & (F.col("game_date") == F.to_date(now)))
    return missing_keys(placed, weather, ["game_id"]).select(*columns).unionByName(fresh.select(*columns)).distinct()


def weather_rows(listed: DataFrame, observations: DataFrame) -> DataFrame:
    """Weather table rows for listed games from a table of observations keyed by game.

    A game in the open without any observation gives no row and stays on the work list.
    """
    covered = F.col("has_dome") > 0
    seen = [c for c in rules.COVERED_WEATHER]
    observed = observations.select("game_id", *seen).withColumn("__seen", F.lit(True))
    joined = listed.join(observed, "game_id", "left").filter(covered | F.col("__seen"))
    filled = fill_fields(joined, covered, rules.COVERED_WEATHER, rules.NO_WEATHER_FALLBACK)
    flagged = wind_flags(filled, "windBearing", "center_azimuth", covered)
    return flagged.select("game_id", "game_time_et", *seen, "blowing_in", "blowing_out")
