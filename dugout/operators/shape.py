"""Projections that bring rows into a wanted shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.score import win_pct

_SUPPORTED = (
    T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DoubleType, T.BooleanType, T.DateType,
    T.TimestampType, T.TimestampNTZType,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast columns to a schema; blank text becomes null for every type but string, absent columns null.

    Other text that cannot be read as the type is an error.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if not isinstance(f.dataType, _SUPPORTED):
            raise TypeError(f"{f.name}: type {f.dataType.simpleString()} is not supported")
        if f.name not in types:
            value = F.lit(None)
        elif isinstance(types[f.name], T.StringType) and not isinstance(f.dataType, T.StringType):
            value = F.nullif(F.trim(f.name), F.lit(""))
        else:
            value = F.col(f.name)
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def select_except(df: DataFrame, skip: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    names = schema.fieldNames() if schema is not None else df.columns
    return df.select(*[c for c in names if c not in skip])


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def one_or_many(json: Column, element: str) -> Column:
    """Array of structs from JSON text that holds either one object or a list of objects."""
    return F.from_json(json, f"array<{element}>")


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Default for null; a default given as ``(value, "blank")`` also replaces empty text."""
    out = {}
    for name, value in defaults.items():
        current = F.col(name)
        if isinstance(value, tuple):
            value = value[0]
            current = F.nullif(current, F.lit(""))
        out[name] = F.coalesce(current, value if isinstance(value, Column) else F.lit(value))
    return df.withColumns(out)


def zero_fill(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null and NaN become 0 in numeric columns."""
    return df.na.fill(0.0, subset=list(columns) if columns else None)


def re_role(df: DataFrame, event: str, actor: str, pitcher_events: Sequence[str]) -> DataFrame:
    """Roles of rows that name one actor: pitcher for the listed events, batter otherwise; -1 for the other."""
    as_pitcher = F.col(event).isin(*pitcher_events)
    return df.withColumns(
        {
            "num": F.lit(-1),
            "pitcher": F.when(as_pitcher, F.col(actor)).otherwise(F.lit(-1)),
            "batter": F.when(as_pitcher, F.lit(-1)).otherwise(F.col(actor)),
        }
    )


def swap_perspective(
    df: DataFrame, is_home: Column, fields: Sequence[str], me: str = "player", other: str = "opponent"
) -> DataFrame:
    """``home_x`` / ``away_x`` pairs become ``player_x`` / ``opponent_x`` as seen from one side."""
    made = {}
    for f in fields:
        home, away = F.col(f"home_{f}"), F.col(f"away_{f}")
        made[f"{me}_{f}"] = F.when(is_home, home).otherwise(away)
        made[f"{other}_{f}"] = F.when(is_home, away).otherwise(home)
    return df.withColumns(made)


def game_features(df: DataFrame) -> DataFrame:
    """Calendar, league and both-sides columns of a player-game row; the home/away columns are consumed."""
    pct = df.withColumns(
        {
            "home_team_win_pct": win_pct(F.col("home_won"), F.col("home_loss")),
            "away_team_win_pct": win_pct(F.col("away_won"), F.col("away_loss")),
            "__home_division": F.concat_ws("_", "home_league", "home_division"),
            "__away_division": F.concat_ws("_", "away_league", "away_division"),
            "is_divisional": (
                (F.col("home_division") == F.col("away_division")) & (F.col("home_league") == F.col("away_league"))
            ).cast("int"),
            "is_cross_league": (F.col("home_league") != F.col("away_league")).cast("int"),
            "game_time_hour": F.split("home_time", ":").getItem(0).try_cast("int"),
            "game_time_month": F.month("game_time_et"),
            "game_weekday": F.weekday("game_time_et"),
            "isHome": F.col("team_id") == F.col("home_team_id"),
        }
    ).withColumnsRenamed({"home_abbrev": "home_team_abbrev", "away_abbrev": "away_team_abbrev"})
    pct = pct.drop("home_division", "away_division").withColumnsRenamed(
        {"__home_division": "home_division", "__away_division": "away_division"}
    )
    swapped = swap_perspective(
        pct, F.col("isHome"), ["team_id", "team_abbrev", "team_win_pct", "league", "division"]
    )
    sides = ("code", "team_abbrev", "name", "won", "loss", "division", "league", "team_id", "team_win_pct")
    used = [f"{s}_{c}" for s in ("home", "away") for c in sides]
    return swapped.drop("team_id", "game_time_et", "home_time", *used)
