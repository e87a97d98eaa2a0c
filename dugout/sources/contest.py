"""Contest player lists and the eligibility rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import baseball as rules
from ..functions.rules import recode
from ..operators.resolve import literal_lookup
from ..operators.shape import conform
from . import schemas


def read_contest_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    rows = raw.select(
        F.col("Position").alias("position"), F.concat_ws(" ", "First Name", "Last Name").alias("name"),
        F.col("Game").alias("contest_game"), F.col("Team").alias("team"), F.col("Salary").alias("salary"),
        F.col("FPPG").alias("points"), F.col("Played").alias("num_games"),
        F.coalesce("Probable Pitcher", F.lit("")).alias("player_status"),
        F.coalesce("Injury Indicator", F.lit("")).alias("injury"),
    ).withColumn("team", F.coalesce(literal_lookup(F.col("team"), rules.CONTEST_TEAM_FIXES), F.col("team")))
    return conform(rows, schemas.CONTEST)


def positional_entries(json: Column) -> Column:
    """Map of entry key to its positional values as text, from an object of heterogeneous arrays."""
    return F.from_json(json, "map<string,array<string>>")


def read_contest_json(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.text(path, wholetext=True)
    e = docs.select(F.explode(positional_entries(F.col("value"))).alias("entry_key", "v"))
    names = ("position", "name", "contest_game", "contest_team", "id3", "salary", "points", "num_games", "flag", "player_status", "injury")
    flat = e.select("entry_key", *[F.get("v", i).alias(n) for i, n in enumerate(names)])
    rows = flat.withColumn("team", literal_lookup(F.col("contest_team"), rules.CONTEST_TEAM_IDS))
    return conform(rows, schemas.CONTEST)


def eligible_csv(
    position: Column, probable: Column, injury: Column, lineup_status: Column, active: Column
) -> Column:
    """Rules for the CSV list; ``lineup_status`` is null when the player is in no lineup list."""
    known = F.coalesce(lineup_status != "No Lineup", F.lit(False))
    pitcher = position == "P"
    no_start = probable == ""
    inactive = F.coalesce(active == "Inactive", F.lit(False))
    unknown_ok = ~(pitcher & no_start) & ~inactive & (injury == "")
    known_ok = F.when(pitcher, ~no_start).otherwise((lineup_status == "Starter") & (injury == ""))
    return F.when(known, known_ok).otherwise(unknown_ok)


def eligible_json(position: Column, code: Column, injury: Column, lineup_status: Column, active: Column) -> Column:
    """Rules for the JSON list, where the player status is a number."""
    known = F.coalesce(lineup_status != "No Lineup", F.lit(False))
    pitcher = position == "P"
    probable = code.isin(*rules.PROBABLE_CODES)
    inactive = F.coalesce(active == "Inactive", F.lit(False))
    unknown_ok = F.when(pitcher, probable).otherwise(code == rules.HITTER_OPEN_CODE) & ~inactive
    known_ok = (pitcher & probable) | (lineup_status == "Starter")
    fit = (injury == "") & ~code.isin(*rules.INJURED_CODES)
    return F.when(known, known_ok).otherwise(unknown_ok) & fit


def merge_lineup(roster: DataFrame, lineup: DataFrame) -> DataFrame:
    """Roster rows (team, name, pos, active) marked by the lineup rows (team, name, position).

    A team without a lineup gets ``No Lineup`` for all; players only in the lineup are added.
    """
    posted = lineup.select("team").distinct().withColumn("posted", F.lit(True))
    chosen = lineup.select("team", "name", F.col("position").alias("lineup_pos")).withColumn("listed", F.lit(True))
    merged = roster.join(chosen, ["team", "name"], "full").join(posted, "team", "left")
    status = (
        F.when(F.col("listed"), "Starter").when(F.col("posted"), "Non-Starter").otherwise("No Lineup")
    )
    pos = F.coalesce(recode(F.col("lineup_pos"), rules.POSITION_GROUPS), F.col("pos"))
    return merged.select("team", "name", pos.alias("pos"), "active", status.alias("status"))
