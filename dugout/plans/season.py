"""The daily jobs over a season's files, as functions from tables to tables.

Every stage reads stored tables and writes stored tables below one root folder, so a stage can be run
again on its own.  The order is: build tables, weather, moving averages, features, codes, models, contest.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import baseball as rules
from ..operators import model as ml
from ..operators import roster
from ..operators.encode import apply_codes, cardinalities, fit_codes
from ..operators.joins import lookup, select_joined, upsert
from ..operators.resolve import alias_table, resolve_names
from ..operators.rollup import batting_rollup, duplicate_keys, played_hitters, played_pitchers, regression_error, table_counts
from ..operators.scd import START, STOP, build_history, join_valid_versions, valid_at
from ..operators.shape import game_features, select_except, sorted_columns
from ..operators.topk import keep_last
from ..operators.trailing import hitter_ratios, pitcher_ratios, trailing_stats
from ..operators.weather import weather_rows, work_list
from ..sources import games as files
from ..sources import schemas
from ..sources.tables import (
    read_dimension,
    read_json_or_empty,
    replace_json,
    write_csv,
    write_json,
    write_lines,
    write_table,
)

TRACKED = ("bats", "rl", "team_id", "status")


class Store:
    """Paths of the stored tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path(name)}.parquet")

    def write(self, df: DataFrame, name: str, json_twin: bool = False) -> None:
        write_table(df, self.path(name), json_twin)


# --- stage 1: tables from game files --------------------------------------------------------------
def player_history(players: DataFrame) -> DataFrame:
    """Player versions; a player has few listings, one per game."""
    return build_history(players, "player_id", "game_date", TRACKED, ["game_id"], bounded=True).select(
        *[c for c in players.columns if c not in ("game_id", "effective_start_dt", "effective_stop_dt")], START, STOP
    )


def batter_games(events: DataFrame, games: DataFrame) -> DataFrame:
    finished = games.filter(F.col("game_status").isin(*rules.FINISHED))
    stats = batting_rollup(events).withColumnRenamed("batter", "player_id")
    return select_joined(select_except(finished, schemas.GAMES_SKIP), stats, ["game_id"])


def pitcher_games(stats: DataFrame, games: DataFrame) -> DataFrame:
    finished = games.filter(F.col("game_status").isin(*rules.FINISHED))
    keep = [c for c in stats.columns if c not in ("modified", "game_date")]
    return select_joined(stats.select(*keep), select_except(finished, schemas.GAMES_SKIP), ["game_id"])


def build_tables(store: Store, landing: str, start: date, stop: date) -> DataFrame:
    """Read the game files of a closed date range and write all base tables; returns row counts."""

    def documents(name: str) -> DataFrame:
        return files.read_documents(store.spark, landing, name, start, stop)

    store.write(files.games(documents(files.LINE_SCORE)), "games", json_twin=True)
    store.write(files.game_events(documents(files.EVENTS)), "game_events", json_twin=True)
    store.write(player_history(files.game_players(documents(files.PLAYERS))), "game_players", json_twin=True)
    store.write(files.pitching_stats(documents(files.BOX_SCORE)), "pitching_stats", json_twin=True)
    games = store.read("games")
    store.write(batter_games(store.read("game_events"), games), "batter_games", json_twin=True)
    store.write(pitcher_games(store.read("pitching_stats"), games), "pitcher_games", json_twin=True)
    names = ("games", "game_events", "game_players", "pitching_stats", "batter_games", "pitcher_games")
    return table_counts({n: store.read(n) for n in names})


# --- stage 2: weather -----------------------------------------------------------------------------
def read_stadium(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, schemas.STADIUM)


def weather_to_fetch(store: Store, stadium: DataFrame, now) -> DataFrame:
    """Games that need weather; an observations table for them is delivered by the caller."""
    stored = read_json_or_empty(store.spark, store.path("weather.json"), schemas.WEATHER)
    first_run = stored.isEmpty()
    return work_list(store.read("games"), stadium, None if first_run else stored, now)


def update_weather(store: Store, listed: DataFrame, observations: DataFrame) -> DataFrame:
    """Upsert the weather table by game; returns game ids that occur more than once (none)."""
    path = store.path("weather.json")
    stored = read_json_or_empty(store.spark, path, schemas.WEATHER)
    fresh = weather_rows(listed, observations).select(*schemas.WEATHER.fieldNames())
    replace_json(upsert(stored, fresh, ["game_id"]), path)
    return duplicate_keys(store.spark.read.schema(schemas.WEATHER).json(path), ["game_id"])


# --- stage 3: moving averages ---------------------------------------------------------------------
def hitter_averages(batters: DataFrame, games: DataFrame, cov_mode: str = "ratio") -> DataFrame:
    return trailing_stats(
        played_hitters(batters), "player_id", "game_date", rules.HITTER_STATS, rules.HITTER_WINDOWS, games,
        ratios=hitter_ratios, scales=rules.STAT_SCALES, scaled=False, cov_mode=cov_mode,
    )


def pitcher_averages(pitchers: DataFrame, games: DataFrame, cov_mode: str = "ratio") -> DataFrame:
    return trailing_stats(
        played_pitchers(pitchers), "player_id", "game_date", rules.PITCHER_STATS, rules.PITCHER_WINDOWS, games,
        ratios=pitcher_ratios, scales=rules.STAT_SCALES, scaled=False, cov_mode=cov_mode,
    )


def build_averages(store: Store) -> None:
    games = store.read("games")
    store.write(hitter_averages(store.read("batter_games"), games), "batter_moving_averages")
    store.write(pitcher_averages(store.read("pitcher_games"), games), "pitcher_moving_averages")


# --- stage 4: features ----------------------------------------------------------------------------
HITTER_RESULTS = ("fd_points", "_1b", "_2b", "_3b", "hr", "rbi", "r", "bb", "sb", "hbp", "out")
PITCHER_RESULTS = ("earned_runs", "strikeouts", "innings_pitched", "fd_points", "is_starter", "win")


def assemble(
    games: DataFrame, players: DataFrame, averages: DataFrame, results: DataFrame, stadium: DataFrame, weather: DataFrame,
    labels: Sequence[str], hitters_only: bool,
) -> DataFrame:
    """One row per game and listed player with everything known before the game, and the result if there is one."""
    base = select_except(games, schemas.GAMES_SKIP)
    versions = select_except(players, [c for c in schemas.GAME_PLAYERS_SKIP if c not in ("player_id", START, STOP)])
    if hitters_only:
        versions = versions.filter(F.col("fd_position") != "P")
    placed = base.join(
        stadium.select("stadium_id", "has_dome", "capacity", "elevation").dropDuplicates(["stadium_id"]), "stadium_id"
    ).join(select_except(weather, ["game_time_et"]), "game_id")
    rows = join_valid_versions(placed, versions, "game_date", {"home": "home_team_id", "away": "away_team_id"}, "team_id")
    rows = rows.drop("side", START, STOP).join(averages, ["game_date", "player_id"])
    actual = results.select("game_id", "player_id", *labels)
    return sorted_columns(game_features(rows.join(actual, ["game_id", "player_id"], "left")))


def build_features(store: Store, stadium: DataFrame) -> None:
    games, players = store.read("games"), store.read("game_players")
    weather = store.spark.read.schema(schemas.WEATHER).json(store.path("weather.json"))
    jobs = (
        ("batting_features", "batter_moving_averages", "batter_games", HITTER_RESULTS, True),
        ("pitching_features", "pitcher_moving_averages", "pitcher_games", PITCHER_RESULTS, False),
    )
    for name, averages, results, labels, hitters_only in jobs:
        features = assemble(games, players, store.read(averages), store.read(results), stadium, weather, labels, hitters_only)
        store.write(features, name)
        write_csv(store.read(name), store.path(f"{name}.csv"))


# --- stage 5: codes -------------------------------------------------------------------------------
def encode_features(store: Store, name: str, columns: Sequence[str], reuse: bool = False) -> DataFrame:
    """Replace categories by codes; the dictionary is a stored table and may be reused."""
    features = store.read(name)
    if not reuse:
        store.write(fit_codes(features, columns), f"{name}.codes")
    dictionary = store.read(f"{name}.codes")
    write_json(cardinalities(dictionary), store.path(f"{name}.numvals.json"))
    raw_id = features.withColumn("raw_player_id", F.col("player_id"))
    store.write(apply_codes(raw_id, columns, dictionary), f"{name}.enc")
    return store.read(f"{name}.enc")


# --- stage 6: models ------------------------------------------------------------------------------
_KEYS = ("raw_player_id", "game_id")


def model_inputs(encoded: DataFrame) -> list[str]:
    return ml.feature_names(encoded, (*rules.NOT_FEATURES, "raw_player_id"))


def _sizes(store: Store, name: str) -> dict[str, int]:
    rows = store.spark.read.schema("column string, n_values long").json(store.path(f"{name}.numvals.json")).collect()
    return {r["column"]: r["n_values"] for r in rows}


def train_role(
    store: Store, name: str, target: str = "fd_points", rounds: int = rules.MODEL_ROUNDS, played_only: bool = False
) -> DataFrame:
    """Train on 70 % of the rows, store the model, return the hold-out error.

    Listed players without a result count with label 0 unless ``played_only``.
    """
    encoded = store.read(f"{name}.enc")
    if played_only:
        encoded = encoded.filter(F.col(target).isNotNull())
    inputs, sizes = model_inputs(encoded), _sizes(store, name)
    vectors = ml.to_vectors(encoded, inputs, target, {c: sizes[c] for c in inputs if c in sizes})
    train, test = ml.split_by_hash(vectors, _KEYS)
    ml.save_model(ml.train(train, rounds=rounds), store.path(f"{name}.{target}.model"))
    model = ml.load_model(store.path(f"{name}.{target}.model"))
    scored = ml.predict(model, test, [*_KEYS, "label"])
    write_csv(scored, store.path(f"{name}.{target}.holdout.csv"))
    return regression_error(scored, "label", "prediction")


def score_role(store: Store, name: str, rows: DataFrame, target: str = "fd_points") -> DataFrame:
    """Predictions of the stored model for coded feature rows."""
    model = ml.load_model(store.path(f"{name}.{target}.model"))
    return ml.predict(model, ml.to_vectors(rows, model_inputs(rows)), [*_KEYS, "game_date"], target)


def train_all_targets(store: Store, name: str, targets: Sequence[str], rounds: int = rules.MODEL_ROUNDS_PER_TARGET) -> DataFrame:
    """One model per target and the weighted sum of their predictions for the hold-out rows."""
    encoded = store.read(f"{name}.enc")
    inputs, sizes = model_inputs(encoded), _sizes(store, name)
    nominal = {c: sizes[c] for c in inputs if c in sizes}
    train, test = ml.split_by_hash(encoded, _KEYS)
    models = ml.train_targets(lambda t: ml.to_vectors(train, inputs, t, nominal), targets, rounds)
    for target, model in models.items():
        ml.save_model(model, store.path(f"{name}.{target}.model"))
    combined = ml.combine_targets(models, ml.to_vectors(test, inputs), list(_KEYS))
    actual = test.select(*_KEYS, F.coalesce("fd_points", F.lit(0.0)).alias("actual_fd_points"))
    return combined.join(actual, list(_KEYS))


# --- stage 7: contest -----------------------------------------------------------------------------
def contest_players(players: DataFrame, history: DataFrame, day: date) -> DataFrame:
    """Contest players with the id valid on the day; unresolved ones keep a null id."""
    known = (
        valid_at(history, F.lit(day))
        .groupBy(F.upper("lookup_name").alias("known_name"))
        .agg(F.max("player_id").alias("player_id"))
    )
    keyed = players.withColumn("contest_key", F.concat_ws("_", "name", "team"))
    return resolve_names(keyed, "contest_key", F.col("contest_key"), known, rules.ALTERNATE_NAMES, "known_name", "player_id")


def contest_scores(store: Store, players: DataFrame, day: date) -> DataFrame:
    """Predicted points and tie-break of each contest player.

    The tie-break is the negated spread of recent points, so the steadier player wins.  A player with
    two games that day is scored by the later one.  Players without features get fixed low values.
    """
    scored = []
    for name, spread in (("batting_features", "mv_7_std_fd_points"), ("pitching_features", "mv_30_std_fd_points")):
        pitchers = name == "pitching_features"
        mine = players.filter((F.col("position") == "P") == F.lit(pitchers))
        coded = store.read(f"{name}.enc").filter(F.col("game_date") == F.lit(day))
        coded = coded.join(mine.select(F.col("player_id").alias("raw_player_id")), "raw_player_id", "left_semi")
        points = score_role(store, name, coded).drop("game_date")
        spreads = coded.select("raw_player_id", "game_id", (-F.col(spread)).alias("secondary_sort"))
        both = points.join(spreads, ["raw_player_id", "game_id"])
        last = keep_last(both, ["raw_player_id"], ["game_id"]).drop("game_id").withColumnRenamed("raw_player_id", "player_id")
        scored.append(
            lookup(mine, last, ["player_id"], {"fd_points": rules.UNSCORED, "secondary_sort": rules.UNSCORED_TIE_BREAK})
        )
    return scored[0].unionByName(scored[1])


def write_predictions(store: Store, scored: DataFrame) -> None:
    columns = ["position", "contest_key", "salary", "fd_points", "secondary_sort"]
    write_lines(scored, store.path("predictions.out"), columns, [F.desc("fd_points"), F.asc("contest_key")])
    write_json(scored.filter(F.col("fd_points") == rules.UNSCORED), store.path("no_predictions.json"))


def best_rosters(
    scored: DataFrame, keep: int = rules.KEEP_ROSTERS, prune: bool = True, literal: bool = False
) -> DataFrame:
    """The best legal rosters; points are compared to a thousandth.

    ``literal`` first combines the shortstop with three outfielders and keeps the best group per cost,
    whatever its teams; the default compares all legal rosters of the candidates.
    """
    players = scored.select(
        "position", "team", F.col("contest_key").alias("player"), F.col("salary").cast("bigint").alias("cost"),
        F.round(F.col("fd_points") * 1000).cast("bigint").alias("points"), "secondary_sort",
    )
    if prune:
        players = roster.prune_candidates(players, rules.PER_SALARY, [F.desc("secondary_sort")])
    players, slots = players.drop("secondary_sort"), rules.ROSTER_SLOTS
    if literal:
        groups = roster.precombine(players, "SS", "OF", 3, rules.SALARY_CAP, "SS+OF").drop("n_skipped")
        players = roster.as_groups(players).unionByName(groups)
        slots = (*[s for s in slots if s not in ("SS", "OF")], "SS+OF")
    found = roster.top_rosters(players, slots, rules.SALARY_CAP, rules.TEAM_LIMIT, keep)
    return found.withColumn("points", F.col("points") / F.lit(1000.0))


def team_aliases(spark: SparkSession, teams_csv: str, aliases_csv: str) -> DataFrame:
    teams = read_dimension(spark, teams_csv, schemas.TEAMS)
    return alias_table(read_dimension(spark, aliases_csv, schemas.TEAM_ALIASES), teams, "team", "teamalias")

