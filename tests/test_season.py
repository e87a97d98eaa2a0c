from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dugout.functions import baseball as rules
from dugout.operators import trailing
from dugout.plans import season
from dugout.sources import contest, games, schemas, tables

from season_files import FIRST, HITTERS, PITCHERS, write_season

STOP_DAY = FIRST + timedelta(days=30)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    write_season(root)
    return str(root)


@pytest.fixture(scope="module")
def store(spark, landing, tmp_path_factory):
    s = season.Store(spark, str(tmp_path_factory.mktemp("store")))
    s.counts = {r["table_name"]: r["n"] for r in season.build_tables(s, landing, FIRST, STOP_DAY).collect()}
    return s


def stadium(spark):
    rows = [(1, "T", "Park", None, 1, 40000.0, 1.0, 2.0, "1/1/90", 45, 10), (2, "U", "Field", None, 0, 30000.0, 1.0, 2.0, "1/1/90", 0, 20)]
    return spark.createDataFrame(rows, schemas.STADIUM)


def test_date_range(spark, landing):
    docs = games.read_documents(spark, landing, "linescore.json", FIRST, FIRST + timedelta(days=1))
    assert sorted(r["game_date"] for r in docs.collect()) == [FIRST, FIRST, FIRST + timedelta(days=1)]
    assert games.read_documents(spark, landing, "linescore.json", date(2013, 1, 1), date(2013, 3, 1)).count() == 0
    assert games.months_between(date(2014, 12, 5), date(2015, 2, 1)) == ["year_2014/month_12", "year_2015/month_01", "year_2015/month_02"]


def test_missing_files(spark, landing):
    gone = {(r["game_id"][4:14], r["file_name"]) for r in games.missing_files(spark, landing).collect()}
    assert ("2015_04_09", "boxscore.json") in gone and ("2015_04_02", "boxscore.json") in gone and ("2015_04_03", "boxscore.json") not in gone


def test_games(store):
    g = {r["game_date"]: r for r in store.read("games").collect()}
    assert len(g) == 7 and FIRST + timedelta(days=3) not in g
    assert g[FIRST]["game_time_et"] == datetime(2015, 4, 2, 19, 5) and g[FIRST + timedelta(days=1)]["game_time_et"] == datetime(2015, 4, 3, 12, 35)
    assert (g[FIRST]["home_team_id"], g[FIRST]["home_abbrev"], g[FIRST]["stadium_id"]) == (10, "SFN", 1)
    assert store.counts["games"] == 7 and store.read("games").schema.fieldNames() == schemas.GAMES.fieldNames()


def test_events(store):
    first = store.read("game_events").filter(F.col("game_date") == FIRST)
    # 6 + 6 at-bats, 2 kept actions of the first inning, a lone at-bat, one of two in the third; the half without at-bats is skipped
    assert first.count() == 16
    codes = {r["fd_batter_event"]: r["count"] for r in first.groupBy("fd_batter_event").count().collect()}
    assert codes["SB"] == 1 and codes["WP"] == 1 and codes["HR"] == 3
    wild = first.filter("fd_batter_event = 'WP'").first()
    assert (wild["pitcher"], wild["batter"], wild["num"], wild["balls"], wild["start_tfs_zulu"]) == (PITCHERS["sfn"][0], -1, -1, 0, datetime(2015, 4, 3, 0, 10))
    assert first.filter("fd_batter_event = 'SB'").first()["start_tfs_zulu"] is None


def test_pitchers(store):
    rows = store.read("pitching_stats").filter(F.col("game_date") == FIRST).orderBy("player_id").collect()
    assert [(r["player_id"], r["team_id"], r["is_starter"], r["win"]) for r in rows] == [(190, "10", True, 1), (290, "20", True, 0)]
    assert rows[0]["innings_pitched"] == 6.0 and rows[0]["fd_points"] == 45.0 and rows[0]["non_win_fd_points"] == 11.0


def test_player_versions(store):
    p = store.read("game_players")
    plain = p.filter(F.col("player_id") == 205).collect()
    assert len(plain) == 1 and plain[0]["fd_position"] == "1B" and plain[0]["effective_stop_dt"] == date(9999, 1, 1)
    assert p.filter(F.col("player_id") == 100).first()["bats"] == "R" and p.filter(F.col("player_id") == 102).first()["position"] == "OF"
    changed = p.filter(F.col("player_id") == 203).orderBy("effective_start_dt").collect()
    assert [r["status"] for r in changed] == ["A", "D", "A"]
    assert all(a["effective_stop_dt"] == b["effective_start_dt"] for a, b in zip(changed, changed[1:]))


def test_batter_games(store):
    one = store.read("batter_games").filter((F.col("game_date") == FIRST) & (F.col("player_id") == HITTERS["oak"][2])).first()
    assert (one["hr"], one["ab"], one["rbi"], one["fd_points"]) == (1, 1, 2, 12.0 + 7.0 + 3.2)


@pytest.fixture(scope="module")
def weathered(spark, store):
    listed = season.weather_to_fetch(store, stadium(spark), F.lit("2015-04-09 10:00:00").cast("timestamp_ntz"))
    assert listed.count() == 7
    types = ", ".join(f"{n} {'string' if isinstance(v, str) else 'double'}" for n, v in rules.COVERED_WEATHER.items())
    ids = [r["game_id"] for r in listed.collect()]
    seen = spark.createDataFrame([(g, *[1.5 if not isinstance(v, str) else "x" for v in rules.COVERED_WEATHER.values()]) for g in ids], f"game_id string, {types}")
    assert season.update_weather(store, listed, seen).count() == 0
    again = season.weather_to_fetch(store, stadium(spark), F.lit("2015-04-09 10:00:00").cast("timestamp_ntz"))
    assert [r["game_id"][4:14] for r in again.collect()] == ["2015_04_09"]
    assert season.update_weather(store, again, seen).count() == 0
    return store


@pytest.fixture(scope="module")
def features(spark, weathered):
    season.build_averages(weathered)
    season.build_features(weathered, stadium(spark))
    return weathered


def test_averages(store, features):
    a = features.read("batter_moving_averages")
    assert len(a.columns) == 2 + 5 * 82 and len(features.read("pitcher_moving_averages").columns) == 2 + 4 * 79
    slow = store.read("batter_games").filter("player_id = 201 and game_date < '2015-04-09'").agg(F.avg("fd_points"), F.stddev_pop("fd_points")).first()
    got = a.filter("player_id = 201 and game_date = '2015-04-09'").first()
    assert got["mv_SEASON_avg_fd_points"] == pytest.approx(slow[0]) and got["mv_SEASON_std_fd_points"] == pytest.approx(slow[1])


def test_features(features):
    b = features.read("batting_features")
    today = b.filter("game_date = '2015-04-09'")
    assert today.count() > 0 and today.filter("fd_points is not null").count() == 0
    assert b.groupBy("game_id", "player_id").count().filter("count > 1").count() == 0
    row = b.filter("player_id = 205 and game_date = '2015-04-05'").collect() + b.filter("player_id = 205 and game_date = '2015-04-06'").collect()
    assert row and {r["player_team_abbrev"] for r in row} == {"OAK"}
    assert b.filter("player_id = 201").count() == 0  # no team id, so no match
    assert not {"home_code", "team_id", "home_time"} & set(b.columns) and {"opponent_division", "game_weekday"} <= set(b.columns)
    assert features.read("pitching_features").filter("is_starter").count() > 0


def test_train_and_contest(spark, features, tmp_path):
    season.encode_features(features, "batting_features", rules.CATEGORICAL)
    season.encode_features(features, "pitching_features", rules.PITCHER_CATEGORICAL)
    for role in ("batting_features", "pitching_features"):
        error = season.train_role(features, role, rounds=2).first()
        assert error["n"] > 0 and error["mse"] >= 0
    combined = season.train_all_targets(features, "batting_features", ("fd_points", "hr", "bb"))
    assert {"fd_sum", "actual_fd_points"} <= set(combined.columns) and combined.count() > 0
    # the summed targets overwrote the single model only for the shared target
    day = date(2015, 4, 9)
    path = tmp_path / "contest.csv"
    lines = ["Position,First Name,Last Name,Game,Team,Salary,FPPG,Played,Probable Pitcher,Injury Indicator"]
    lines += [f"{p},F{i},L{i},G,OAK,{2000 + 100 * n},1.5,3,Yes," for n, (p, i) in enumerate(zip(("C", "2B", "3B", "SS", "OF", "1B"), HITTERS["oak"]))]
    lines += ["P,F290,L290,G,OAK,5000,9.0,3,Yes,", "OF,Nobody,Known,G,TAM,2000,1.0,1,,DTD"]
    path.write_text("\n".join(lines) + "\n")
    listed = contest.read_contest_csv(spark, str(path))
    assert listed.filter("team = 'TB' and injury = 'DTD' and player_status = ''").count() == 1
    resolved = season.contest_players(listed, features.read("game_players"), day)
    assert resolved.filter("player_id is null").count() == 1
    scored = season.contest_scores(features, resolved, day)
    assert scored.count() == 8
    low = {r["name"]: r["fd_points"] for r in scored.collect()}
    assert low["Nobody Known"] == rules.UNSCORED and low["F290 L290"] > rules.UNSCORED
    season.write_predictions(features, scored)
    assert spark.read.text(features.path("predictions.out")).count() == 8
    assert season.best_rosters(scored).count() == 0  # one team, so no legal roster


def test_contest_json(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"7":["2B","Ed Example","83325","606","1000","2500",1.3,26,false,4,""]}')
    row = contest.read_contest_json(spark, str(path)).first()
    assert (row["position"], row["team"], row["salary"], row["points"], row["player_status"]) == ("2B", "MIA", 2500.0, 1.3, "4")


def test_dimension_with_bare_carriage_returns(spark, tmp_path):
    path = tmp_path / "stadium.csv"
    path.write_bytes(b'stadium_id,city,name,weather_loco,has_dome,capacity,latitude,longitude,opened,center_azimuth,elevation\r1,"A, B",P,null,0,45.00,1.5,-2.5,4/1/66,45,160\r2,,Q,X,1,3.00,1.5,-2.5,4/1/66,0,1')
    got = season.read_stadium(spark, str(path)).orderBy("stadium_id").collect()
    assert [(r["stadium_id"], r["city"], r["elevation"]) for r in got] == [(1, "A, B", 160), (2, None, 1)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.write_table(df, str(tmp_path / "t"), json_twin=True)
    assert spark.read.parquet(str(tmp_path / "t.parquet")).count() == spark.read.json(str(tmp_path / "t.json")).count() == 2
    tables.write_csv(df, str(tmp_path / "c"), single_file=True)
    assert tables.read_dimension(spark, str(tmp_path / "c")).schema["k"].dataType.simpleString() == "int"
    missing = tables.read_json_or_empty(spark, str(tmp_path / "none"), df.schema)
    assert missing.count() == 0 and missing.schema == df.schema
    tables.replace_json(df, str(tmp_path / "j"))
    tables.replace_json(spark.read.schema(df.schema).json(str(tmp_path / "j")).filter("k = 1"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1


def test_forecast_sums_equal_frames(spark, store):
    facts = store.read("batter_games").select("player_id", "game_date", F.col("ab").cast("long").alias("ab"))
    days = store.read("games").select("game_date")
    a = trailing.interval_join_sums(facts, "player_id", "game_date", ["ab"], [4], days)
    daily = trailing.daily_moments(facts, "player_id", "game_date", ["ab"], moments="s")
    b = trailing.trailing_sums(daily, "player_id", "game_date", [4], days).filter("`__n@4` > 0")
    b = b.select("player_id", "game_date", F.col("`__s_ab@4`").alias("sum_4_ab"))
    assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count()


def test_replacing_survives_a_crash(spark, tmp_path, monkeypatch):
    path, kind = str(tmp_path / "t.json"), "a int, b string"
    spark.createDataFrame([(1, "x"), (2, "y")], kind).write.json(path)
    schema = spark.read.json(path).schema
    new = tables.read_json_or_empty(spark, path, schema).withColumn("b", F.upper("b"))
    tables.replace_json(new, path)
    assert sorted(map(tuple, tables.read_json_or_empty(spark, path, schema).collect())) == [(1, "X"), (2, "Y")]
    monkeypatch.setattr(tables, "_remove", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        tables.replace_json(tables.read_json_or_empty(spark, path, schema).withColumn("b", F.lit("z")), path)
    # the table is gone half-way, the copy is whole
    tables.read_json(spark, path).limit(0).write.mode("overwrite").json(path)
    assert {r["b"] for r in tables.read_json_or_empty(spark, path, schema).collect()} == {"z"}
    monkeypatch.undo()
    tables.replace_json(tables.read_json_or_empty(spark, path, schema).withColumn("a", F.col("a") + 1), path)
    assert sorted(map(tuple, tables.read_json_or_empty(spark, path, schema).collect())) == [(2, "z"), (3, "z")]


def test_scratch_needs_a_shared_folder_off_a_local_master(spark):
    from dugout.session import scratch_path

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError):
        scratch_path(Session, "x")
    assert scratch_path(Session, "x", "hdfs://shared/").startswith("hdfs://shared/x-")
    Session.conf["spark.checkpoint.dir"] = "hdfs://other"
    assert scratch_path(Session, "x").startswith("hdfs://other/x-")


def test_events_are_read_in_one_pass_over_the_documents(spark):
    inning = '{"num":"1","top":{"atbat":{"event":"Walk","pitcher":"5","batter":"6","num":"1","player":"x"},"action":[{"event":"Wild Pitch","player":"7","tfs_zulu":"2016-05-01T23:00:00Z"},{"event":"Stolen Base 2B","player":"8"}]}}'
    doc = F.concat(F.lit('{"data":{"game":{"inning":'), F.when(F.col("id") == 0, F.lit(inning)).otherwise(F.lit(f"[{inning}]")), F.lit("}}}"))
    docs = spark.range(2).select(F.concat(F.lit("gid_"), "id").alias("game_id"), F.to_date(F.lit("2016-05-01")).alias("game_date"), doc.alias("doc"))
    events = games.game_events(docs)
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("get_json_object") == 1
    got = {(r["game_id"], r["fd_batter_event"], r["pitcher"], r["batter"], r["num"], r["start_tfs_zulu"] is None) for r in events.collect()}
    assert got == {("gid_1", "W", 5, 6, 1, True), ("gid_1", "WP", 7, -1, -1, False), ("gid_1", "SB", -1, 8, -1, True)}
