from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dugout.functions import baseball as rules
from dugout.functions import text
from dugout.operators import encode, joins, model, resolve, rollup, roster, scd, shape, skew, topk, trailing, weather
from dugout.sources.schemas import ddl
from dugout.sources.contest import eligible_csv, merge_lineup


def d(text):
    return date.fromisoformat(text)


# --- shape ----------------------------------------------------------------------------------------
def test_conform(spark, rows):
    df = spark.createDataFrame([("1", " ", "x"), ("", "2.5", None)], "a string, b string, c string")
    got = shape.conform(df, ddl("a int, b double, c string, d date"))
    assert rows(got) == sorted([(1, None, "x", None), (None, 2.5, None, None)], key=repr)
    with pytest.raises(TypeError):
        from pyspark.sql import types as T

        shape.conform(df, T.StructType([T.StructField("a", T.BinaryType())]))


def test_one_or_many(spark, rows):
    df = spark.createDataFrame([(1, '{"x":1}'), (2, '[{"x":1},{"x":2}]')], ["id", "j"])
    got = df.select("id", F.explode(shape.one_or_many(F.col("j"), "struct<x:int>")).alias("e")).select("id", "e.x")
    assert rows(got) == [(1, 1), (2, 1), (2, 2)]


# --- roll-up --------------------------------------------------------------------------------------
def events(spark, items):
    data = [("g", 7, code, des) for code, des in items]
    return spark.createDataFrame(data, "game_id string, batter int, fd_batter_event string, des string")


@pytest.mark.parametrize(
    ("items", "expected"),
    [
        ([("HR", "A B homers. C D scores. E F scores. ")], {"ab": 1, "hr": 1, "total_hits": 1, "r": 1, "rbi": 3, "out": 0, "fd_points": 25.7}),
        ([("W", ""), ("H", ""), ("O", "")], {"ab": 2, "bb": 1, "_1b": 1, "total_hits": 1, "out": 1, "fd_points": 6.0}),
        ([("SAC", "C D scores.")], {"ab": 0, "rbi": 1, "out": 0, "fd_points": 3.5}),
        ([(None, "")], {"ab": 1, "out": 1, "unclassified": 1, "fd_points": 0.0}),
        ([("2B", ""), ("3B", ""), ("W", "")], {"fd_points_2b": 6.0, "fd_points_3b": 9.0, "fd_points_tb": 16.0}),
    ],
)
def test_batting(spark, items, expected):
    got = rollup.batting_rollup(events(spark, items)).first().asDict()
    assert {k: got[k] for k in expected} == pytest.approx(expected)


def test_unknown_code_is_an_error(spark):
    with pytest.raises(Exception, match="unhandled event code"):
        rollup.batting_rollup(events(spark, [("ZZ", "")])).collect()


def test_no_batter_is_ignored(spark):
    df = events(spark, [("WP", "")]).withColumn("batter", F.lit(-1))
    assert rollup.batting_rollup(df).count() == 0


def test_pitching_score(spark):
    df = spark.createDataFrame([(1, 6.0, 2, 7)], "win int, innings_pitched double, earned_runs int, strikeouts int")
    got = rollup.pitching_scores(df).first()
    assert (got["fd_points"], got["non_win_fd_points"]) == (45.0, 11.0)


# --- histories ------------------------------------------------------------------------------------
def test_history(spark, rows):
    data = [(1, d("2015-04-01"), "L", 10), (1, d("2015-04-03"), "L", 10), (1, d("2015-04-05"), "L", None), (1, d("2015-04-07"), "L", 10)]
    df = spark.createDataFrame(data, "p int, day date, bats string, team int")
    got = rows(scd.build_history(df, "p", "day", ["bats", "team"]), "effective_start_dt", "effective_stop_dt", "team")
    assert got == [
        (d("2015-04-01"), d("2015-04-05"), 10), (d("2015-04-05"), d("2015-04-07"), None), (d("2015-04-07"), d("9999-01-01"), 10),
    ]


def test_same_day_change_leaves_no_empty_version(spark, rows):
    data = [(1, d("2015-04-01"), "a", "g1"), (1, d("2015-04-01"), "b", "g2")]
    df = spark.createDataFrame(data, "p int, day date, s string, g string")
    assert rows(scd.build_history(df, "p", "day", ["s"], ["g"]), "s") == [("b",)]


@pytest.mark.parametrize("size", [3000, 200, 40, 10**6])
def test_history_of_hot_keys_is_the_same(spark, rows, size):
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "ts", "event_type", "value", "user_id")
    # one user holds a third of the rows, another one has no user at all
    e = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 7 == 0, None).otherwise(F.col("user_id")))
    # long runs, so that runs reach over several segments
    e = e.withColumn("event_type", F.when(F.col("event_id") < 4000, "x").otherwise(F.col("event_type")))
    plain = scd.build_history(e, "user_id", "ts", ["event_type"], ["event_id"], bounded=True)
    cut = scd.build_history(e, "user_id", "ts", ["event_type"], ["event_id"], rows_per_segment=size)
    assert rows(plain) == rows(cut)


@pytest.mark.parametrize("keys", [[], ["user_id"]])
def test_numbering_of_hot_keys_is_the_same(spark, rows, keys):
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "ts", "user_id")
    e = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("user_id")))
    plain = skew.number_rows(e, keys, ["ts", "event_id"])
    cut = skew.number_rows(e, keys, ["ts", "event_id"], rows_per_segment=100)
    assert rows(plain, "event_id", "rn") == rows(cut, "event_id", "rn")


def test_hot_key_is_cut_in_small_segments(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "ts", "user_id")
    e = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id")))
    sizes = skew.segmented(e, ["user_id"], ["ts", "event_id"], 200).filter("user_id = 1").groupBy(skew.SEGMENT).count()
    assert sizes.count() > 10 and sizes.agg(F.max("count")).first()[0] < 3 * 200


def test_valid_version_join_equals_or_join(spark, rows):
    games = spark.createDataFrame(
        [(1, d("2015-04-02"), 10, 20), (2, d("2015-05-02"), 10, 30), (3, d("2015-05-02"), 10, 10)], "g int, day date, home int, away int"
    )
    versions = spark.createDataFrame(
        [("p1", 10, d("2015-04-01"), d("2015-05-01")), ("p1", 30, d("2015-05-01"), d("9999-01-01")), ("p2", 20, d("2015-04-01"), d("9999-01-01")),
         ("p3", None, d("2015-04-01"), d("9999-01-01")), ("p4", 10, d("2015-05-02"), d("2015-05-03"))],
        "p string, team int, effective_start_dt date, effective_stop_dt date",
    )
    games.createOrReplaceTempView("g1")
    versions.createOrReplaceTempView("v1")
    expected = spark.sql(
        """select g, p from g1 join v1 on day >= effective_start_dt and day < effective_stop_dt and (home = team or away = team)"""
    )
    for days in (1, 7, 400):
        got = scd.join_valid_versions(games, versions, "day", {"home": "home", "away": "away"}, "team", bucket_days=days)
        assert rows(got, "g", "p") == rows(expected)
    assert (2, "p1") in rows(expected) and (3, "p4") in rows(expected)


# --- trailing statistics --------------------------------------------------------------------------
def test_trailing(spark):
    facts = spark.createDataFrame(
        [(1, d("2015-04-01"), 3), (1, d("2015-04-03"), 5), (1, d("2015-04-03"), 1), (1, d("2015-04-10"), 7)], "p int, day date, x int"
    )
    days = spark.createDataFrame([(d(x),) for x in ("2015-04-01", "2015-04-03", "2015-04-05", "2015-04-10", "2015-04-12", "2016-01-01")], "day date")
    halves = facts.withColumn("x", F.col("x") / 2)
    for scale in (1, 2):
        how = {"scales": {"x": 2.0}, "scaled": False} if scale == 2 else {}
        got = trailing.trailing_stats(halves if scale == 2 else facts, "p", "day", ["x"], ("SEASON", 4), days, **how)
        got = got.withColumns({c: F.col(c) * scale for c in ("mv_4_avg_x", "mv_SEASON_avg_x")})
        avg = {str(r["day"])[5:]: (r["mv_4_avg_x"], r["mv_SEASON_avg_x"]) for r in got.collect()}
        assert avg == {"04-03": (3, 3), "04-05": (3, 3), "04-10": (0, 3), "04-12": (7, 4)}


def test_norms_and_spread(spark):
    facts = spark.createDataFrame([(1, d("2015-04-01"), 3), (1, d("2015-04-02"), -4)], "p int, day date, x int")
    days = spark.createDataFrame([(d("2015-04-05"),)], "day date")
    r = trailing.trailing_stats(facts, "p", "day", ["x"], (7,), days).first()
    assert (r["mv_7_l1norm_x"], r["mv_7_l2norm_x"], r["mv_7_avg_x"], r["mv_7_std_x"], r["mv_7_cov_x"]) == (7.0, 5.0, -0.5, 3.5, -7.0)
    literal = trailing.trailing_stats(facts, "p", "day", ["x"], (7,), days, cov_mode="literal").first()
    assert literal["mv_7_cov_x"] == 1.0
    constant = facts.withColumn("x", F.lit(2))
    assert trailing.trailing_stats(constant, "p", "day", ["x"], (7,), days, cov_mode="literal").first()["mv_7_cov_x"] == 0.0


def test_rate_columns(spark):
    values = {"ab": 4, "_1b": 1, "_2b": 0, "_3b": 0, "hr": 1, "bb": 1, "hbp": 0}
    df = spark.createDataFrame([tuple(float(v) for v in values.values())], list(values))
    got = df.select(*[c.alias(n) for n, c in trailing.hitter_ratios({k: F.col(k) for k in values}).items()]).first().asDict()
    assert got == pytest.approx({"slugging": 1.25, "obp": 0.6, "ops": 1.85, "woba": 0.736})
    pitch = {"innings_pitched": 6, "num_hits": 5, "num_walks": 2, "hr": 1, "strikeouts": 7, "batters_faced": 25}
    for factor, expected in (
        (1.0, {"whip": 7 / 6, "babip": 4 / 17, "k_per_nine": 10.5, "bb_per_nine": 3, "fip": 5 / 6 - 2 / 6 + 3.072 - 0.0, "k_percent": 0.28, "k_bb": 0.08}),
        (0.0, dict.fromkeys(("whip", "babip", "k_per_nine", "bb_per_nine", "fip", "k_percent", "k_bb"), 0.0)),
    ):
        df = spark.createDataFrame([tuple(v * factor for v in pitch.values())], list(pitch))
        got = df.select(*[c.alias(n) for n, c in trailing.pitcher_ratios({k: F.col(k) for k in pitch}).items()]).first().asDict()
        if factor:
            expected["fip"] = (13 + 6 - 14) / 6 + 3.072
        assert got == pytest.approx(expected)


# --- rankings, joins, codes -----------------------------------------------------------------------
def test_top_k(spark, rows):
    df = spark.createDataFrame([("P", 10, 5, 1.0, "a"), ("P", 10, 7, 2.0, "b"), ("P", 10, 7, 1.0, "c"), ("OF", 10, 1, 1.0, "d"), ("OF", 10, 2, 1.0, "e")],
                               "pos string, salary int, points int, std double, who string")
    got = topk.top_k_by_group(df, "pos", ["pos", "salary"], [F.desc("points"), F.asc("std")], {"OF": 4})
    assert rows(got, "who") == [("c",), ("d",), ("e",)]


def test_upsert(spark, rows):
    stored = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (4, "new")], "k int, v string")
    merged = joins.upsert(stored, new, ["k"])
    assert rows(merged) == [(1, "old"), (2, "new"), (3, "old"), (4, "new")]
    assert rollup.duplicate_keys(merged, ["k"]).count() == 0


def test_codes(spark, rows):
    df = spark.createDataFrame([("b", 10), (None, 9), ("a", 10), ("b", 2)], "s string, n int")
    codes = encode.fit_codes(df, ["s", "n", "s"])
    assert rows(codes.filter("column = 's'"), "value", "code") == sorted([(None, 0), ("a", 1), ("b", 2)], key=repr)
    assert rows(codes.filter("column = 'n'"), "value", "code") == [("10", 2), ("2", 0), ("9", 1)]
    assert rows(encode.cardinalities(codes)) == [("n", 3), ("s", 3)]
    coded = encode.apply_codes(df, ["s", "n"], codes, keep=True)
    back = encode.invert_codes(coded, {"s_code": "s", "n_code": "n"}, codes)
    assert back.filter("not (s_code_value <=> s) or n_code_value <> n").count() == 0
    other = spark.createDataFrame([("zz", 10)], "s string, n int")
    assert rows(encode.apply_codes(other, ["s"], codes), "s") == [(-1,)]
    hot = encode.fit_codes(df, ["s", "n"], rows_per_segment=2)
    assert rows(hot) == rows(codes)


def test_aliases(spark, rows):
    teams = spark.createDataFrame([("SF",), ("KC",)], "team string")
    aliases = spark.createDataFrame([("SF", "SFG"), ("KC", "KCR")], "team string, teamalias string")
    table = resolve.alias_table(aliases, teams, "team", "teamalias")
    names = spark.createDataFrame([("SFG",), ("sf",), ("kcr",), ("xyz",)], "n string")
    assert rows(resolve.resolve_alias(names, "n", table)) == sorted([("SFG", "SF"), ("sf", "SF"), ("kcr", "KC"), ("xyz", None)], key=repr)


def test_alternate_names(spark, rows):
    known = spark.createDataFrame([("MIKE X_BOS", 5), ("NATE Y_SF", 6)], "nm string, id int")
    df = spark.createDataFrame([(1, "Michael X_BOS"), (2, "Nobody_BOS"), (3, "Nathan Y_SF")], "k int, n string")
    got = resolve.resolve_names(df, "k", F.col("n"), known, rules.ALTERNATE_NAMES, "nm", "id")
    assert rows(got, "k", "id") == [(1, 5), (2, None), (3, 6)]


def test_eligibility(spark):
    data = [("P", "", "", None, None, False), ("OF", "", "", "Starter", "Active", True), ("OF", "", "", "Non-Starter", "Active", False),
            ("P", "Yes", "DTD", "Non-Starter", None, True), ("OF", "", "", "No Lineup", "Inactive", False)]
    df = spark.createDataFrame(data, "p string, pr string, i string, s string, a string, want boolean")
    assert df.filter(eligible_csv(*[F.col(c) for c in ("p", "pr", "i", "s", "a")]) != F.col("want")).count() == 0


def test_lineup_merge(spark, rows):
    roster_rows = spark.createDataFrame([("A", "x", "OF", "Active"), ("A", "y", "P", "Active"), ("B", "z", "C", "Active")], "team string, name string, pos string, active string")
    lineup = spark.createDataFrame([("A", "x", "LF"), ("A", "new", "DH")], "team string, name string, position string")
    got = rows(merge_lineup(roster_rows, lineup), "name", "pos", "status")
    assert got == [("new", "1B", "Starter"), ("x", "OF", "Starter"), ("y", "P", "Non-Starter"), ("z", "C", "No Lineup")]


def test_batches_and_lines(spark, rows):
    df = spark.range(0, 10).withColumn("g", F.col("id") % 2)
    assert rows(topk.batches(df, ["id"], 4), "id", "batch")[3:5] == [(3, 0), (4, 1)]
    lines = topk.joined_text(df, ["g"], ["id"], "id", "|", 3)
    assert rows(lines) == [(0, 0, "0|2|4"), (0, 1, "6|8"), (1, 0, "1|3|5"), (1, 1, "7|9")]


def test_weather_fallbacks(spark):
    listed = spark.createDataFrame(
        [("g1", datetime(2015, 4, 2, 19), 0.0, 0.0, 1, 45), ("g2", datetime(2015, 4, 2, 19), 0.0, 0.0, 0, 45), ("g3", datetime(2015, 4, 2, 19), 0.0, 0.0, 0, 45)],
        "game_id string, game_time_et timestamp_ntz, latitude double, longitude double, has_dome int, center_azimuth int",
    )
    seen = {n: None for n in rules.COVERED_WEATHER} | {"windBearing": 50.0, "icon": "rain"}
    types = ", ".join(f"{n} {'string' if isinstance(v, str) else 'double'}" for n, v in rules.COVERED_WEATHER.items())
    obs = spark.createDataFrame([("g2", *[seen[n] for n in rules.COVERED_WEATHER])], f"game_id string, {types}")
    got = {r["game_id"]: r for r in weather.weather_rows(listed, obs).collect()}
    assert set(got) == {"g1", "g2"}
    assert (got["g1"]["icon"], got["g1"]["temperature"], got["g1"]["blowing_out"]) == ("dome_clear", 70.0, False)
    assert (got["g2"]["icon"], got["g2"]["temperature"], got["g2"]["ozone"], got["g2"]["blowing_out"]) == ("rain", None, 310.0, True)


# --- models ---------------------------------------------------------------------------------------
def test_model_round_trip(spark, tmp_path):
    df = spark.range(0, 400).select(
        "id", (F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), (F.col("id") % 2 == 0).alias("c"), (F.col("id") % 7 * 2).cast("double").alias("y")
    )
    names = model.feature_names(df, ("id", "y"))
    assert names == ["a", "b", "c"]
    vectors = model.to_vectors(df, names, "y", {"b": 3})
    train, test = model.split_by_hash(vectors, ["id"])
    assert train.count() + test.count() == 400 and 200 < train.count() < 340
    m = model.train(train, rounds=5)
    model.save_model(m, str(tmp_path / "m"))
    loaded = model.load_model(str(tmp_path / "m"))
    scored = model.predict(loaded, test, ["id", "label"])
    assert rollup.regression_error(scored, "label", "prediction").first()["mse"] < 0.5
    assert model.importances(loaded, names)[0][0] == "a"
    assert "If (a" in model.describe(loaded, names)
    both = model.combine_targets({"hr": m, "sb": m}, test, ["id"], {"hr": 2.0, "sb": 1.0})
    row = both.first()
    assert row["fd_sum"] == pytest.approx(row["hr"] * 3)


# --- rosters --------------------------------------------------------------------------------------
def brute_force(cands, slots, cap, limit):
    from collections import Counter
    from itertools import combinations, product

    pools = []
    for position in dict.fromkeys(slots):
        mine = sorted((c for c in cands if c[0] == position), key=lambda c: (-c[4], c[2]))
        pools.append(list(combinations(mine, slots.count(position))))
    out = []
    for pick in product(*pools):
        team = [p for group in pick for p in group]
        cost, points = sum(p[3] for p in team), sum(p[4] for p in team)
        if cost <= cap and max(Counter(p[1] for p in team).values()) <= limit:
            out.append((",".join(p[2] for p in team), cost, points))
    return sorted(out, key=lambda r: (-r[2], r[0]))


@pytest.mark.parametrize(("seed", "cap", "limit"), [(1, 900, 2), (2, 700, 1), (3, 100, 2), (4, 2000, 4)])
def test_search_equals_brute_force(spark, seed, cap, limit):
    import random

    rnd = random.Random(seed)
    slots = ["C", "P", "OF", "OF", "OF"]
    cands = [
        (pos, rnd.choice("ABCD"), f"{pos}{i}", rnd.randint(1, 4) * 100, rnd.randint(-5, 30)) for pos, n in (("C", 6), ("P", 5), ("OF", 8)) for i in range(n)
    ]
    df = spark.createDataFrame(cands, "position string, team string, player string, cost long, points long")
    expected = brute_force(cands, slots, cap, limit)
    got = [tuple(r) for r in roster.top_rosters(df, slots, cap, limit, keep=12).orderBy("rank").select("players", "cost", "points").collect()]
    assert got == expected[:12]
    counts = {}
    for _, _, points in expected:
        counts[points] = counts.get(points, 0) + 1
    hist = [tuple(r) for r in roster.top_score_histogram(df, slots, cap, limit, scores=5).collect()]
    assert hist == sorted(counts.items(), reverse=True)[:5]


def test_search_limits(spark):
    same = [("OF", "A", f"p{i}", 100, 1) for i in range(5)]
    df = spark.createDataFrame(same, "position string, team string, player string, cost long, points long")
    assert roster.top_rosters(df, ["OF"] * 5, 500, 4).count() == 0
    assert roster.top_rosters(df, ["OF"] * 4, 400, 4).count() == 5
    assert roster.top_rosters(df, ["OF"] * 4, 300, 4).count() == 0
    assert roster.combinations(df.limit(4), "OF", 3, 400).count() == 4
    with pytest.raises(ValueError, match="multiple"):
        roster.top_rosters(df, ["OF"], 400, 4, unit=30)


def test_precombined_groups(spark, rows):
    data = [("SS", "A", "s1", 100, 5), ("OF", "A", "o1", 100, 9), ("OF", "B", "o2", 100, 7), ("OF", "C", "o3", 100, 6), ("OF", "D", "o4", 200, 1), ("C", "A", "c1", 100, 2)]
    df = spark.createDataFrame(data, "position string, team string, player string, cost long, points long")
    groups = roster.precombine(df, "SS", "OF", 3, 1000, "X")
    assert rows(groups, "cost", "points", "n_skipped") == [(400, 27, 0), (500, 22, 2)]
    both = roster.as_groups(df).unionByName(groups.drop("n_skipped"))
    best = roster.top_rosters(both, ["C", "X"], 1000, 3).orderBy("rank").collect()
    assert [(r["players"], r["points"]) for r in best] == [("c1,o1,o2,o3,s1", 29), ("c1,o1,o2,o4,s1", 24)]
    # the exact search also finds the groups the shortcut hides
    assert roster.top_rosters(df, ["C", "SS", "OF", "OF", "OF"], 1000, 3).count() == 4


def test_default_points(spark, rows):
    a = spark.createDataFrame([("x",), ("y",)], "name string")
    assert rows(roster.with_points(a, spark.createDataFrame([("x", 3)], "name string, points int"), ["name"])) == [("x", 3), ("y", 0)]


def test_search_uses_equi_joins(spark):
    data = [("C", "A", f"c{i}", 100 * i, i) for i in range(1, 5)] + [("OF", "B", f"o{i}", 100 * i, i) for i in range(1, 6)]
    df = roster.number_candidates(spark.createDataFrame(data, "position string, team string, player string, cost long, points long"))
    slots = ["C", "OF", "OF"]
    found = roster.rosters_at_least(df, slots, 900, 2, 0, roster._bounds(df, slots, 900, 100))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("BroadcastHashJoin") == 2
    assert found.count() == 27


def test_costs_between_units_count_exactly(spark, rows):
    data = [("OF", "A", "a", 150, 1), ("OF", "B", "b", 199, 1), ("OF", "C", "c", 101, 1), ("OF", "D", "d", 202, 1)]
    df = spark.createDataFrame(data, "position string, team string, player string, cost long, points long")
    pairs = roster.combinations(df, "OF", 2, 300)
    assert rows(pairs, "cost") == [(251,), (300,)]


def test_first_row_with_ties_and_nulls(spark, rows):
    data = [(1, None, 1), (1, None, 2), (2, 5, 2), (2, 5, 1), (2, None, 0), (None, 1, 1), (None, 1, 2)]
    df = spark.createDataFrame(data, "k int, o int, t int")
    got = topk.mark_first(df, ["k"], "o", "first", ties=["t"])
    assert got.columns == ["k", "o", "t", "first"]
    assert sorted(map(tuple, got.filter("first").select("k", "o", "t").collect()), key=repr) == sorted([(1, None, 1), (2, 5, 1), (None, 1, 1)], key=repr)


def test_unreadable_text_is_an_error(spark):
    df = spark.createDataFrame([("x1",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        shape.conform(df, ddl("a int")).collect()


def test_splice_over_many_pages(spark):
    words = ["w" * (1 + i % 7) for i in range(5000)]
    starts, used = [0], 0
    for i, w in enumerate(words):
        if used + len(w) > 9:
            starts.append(i)
            used = 0
        used += len(w)
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert df.select(text.splice_starts(F.col("w"), 9)).first()[0] == starts
