from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dugout.functions import baseball as rules
from dugout.functions import text, timegeo
from dugout.functions.rules import classify, recode
from dugout.functions.score import linear_score, ratio, win_pct


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values()) or (1,)], [*values] or ["x"])
    return frame.select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    ("clock", "ampm", "hour", "minute"), [("7:05", "PM", 19, 5), ("12:35", "PM", 12, 35), ("11:05", "AM", 11, 5), ("DH", "AM", 19, 0)]
)
def test_clock(spark, clock, ampm, hour, minute):
    df = spark.createDataFrame([(date(2015, 4, 2), clock, ampm)], "d date, c string, a string")
    got = df.select(timegeo.clock_12h(F.col("d"), F.col("c"), F.col("a"))).first()[0]
    assert got == datetime(2015, 4, 2, hour, minute)


@pytest.mark.parametrize(
    ("axis", "bearing", "out", "into"),
    [(45, 100, True, False), (45, 101, False, False), (45, 350, True, False), (45, 349, False, False), (0, 350, True, False), (0, 180, False, True)],
)
def test_sector(spark, axis, bearing, out, into):
    df = spark.createDataFrame([(axis, bearing)], "a int, b int")
    got = df.select(timegeo.in_sector(F.col("b"), F.col("a")), timegeo.in_opposite_sector(F.col("b"), F.col("a"))).first()
    assert tuple(got) == (out, into)


def test_paths(spark):
    path = "/l/year_2015/month_04/day_02/gid_2015_04_02_sfnmlb_oakmlb_1/linescore.json"
    df = spark.createDataFrame([(path,)], ["p"])
    got = df.select(timegeo.path_game_id(F.regexp_replace("p", "/[^/]*$", "")), timegeo.path_game_date(F.col("p")), timegeo.path_day(F.col("p"))).first()
    assert tuple(got) == ("gid_2015_04_02_sfnmlb_oakmlb_1", date(2015, 4, 2), date(2015, 4, 2))
    bad = spark.createDataFrame([("/year_2015/month_04/day_00/x",)], ["p"])
    assert bad.select(timegeo.path_day(F.col("p"))).first()[0] is None


def test_partial_dates(spark):
    df = spark.createDataFrame([("2015",), ("2015-04",), ("2015-04-03",), ("x",)], ["s"])
    got = [tuple(r) for r in df.select(timegeo.boundary(F.col("s")), timegeo.boundary_parts(F.col("s"))).collect()]
    assert got == [(date(2015, 1, 1), 1), (date(2015, 4, 1), 2), (date(2015, 4, 3), 3), (None, 0)]


def test_event_codes(spark):
    cases = {
        ("Groundout", ""): "O", ("Single", ""): "H", ("Strikeout - DP", ""): "SO", ("Intent Walk", ""): "W", ("Home Run", ""): "HR",
        ("Stolen Base 2B", ""): "SB", ("Sac Fly DP", ""): "SAC", ("Balk", ""): "BALK", ("Fielders Choice Out", ""): "FC",
        ("Wild Pitch", ""): "WP", ("Error", ""): "E", ("Hit By Pitch", ""): "HBP", ("Triple", ""): "3B", ("Whatever", ""): None,
        ("Fan interference", "he doubles and is out"): "2B", ("Fan Interference", "triples"): "3B", ("Fan interference", "is out"): "O",
        ("Fan interference", "throwing error"): "E", ("Fan interference", "singles"): "H", ("Fan interference", "nothing"): None,
    }
    df = spark.createDataFrame(list(cases), ["e", "d"])
    got = df.select("e", "d", classify(F.col("e"), rules.EVENT_RULES, F.col("d")).alias("c")).collect()
    assert {(r["e"], r["d"]): r["c"] for r in got} == cases


def test_positions(spark):
    df = spark.createDataFrame([("SP",), ("RF",), ("DH",), ("SS",)], ["p"])
    assert [r[0] for r in df.select(recode(F.col("p"), rules.POSITION_GROUPS)).collect()] == ["P", "OF", "1B", "SS"]


@pytest.mark.parametrize(
    ("des", "n"), [("Upton Jr. scores.", 0), ("José scores.", 0), ("A B scores. C D scores. ", 2), ("scores.", 0), (" scores.", 0), ("x scores.", 1)]
)
def test_scoring_sentences(spark, des, n):
    df = spark.createDataFrame([(des,)], ["d"])
    assert df.select(text.count_matches(F.col("d"), rules.SCORING_PATTERN)).first()[0] == n
    assert df.select(text.count_matches(F.col("d"), r"[\w ]+ scores\.")).first()[0] == n


def test_text(spark):
    df = spark.createDataFrame([(999.0,), (1500.0,), (2000000.0,), (2e15,)], ["n"])
    assert [r[0] for r in df.select(text.magnitude(F.col("n"))).collect()] == ["999.000", "1.500k", "2.000M", None]
    df = spark.createDataFrame([(["aaa", "bbb", "ccccc", "dd"],), (["toolong", "a"],), ([],)], "w array<string>")
    assert [r[0] for r in df.select(text.splice(F.col("w"), 6)).collect()] == [[[0, 1], [2], [3]], [[], [0], [1]], [[]]]
    df = spark.createDataFrame([("8. Ryan Example (L) 2B",), ("No lineup",)], ["l"])
    got = [r[0] for r in df.select(text.parse_lineup(F.col("l"))).collect()]
    assert tuple(got[0]) == (8, "Ryan Example", "L", "2B") and got[1] is None


def test_ratios(spark):
    df = spark.createDataFrame([(0, 0), (3, 1)], ["w", "l"])
    assert [r[0] for r in df.select(win_pct(F.col("w"), F.col("l"))).collect()] == [0.0, 0.75]
    assert df.select(ratio(F.col("w"), F.col("l"))).first()[0] == 0.0
    assert df.select(linear_score({"w": 2.0, "gone": 5.0}, ["w"]).alias("s")).collect()[1][0] == 6.0
