"""Merges, increments, sweeps and frontiers against plain joins and enumerations."""

import random
from datetime import date, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from dugout.operators import frontier, scd, skew, topk, trailing

DAY0 = date(2019, 12, 1)


def histories(rnd, members, overlap=False):
    out = []
    for m in members:
        for p in range(4 if overlap else 1):
            day = DAY0 + timedelta(days=rnd.randint(-2000, 20))
            for v in range(rnd.randint(0, 6)):
                stop = day + timedelta(days=rnd.choice([1, 3, 30, 400, 3000]))
                last = rnd.random() < 0.2
                out.append((m, f"{p}.{v}", day, date(9999, 1, 1) if last else stop))
                if last:
                    break
                day = stop + timedelta(days=rnd.choice([0, 0, 5]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("overlap", [False, True])
def test_as_of_joins_equal_the_range_join(spark, rows, seed, overlap):
    rnd = random.Random(seed)
    versions = histories(rnd, [*range(12), None], overlap)
    facts = [(i, DAY0 + timedelta(days=rnd.randint(-2100, 900)) if i % 17 else None, rnd.choice([0, 0, 0, rnd.randint(0, 14), None]), rnd.randint(0, 14)) for i in range(400)]
    f = spark.createDataFrame(facts, "g int, day date, home int, away int")
    v = spark.createDataFrame(versions, "team int, v string, effective_start_dt date, effective_stop_dt date")
    f.createOrReplaceTempView("facts1")
    v.createOrReplaceTempView("versions1")
    expected = rows(spark.sql("select g, team, v from facts1 join versions1 on (home = team or away = team) and day >= effective_start_dt and day < effective_stop_dt"))
    sides = {"home": "home", "away": "away"}
    assert expected and rows(scd.join_valid_versions(f, v, "day", sides, "team"), "g", "team", "v") == expected
    assert rows(scd.join_valid_versions(f, v, "day", sides, "team", bucket_days=1), "g", "team", "v") == expected
    if not overlap:
        for how in ({"bounded": True}, {}, {"rows_per_segment": 7}, {"rows_per_segment": 50}):
            assert rows(scd.as_of_versions(f, v, "day", sides, "team", **how), "g", "team", "v") == expected
    with pytest.raises(ValueError, match="both sides"):
        scd.as_of_versions(f.withColumn("v", F.lit(1)), v, "day", sides, "team")


def test_an_open_version_has_few_ranges(spark):
    v = spark.createDataFrame([(date(2013, 4, 1), date(9999, 1, 1)), (date(2013, 4, 1), date(2013, 4, 2)), (date(1931, 1, 1), date(2031, 1, 1))], "a date, b date")
    bucket = lambda c: F.floor(F.unix_date(c) / 7).cast("int")
    made = v.select(F.size(scd._covering(bucket("a"), bucket("b"))).alias("n")).collect()
    assert max(r["n"] for r in made) <= 7 * 14


def test_increments_equal_one_build(spark, rows):
    rnd = random.Random(5)
    seen = [(rnd.choice([1, 1, 1, 2, 3, None, rnd.randint(4, 30)]), DAY0 + timedelta(days=rnd.randint(0, 60)), i, rnd.choice("ab")) for i in range(500)]
    df = spark.createDataFrame(seen, "p int, day date, i int, s string")
    whole = scd.build_history(df, "p", "day", ["s"], ["i"])
    cuts = [DAY0 + timedelta(days=n) for n in (20, 21, 40, 61)]
    first = scd.build_history(df.filter(F.col("day") < cuts[0]), "p", "day", ["s"], ["i"])
    still = F.col("effective_stop_dt") == F.lit(date(9999, 1, 1))
    closed, opened = [first.filter(~still)], first.filter(still)
    for low, high in zip(cuts, cuts[1:]):
        done, opened = scd.advance_history(opened, df.filter((F.col("day") >= low) & (F.col("day") < high)), "p", "day", ["s"], ["i"])
        closed.append(done)
    parts = closed[0].union(closed[1]).union(closed[2]).union(closed[3]).unionByName(opened)
    columns = ("p", "s", "i", "effective_start_dt", "effective_stop_dt")
    assert rows(parts, *columns) == rows(whole, *columns)
    # nothing new changes nothing
    done, same = scd.advance_history(opened, df.limit(0), "p", "day", ["s"], ["i"])
    assert done.count() == 0 and rows(same, *columns) == rows(opened, *columns)


def test_equal_rows_are_cut(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("k"), F.lit(None).cast("int").alias("o"), "id")
    sizes = skew.segmented(df, ["k"], ["o"], 100_000).groupBy(skew.SEGMENT).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 250_000
    numbered = skew.number_rows(df, ["k"], ["o"], rows_per_segment=100_000)
    assert tuple(numbered.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()) == (1, 1_000_000, 1_000_000)
    assert topk.batches(df, ["o"], 250).groupBy("batch").count().filter("count <> 250").count() == 0


def test_numbering_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, o int")
    assert skew.number_rows(df, ["k"], ["o"]).count() == 0 and skew.number_rows(df, [], ["o"]).count() == 0


def test_sweep_equals_the_interval_join(spark, rows):
    rnd = random.Random(3)
    facts = spark.createDataFrame([(rnd.randint(1, 4), DAY0 + timedelta(days=rnd.randint(0, 430)), rnd.randint(-9, 9)) for _ in range(120)], "p int, day date, x int")
    first, last = DAY0 + timedelta(days=10), DAY0 + timedelta(days=450)
    days = spark.createDataFrame([(first + timedelta(days=i),) for i in range((last - first).days + 1)], "day date")
    a = trailing.sweep_sums(facts, "p", "day", ["x"], [3, 40], first, last)
    b = trailing.interval_join_sums(facts, "p", "day", ["x"], [3, 40], days)
    assert rows(a, "p", "day", "sum_3_x", "sum_40_x") == rows(b, "p", "day", "sum_3_x", "sum_40_x")
    assert trailing.sweep_sums(facts.limit(0), "p", "day", ["x"], [3], first, last).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_frontier_and_counts_equal_enumeration(spark, seed):
    rnd = random.Random(seed)
    cands = [(pos, rnd.choice("ABCD" if seed < 3 else "A"), f"{pos}{i}", rnd.randint(1, 3) * 100, rnd.randint(-5, 9)) for pos, n in (("OF", 7), ("SS", 4)) for i in range(n)]
    df = spark.createDataFrame(cands, "position string, team string, player string, cost long, points long")
    of, ss = (sorted((c for c in cands if c[0] == p), key=lambda c: (-c[4], c[2])) for p in ("OF", "SS"))
    picks = [(*trio, s) for trio in combinations(of, 3) for s in ss]
    best = {}
    for pick in picks:
        best.setdefault(sum(c[3] for c in pick), []).append((-sum(c[4] for c in pick), [c[2] for c in pick]))
    want = [(cost, -min(found)[0], min(found)[1], len(found)) for cost, found in sorted(best.items())]
    got = frontier.cost_frontier(df, ["OF", "OF", "OF", "SS"], 10_000).orderBy("cost").collect()
    assert [tuple(r) for r in got] == want
    for cap, limit in ((700, 1), (800, 2), (10_000, 4)):
        over = [p for p in picks if sum(c[3] for c in p) > cap]
        crowded = [p for p in picks if p not in over and max([c[1] for c in p].count(t) for t in "ABCD") > limit]
        row = frontier.count_rosters(df, ["OF", "OF", "OF", "SS"], cap, limit).first()
        assert tuple(row) == (len(picks), len(over), len(crowded), len(picks) - len(over) - len(crowded))
    assert frontier.cost_frontier(df.limit(0), ["OF", "SS"], 1000).count() == 0
    assert tuple(frontier.count_rosters(df.limit(0), ["OF", "SS"], 1000, 2).first()) == (0, 0, 0, 0)


def test_small_segments_make_no_more_tasks(spark):
    df = spark.range(6_000).selectExpr("id % 3 AS k", "id AS o")
    rows = skew.segmented(df, ["k"], ["o"], rows_per_segment=10)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(rows.inputFiles()) <= tasks
    sizes = [r["count"] for r in rows.groupBy(skew.SEGMENT).count().collect()]
    assert max(sizes) == 10 and 600 <= len(sizes) <= 600 + tasks
    spans = sorted((r["lo"], r["hi"], r["segment"]) for r in rows.selectExpr("k * 10000 + o AS at", f"{skew.SEGMENT} AS segment").groupBy("segment").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).collect())
    assert all(a[1] < b[0] and a[2] < b[2] for a, b in zip(spans, spans[1:]))
    assert rows.filter(f"{skew.PLACE} >= 10 OR {skew.PLACE} < 0").count() == 0
