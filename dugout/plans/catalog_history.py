"""Queries on histories, trailing statistics, roll-ups and the feature table."""

from __future__ import annotations

import functools
from datetime import date

from pyspark.sql import functions as F

from ..functions import baseball as rules
from ..functions.score import scaled
from ..functions.text import count_matches
from ..operators.rollup import batting_rollup
from ..operators.scd import advance_history, as_of_versions, build_history, valid_at
from ..operators.shape import swap_perspective
from ..operators.topk import keep_last
from ..operators.trailing import daily_moments, hitter_ratios, interval_join_sums, sweep_sums, trailing_from_daily, trailing_stats
from ..session import materialise
from .registry import query

_HISTORY_SQL = """
    l AS (SELECT *, lag(event_type) OVER w AS before, lag(event_id) OVER w IS NULL AS is_first FROM obs
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    v AS (SELECT *, sum((is_first OR before IS DISTINCT FROM event_type)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM l),
    g AS (SELECT user_id, version, min(ts) AS start, arg_max(event_type, (ts, event_id)) AS event_type,
                 arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM v GROUP BY 1, 2),
    h AS (SELECT user_id, event_type, event_id, value, start AS effective_start_dt,
                 lead(start, 1, TIMESTAMP '9999-01-01') OVER (PARTITION BY user_id ORDER BY version) AS effective_stop_dt FROM g)
"""
_EVENT_HISTORY = f"WITH obs AS (SELECT user_id, event_type, event_id, value, ts FROM events), {_HISTORY_SQL}"


def event_history(t):
    seen = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    return build_history(seen, "user_id", "ts", ["event_type"], tie_break=["event_id"]).drop("ts")


@query(f"{_EVENT_HISTORY} SELECT * FROM h WHERE effective_start_dt < effective_stop_dt")
def scd2_build(t):
    return event_history(t)


_HOT = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"
_HOT_HISTORY = f"WITH obs AS (SELECT {_HOT} AS user_id, event_type, event_id, value, ts FROM events), {_HISTORY_SQL}"


@query(f"{_HOT_HISTORY} SELECT * FROM h WHERE effective_start_dt < effective_stop_dt")
def scd2_hot_key(t):
    key = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id")
    seen = t.events.select(key, "event_type", "event_id", "value", "ts")
    return build_history(seen, "user_id", "ts", ["event_type"], tie_break=["event_id"], rows_per_segment=1_000).drop("ts")


@query(f"{_EVENT_HISTORY} SELECT * FROM h WHERE effective_start_dt < effective_stop_dt")
def scd2_increment(t):
    """The same history made step by step: a first build, then a few days at a time."""
    seen = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    cuts = [F.lit(f"2024-01-{day}").cast("timestamp_ntz") for day in ("20", "23", "26")]
    first = materialise(build_history(seen.filter(F.col("ts") < cuts[0]), "user_id", "ts", ["event_type"], ["event_id"]), "first")
    still = F.col("effective_stop_dt") == F.lit("9999-01-01").cast("timestamp_ntz")
    closed, opened = [first.filter(~still)], first.filter(still)
    for low, high in zip(cuts, [*cuts[1:], None]):
        rows = seen.filter(F.col("ts") >= low if high is None else (F.col("ts") >= low) & (F.col("ts") < high))
        done, opened = advance_history(opened, rows, "user_id", "ts", ["event_type"], ["event_id"])
        closed.append(done)
        opened = materialise(opened, "opened")
    return functools.reduce(lambda a, b: a.unionByName(b), [*closed, opened]).drop("ts")


@query(
    f"""{_EVENT_HISTORY} SELECT user_id, event_type, event_id, effective_start_dt FROM h
    WHERE effective_start_dt <= TIMESTAMP '2024-01-15' AND effective_stop_dt > TIMESTAMP '2024-01-15'"""
)
def as_of_lookup(t):
    versions = valid_at(event_history(t), F.lit("2024-01-15").cast("timestamp_ntz"))
    return versions.select("user_id", "event_type", "event_id", "effective_start_dt")


_DAILY_HISTORY = f"""
    WITH obs AS (SELECT user_id, ts::DATE AS ts, arg_max(event_type, (ts, event_id)) AS event_type,
                        arg_max(event_id, (ts, event_id)) AS event_id, 0 AS value FROM events GROUP BY user_id, ts::DATE),
    {_HISTORY_SQL}
"""


def daily_history(t):
    """One version per run of days whose last event has the same type."""
    e = t.events.select("user_id", F.to_date("ts").alias("day"), "ts", "event_id", "event_type")
    last = keep_last(e, ["user_id", "day"], ["ts", "event_id"]).select("user_id", "day", "event_type")
    return build_history(last, "user_id", "day", ["event_type"], bounded=True).drop("day")


def _meetings(t):
    """Distinct (day, home, away): the user of an event and the user its payload names."""
    k = F.from_json("props", "struct<k:bigint>")["k"]
    pairs = t.events.select(F.to_date("ts").alias("day"), F.col("user_id").alias("home"), k.alias("away")).distinct()
    return materialise(pairs, "meetings")


@query(
    f"""{_DAILY_HISTORY}, m AS (SELECT DISTINCT ts::DATE AS day, user_id AS home, CAST(json_extract_string(props, '$.k') AS BIGINT) AS away FROM events)
    SELECT day, home, away, user_id, CASE WHEN user_id = home THEN 'home' ELSE 'away' END AS side, event_type,
           effective_start_dt::DATE AS effective_start_dt, effective_stop_dt::DATE AS effective_stop_dt
    FROM m JOIN h ON (home = user_id OR away = user_id) AND effective_start_dt <= day AND day < effective_stop_dt"""
)
def as_of_disjunctive(t):
    return as_of_versions(_meetings(t), daily_history(t), "day", {"home": "home", "away": "away"}, "user_id", bounded=True)


@query(
    f"""WITH obs AS (SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id, event_type, event_id, value, ts FROM events), {_HISTORY_SQL},
    f AS (SELECT event_id AS fact, ts AS moment, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS one, CASE WHEN event_id % 5 = 0 THEN user_id ELSE -1 END AS other FROM events)
    SELECT fact, moment, user_id, CASE WHEN user_id = one THEN 'one' ELSE 'other' END AS side, event_type, event_id, effective_start_dt
    FROM f JOIN h ON (one = user_id OR other = user_id) AND effective_start_dt <= moment AND moment < effective_stop_dt"""
)
def as_of_hot_member(t):
    """Moments to the microsecond, most rows on one member, and versions carried over cuts."""
    member = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    seen = t.events.select(member.alias("user_id"), "event_type", "event_id", "value", "ts")
    history = build_history(seen, "user_id", "ts", ["event_type"], ["event_id"]).drop("ts", "value")
    other = F.when(F.col("event_id") % 5 == 0, F.col("user_id")).otherwise(F.lit(-1))
    facts = t.events.select(F.col("event_id").alias("fact"), F.col("ts").alias("moment"), member.alias("one"), other.alias("other"))
    found = as_of_versions(facts, history, "moment", {"one": "one", "other": "other"}, "user_id", rows_per_segment=2_000)
    return found.drop("one", "other", "effective_stop_dt")


_WINDOWS = ("SEASON", 4, 7, 14)


def _interval_sql(facts: str, selected: str, keys: str = "user_id, day") -> str:
    """Window sums the slow way: every fact joined to every later as-of day of its year."""
    return f"""
    WITH f AS ({facts}), c AS (SELECT DISTINCT day FROM f),
         j AS (SELECT f.* EXCLUDE (day), c.day, date_diff('day', f.day, c.day) AS age FROM f JOIN c ON f.day < c.day AND year(f.day) = year(c.day))
    SELECT user_id, day, {selected} FROM j GROUP BY user_id, day"""


def _agg_sql(stat: str, window, aggs=("avg", "std", "var", "l1norm", "l2norm"), unit: str = "100.0::DOUBLE") -> list[str]:
    inside = "" if window == "SEASON" else f" FILTER (age <= {window})"
    n, s = f"count(*){inside}", f"coalesce(sum({stat}){inside}, 0)"
    q = f"coalesce(sum({stat}::HUGEINT * {stat}){inside}, 0)"
    var = f"coalesce(({n} * {q} - {s} * {s})::DOUBLE / nullif({n}::DOUBLE * {n}::DOUBLE, 0), 0)"
    mean = f"coalesce({s}::DOUBLE / nullif({n}::DOUBLE, 0), 0)"
    forms = {
        "avg": f"{mean} / {unit}",
        "std": f"sqrt({var}) / {unit}",
        "var": f"{var} / ({unit} * {unit})",
        "l1norm": f"coalesce(sum(abs({stat})){inside}, 0)::DOUBLE / {unit}",
        "l2norm": f"sqrt({q}::DOUBLE) / {unit}",
        "cov": f"coalesce(sqrt({var}) / nullif({mean}, 0), 0)",
        "literal": f"CASE WHEN sqrt({var}) > 0 THEN 1.0::DOUBLE ELSE 0.0 END",
    }
    return [f'{forms[a]} AS "mv_{window}_{a if a != "literal" else "cov"}_{stat}"' for a in aggs]


_CENTS = "SELECT user_id, ts::DATE AS day, round(value * 100)::BIGINT - 5000 AS cents FROM events"


def _cent_facts(t):
    return t.events.select("user_id", F.to_date("ts").alias("day"), (scaled("value") - 5000).alias("cents"))


@query(_interval_sql(_CENTS, ", ".join(x for w in _WINDOWS for x in _agg_sql("cents", w))), name="trailing_stats")
def trailing_averages(t):
    aggregates = ("avg", "std", "var", "l1norm", "l2norm")
    return trailing_stats(_cent_facts(t), "user_id", "day", ["cents"], _WINDOWS, aggregates=aggregates, scales={"cents": 100.0})


@query(_interval_sql("SELECT user_id, ts::DATE AS day, round(value * 100)::BIGINT AS value FROM events", ", ".join(x for w in ("SEASON", 7) for x in _agg_sql("value", w))))
def trailing_decimals(t):
    """Measures with decimals, scaled up inside, as the season jobs do."""
    facts = t.events.select("user_id", F.to_date("ts").alias("day"), "value")
    aggregates = ("avg", "std", "var", "l1norm", "l2norm")
    return trailing_stats(facts, "user_id", "day", ["value"], ("SEASON", 7), aggregates=aggregates, scales={"value": 100.0}, scaled=False)


@query(_interval_sql(_CENTS, ", ".join(x for w in (7, 14) for x in _agg_sql("cents", w, ["cov"]))))
def trailing_cov(t):
    return trailing_stats(_cent_facts(t), "user_id", "day", ["cents"], (7, 14), aggregates=("cov",), scales={"cents": 100.0})


@query(_interval_sql(_CENTS, ", ".join(x for w in (7, 14) for x in _agg_sql("cents", w, ["literal"]))))
def trailing_cov_literal(t):
    return trailing_stats(
        _cent_facts(t), "user_id", "day", ["cents"], (7, 14), aggregates=("cov",), scales={"cents": 100.0}, cov_mode="literal"
    )


_CODE = "CASE event_type WHEN 'click' THEN 'H' WHEN 'view' THEN 'O' WHEN 'purchase' THEN 'HR' WHEN 'signup' THEN 'W' WHEN 'error' THEN 'SB' END"
_ROLLUP = f"""
    SELECT day, user_id, ab, _1b, _2b, _3b, hr, rbi, r, bb, sb, hbp, total_hits, unclassified, ab - total_hits AS out,
           ((((((((0.0::DOUBLE + _1b * 3.0::DOUBLE) + _2b * 6.0::DOUBLE) + _3b * 9.0::DOUBLE) + hr * 12.0::DOUBLE) + rbi * 3.5::DOUBLE)
             + r * 3.2::DOUBLE) + bb * 3.0::DOUBLE) + sb * 6.0::DOUBLE) + hbp * 3.0::DOUBLE AS points
    FROM (SELECT ts::DATE AS day, user_id, count(*) FILTER (code IN ('H', 'O', 'HR') OR code IS NULL) AS ab, count(*) FILTER (code = 'H') AS _1b,
                 0::BIGINT AS _2b, 0::BIGINT AS _3b, count(*) FILTER (code = 'HR') AS hr,
                 (count(*) FILTER (code = 'HR') + sum(len(regexp_extract_all(des, '[\\w ]+ scores\\.'))))::BIGINT AS rbi,
                 count(*) FILTER (code = 'HR') AS r, count(*) FILTER (code = 'W') AS bb, count(*) FILTER (code = 'SB') AS sb, 0::BIGINT AS hbp,
                 count(*) FILTER (code IN ('H', 'HR')) AS total_hits, count(*) FILTER (code IS NULL) AS unclassified
          FROM (SELECT ts, user_id, CASE WHEN event_id % 20 = 0 THEN NULL ELSE {_CODE} END AS code,
                       CASE WHEN event_id % 3 = 0 THEN 'A B scores. C D scores. ' ELSE 'nobody' END AS des FROM events)
          WHERE user_id > 0 GROUP BY 1, 2)
"""


def _batting(t):
    codes = {"click": "H", "view": "O", "purchase": "HR", "signup": "W", "error": "SB"}
    code = F.try_element_at(F.create_map(*[F.lit(x) for p in codes.items() for x in p]), F.col("event_type"))
    rows = t.events.select(
        F.to_date("ts").alias("game_id"), F.col("user_id").alias("batter"),
        F.when(F.col("event_id") % 20 != 0, code).alias("fd_batter_event"),
        F.when(F.col("event_id") % 3 == 0, "A B scores. C D scores. ").otherwise("nobody").alias("des"),
    )
    return batting_rollup(rows).withColumnsRenamed({"game_id": "day", "batter": "user_id", "fd_points": "points"})


@query(_ROLLUP)
def event_rollup_score(t):
    columns = "day user_id ab _1b _2b _3b hr rbi r bb sb hbp total_hits unclassified out points"
    return _batting(t).select(*columns.split())


_COUNTERS = ("ab", "_1b", "_2b", "_3b", "hr", "bb", "hbp")


def _ratio_sql(w) -> str:
    inside = "" if w == "SEASON" else f" FILTER (age <= {w})"
    s = {c: f"coalesce(sum({c}){inside}, 0)::DOUBLE" for c in _COUNTERS}
    chances = f"({s['ab']} + {s['bb']} + {s['hbp']})"
    slugging = f"CASE WHEN {s['ab']} > 0 THEN ({s['_1b']} + {s['_2b']} * 2 + {s['_3b']} * 3 + {s['hr']} * 4) / {s['ab']} ELSE 0.0 END"
    obp = f"CASE WHEN {chances} > 0 THEN ({s['_1b']} + {s['_2b']} + {s['_3b']} + {s['hr']} + {s['bb']} + {s['hbp']}) / {chances} ELSE 0.0 END"
    d = "::DOUBLE"
    weights = [("bb", "0.69"), ("hbp", "0.72"), ("_1b", "0.89"), ("_2b", "1.27"), ("_3b", "1.62"), ("hr", "2.10")]
    total = "0.0::DOUBLE"
    for c, x in weights:
        total = f"({total} + {s[c]} * {x}{d})"
    woba = f"coalesce({total} / nullif({chances}, 0), 0)"
    return f'{slugging} AS "mv_{w}_slugging", {obp} AS "mv_{w}_obp", {obp} + {slugging} AS "mv_{w}_ops", {woba} AS "mv_{w}_woba"'


@query(_interval_sql(_ROLLUP, ", ".join(_ratio_sql(w) for w in ("SEASON", 4, 30))))
def trailing_ratios(t):
    facts = _batting(t).select("user_id", "day", *_COUNTERS)
    return trailing_stats(facts, "user_id", "day", _COUNTERS, ("SEASON", 4, 30), aggregates=(), ratios=hitter_ratios)


@query(
    """
    WITH f AS (SELECT user_id, ts::DATE AS day, round(value * 100)::BIGINT AS cents FROM events),
         c AS (SELECT DISTINCT day FROM f WHERE day >= DATE '2024-01-28')
    SELECT user_id, c.day, coalesce(sum(cents) FILTER (date_diff('day', f.day, c.day) <= 4), 0)::BIGINT AS sum_4_cents,
           sum(cents)::BIGINT AS sum_14_cents
    FROM f JOIN c ON f.day < c.day AND date_diff('day', f.day, c.day) <= 14 AND year(f.day) = year(c.day) GROUP BY ALL
    """
)
def forecast_day_sums(t):
    facts = t.events.select("user_id", "ts", F.to_date("ts").alias("day"), scaled("value").alias("cents"))
    days = facts.filter(F.col("ts") >= F.lit("2024-01-28").cast("timestamp_ntz")).select("day")
    sums = interval_join_sums(facts, "user_id", "day", ["cents"], [4, 14], days, moment="ts")
    return sums.select("user_id", "day", *[F.col(c).cast("bigint").alias(c) for c in ("sum_4_cents", "sum_14_cents")])


@query(
    """
    WITH f AS (SELECT o_custkey, o_orderdate::DATE AS day, round(o_totalprice * 100)::BIGINT AS cents FROM orders),
         c AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '1997-12-31', INTERVAL 1 DAY))::DATE AS day)
    SELECT o_custkey, c.day, coalesce(sum(cents) FILTER (date_diff('day', f.day, c.day) <= 7), 0)::BIGINT AS sum_7_cents, sum(cents)::BIGINT AS sum_30_cents
    FROM f JOIN c ON f.day < c.day AND date_diff('day', f.day, c.day) <= 30 AND year(f.day) = year(c.day) GROUP BY ALL
    """
)
def forecast_every_day(t):
    """All days of three years."""
    facts = t.orders.select("o_custkey", "o_orderdate", F.to_date("o_orderdate").alias("day"), scaled("o_totalprice").alias("cents"))
    return sweep_sums(facts, "o_custkey", "day", ["cents"], [7, 30], date(1995, 1, 1), date(1997, 12, 31), moment="o_orderdate")


@query(
    r"""
    SELECT source, count(*) AS n_docs, sum(len(regexp_extract_all(text, '[A-Za-z0-9_ ]+ [a-z]+\.')))::BIGINT AS n_matches,
           sum(len(regexp_extract_all(text, '[\w ]+ scores\.')))::BIGINT AS n_scores FROM documents GROUP BY source
    """
)
def pattern_count(t):
    return t.documents.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(count_matches(F.col("text"), r"[A-Za-z0-9_ ] [a-z]+\.")).alias("n_matches"),
        F.sum(count_matches(F.col("text"), rules.SCORING_PATTERN)).alias("n_scores"),
    )


_FEATURE_SQL = f"""
    WITH RECURSIVE_FREE AS (SELECT 1), mv AS ({_interval_sql(_CENTS, ", ".join(x for w in _WINDOWS for x in _agg_sql("cents", w, ["avg", "std"])))}),
    hist AS ({_DAILY_HISTORY} SELECT user_id, event_type AS status, effective_start_dt, effective_stop_dt FROM h),
    m AS (SELECT DISTINCT ts::DATE AS day, user_id AS home, CAST(json_extract_string(props, '$.k') AS BIGINT) AS away FROM events),
    dim AS (SELECT c_custkey, n_name, r_name, c_mktsegment, round(c_acctbal * 100)::BIGINT AS balance_cents FROM customer
            JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
    label AS (SELECT user_id, day, sum(cents)::BIGINT AS label_cents FROM ({_CENTS}) GROUP BY 1, 2)
    SELECT m.day, home, away, hist.user_id, status, hist.user_id = home AS is_home,
           CASE WHEN hist.user_id = home THEN hd.n_name ELSE ad.n_name END AS player_nation,
           CASE WHEN hist.user_id = home THEN ad.n_name ELSE hd.n_name END AS opponent_nation,
           CASE WHEN hist.user_id = home THEN hd.r_name ELSE ad.r_name END AS player_region,
           CASE WHEN hist.user_id = home THEN ad.r_name ELSE hd.r_name END AS opponent_region,
           (hd.r_name = ad.r_name AND hd.n_name = ad.n_name)::INT AS is_divisional, (hd.r_name <> ad.r_name)::INT AS is_cross_league,
           month(m.day)::INT AS game_month, (isodow(m.day) - 1)::INT AS game_weekday, label_cents, mv.* EXCLUDE (user_id, day)
    FROM m JOIN hist ON (home = hist.user_id OR away = hist.user_id) AND effective_start_dt <= m.day AND m.day < effective_stop_dt
    JOIN mv ON mv.user_id = hist.user_id AND mv.day = m.day
    JOIN dim hd ON hd.c_custkey = home JOIN dim ad ON ad.c_custkey = away
    LEFT JOIN label ON label.user_id = hist.user_id AND label.day = m.day
"""


@query(_FEATURE_SQL.replace("WITH RECURSIVE_FREE AS (SELECT 1), mv", "WITH mv"))
def feature_assembly(t):
    """Point-in-time features: the version valid on the day, trailing statistics, both sides, the label."""
    seen = t.events.select(
        "user_id", F.to_date("ts").alias("day"), (scaled("value") - 5000).alias("cents"), "ts", "event_id", "event_type"
    )
    # one pass over the events gives the moments, the label and the status of each user and day
    status = F.max_by("event_type", F.struct("ts", "event_id")).alias("status")
    daily = materialise(daily_moments(seen, "user_id", "day", ["cents"], "sq", [status]), "daily")
    trailing = trailing_from_daily(
        daily, "user_id", "day", ["cents"], _WINDOWS, daily, aggregates=("avg", "std"), scales={"cents": 100.0}
    )
    label = daily.select("user_id", "day", F.col("__s_cents").alias("label_cents"))
    dim = (
        t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )

    def side(name):
        return dim.select(F.col("c_custkey").alias(name), F.col("n_name").alias(f"{name}_nation"), F.col("r_name").alias(f"{name}_region"))

    history = build_history(daily.select("user_id", "day", "status"), "user_id", "day", ["status"], bounded=True).drop("day")
    rows = (
        as_of_versions(_meetings(t), history, "day", {"home": "home", "away": "away"}, "user_id", bounded=True)
        .drop("side", "effective_start_dt", "effective_stop_dt")
        .join(trailing, ["user_id", "day"])
        .join(label, ["user_id", "day"], "left")
        .join(side("home"), "home")
        .join(side("away"), "away")
    )
    same_region = F.col("home_region") == F.col("away_region")
    flagged = rows.withColumns(
        {
            "is_home": F.col("user_id") == F.col("home"),
            "is_divisional": (same_region & (F.col("home_nation") == F.col("away_nation"))).cast("int"),
            "is_cross_league": (~same_region).cast("int"),
            "game_month": F.month("day"),
            "game_weekday": F.weekday("day"),
        }
    )
    swapped = swap_perspective(flagged, F.col("is_home"), ["nation", "region"])
    return swapped.drop("home_nation", "away_nation", "home_region", "away_region")
