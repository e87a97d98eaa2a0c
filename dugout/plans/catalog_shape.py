"""Queries on projections, filters, rules, dates and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import baseball as rules
from ..functions import text, timegeo
from ..functions.rules import Rule, classify, denied, recode
from ..functions.score import scaled, win_pct
from ..operators.joins import select_joined
from ..operators.shape import conform, re_role, select_except, sorted_columns, swap_perspective, with_defaults, zero_fill
from ..operators.weather import fill_fields, wind_flags
from ..sources.contest import eligible_csv, eligible_json
from ..sources.schemas import ddl
from .registry import query


def _k(df):
    return df.withColumn("k", F.from_json("props", "struct<k:int>")["k"])


@query(
    """
    SELECT c_custkey::INT AS c_custkey, c_name, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
           c_acctbal, round(c_acctbal * 100)::BIGINT / 3.0::DOUBLE AS thirds, NULL::INT AS absent FROM customer
    """
)
def conform_schema(t):
    raw = t.customer.select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.when(F.col("c_nationkey") % 5 == 0, " ").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
        (scaled("c_acctbal").cast("double") / F.lit(3.0)).alias("thirds"),
    )
    return conform(raw, ddl("c_custkey int, c_name string, c_nationkey int, c_acctbal double, thirds double, absent int"))


@query(
    """
    SELECT c_acctbal, c_mktsegment, c_name, o_orderkey, o_orderstatus, o_totalprice,
           o_totalprice AS score_orig, c_nationkey + o_totalprice AS score
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    name="select_except",
)
def column_selection(t):
    customers = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    joined = select_joined(t.orders, customers, ["o_custkey"])
    scored = joined.withColumns({"score_orig": F.col("o_totalprice"), "score": F.col("c_nationkey") + F.col("o_totalprice")})
    return sorted_columns(select_except(scored, ["o_custkey", "o_orderdate", "o_orderpriority", "c_nationkey"]))


@query(
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW' AND o_totalprice > 0
    """
)
def filter_status(t):
    kept = t.orders.filter(F.col("o_orderstatus").isin("F", "O") & (F.col("o_orderpriority") != "5-LOW") & (F.col("o_totalprice") > 0))
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    """
    SELECT event_id, event_type FROM events
    WHERE NOT (event_type = 'error' OR starts_with(event_type, 'sign')) AND user_id > 0 AND NOT (value < 1 AND user_id % 2 = 0)
    """
)
def event_denylist(t):
    keep = ~denied(F.col("event_type"), exact=["error"], prefixes=["sign"]) & (F.col("user_id") > 0)
    empty = (F.col("value") < 1) & (F.col("user_id") % 2 == 0)
    return t.events.filter(keep & ~empty).select("event_id", "event_type")


@query(
    """
    WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k0 FROM events)
    SELECT event_id, CASE WHEN k0 % 10 = 0 THEN -5 ELSE k0 END AS k, -1 AS num,
           CASE WHEN event_type = 'error' THEN user_id ELSE -1 END AS pitcher,
           CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS batter,
           CASE WHEN k0 % 7 < 2 THEN 0.0 ELSE value END AS value,
           CASE WHEN event_type = 'view' THEN 'OF' ELSE event_type END AS position
    FROM e
    """
)
def defaults_and_roles(t):
    e = _k(t.events)
    k = F.col("k")
    e = e.withColumns(
        {
            "value": F.when(k % 7 == 0, None).when(k % 7 == 1, F.lit(float("nan"))).otherwise(F.col("value")),
            "position": F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")),
            "k": F.when(k % 10 != 0, k),
        }
    )
    filled = with_defaults(zero_fill(e, ["value"]), {"k": -5, "position": ("OF", "blank")})
    roles = re_role(filled, "event_type", "user_id", ["error"])
    return roles.select("event_id", "k", "num", "pitcher", "batter", "value", "position")


@query(
    """
    SELECT event_id, CASE WHEN event_type IN ('purchase', 'error') THEN 'O' WHEN starts_with(event_type, 'sign') THEN 'SB'
           WHEN event_type = 'click' THEN CASE WHEN contains(props, '7') THEN '2B' WHEN contains(props, '5') THEN '3B'
           WHEN contains(props, '3') THEN 'O' END END AS code FROM events
    """,
    name="classify",
)
def classify_events(t):
    table = [
        Rule("O", exact=("purchase", "error")),
        Rule("SB", prefixes=("sign",)),
        Rule(exact=("click",), by_text=(("7", "2B"), ("5", "3B"), ("3", "O"))),
    ]
    return t.events.select("event_id", classify(F.col("event_type"), table, F.col("props")).alias("code"))


@query(
    """
    SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'P' WHEN p_type IN ('SMALL', 'LARGE', 'MEDIUM') THEN 'OF'
           ELSE p_type END AS position FROM part
    """
)
def recode_positions(t):
    groups = {"P": ("ECONOMY", "STANDARD"), "OF": ("SMALL", "LARGE", "MEDIUM")}
    return t.part.select("p_partkey", recode(F.col("p_type"), groups).alias("position"))


@query(
    """
    SELECT event_id,
           CASE WHEN event_id % 50 = 0 THEN date_trunc('day', ts)::TIMESTAMP + INTERVAL 19 HOUR ELSE date_trunc('minute', ts) END AS game_time,
           CASE WHEN event_id % 37 = 0 THEN NULL ELSE date_trunc('second', ts) END AS zulu,
           date_trunc('second', ts) + INTERVAL 5 HOUR AS utc
    FROM events
    """
)
def clock_parse(t):
    day = F.to_date("ts")
    clock = F.when(F.col("event_id") % 50 == 0, "DH").otherwise(F.date_format("ts", "h:mm"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    blanked = F.when(F.col("event_id") % 37 == 0, "").otherwise(stamp)
    return t.events.select(
        "event_id",
        timegeo.clock_12h(day, clock, F.date_format("ts", "a")).alias("game_time"),
        timegeo.zulu(blanked).alias("zulu"),
        timegeo.eastern_to_utc(timegeo.zulu(stamp)).alias("utc"),
    )


@query(
    """
    SELECT o_orderkey, hour(ts)::INT AS game_hour, month(ts)::INT AS game_month, (isodow(ts) - 1)::INT AS game_weekday,
           (n.n_regionkey = 2 AND c_nationkey % 2 = 0)::INT AS is_divisional, (n.n_regionkey <> 2)::INT AS is_cross_league
    FROM (SELECT *, o_orderdate + INTERVAL (o_orderkey % 24) HOUR AS ts FROM orders) o
    JOIN customer ON c_custkey = o_custkey JOIN nation n ON n_nationkey = c_nationkey
    """
)
def calendar_features(t):
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    clock = F.concat_ws(":", (F.col("o_orderkey") % 24).cast("string"), F.lit("05"))
    same_league = F.col("n_regionkey") == 2
    return o.select(
        "o_orderkey", timegeo.hour_of_clock(clock).alias("game_hour"), F.month("o_orderdate").alias("game_month"),
        F.weekday("o_orderdate").alias("game_weekday"),
        (same_league & (F.col("c_nationkey") % 2 == 0)).cast("int").alias("is_divisional"),
        (~same_league).cast("int").alias("is_cross_league"),
    )


@query(
    """
    WITH g AS (
        SELECT c_nationkey AS home, s_nationkey AS away, count(*) FILTER (l_returnflag = 'A') AS home_won,
               count(*) FILTER (l_returnflag = 'R') AS home_loss, count(*) FILTER (l_linenumber = 1) AS away_won,
               count(*) FILTER (l_linenumber = 2) AS away_loss
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL)
    SELECT home, away, home < away AS is_home, CASE WHEN home < away THEN home ELSE away END AS player_team,
           CASE WHEN home < away THEN away ELSE home END AS opponent_team,
           CASE WHEN home < away THEN hp ELSE ap END AS player_win_pct, CASE WHEN home < away THEN ap ELSE hp END AS opponent_win_pct
    FROM (SELECT *, coalesce(home_won / nullif(home_won + home_loss, 0)::DOUBLE, 0) AS hp,
                 coalesce(away_won / nullif(away_won + away_loss, 0)::DOUBLE, 0) AS ap FROM g)
    """
)
def perspective_swap(t):
    facts = (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    )
    g = facts.groupBy(F.col("c_nationkey").alias("home"), F.col("s_nationkey").alias("away")).agg(
        F.count_if(F.col("l_returnflag") == "A").alias("home_won"), F.count_if(F.col("l_returnflag") == "R").alias("home_loss"),
        F.count_if(F.col("l_linenumber") == 1).alias("away_won"), F.count_if(F.col("l_linenumber") == 2).alias("away_loss"),
    )
    sides = g.select(
        "home", "away", (F.col("home") < F.col("away")).alias("is_home"), F.col("home").alias("home_team"),
        F.col("away").alias("away_team"), win_pct(F.col("home_won"), F.col("home_loss")).alias("home_win_pct"),
        win_pct(F.col("away_won"), F.col("away_loss")).alias("away_win_pct"),
    )
    swapped = swap_perspective(sides, F.col("is_home"), ["team", "win_pct"])
    return swapped.drop("home_team", "away_team", "home_win_pct", "away_win_pct")


@query(
    """
    SELECT o_orderkey, o_custkey || '_' || o_orderkey AS player_game, o_orderpriority || '_' || o_orderstatus AS division,
           string_split(o_orderpriority, '-')[1] AS first_part FROM orders
    """
)
def key_strings(t):
    return t.orders.select(
        "o_orderkey", F.concat_ws("_", "o_custkey", "o_orderkey").alias("player_game"),
        F.concat_ws("_", "o_orderpriority", "o_orderstatus").alias("division"),
        F.get(F.split("o_orderpriority", "-"), 0).alias("first_part"),
    )


@query(
    """
    WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) * 4 AS bearing, (user_id * 15 % 360)::INT AS axis,
                      user_id % 6 = 0 AS covered FROM events),
         a AS (SELECT *, abs(((bearing - axis + 180) % 360 + 360) % 360 - 180) AS diff,
                      abs(((bearing + 180 - axis + 180) % 360 + 360) % 360 - 180) AS back FROM e)
    SELECT event_id, bearing, axis, diff <= 55 AND NOT covered AS blowing_out, back <= 55 AND NOT covered AS blowing_in FROM a
    """
)
def angle_sector(t):
    e = _k(t.events).select(
        "event_id", (F.col("k") * 4).alias("bearing"), (F.col("user_id") * 15 % 360).cast("int").alias("axis"),
        (F.col("user_id") % 6 == 0).alias("covered"),
    )
    return wind_flags(e, "bearing", "axis", F.col("covered")).drop("covered")


@query(
    """
    WITH e AS (SELECT event_id, user_id % 3 AS dome, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
         o AS (SELECT event_id, dome, CASE WHEN k % 4 > 0 THEN k * 1.0::DOUBLE END AS temperature,
                      CASE WHEN k % 5 > 0 THEN k / 2.0::DOUBLE END AS "windSpeed", CASE WHEN k % 3 > 0 THEN 'rain' END AS "precipType",
                      CASE WHEN k % 2 > 0 THEN 300.0::DOUBLE + k END AS ozone FROM e)
    SELECT event_id, CASE WHEN dome > 0 THEN 70.0 ELSE temperature END AS temperature,
           CASE WHEN dome > 0 THEN 0.0 ELSE coalesce("windSpeed", 0.0) END AS "windSpeed",
           CASE WHEN dome > 0 THEN '' ELSE coalesce("precipType", '') END AS "precipType", coalesce(ozone, 310.0) AS ozone
    FROM o
    """
)
def dome_defaults(t):
    k = F.col("k")
    seen = _k(t.events).select(
        "event_id", (F.col("user_id") % 3).alias("dome"), F.when(k % 4 > 0, k.cast("double")).alias("temperature"),
        F.when(k % 5 > 0, k / F.lit(2.0)).alias("windSpeed"), F.when(k % 3 > 0, "rain").alias("precipType"),
        F.when(k % 2 > 0, k + F.lit(300.0)).alias("ozone"),
    )
    constants = {n: rules.COVERED_WEATHER[n] for n in ("temperature", "windSpeed", "precipType", "ozone")}
    filled = fill_fields(seen, F.col("dome") > 0, constants, rules.NO_WEATHER_FALLBACK, keep_when_covered=["ozone"])
    return filled.drop("dome")


@query(
    """
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL WHEN 1 THEN date_trunc('month', o_orderdate)::DATE
           WHEN 2 THEN date_trunc('year', o_orderdate)::DATE ELSE o_orderdate::DATE END AS day,
           CASE o_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS parts,
           o_orderkey % 4 = 0 AS is_full,
           CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
           WHEN 2 THEN strftime(o_orderdate, '%Y') ELSE 'junk' END AS reformatted,
           strftime(o_orderdate, 'year_%Y/month_%m/day_%d') AS folder
    FROM orders
    """
)
def multi_date_parse(t):
    form = F.col("o_orderkey") % 4
    shown = (
        F.when(form == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(form == 1, F.date_format("o_orderdate", "yyyy-MM"))
        .when(form == 2, F.date_format("o_orderdate", "yyyy"))
        .otherwise("junk")
    )
    return t.orders.withColumn("shown", shown).select(
        "o_orderkey", timegeo.boundary(F.col("shown")).alias("day"), timegeo.boundary_parts(F.col("shown")).alias("parts"),
        timegeo.is_valid_date(F.col("shown"), "yyyy-MM-dd").alias("is_full"),
        timegeo.reformat_date(F.col("shown"), "yyyy-MM-dd", "yyyyMMdd").alias("reformatted"),
        timegeo.day_path(F.col("o_orderdate")).alias("folder"),
    )


@query(
    """
    SELECT o_orderkey, o_orderpriority AS decoded,
           CASE WHEN v < 1e3 THEN printf('%.3f', v) WHEN v < 1e6 THEN printf('%.3fk', v / 1e3)
                WHEN v < 1e9 THEN printf('%.3fM', v / 1e6) END AS shown
    FROM (SELECT *, ((o_totalprice + 0.001::DOUBLE) * (CASE WHEN o_orderkey % 3 = 0 THEN 0.0009765625 WHEN o_orderkey % 3 = 1 THEN 1 ELSE 1024 END)::DOUBLE) AS v FROM orders)
    """
)
def text_utils(t):
    factor = F.when(F.col("o_orderkey") % 3 == 0, 0.0009765625).when(F.col("o_orderkey") % 3 == 1, 1.0).otherwise(1024.0)
    return t.orders.select(
        "o_orderkey", text.decode_base64(F.base64(F.encode("o_orderpriority", "UTF-8"))).alias("decoded"),
        text.magnitude((F.col("o_totalprice") + 0.001) * factor).alias("shown"),
    )


@query(
    """
    WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents),
         s AS (SELECT doc_id, len(words) AS n_words,
                      list_reduce(list_transform(words, lambda x: {'used': len(x), 'runs': 0}),
                                  lambda a, x: CASE WHEN a.used + x.used <= 80 THEN {'used': a.used + x.used, 'runs': a.runs}
                                               ELSE {'used': x.used, 'runs': a.runs + 1} END,
                                  {'used': 0::BIGINT, 'runs': 1::INTEGER}) AS st FROM w)
    SELECT doc_id, n_words::INT AS n_words, st.runs AS n_runs, st.used::INT AS last_length FROM s
    """
)
def greedy_splice(t):
    words = F.split("text", " ")
    runs = t.documents.select("doc_id", words.alias("words"), text.splice_starts(words, 80).alias("starts"))
    tail = F.slice("words", F.element_at("starts", -1) + F.lit(1), F.size("words"))
    return runs.select(
        "doc_id", F.size("words").alias("n_words"), F.size("starts").alias("n_runs"),
        F.aggregate(tail, F.lit(0), lambda a, w: a + F.length(w)).alias("last_length"),
    )


@query(
    """
    SELECT p_partkey, CASE WHEN p_partkey % 11 > 0 THEN (p_partkey % 9 + 1)::INT END AS batting_order,
           CASE WHEN p_partkey % 11 > 0 THEN p_name END AS name,
           CASE WHEN p_partkey % 11 > 0 THEN substr(p_brand, 7) END AS side, CASE WHEN p_partkey % 11 > 0 THEN p_type END AS position
    FROM part
    """
)
def lineup_parse(t):
    line = F.when(
        F.col("p_partkey") % 11 > 0,
        F.concat((F.col("p_partkey") % 9 + 1).cast("string"), F.lit(". "), "p_name", F.lit(" ("), F.substring("p_brand", 7, 9), F.lit(") "), "p_type"),
    ).otherwise("no lineup yet")
    p = t.part.select("p_partkey", text.parse_lineup(line).alias("l"))
    return p.select("p_partkey", F.col("l.order").alias("batting_order"), "l.name", "l.side", "l.position")


_STATUS_SQL = """
    WITH s AS (SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'P' ELSE 'OF' END AS position,
                      CASE WHEN k % 3 = 0 THEN '' ELSE 'Yes' END AS probable, k % 7 AS code,
                      CASE WHEN k % 5 = 0 THEN 'DTD' ELSE '' END AS injury,
                      CASE event_type WHEN 'view' THEN 'Starter' WHEN 'click' THEN 'Non-Starter' WHEN 'error' THEN 'No Lineup' END AS status,
                      CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'Inactive' WHEN event_type <> 'signup' THEN 'Active' END AS active
               FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))
"""


def _statuses(t):
    k, kind = F.col("k"), F.col("event_type")
    return _k(t.events).select(
        "event_id", F.when(F.col("user_id") % 4 == 0, "P").otherwise("OF").alias("position"),
        F.when(k % 3 == 0, "").otherwise("Yes").alias("probable"), (k % 7).alias("code"),
        F.when(k % 5 == 0, "DTD").otherwise("").alias("injury"),
        F.when(kind == "view", "Starter").when(kind == "click", "Non-Starter").when(kind == "error", "No Lineup").alias("status"),
        F.when((kind == "error") & (k % 2 == 0), "Inactive").when(kind != "signup", "Active").alias("active"),
    )


@query(
    _STATUS_SQL
    + """
    SELECT event_id FROM s WHERE CASE
        WHEN status IS NULL OR status = 'No Lineup' THEN NOT (position = 'P' AND probable = '') AND coalesce(active, '') <> 'Inactive' AND injury = ''
        WHEN position = 'P' THEN probable <> '' ELSE status = 'Starter' AND injury = '' END
    """
)
def eligibility(t):
    c = [F.col(x) for x in ("position", "probable", "injury", "status", "active")]
    return _statuses(t).filter(eligible_csv(*c)).select("event_id")


@query(
    _STATUS_SQL
    + """
    SELECT event_id FROM s WHERE injury = '' AND code NOT IN (2, 6) AND CASE
        WHEN status IS NULL OR status = 'No Lineup' THEN NOT (position = 'P' AND code NOT IN (1, 5)) AND coalesce(active, '') <> 'Inactive'
             AND NOT (position <> 'P' AND code <> 4)
        ELSE (position = 'P' AND code IN (1, 5)) OR status = 'Starter' END
    """
)
def eligibility_codes(t):
    c = [F.col(x) for x in ("position", "code", "injury", "status", "active")]
    return _statuses(t).filter(eligible_json(*c)).select("event_id")
