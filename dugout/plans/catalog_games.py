"""Queries on the readers of game documents, contest lists and pages.

The documents are built from the test tables in the shape of the landing area, one per order or customer, and
go through the readers as they are; the SQL states the rows that must come out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timegeo import path_day, path_game_date, path_game_id
from ..operators import roster
from ..operators.rollup import played_hitters, played_pitchers
from ..operators.trailing import pitcher_ratios, trailing_stats
from ..session import scratch_path
from ..sources import games, pages
from ..sources.contest import read_contest_csv
from ..sources.tables import write_csv
from .catalog_model import _PLAYERS, _candidates
from .registry import query


def _order_documents(t, doc):
    """(game_id, game_date, doc) with one document per order."""
    return t.orders.select(
        F.concat(F.lit("gid_"), F.col("o_orderkey")).alias("game_id"), F.to_date("o_orderdate").alias("game_date"), F.to_json(doc).alias("doc")
    )


def _text(value):
    return value.cast("string")


@query(
    """
    SELECT 'gid_' || o_orderkey AS game_id, o_orderdate::DATE AS game_date, year(o_orderdate)::INT AS game_year, 'Final' AS game_status,
           (o_custkey % 90)::INT AS home_won, NULL::INT AS away_won, 'H' || o_custkey % 30 AS home_abbrev,
           CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate::DATE + INTERVAL 19 HOUR
                ELSE o_orderdate::DATE + to_hours((o_orderkey % 12 + CASE WHEN o_orderkey % 4 < 2 THEN 12 ELSE 0 END)::INT) + INTERVAL 5 MINUTE
           END::TIMESTAMP AS game_time_et,
           (o_custkey % 40)::INT AS stadium_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Town' ELSE '' END AS stadium_location
    FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0
    """
)
def line_score_games(t):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    hour = F.when(key % 12 == 0, 12).otherwise(key % 12)
    fields = {
        "game_type": F.when(key % 5 == 0, "S").otherwise("R"), "status": F.lit("Final"), "home_win": _text(cust % 90), "away_win": F.lit(" "),
        "home_team_name": F.when(key % 7 == 0, "TBD").otherwise("Home"), "home_code": F.concat(F.lit("h"), cust % 30),
        "time": F.when(key % 6 == 0, "late").otherwise(F.concat(hour, F.lit(":05"))), "ampm": F.when(key % 4 < 2, "pm").otherwise("AM"),
        "venue_id": _text(cust % 40), "location": F.when(key % 2 == 0, "Town"),
    }
    game = F.struct(*[c.alias(n) for n, c in fields.items()])
    rows = games.games(_order_documents(t, F.struct(F.struct(game.alias("game")).alias("data"))))
    return rows.select(
        "game_id", "game_date", "game_year", "game_status", "home_won", "away_won", "home_abbrev", "game_time_et", "stadium_id", "stadium_location"
    )


def _event(event, player=None, **more):
    fields = {"event": event, "player": player, **more}
    return F.struct(*[_text(c if not isinstance(c, (str, int)) else F.lit(c)).alias(n) for n, c in fields.items() if c is not None])


@query(
    """
    WITH o AS (SELECT 'gid_' || o_orderkey AS game_id, o_orderdate::DATE AS game_date, o_orderkey AS k, o_custkey AS c FROM orders WHERE o_orderkey % 4 <> 0)
    SELECT game_id, game_date, 1 AS inning, 'top' AS top_bottom, CASE k % 5 WHEN 0 THEN 'H' WHEN 1 THEN 'HR' WHEN 2 THEN 'W' ELSE 'SO' END AS fd_batter_event,
           2 AS balls, 0 AS strikes, (k % 3)::INT AS outs, c::INT AS pitcher, (c + 1)::INT AS batter, 1 AS num,
           (game_date + INTERVAL 23 HOUR)::TIMESTAMP AS start_tfs_zulu FROM o WHERE k % 5 <> 4
    UNION ALL SELECT game_id, game_date, 1, 'bottom', '2B', 0, 0, 1, c, c + 2, 2, NULL FROM o
    UNION ALL SELECT game_id, game_date, 1, 'bottom', '2B', 0, 1, 2, c, c + 3, 3, NULL FROM o
    UNION ALL SELECT game_id, game_date, 2, 'top', 'O', 0, 0, 1, c, c + 4, 4, NULL FROM o
    UNION ALL SELECT game_id, game_date, 2, 'top', 'WP', 0, 0, 1, c + 9, -1, -1, NULL FROM o
    UNION ALL SELECT game_id, game_date, 2, 'top', 'SB', 0, 0, 1, -1, c + 8, -1, NULL FROM o
    """
)
def event_documents(t):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.element_at(F.array(*map(F.lit, ("Single", "Home Run", "Walk", "Strikeout", "Runner Out"))), (key % 5 + 1).cast("int"))
    when = F.concat(F.to_date("o_orderdate"), F.lit("T23:00:00Z"))
    at_bat = F.struct(_event(kind, b=2, o=key % 3, pitcher=cust, batter=cust + 1, num=1, start_tfs_zulu=when).alias("atbat"))
    two = F.array(
        _event("Double", s="0", o="1", pitcher=cust, batter=cust + 2, num=2, des="x"),
        _event("Fan interference", s="1", o="2", pitcher=cust, batter=cust + 3, num=3, des="hits a double"),
    )
    actions = F.array(*[_event(e, p, o="1") for e, p in (("Wild Pitch", cust + 9), ("Pickoff Attempt 1B", cust), ("Stolen Base 2B", cust + 8))])
    # an at-bat is an object or a list, an action belongs to a half inning with at-bats
    first = F.struct(F.lit("1").alias("num"), at_bat.alias("top"), F.struct(two.alias("atbat")).alias("bottom"))
    out = F.struct(_event("Groundout", o=1, pitcher=cust, batter=cust + 4, num=4).alias("atbat"), actions.alias("action"))
    second = F.struct(F.lit("2").alias("num"), out.alias("top"), F.struct(actions.alias("action")).alias("bottom"))
    innings = F.when(key % 4 == 0, F.to_json(first)).otherwise(F.concat(F.lit("["), F.to_json(first), F.lit(","), F.to_json(second), F.lit("]")))
    doc = F.concat(F.lit('{"data":{"game":{"inning":'), innings, F.lit("}}}"))
    docs = t.orders.select(F.concat(F.lit("gid_"), key).alias("game_id"), F.to_date("o_orderdate").alias("game_date"), doc.alias("doc"))
    return games.game_events(docs).drop("des", "modified")


@query(
    """
    WITH o AS (SELECT 'gid_' || o_orderkey AS game_id, o_orderdate::DATE AS game_date, o_orderkey AS k, o_custkey AS c FROM orders),
    p AS (SELECT *, c AS player_id, '10' AS team_id, 'hom' AS team_abbrev, (k % 3 = 0)::INT AS win, k % 5 AS er, k % 8 AS so, (k % 10)::DOUBLE AS outs, k % 4 * 10 AS np, true AS is_starter FROM o
      UNION ALL SELECT *, c + 1, '10', 'hom', 0, 1, 2, 3.0::DOUBLE, 7, false FROM o
      UNION ALL SELECT *, c + 2, '20', 'awa', 0, k % 2, 0, 1.0::DOUBLE, CASE WHEN k % 6 = 0 THEN 0 ELSE 5 END, true FROM o)
    SELECT game_id, game_date, player_id::INT AS player_id, team_id, team_abbrev, win::INT AS win, er::INT AS earned_runs, so::INT AS strikeouts, outs / 3.0::DOUBLE AS innings_pitched,
           np::INT AS num_pitches, is_starter, 0.0::DOUBLE + win::DOUBLE * 12.0 + outs / 3.0::DOUBLE * 3.0::DOUBLE + er::DOUBLE * -3.0::DOUBLE + so::DOUBLE * 3.0::DOUBLE AS fd_points FROM p WHERE np > 0
    """
)
def box_score_pitchers(t):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def pitcher(id_, win, er, so, out, np):
        values = {"id": id_, "win": win, "er": er, "so": so, "out": out, "np": np, "hr": F.lit(0)}
        return F.struct(*[_text(c if not isinstance(c, (int, str)) else F.lit(c)).alias(n) for n, c in values.items()])

    home = F.array(pitcher(cust, F.when(key % 3 == 0, "true"), key % 5, key % 8, key % 10, key % 4 * 10), pitcher(cust + 1, "false", 1, 2, 3, 7))
    away = pitcher(cust + 2, "", key % 2, 0, 1, F.when(key % 6 != 0, 5))
    sides = F.concat(F.lit('[{"team_flag":"home","pitcher":'), F.to_json(home), F.lit('},{"team_flag":"away","pitcher":'), F.to_json(away), F.lit("}]"))
    head = '{"data":{"boxscore":{"home_id":"10","away_id":"20","home_team_code":"hom","away_team_code":"awa","pitching":'
    docs = t.orders.select(F.concat(F.lit("gid_"), key).alias("game_id"), F.to_date("o_orderdate").alias("game_date"), F.concat(F.lit(head), sides, F.lit("}}}")).alias("doc"))
    columns = "game_id game_date player_id team_id team_abbrev win earned_runs strikeouts innings_pitched num_pitches is_starter fd_points"
    return games.pitching_stats(docs).select(*columns.split())


@query(
    """
    SELECT 'gid_' || c_custkey AS game_id, DATE '2016-05-01' AS game_date, 'HOM' AS team_abbrev, c_custkey::INT AS player_id, 'A' AS first_name, c_mktsegment AS last_name,
           'A ' || c_mktsegment || '_HOM' AS lookup_name, 'L' AS bats, CASE WHEN c_custkey % 2 = 0 THEN 'LF' ELSE 'OF' END AS position, 'OF' AS fd_position, (c_nationkey)::INT AS team_id FROM customer
    UNION ALL SELECT 'gid_' || c_custkey, DATE '2016-05-01', 'away', c_custkey + 1, 'B', 'C', 'B C_away', 'R', 'SP', 'P', NULL FROM customer
    """
)
def player_documents(t):
    doc = F.format_string(
        '<game><team type="home" id="home"><player id="%d" first="A" last="%s" bats="L" position="%s" team_abbrev="HOM" team_id="%d"/></team>'
        '<team type="away" id="away"><player id="%d" first="B" last="C" position="SP"/></team><team type="umpires"><player id="1"/></team></game>',
        "c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "LF").otherwise(" "), "c_nationkey", F.col("c_custkey") + 1,
    )
    docs = t.customer.select(F.concat(F.lit("gid_"), F.col("c_custkey")).alias("game_id"), F.lit("2016-05-01").cast("date").alias("game_date"), doc.alias("doc"))
    return games.game_players(docs).select(
        "game_id", "game_date", "team_abbrev", "player_id", "first_name", "last_name", "lookup_name", "bats", "position", "fd_position", "team_id"
    )


@query(
    r"""
    WITH p AS (SELECT o_orderkey, '/x/year_' || year(o_orderdate) || '/month_' || lpad(month(o_orderdate)::VARCHAR, 2, '0') || '/day_'
                      || CASE WHEN o_orderkey % 9 = 0 THEN '00' ELSE lpad(day(o_orderdate)::VARCHAR, 2, '0') END AS d,
               CASE WHEN o_orderkey % 5 > 0 THEN 'gid_' || strftime(o_orderdate, '%Y_%m_%d') || '_aaa_bbb_' || o_orderkey END AS g, o_orderdate::DATE AS day FROM orders)
    SELECT o_orderkey, g AS game_id, CASE WHEN g IS NOT NULL THEN day END AS game_date, CASE WHEN o_orderkey % 9 > 0 THEN day END AS day FROM p
    """
)
def landing_paths(t):
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    folder = F.concat(F.date_format(day, "'/x/year_'yyyy'/month_'MM'/day_'"), F.when(key % 9 == 0, "00").otherwise(F.date_format(day, "dd")))
    game = F.when(key % 5 > 0, F.concat(F.date_format(day, "'/gid_'yyyy_MM_dd'_aaa_bbb_'"), key)).otherwise(F.lit("/other"))
    path = F.concat(folder, game, F.lit("/linescore.json"))
    return t.orders.select("o_orderkey", path_game_id(path).alias("game_id"), path_game_date(path).alias("game_date"), path_day(path).alias("day"))


@query(
    """
    SELECT p_type AS position, 'A ' || p_partkey AS name, p_name AS contest_game, CASE WHEN p_size % 3 = 0 THEN 'TB' ELSE p_brand END AS team, (p_size * 100)::DOUBLE AS salary,
           p_retailprice AS points, p_size AS num_games, CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE '' END AS player_status, '' AS injury FROM part
    """
)
def contest_list_csv(t):
    path = scratch_path(t.spark, "contest")
    listed = t.part.select(
        F.col("p_type").alias("Position"), F.lit("A").alias("First Name"), F.col("p_partkey").alias("Last Name"), F.col("p_name").alias("Game"),
        F.when(F.col("p_size") % 3 == 0, "TAM").otherwise(F.col("p_brand")).alias("Team"), (F.col("p_size") * 100).alias("Salary"), F.col("p_retailprice").alias("FPPG"),
        F.col("p_size").alias("Played"), F.when(F.col("p_size") % 2 == 0, "Yes").alias("Probable Pitcher"), F.lit(None).cast("string").alias("Injury Indicator"),
    )
    write_csv(listed, path)
    return read_contest_csv(t.spark, path)


@query("SELECT 'p_partkey,p_name,p_size' AS header, p_partkey, p_name, p_size FROM part")
def csv_side_header(t):
    path = scratch_path(t.spark, "side-header")
    write_csv(t.part.select("p_partkey", "p_name", "p_size"), path, side_header=True)
    names = t.spark.read.text(f"{path}.header").first()[0]
    return t.spark.read.schema("p_partkey long, p_name string, p_size int").csv(path).select(F.lit(names).alias("header"), "p_partkey", "p_name", "p_size")


@query(
    """
    SELECT c_nationkey::INT AS team, 'Pitchers' AS section, '1' AS number, c_name AS name, 'P' AS position, 'Active' AS active FROM customer
    UNION ALL SELECT c_nationkey, 'Disabled List', '', 'Q' || c_custkey, 'C', 'Inactive' FROM customer
    UNION ALL SELECT c_nationkey, 'Coaches', '3', 'R', NULL, 'Unknown' FROM customer
    """
)
def roster_page_rows(t):
    html = F.format_string(
        '<table><tr class="stathead"><td colspan="3">Pitchers </td></tr><tr class="oddrow player-1-%d"><td>1</td><td><a href="x">%s</a></td><td>P</td></tr>'
        '<tr class="stathead"><td>Disabled List</td></tr><tr class="evenrow player-2"><td></td><td>Q%d</td><td>C</td></tr>'
        '<tr class="stathead"><td>Coaches</td></tr><tr class="oddrow player-3"><td>3</td><td>R</td></tr></table>',
        "c_custkey", "c_name", "c_custkey",
    )
    return pages.roster_rows(t.customer.select(F.col("c_nationkey").cast("int").alias("team"), html.alias("html")), "team", "html")


@query(
    """
    WITH e AS (SELECT min(page_id) FILTER (contains(url, '/es/')) AS lo, min(page_id) FILTER (contains(url, '9.html')) AS hi FROM pages)
    SELECT page_id, url FROM pages, e WHERE page_id >= lo AND (hi IS NULL OR page_id <= hi)
    """
)
def address_range(t):
    return pages.inclusive_range(t.pages.select("page_id", "url"), "page_id", "url", "/es/", "9.html")


@query(
    """
    WITH h AS (SELECT l_partkey, sum(l_linenumber - 1)::BIGINT AS ab, count(*) FILTER (l_returnflag = 'R') AS bb, sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END)::BIGINT AS fd_points FROM lineitem GROUP BY 1),
         p AS (SELECT l_suppkey, sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END)::BIGINT AS num_pitches FROM lineitem GROUP BY 1)
    SELECT 'hitter' AS kind, l_partkey AS player_id, ab AS n FROM h WHERE NOT (ab = 0 AND bb = 0 AND fd_points = 0)
    UNION ALL SELECT 'pitcher', l_suppkey, num_pitches FROM p WHERE num_pitches > 0
    """
)
def played_filters(t):
    lines = t.lineitem
    hitters = lines.groupBy(F.col("l_partkey").alias("player_id")).agg(
        F.sum(F.col("l_linenumber") - 1).cast("bigint").alias("ab"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("bb"),
        F.sum(F.when(F.col("l_quantity") > 25, 1).otherwise(0)).alias("fd_points"),
    )
    pitchers = lines.groupBy(F.col("l_suppkey").alias("player_id")).agg(F.sum(F.when(F.col("l_linenumber") == 1, 1).otherwise(0)).alias("num_pitches"))
    rows = played_hitters(hitters).select(F.lit("hitter").alias("kind"), "player_id", F.col("ab").alias("n"))
    return rows.unionByName(played_pitchers(pitchers).select(F.lit("pitcher").alias("kind"), "player_id", F.col("num_pitches").alias("n")))


_PITCHER_FACTS = {"innings_pitched": 9, "batters_faced": 13, "strikeouts": 7, "num_walks": 5, "num_hits": 11, "hr": 3}


def _pitcher_sql(w) -> str:
    inside = "" if w == "SEASON" else f" FILTER (age <= {w})"
    s = {c: f"coalesce(sum({c}){inside}, 0)::DOUBLE" for c in _PITCHER_FACTS}
    ip, bf = s["innings_pitched"], s["batters_faced"]
    forms = {
        "whip": (f"{s['num_walks']} + {s['num_hits']}", ip), "babip": (f"{s['num_hits']} - {s['hr']}", f"({bf} - {s['strikeouts']} - {s['hr']})"),
        "k_per_nine": (f"{s['strikeouts']} * 9.0::DOUBLE", ip), "bb_per_nine": (f"{s['num_walks']} * 9.0::DOUBLE", ip),
        "k_percent": (s["strikeouts"], bf), "k_bb": (s["num_walks"], bf),
    }
    parts = [f'CASE WHEN {b} > 0 THEN ({a}) / {b} ELSE 0.0::DOUBLE END AS "mv_{w}_{n}"' for n, (a, b) in forms.items()]
    fip = f"({s['hr']} * 13.0::DOUBLE + {s['num_walks']} * 3.0::DOUBLE - {s['strikeouts']} * 2.0::DOUBLE) / {ip} + 3.072::DOUBLE"
    return ", ".join([*parts, f'CASE WHEN {ip} > 0 THEN {fip} ELSE 0.0::DOUBLE END AS "mv_{w}_fip"'])


@query(
    f"""
    WITH f AS (SELECT o_custkey % 25 AS pitcher, o_orderdate::DATE AS day, {', '.join(f'o_orderkey % {m} + 1 AS {c}' for c, m in _PITCHER_FACTS.items())} FROM orders),
         c AS (SELECT DISTINCT day FROM f),
         j AS (SELECT f.* EXCLUDE (day), c.day, date_diff('day', f.day, c.day) AS age FROM f JOIN c ON f.day < c.day AND year(f.day) = year(c.day))
    SELECT pitcher, day, {', '.join(_pitcher_sql(w) for w in ('SEASON', 14, 30, 60))} FROM j GROUP BY pitcher, day
    """
)
def trailing_pitcher(t):
    facts = t.orders.select(
        (F.col("o_custkey") % 25).alias("pitcher"), F.to_date("o_orderdate").alias("day"), *[(F.col("o_orderkey") % m + 1).alias(c) for c, m in _PITCHER_FACTS.items()]
    )
    return trailing_stats(facts, "pitcher", "day", list(_PITCHER_FACTS), ("SEASON", 14, 30, 60), aggregates=(), ratios=pitcher_ratios)


@query(
    f"""WITH {_PLAYERS.format(k=4)}, n AS (SELECT position, count(*) AS n FROM cand GROUP BY 1)
    SELECT product(CASE WHEN position = 'PROMO' THEN n * (n - 1) * (n - 2) // 6 ELSE n END)::DOUBLE AS total FROM n"""
)
def search_total(t):
    slots = ["ECONOMY", "STANDARD", "LARGE", "MEDIUM", "SMALL", "PROMO", "PROMO", "PROMO"]
    return roster.search_total(_candidates(t, 4), slots)
