"""Queries on sources, sinks, documents and pages."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from ..functions import baseball as rules
from ..operators.joins import missing_keys, upsert
from ..operators.rollup import fetch_failures, fetch_totals
from ..operators.shape import one_or_many
from ..session import scratch_path
from ..sources import pages as web
from ..sources.contest import positional_entries
from ..sources import games as landing
from ..sources.schemas import ddl
from ..sources.tables import empty_like, read_dimension, read_version, register, replace_version, round_trip, small_table, write_lines
from .registry import query


@query(
    """
    SELECT year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, day(o_orderdate)::INT AS d, count(*) AS n
    FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-05' AND TIMESTAMP '1998-02-10' GROUP BY ALL
    """
)
def listing_range_prune(t):
    day = F.col("o_orderdate")
    inside = t.orders.filter(day.between(F.lit("1997-03-05").cast("timestamp_ntz"), F.lit("1998-02-10").cast("timestamp_ntz")))
    return inside.groupBy(F.year(day).alias("y"), F.month(day).alias("m"), F.dayofmonth(day).alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    r"""
    WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
                      regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages)
    SELECT page_id, host, regexp_extract(path, '^/([^/]*)', 1) AS first_part,
           try_cast(regexp_extract(path, '(\d+)/?$', 1) AS BIGINT) AS number FROM p
    """
)
def path_keys(t):
    return t.pages.select("page_id", *[c.alias(n) for n, c in web.url_parts(F.col("url")).items()])


@query(
    r"""
    WITH a AS (SELECT page_id, url, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS hrefs FROM pages),
         l AS (SELECT page_id, url, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos FROM a)
    SELECT page_id, pos::INT AS pos, href, CASE WHEN href LIKE '//%' THEN regexp_extract(url, '^([a-z]+:)', 1) || href
           ELSE regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || href END AS resolved
    FROM l WHERE starts_with(href, '/')
    """
)
def link_extract(t):
    return web.links(t.pages, "page_id", "url", "html", prefix="/")


def _quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


@query(
    rf"""
    WITH s AS (SELECT page_id, string_split_regex(html, '<(?:title|h1)') AS parts FROM pages),
         h AS (SELECT page_id, unnest(parts) AS part, unnest(range(len(parts))) AS heading_no FROM s),
         i AS (SELECT page_id, heading_no,
                      CASE WHEN heading_no > 0 THEN regexp_extract(part, '^[^>]*>(?:<[^>]*>)*([^<]*)', 1) END AS heading,
                      regexp_extract_all(part, '<li><a[^>]*>([^<]*)</a></li>', 1) AS items FROM h),
         r AS (SELECT page_id, heading_no, heading, unnest(range(len(items))) AS pos, unnest(items) AS item FROM i)
    SELECT page_id, heading_no::INT AS heading_no, heading, pos::INT AS pos, item,
           CASE WHEN heading IN ({_quoted(rules.ACTIVE_SECTIONS)}) THEN 'Active'
                WHEN heading IN ({_quoted(rules.INACTIVE_SECTIONS)}) THEN 'Inactive'
                ELSE 'Unknown' END AS section FROM r
    """
)
def html_table_rows(t):
    rows = web.section_rows(t.pages, "page_id", "html", "<(?:title|h1)", "<li><a[^>]*>([^<]*)</a></li>")
    return rows.withColumn("section", web.section_status(F.col("heading")))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type FROM events")
def json_props(t):
    return t.events.select("event_id", F.from_json("props", "struct<k:int>")["k"].alias("k"), "event_type")


@query(
    """
    WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
    SELECT event_id, 0 AS pos, k FROM e
    UNION ALL SELECT event_id, 1 AS pos, k + 1 AS k FROM e WHERE event_id % 2 = 1
    """
)
def one_or_many_explode(t):
    k = F.from_json("props", "struct<k:int>")["k"]
    second = F.concat(F.lit('{"k":'), (k + 1).cast("string"), F.lit("}"))
    node = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(
        F.concat(F.lit("["), F.col("props"), F.lit(","), second, F.lit("]"))
    )
    doc = F.concat(F.lit('{"data":{"node":'), node, F.lit("}}"))
    found = t.events.select("event_id", F.get_json_object(doc, "$.data.node").alias("node"))
    items = found.select("event_id", F.posexplode(one_or_many(F.col("node"), "struct<k:int>")).alias("pos", "item"))
    return items.select("event_id", "pos", "item.k")


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS entry_key, p_type AS position, p_name AS name, p_size AS size,
           p_retailprice AS price FROM part
    """
)
def json_positional_map(t):
    name = f"contest_source_{uuid.uuid4().hex}"
    register({name: t.part})
    docs = t.spark.sql(
        f"""select concat('{{"', p_partkey, '":["', p_type, '","', p_name, '",', p_size, ',', p_retailprice, ']}}') as doc
           from {name}"""
    )
    t.spark.catalog.dropTempView(name)
    entries = docs.select(F.explode(positional_entries(F.col("doc"))).alias("entry_key", "v"))
    return entries.select(
        "entry_key", F.get("v", 0).alias("position"), F.get("v", 1).alias("name"),
        F.get("v", 2).cast("int").alias("size"), F.get("v", 3).cast("double").alias("price"),
    )


@query(
    """
    SELECT c_custkey AS doc_id, 'home' AS side, c_nationkey AS team, c_custkey AS player_id, c_mktsegment AS segment FROM customer
    UNION ALL SELECT c_custkey, 'away', 24 - c_nationkey, c_custkey + 1, NULL FROM customer
    UNION ALL SELECT c_custkey, 'away', 24 - c_nationkey, c_custkey + 2, c_mktsegment FROM customer
    """
)
def xml_nested(t):
    doc = F.format_string(
        '<game><team type="home" id="%d"><player id="%d" first="%s"/></team>'
        '<team type="away" id="%d"><player id="%d"/><player id="%d" first="%s"/></team></game>',
        "c_nationkey", "c_custkey", "c_mktsegment", 24 - F.col("c_nationkey"), F.col("c_custkey") + 1,
        F.col("c_custkey") + 2, "c_mktsegment",
    )
    shape = "struct<team:array<struct<_type:string,_id:int,player:array<struct<_id:bigint,_first:string>>>>>"
    parsed = t.customer.select(F.col("c_custkey").alias("doc_id"), F.from_xml(doc, shape).alias("g"))
    teams = parsed.select("doc_id", F.explode("g.team").alias("team"))
    players = teams.select(
        "doc_id", F.col("team._type").alias("side"), F.col("team._id").alias("team"), F.explode("team.player").alias("p")
    )
    return players.select("doc_id", "side", "team", F.col("p._id").alias("player_id"), F.col("p._first").alias("segment"))


@query("SELECT * FROM customer")
def csv_round_trip(t):
    return round_trip(t.customer, "csv")


@query("SELECT * FROM customer")
def json_round_trip(t):
    return round_trip(t.customer, "json")


@query("SELECT * FROM customer")
def parquet_round_trip(t):
    return round_trip(t.customer, "parquet")


@query(
    """
    SELECT p_partkey, CASE p_partkey WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE p_name END AS p_name,
           CASE p_partkey WHEN 1 THEN 0 WHEN 2 THEN 0 ELSE p_size END AS p_size FROM part
    """
)
def empty_then_upsert(t):
    rows = t.part.select("p_partkey", "p_name", "p_size")
    stored = upsert(empty_like(t.spark, rows.schema), rows, ["p_partkey"])
    return upsert(stored, small_table(t.spark, [(1, "first", 0), (2, "second", 0)], rows.schema), ["p_partkey"])


@query(
    """
    SELECT c_nationkey, count(*) AS n_missing FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 25 = c_nationkey) GROUP BY c_nationkey
    """
)
def missing_inputs(t):
    held = t.orders.select(F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 25).alias("c_nationkey"))
    absent = missing_keys(t.customer, held, ["c_custkey", "c_nationkey"])
    return absent.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_missing"))


@query(
    """
    SELECT l_suppkey, count(*) FILTER (l_returnflag <> 'R') AS n_ok, count(*) FILTER (l_returnflag = 'R') AS n_failed
    FROM lineitem GROUP BY ROLLUP (l_suppkey)
    """
)
def fetch_summary(t):
    return fetch_totals(t.lineitem, ["l_suppkey"], F.col("l_returnflag") != "R")


@query("SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'")
def fetch_failed(t):
    log = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag")
    return fetch_failures(log, F.col("l_returnflag") != "R").drop("l_returnflag")


@query(
    """
    SELECT concat_ws(chr(9), p_type, p_name, CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR),
                     CAST(p_partkey AS VARCHAR)) AS line FROM part
    """
)
def tsv_export_line(t):
    path = scratch_path(t.spark, "lines")
    order = [F.desc("p_retailprice"), F.asc("p_partkey")]
    write_lines(t.part, path, ["p_type", "p_name", "p_size", "p_retailprice", "p_partkey"], order)
    return t.spark.read.text(path).select(F.col("value").alias("line"))


_TREE_SQL = """
    WITH g AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE min(day(o_orderdate)) END AS d,
                      o_orderstatus AS s, count(*) AS n FROM orders GROUP BY year(o_orderdate), month(o_orderdate), o_orderstatus),
    f AS (SELECT y, m, d, printf('gid_%04d_%02d_%02d_%s', y, m, d, lower(s)) AS game_id, n, unnest(['linescore.json', 'game_events.json', 'boxscore.json']) AS file_name FROM g),
    t AS (SELECT *, CASE WHEN d > 0 THEN make_date(y, m, d) END AS day FROM f
          WHERE file_name = 'linescore.json' OR d > 0 AND (file_name = 'boxscore.json' OR n % 3 > 0))
"""
_TREE_TOPICS = ("linescore.json", "game_events.json", "boxscore.json")


def _landing_tree(t):
    """A landing area of real folders: a game per month and status, day 00 where there is no date, files that lack."""
    at = F.col("o_orderdate")
    games = t.orders.groupBy(F.year(at).alias("y"), F.month(at).alias("m"), "o_orderstatus").agg(F.min(F.dayofmonth(at)).alias("d"), F.count(F.lit(1)).alias("n"))
    games = games.withColumn("d", F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.col("d")))
    files = games.withColumn("topic", F.explode(F.array(*[F.lit(x) for x in _TREE_TOPICS])))
    there = (F.col("topic") == _TREE_TOPICS[0]) | ((F.col("d") > 0) & ((F.col("topic") == _TREE_TOPICS[2]) | (F.col("n") % 3 > 0)))
    parts = [F.format_string(p, c) for p, c in (("%04d", "y"), ("%02d", "m"), ("%02d", "d"))]
    named = [p.alias(n) for p, n in zip(parts, ("year", "month", "day"))]
    game = F.concat(F.lit("gid_"), F.concat_ws("_", *parts, F.lower("o_orderstatus"))).alias("game")
    docs = files.filter(there).select(*named, game, "topic", F.concat(F.lit('{"n":'), F.col("n").cast("string"), F.lit("}")).alias("value"))
    path = scratch_path(t.spark, "landing")
    docs.repartition("year", "month").write.partitionBy("year", "month", "day", "game", "topic").text(path)
    return path


@query(
    f"""{_TREE_SQL} SELECT game_id, day, file_name, (length('{{"n":' || n || '}}') + 1)::BIGINT AS bytes FROM t
    WHERE y * 100 + m >= 199303 AND y * 100 + m <= 199502 AND (day IS NULL OR day BETWEEN DATE '1993-03-01' AND DATE '1995-02-02')"""
)
def landing_list(t):
    return landing.list_games(t.spark, _landing_tree(t), _TREE_TOPICS, date(1993, 3, 1), date(1995, 2, 2), landing.KEYED)


@query(
    f"""{_TREE_SQL}, w AS (SELECT DISTINCT game_id, unnest(['linescore.json', 'game_events.json', 'boxscore.json']) AS file_name FROM t)
    SELECT game_id, file_name FROM w ANTI JOIN t USING (game_id, file_name)"""
)
def landing_missing(t):
    return landing.missing_files(t.spark, _landing_tree(t), _TREE_TOPICS, layout=landing.KEYED)


_SUPPLIERS = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def dimension_csv(t):
    """Columns of the file in another order and case, and one more than wanted."""
    path = scratch_path(t.spark, "dimension")
    t.supplier.select(F.col("s_acctbal").alias("S_AcctBal"), "s_name", F.lit("x").alias("note"), "s_nationkey", "s_suppkey").write.option("header", True).csv(path)
    return read_dimension(t.spark, path, ddl(_SUPPLIERS))


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey FROM supplier")
def dimension_cr(t):
    """Lines that end with a bare carriage return, all columns as text."""
    path = scratch_path(t.spark, "dimension")
    t.supplier.select("s_name", "s_nationkey", "s_suppkey").write.option("header", True).option("lineSep", "\r").csv(path)
    return read_dimension(t.spark, path, ddl("s_suppkey string, s_name string, s_nationkey string"))


@query(
    """
    SELECT 0 AS back, s_nationkey, count(*) AS n, sum(s_suppkey + 2)::BIGINT AS keys FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey
    UNION ALL SELECT 1, s_nationkey, count(*), sum(s_suppkey + 1)::BIGINT FROM supplier GROUP BY s_nationkey
    """
)
def replace_versions(t):
    """A table replaced from itself; the newest version and the one before it, which a late reader may still use."""
    path = scratch_path(t.spark, "versions")
    schema = ddl("s_suppkey bigint, s_nationkey int, s_acctbal double")
    replace_version(t.supplier.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), F.col("s_nationkey").cast("int").alias("s_nationkey"), "s_acctbal"), path)
    for kept in (F.lit(True), F.col("s_acctbal") > 0):
        replace_version(read_version(t.spark, path, schema).filter(kept).withColumn("s_suppkey", F.col("s_suppkey") + 1), path)
    both = [read_version(t.spark, path, schema, back).withColumn("back", F.lit(back)) for back in (0, 1)]
    return both[0].union(both[1]).groupBy("back", "s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("keys"))
