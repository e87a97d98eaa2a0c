"""Queries on joins, set operations, rankings, numbering and name resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.score import scaled
from ..operators.encode import apply_codes, cardinalities, fit_codes, invert_codes
from ..operators.joins import lookup, merge_dictionaries, missing_keys, present_keys, upsert
from ..operators.resolve import alias_table, resolve_alias, resolve_names, translate
from ..operators.rollup import duplicate_keys, exact_regression_error, table_counts
from ..operators.topk import batches, joined_text, keep_last, mark_first, top_k_by_group
from ..session import materialise
from ..sources.contest import merge_lineup as merge_team_lineup
from .registry import query


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


@query(
    """
    SELECT r_name, n_name, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS revenue_cents, count(*) AS n_lines,
           sum(l_quantity::BIGINT)::BIGINT AS quantity
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    GROUP BY ALL
    """
)
def fact_dim_join(t):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # the largest join first, then one partial sum per customer before the dimensions are joined
    per_customer = (
        t.lineitem.join(orders, "l_orderkey")
        .groupBy("o_custkey")
        .agg(F.sum(scaled("l_extendedprice")).alias("cents"), F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))
    )
    named = (
        per_customer.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    )
    return named.groupBy("r_name", "n_name").agg(
        F.sum("cents").alias("revenue_cents"), F.sum("lines").alias("n_lines"), F.sum("qty").alias("quantity")
    )


@query(
    """
    WITH y AS (SELECT c_custkey, unnest(range(1992, 2003)) AS order_year FROM customer)
    SELECT y.c_custkey, y.order_year::INT AS order_year, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS label
    FROM y LEFT JOIN orders ON o_custkey = c_custkey AND year(o_orderdate) = y.order_year GROUP BY 1, 2
    """
)
def left_label(t):
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("order_year")).agg(
        F.sum(scaled("o_totalprice")).alias("label")
    )
    wanted = t.customer.select("c_custkey", F.explode(F.sequence(F.lit(1992), F.lit(2002))).alias("order_year"))
    return wanted.join(totals, ["c_custkey", "order_year"], "left")


@query(
    """
    SELECT p_partkey, p_name FROM part
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity::INT = p_size)
    """
)
def anti_missing(t):
    ordered = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("int").alias("p_size"))
    return missing_keys(t.part, ordered, ["p_partkey", "p_size"]).select("p_partkey", "p_name")


@query(
    """
    SELECT DISTINCT part.* FROM part, lineitem WHERE p_partkey = l_partkey
    AND l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01'
    """
)
def semi_contest(t):
    shipped = t.lineitem.filter((F.col("l_shipdate") >= _ts("1997-03-01")) & (F.col("l_shipdate") < _ts("1997-04-01")))
    return present_keys(t.part, shipped.select(F.col("l_partkey").alias("p_partkey")), ["p_partkey"])


@query(
    """
    WITH u AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders
               WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'
               UNION ALL SELECT -o_orderkey - 1, o_custkey, 'N', o_totalprice FROM orders
               WHERE o_orderdate >= TIMESTAMP '2001-07-01')
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u)
    UNION ALL SELECT * FROM u
    """,
    name="upsert",
)
def upsert_orders(t):
    stored = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    changed = stored.filter((F.col("o_orderdate") >= _ts("1997-03-01")) & (F.col("o_orderdate") < _ts("1997-04-01")))
    changed = changed.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})
    added = stored.filter(F.col("o_orderdate") >= _ts("2001-07-01"))
    added = added.withColumns({"o_orderstatus": F.lit("N"), "o_orderkey": -F.col("o_orderkey") - 1})
    return upsert(stored, changed.unionByName(added), ["o_orderkey"]).drop("o_orderdate")


@query(
    """
    WITH p AS (SELECT l_returnflag, round(l_extendedprice * 100)::BIGINT AS actual,
                      coalesce(round(p_retailprice * 100)::BIGINT * 25, -9900) AS predicted
               FROM lineitem LEFT JOIN part ON p_partkey * 2 = l_partkey)
    SELECT l_returnflag, sum((actual - predicted)::HUGEINT * (actual - predicted))::DOUBLE / count(*)::DOUBLE / 10000.0::DOUBLE AS mse,
           sum(abs(actual - predicted))::DOUBLE / count(*)::DOUBLE / 100.0::DOUBLE AS mae, count(*) AS n FROM p GROUP BY 1
    """
)
def predictions_join(t):
    # only even keys have a prediction, so half of the lines miss
    predicted = t.part.select(
        (F.col("p_partkey") * 2).alias("l_partkey"), (scaled("p_retailprice") * 25).alias("predicted")
    )
    lines = t.lineitem.select("l_partkey", "l_returnflag", scaled("l_extendedprice").alias("actual"))
    scored = lookup(lines, predicted, ["l_partkey"], {"predicted": -9900})
    return exact_regression_error(scored, "actual", "predicted", 100.0, ["l_returnflag"])


@query(
    """
    WITH r AS (SELECT c_nationkey AS team, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'LF' ELSE '2B' END AS pos,
                      CASE WHEN c_acctbal > 1000 THEN 'Active' ELSE 'Inactive' END AS active FROM customer WHERE c_acctbal >= 0),
         l AS (SELECT c_nationkey AS team, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'RF' ELSE 'DH' END AS p
               FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey % 2 = 0)
    SELECT coalesce(r.team, l.team) AS team, coalesce(r.name, l.name) AS name,
           coalesce(CASE l.p WHEN 'RF' THEN 'OF' WHEN 'DH' THEN '1B' END, r.pos) AS pos, active,
           CASE WHEN l.name IS NOT NULL THEN 'Starter' WHEN coalesce(r.team, l.team) IN (SELECT team FROM l) THEN 'Non-Starter'
                ELSE 'No Lineup' END AS status
    FROM r FULL JOIN l ON r.team = l.team AND r.name = l.name
    """
)
def merge_lineup(t):
    c = t.customer
    roster = c.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_nationkey").alias("team"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 2 == 0, "LF").otherwise("2B").alias("pos"),
        F.when(F.col("c_acctbal") > 1000, "Active").otherwise("Inactive").alias("active"),
    )
    lineup = c.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") % 2 == 0)).select(
        F.col("c_nationkey").alias("team"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, "RF").otherwise("DH").alias("position"),
    )
    return merge_team_lineup(roster, lineup)


@query(
    """
    SELECT DISTINCT o_orderkey, o_orderdate FROM (
        SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01')
    """
)
def todo_union(t):
    done = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    fresh = t.orders.filter(F.col("o_orderdate") > _ts("2001-06-01"))
    columns = ["o_orderkey", "o_orderdate"]
    return missing_keys(t.orders, done, ["o_orderkey"]).select(*columns).unionByName(fresh.select(*columns)).distinct()


@query(
    """
    WITH a AS (SELECT lower(n_name) AS alias, n_name AS code FROM nation UNION ALL SELECT lower(substr(n_name, 1, 8)), n_name FROM nation
               UNION ALL SELECT 'n' || n_nationkey, n_name FROM nation),
         u AS (SELECT alias, min(code) AS code FROM a GROUP BY 1),
         i AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN upper(n_name) WHEN 1 THEN lower(n_name) WHEN 2 THEN 'N' || n_nationkey
               ELSE 'xyz' END AS spelled FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT c_custkey, spelled, code, n_regionkey AS league FROM i LEFT JOIN u ON lower(spelled) = alias LEFT JOIN nation ON n_name = code
    """
)
def alias_union_resolve(t):
    n = t.nation
    aliases = n.select("n_name", F.substring("n_name", 1, 8).alias("alias")).unionByName(
        n.select("n_name", F.concat(F.lit("N"), "n_nationkey").alias("alias"))
    )
    table = alias_table(aliases, n, "n_name", "alias")
    form = F.col("c_custkey") % 4
    spelled = (
        F.when(form == 0, F.upper("n_name")).when(form == 1, F.lower("n_name")).when(form == 2, F.concat(F.lit("N"), "n_nationkey")).otherwise("xyz")
    )
    inputs = t.customer.join(n, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", spelled.alias("spelled"))
    return translate(resolve_alias(inputs, "spelled", table), "code", n, "n_name", "n_regionkey", "league")


@query(
    """
    WITH k AS (SELECT upper(p_name) AS nm, min(p_partkey) AS id FROM part GROUP BY 1),
         i AS (SELECT p_partkey, upper(CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, 'bolt', 'screw')
               WHEN 2 THEN p_name || ' jr.' WHEN 3 THEN replace(p_name, 'ring', 'loop') ELSE 'no ' || p_name END) AS spelled FROM part),
         c AS (SELECT p_partkey, spelled, 0 AS pos, spelled AS tried FROM i
               UNION ALL SELECT p_partkey, spelled, 1, replace(spelled, 'SCREW', 'BOLT') FROM i
               UNION ALL SELECT p_partkey, spelled, 2, replace(spelled, ' JR.', '') FROM i
               UNION ALL SELECT p_partkey, spelled, 3, replace(spelled, 'LOOP', 'RING') FROM i),
         h AS (SELECT p_partkey, min_by(id, pos) AS known_id, min_by(tried, pos) AS matched_name FROM c JOIN k ON nm = tried GROUP BY 1)
    SELECT p_partkey, spelled, known_id, matched_name FROM i LEFT JOIN h USING (p_partkey)
    """
)
def alt_name_resolve(t):
    form, name = F.col("p_partkey") % 5, F.col("p_name")
    spelled = (
        F.when(form == 0, name).when(form == 1, F.replace(name, F.lit("bolt"), F.lit("screw"))).when(form == 2, F.concat(name, F.lit(" jr.")))
        .when(form == 3, F.replace(name, F.lit("ring"), F.lit("loop"))).otherwise(F.concat(F.lit("no "), name))
    )
    known = t.part.groupBy(F.upper("p_name").alias("known")).agg(F.min("p_partkey").alias("known_id"))
    pairs = [("SCREW", "BOLT"), (" JR.", ""), ("LOOP", "RING")]
    inputs = t.part.select("p_partkey", F.upper(spelled).alias("spelled"))
    return resolve_names(inputs, "p_partkey", F.col("spelled"), known, pairs, "known", "known_id")


@query(
    """
    WITH a AS (SELECT p_brand AS k, min(p_size) AS v FROM part GROUP BY 1), b AS (SELECT p_name AS k, max(p_size) AS v FROM part GROUP BY 1
               UNION ALL SELECT p_brand, max(p_size) FROM part WHERE p_type = 'PROMO' AND p_partkey % 2 = 0 GROUP BY 1)
    SELECT coalesce(b.k, a.k) AS k, coalesce(b.v, a.v) AS v FROM a FULL JOIN b ON a.k = b.k
    """
)
def dictionary_merge(t):
    p = t.part
    first = p.groupBy(F.col("p_brand").alias("k")).agg(F.min("p_size").alias("v"))
    second = p.groupBy(F.col("p_name").alias("k")).agg(F.max("p_size").alias("v"))
    promo = p.filter((F.col("p_type") == "PROMO") & (F.col("p_partkey") % 2 == 0))
    second = second.unionByName(promo.groupBy(F.col("p_brand").alias("k")).agg(F.max("p_size").alias("v")))
    return merge_dictionaries(first, second, "k", "v")


@query(
    """
    SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def dup_check(t):
    return duplicate_keys(t.events.select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")), ["user_id", "hour"])


@query(
    """
    SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types, count(DISTINCT ts::DATE) AS days FROM events
    """
)
def distinct_counts(t):
    return t.events.agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types"), F.count_distinct(F.to_date("ts")).alias("days")
    )


_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _NAMES), name="table_counts")
def table_sizes(t):
    return table_counts({n: getattr(t, n) for n in _NAMES})


@query(
    """
    WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 3 > 0 THEN l_suppkey % 2 END AS place FROM lineitem)
    SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY place NULLS LAST, l_linenumber, l_partkey) = 1 AS is_starter FROM l
    """
)
def first_flag(t):
    place = F.when(F.col("l_linenumber") % 3 > 0, F.col("l_suppkey") % 2)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", place.alias("place"))
    return mark_first(lines, ["l_orderkey"], "place", "is_starter", ties=["l_linenumber", "l_partkey"])


@query(
    """
    SELECT p_type, p_size, p_partkey, p_retailprice, rn::INT AS rn FROM (
        SELECT *, row_number() OVER (PARTITION BY p_type, p_size ORDER BY p_retailprice DESC, p_brand, p_partkey) AS rn FROM part)
    WHERE rn <= CASE WHEN p_type = 'PROMO' THEN 4 ELSE 1 END
    """
)
def topk_per_group(t):
    order = [F.desc("p_retailprice"), F.asc("p_brand"), F.asc("p_partkey")]
    best = top_k_by_group(t.part, "p_type", ["p_type", "p_size"], order, {"PROMO": 4})
    return best.select("p_type", "p_size", "p_partkey", "p_retailprice", "rn")


_CODES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, (dense_rank() OVER (ORDER BY {c} NULLS FIRST) - 1)::BIGINT AS code "
    f"FROM (SELECT DISTINCT {c} FROM coded)"
    for c in ("p_brand", "p_type", "p_size")
)
_CODED = "WITH coded AS (SELECT p_partkey, nullif(p_brand, 'Brand#7') AS p_brand, p_type, p_size FROM part)"


def _coded_parts(t):
    return t.part.select("p_partkey", F.nullif("p_brand", F.lit("Brand#7")).alias("p_brand"), "p_type", "p_size")


@query(f"{_CODED} {_CODES_SQL}")
def dense_codes(t):
    return fit_codes(_coded_parts(t), ["p_brand", "p_type", "p_size"])


@query(f'{_CODED} SELECT "column", count(*) AS n_values FROM ({_CODES_SQL}) GROUP BY 1')
def code_cardinality(t):
    return cardinalities(fit_codes(_coded_parts(t), ["p_brand", "p_type", "p_size"]))


@query(
    f"""{_CODED}, d AS ({_CODES_SQL})
    SELECT p_partkey, b.code AS p_brand_code, coalesce(s.code, -1) AS p_size_code, p_brand, CASE WHEN s.code IS NOT NULL THEN p_size END AS size_back
    FROM coded JOIN d b ON b."column" = 'p_brand' AND b.value IS NOT DISTINCT FROM p_brand
    LEFT JOIN (SELECT * FROM d WHERE "column" = 'p_size' AND value <> '50') s ON s.value = CAST(p_size AS VARCHAR)
    """
)
def decode(t):
    parts = _coded_parts(t)
    # the stored dictionary is read by every lookup
    fitted = materialise(fit_codes(parts, ["p_brand", "p_type", "p_size"]), "codes")
    known = fitted.filter(~((F.col("column") == "p_size") & (F.col("value") == "50")))
    coded = apply_codes(parts, ["p_brand", "p_size"], known, keep=True)
    back = invert_codes(coded, {"p_brand_code": "p_brand", "p_size_code": "p_size"}, known)
    return back.select(
        "p_partkey", "p_brand_code", "p_size_code", F.col("p_brand_code_value").alias("p_brand"),
        F.col("p_size_code_value").cast("int").alias("size_back"),
    )


@query("SELECT p_partkey, ((row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1) // 50)::BIGINT AS batch FROM part", name="batches")
def part_batches(t):
    return batches(t.part.select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], 50).drop("p_retailprice")


@query(
    """
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
    name="keep_last",
)
def keep_last_event(t):
    last = keep_last(t.events.select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"])
    return last.drop("ts")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10")
def order_limit(t):
    return t.orders.select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(10)


@query("SELECT o_orderkey, o_totalprice, o_custkey FROM orders ORDER BY o_totalprice DESC, o_custkey DESC, o_orderkey LIMIT 30")
def top_price(t):
    top = t.orders.select("o_orderkey", "o_totalprice", "o_custkey")
    return top.orderBy(F.desc("o_totalprice"), F.desc("o_custkey"), "o_orderkey").limit(30)


@query(
    """
    WITH n AS (SELECT s_nationkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) - 1 AS i FROM supplier)
    SELECT s_nationkey, (i // 3)::BIGINT AS line, string_agg(s_name, ' | ' ORDER BY i) AS joined FROM n GROUP BY 1, 2
    """
)
def joined_strings(t):
    return joined_text(t.supplier, ["s_nationkey"], ["s_name", "s_suppkey"], "s_name", " | ", per_line=3, rows_per_segment=30)
