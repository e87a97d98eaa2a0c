"""Queries on feature vectors, models, scores and roster search."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.score import linear_score, scaled
from ..operators import model as ml
from ..operators import roster
from ..operators.frontier import cost_frontier, count_rosters
from ..operators.rollup import regression_error, score_histogram
from ..operators.shape import with_defaults
from ..session import materialise, scratch_path
from .registry import query


@query(
    """
    SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, 0.0) AS label, c_acctbal AS f0_c_acctbal,
           c_nationkey::DOUBLE AS f1_c_nationkey, (o_orderstatus = 'F')::INT::DOUBLE AS f2_is_final,
           CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_custkey::DOUBLE END AS f3_o_custkey
    FROM orders JOIN customer ON c_custkey = o_custkey
    """
)
def feature_vector(t):
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", "c_acctbal", "c_nationkey", "c_mktsegment", F.col("o_orderstatus").eqNullSafe("F").alias("is_final"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_custkey").cast("double")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("target"),
    )
    names = ml.feature_names(rows, exclude=("o_orderkey", "target"))
    v = vector_to_array("features")
    built = ml.to_vectors(rows, names, "target", {"c_nationkey": 25})
    return built.select("o_orderkey", "label", *[F.get(v, i).alias(f"f{i}_{n}") for i, n in enumerate(names)])


@query(
    """
    SELECT bucket < 7 AS is_train, count(*) AS n, min(o_orderkey) AS lowest FROM (
        SELECT o_orderkey, ('0x' || substr(md5(o_custkey || '|' || o_orderkey), 1, 4))::INT % 10 AS bucket FROM orders) GROUP BY 1
    """
)
def hash_split(t):
    marked = t.orders.withColumn("is_train", ml.is_train("o_custkey", "o_orderkey"))
    return marked.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lowest"))


@query()
def gbt_predict(t):
    """Boosted trees on order lines: fit, store, load, score the held-out rows, error per status."""
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "p_size", "p_retailprice", "l_linestatus",
        (F.col("l_returnflag") == "R").alias("is_returned"), F.col("l_extendedprice").alias("target"),
    )
    names = ml.feature_names(rows, exclude=("l_orderkey", "l_linenumber", "target"))
    vectors = ml.to_vectors(rows, names, "target", {"is_returned": 2})
    train, test = ml.split_by_hash(vectors, ["l_orderkey", "l_linenumber"])
    path = scratch_path(t.spark, "model")
    ml.save_model(ml.train(train, rounds=5, depth=4, bins=64), path)
    model = ml.load_model(path)
    scored = ml.predict(model, test, ["l_orderkey", "l_linenumber", "l_linestatus", "label"])
    strongest = ml.importances(model, names)[0][0]
    return regression_error(scored, "label", "prediction", ["l_linestatus"]).withColumn("strongest_feature", F.lit(strongest))


@query(
    """
    WITH m AS (SELECT l_partkey, sum(l_quantity::BIGINT)::DOUBLE / count(*)::DOUBLE AS hr, count(*) FILTER (l_returnflag = 'R')::DOUBLE / count(*)::DOUBLE AS sb,
                      count(*) FILTER (l_linestatus = 'O')::DOUBLE / count(*)::DOUBLE AS out FROM lineitem GROUP BY 1)
    SELECT l_partkey, hr, sb, out, ((0.0::DOUBLE + hr * 4.0::DOUBLE) + sb * 2.0::DOUBLE) + out * (-0.25::DOUBLE) AS fd_sum FROM m
    """
)
def multi_target_sum(t):
    n = F.count(F.lit(1)).cast("double")
    per_target = {
        "hr": F.sum(F.col("l_quantity").cast("bigint")).cast("double") / n,
        "sb": F.count_if(F.col("l_returnflag") == "R").cast("double") / n,
        "out": F.count_if(F.col("l_linestatus") == "O").cast("double") / n,
    }
    # all targets of a key come from one aggregation, so nothing has to be joined back together
    means = t.lineitem.groupBy("l_partkey").agg(*[c.alias(name) for name, c in per_target.items()])
    return means.withColumn("fd_sum", linear_score(ml.rules.TARGET_WEIGHTS, list(per_target)))


@query(
    """
    WITH p AS (SELECT o_custkey, round(o_totalprice * 100)::BIGINT AS cents, o_orderpriority FROM orders),
         m AS (SELECT o_orderpriority, (sum(cents) // count(*))::BIGINT AS predicted FROM p GROUP BY 1),
         s AS (SELECT o_custkey, sum(cents)::BIGINT AS actual, sum(predicted)::BIGINT AS predicted FROM p JOIN m USING (o_orderpriority) GROUP BY 1)
    SELECT o_custkey, actual, predicted, actual - predicted AS miss FROM s
    """
)
def predicted_and_actual(t):
    p = t.orders.select("o_custkey", scaled("o_totalprice").alias("cents"), "o_orderpriority")
    means = p.groupBy("o_orderpriority").agg(F.sum("cents").alias("s"), F.count(F.lit(1)).alias("n"))
    means = means.select("o_orderpriority", F.floor(F.expr("s div n")).cast("bigint").alias("predicted"))
    actual = p.groupBy("o_custkey").agg(F.sum("cents").alias("actual"))
    scored = p.join(means, "o_orderpriority").groupBy("o_custkey").agg(F.sum("predicted").alias("predicted"))
    scored = ml.join_predictions([actual, scored], ["o_custkey"])
    return with_defaults(scored, {"predicted": 0}).withColumn("miss", F.col("actual") - F.col("predicted"))


_PLAYERS = """
    players AS (SELECT p_type AS position, p_brand AS team, CAST(p_partkey AS VARCHAR) AS player, p_size::BIGINT * 100 AS cost, coalesce(points, 0) AS points
                FROM part LEFT JOIN (SELECT l_partkey, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS points FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
    cand AS (SELECT position, team, player, cost, points FROM (
                SELECT *, row_number() OVER (PARTITION BY position, cost ORDER BY points DESC, player) AS rn FROM players)
             WHERE rn <= CASE WHEN position = 'PROMO' THEN {k} ELSE 1 END)
"""


def _candidates(t, k=1):
    """Parts as players: type is the position, size the cost, revenue the points; the best per position and cost."""
    revenue = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum(scaled("l_extendedprice")).alias("points"))
    players = t.part.join(revenue, "p_partkey", "left").select(
        F.col("p_type").alias("position"), F.col("p_brand").alias("team"), F.col("p_partkey").cast("string").alias("player"),
        (F.col("p_size").cast("bigint") * 100).alias("cost"), F.coalesce("points", F.lit(0)).alias("points"),
    )
    return materialise(roster.prune_candidates(players, {"PROMO": k}), "pruned")


@query(f"WITH {_PLAYERS.format(k=4)} SELECT position, team, player, cost, points FROM cand")
def pruned_candidates(t):
    return _candidates(t, 4).select("position", "team", "player", "cost", "points")


@query(
    f"""WITH {_PLAYERS.format(k=4)}, n AS (SELECT position, count(*) AS n FROM cand GROUP BY 1)
    SELECT position, n AS n_candidates, (CASE WHEN position = 'PROMO' THEN n * (n - 1) * (n - 2) // 6 ELSE n END)::BIGINT AS n_choices FROM n"""
)
def positions_cross(t):
    slots = ["ECONOMY", "STANDARD", "LARGE", "MEDIUM", "SMALL", "PROMO", "PROMO", "PROMO"]
    return roster.search_space(_candidates(t, 4), slots)


_RANKED = "r AS (SELECT *, row_number() OVER (PARTITION BY position ORDER BY points DESC, player) AS cid FROM cand)"


@query(
    f"""WITH {_PLAYERS.format(k=1)}, {_RANKED}
    SELECT a.player || ',' || b.player || ',' || c.player AS players, a.cost + b.cost + c.cost AS cost,
           (a.points + b.points + c.points)::BIGINT AS points
    FROM r a JOIN r b ON b.position = a.position AND b.cid > a.cid JOIN r c ON c.position = a.position AND c.cid > b.cid
    WHERE a.position = 'PROMO' AND a.cost + b.cost + c.cost <= 7000"""
)
def combos3(t):
    triples = roster.combinations(_candidates(t, 1), "PROMO", 3, cap=7000)
    return triples.select(F.array_join("players", ",").alias("players"), "cost", "points")


_GROUPS = f"""{_RANKED},
    g AS (SELECT a.player || ',' || b.player || ',' || c.player || ',' || s.player AS players, a.cost + b.cost + c.cost + s.cost AS cost,
                 (a.points + b.points + c.points + s.points)::BIGINT AS points, [a.team, b.team, c.team, s.team] AS teams
          FROM r a JOIN r b ON b.position = a.position AND b.cid > a.cid JOIN r c ON c.position = a.position AND c.cid > b.cid
          JOIN r s ON s.position = 'SMALL' WHERE a.position = 'PROMO')"""


_GROUP_SLOTS = ["PROMO", "PROMO", "PROMO", "SMALL"]


@query(
    f"""WITH {_PLAYERS.format(k=1)}, {_GROUPS}
    SELECT cost, arg_min(players, (-points, players)) AS players, max(points) AS points, count(*) - 1 AS n_skipped FROM g GROUP BY cost""",
    name="best_per_cost",
)
def best_by_cost(t):
    """Three of one position with one of another; the cap pays for all."""
    best = cost_frontier(_candidates(t, 1), _GROUP_SLOTS, cap=20000)
    return best.select("cost", F.array_join("players", ",").alias("players"), "points", (F.col("n") - 1).alias("n_skipped"))


@query(
    f"""WITH {_PLAYERS.format(k=1)}, {_GROUPS},
    x AS (SELECT cost > 6000 AS over_cap, list_max(list_transform(teams, lambda t: len(list_filter(teams, lambda u: u = t)))) > 2 AS crowded FROM g)
    SELECT count(*) AS n_total, count(*) FILTER (over_cap) AS n_over_cap, count(*) FILTER (NOT over_cap AND crowded) AS n_illegal,
           count(*) FILTER (NOT over_cap AND NOT crowded) AS n_legal FROM x"""
)
def roster_counts(t):
    return count_rosters(_candidates(t, 1), _GROUP_SLOTS, cap=6000, team_limit=2)


_SMALL_SLOTS = ["ECONOMY", "STANDARD", "PROMO", "PROMO", "PROMO"]
_SMALL_SQL = f"""WITH {_PLAYERS.format(k=1)}, {_RANKED},
    g AS (SELECT e.player || ',' || s.player || ',' || a.player || ',' || b.player || ',' || c.player AS players,
                 e.cost + s.cost + a.cost + b.cost + c.cost AS cost, (e.points + s.points + a.points + b.points + c.points)::BIGINT AS points
          FROM r a JOIN r b ON b.position = a.position AND b.cid > a.cid AND b.team <> a.team
          JOIN r c ON c.position = a.position AND c.cid > b.cid AND c.team <> a.team AND c.team <> b.team
          JOIN r e ON e.position = 'ECONOMY' AND e.team NOT IN (a.team, b.team, c.team)
          JOIN r s ON s.position = 'STANDARD' AND s.team NOT IN (a.team, b.team, c.team, e.team)
          WHERE a.position = 'PROMO' AND e.cost + s.cost + a.cost + b.cost + c.cost <= 9000)
"""


@query(f"{_SMALL_SQL} SELECT players, cost, points, row_number() OVER (ORDER BY points DESC, players)::INT AS rank FROM g ORDER BY rank LIMIT 30")
def roster_topk(t):
    best = roster.top_rosters(_candidates(t), _SMALL_SLOTS, cap=9000, team_limit=1)
    path = scratch_path(t.spark, "best")
    best.write.mode("overwrite").json(path)
    return t.spark.read.schema(best.schema).json(path)


@query(f"{_SMALL_SQL} SELECT points, count(*) AS n FROM g GROUP BY 1 ORDER BY 1 DESC LIMIT 30")
def roster_histogram(t):
    return roster.top_score_histogram(_candidates(t), _SMALL_SLOTS, cap=9000, team_limit=1)


_FULL_SLOTS = ["PROMO", "PROMO", "PROMO", "SMALL", "ECONOMY", "STANDARD", "LARGE", "MEDIUM"]


def _full_sql(slots: list[str], cap: int, limit: int, keep: int, width: int = 4, unit: int = 100) -> str:
    """The search as a chain of tables: bounds per budget, a few legal rosters for a floor, then all that can reach it."""
    n = len(slots)
    parts = [f"{_PLAYERS.format(k=4)}, {_RANKED}", f"g AS (SELECT unnest(range({cap // unit + 1})) AS b)", f"u{n} AS (SELECT b, 0::BIGINT AS u FROM g)",
             f"o AS (SELECT position, cost // {unit} AS c, max(points) AS p FROM cand GROUP BY ALL)"]
    for i in reversed(range(1, n)):
        parts.append(f"u{i} AS MATERIALIZED (SELECT g.b, max(p + u) AS u FROM g JOIN o ON position = '{slots[i]}' AND c <= g.b JOIN u{i + 1} n ON n.b = g.b - c GROUP BY g.b)")
    for name, floor in (("k", None), ("e", "(SELECT f FROM floor)")):
        for i, slot in enumerate(slots):
            reach = f"JOIN u{i + 1} u ON u.b = ({cap} - {{cost}}) // {unit}" + (f" AND {{points}} + u.u >= {floor}" if floor else "")
            if i == 0:
                body = f"SELECT [player] AS players, [team] AS teams, cost, points, cid FROM r {reach.format(cost='cost', points='points')} WHERE position = '{slot}' AND cost <= {cap}"
            else:
                again = " AND r.cid > s.cid" if slot == slots[i - 1] else ""
                body = (
                    f"SELECT list_append(players, player) AS players, list_append(teams, team) AS teams, s.cost + r.cost AS cost, s.points + r.points AS points, r.cid AS cid FROM {name}{i - 1} s "
                    f"JOIN r ON r.position = '{slot}' AND s.cost + r.cost <= {cap}{again} AND len(list_filter(s.teams, lambda t: t = r.team)) < {limit} {reach.format(cost='(s.cost + r.cost)', points='s.points + r.points')}"
                )
            if not floor:
                body = f"SELECT * FROM ({body}) QUALIFY row_number() OVER (PARTITION BY cost ORDER BY points DESC, players) <= {width}"
            parts.append(f"{name}{i} AS MATERIALIZED ({body})")
        if not floor:
            parts.append(f"floor AS MATERIALIZED (SELECT CASE WHEN count(*) >= {keep} THEN min(points) ELSE -1e18::BIGINT END AS f FROM (SELECT points FROM k{n - 1} ORDER BY points DESC LIMIT {keep}))")
    listed = f"SELECT array_to_string(players, ',') AS players, cost, points::BIGINT AS points FROM e{n - 1}"
    return f"WITH {', '.join(parts)} SELECT players, cost, points, row_number() OVER (ORDER BY points DESC, players)::INT AS rank FROM ({listed}) ORDER BY rank LIMIT {keep}"


@query(_full_sql(_FULL_SLOTS, 14000, 2, 30))
def roster_full(t):
    """Eight picks with four candidates per cost for three of them."""
    return roster.top_rosters(_candidates(t, 4), _FULL_SLOTS, cap=14000, team_limit=2, keep=30)


@query(
    """
    SELECT printf('%.2f', points / 10.0) AS score, count(*) AS n FROM (SELECT round(p_retailprice * 10)::BIGINT AS points FROM part)
    GROUP BY 1 ORDER BY max(points) DESC LIMIT 30
    """
)
def score_counts(t):
    return score_histogram(t.part.select(scaled("p_retailprice", 10).alias("points")), "points", 30, 10.0)
