"""Queries on fitted models that return what can be said without them: counts, and whether promises hold."""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from ..functions.score import linear_score, scaled
from ..operators import model as ml
from ..operators.encode import apply_codes, cardinalities, fit_codes
from ..session import materialise, scratch_path
from .registry import query

_KEYS = ["l_orderkey", "l_linenumber"]
_HELD = "('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 1, 4))::INT % 10 >= 7"


def _vectors(t, *extra):
    """Feature vectors of order lines; the target is the worth of a line at its part's price."""
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        *_KEYS, "l_quantity", "l_discount", "p_size", "p_retailprice", (F.col("l_returnflag") == "R").alias("is_returned"), *extra, (F.col("l_quantity") * F.col("p_retailprice")).alias("target")
    )
    names = ml.feature_names(rows, exclude=(*_KEYS, *extra, "target"))
    return names, ml.to_vectors(rows, names, "target", {"is_returned": 2})


@query(
    f"""
    SELECT l_linestatus, count(*) AS n_held_out, count(*) AS n_scored, true AS beats_the_mean, true AS inside_the_labels, true AS same_after_loading,
           true AS strongest_is_a_feature, true AS dump_has_names
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE {_HELD} GROUP BY 1
    """
)
def model_contract(t):
    """Fit, store, load, score the held-out lines; each promise as a truth value per status."""
    names, vectors = _vectors(t, "l_linestatus")
    train, test = ml.split_by_hash(vectors, _KEYS)
    fitted = ml.train(train, rounds=5, depth=4, bins=64)
    path = scratch_path(t.spark, "model")
    ml.save_model(fitted, path)
    loaded = ml.load_model(path)
    mean, low, high = train.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    keys = [*_KEYS, "l_linestatus", "label"]
    # the stored model is applied to what the fitted one has scored, so both stand on one row
    scored = ml.predict(loaded, ml.predict(fitted, test, [*keys, "features"], "first"), [*keys, "first"], "second")
    # trees are fitted to residuals, so a sum of them may leave the labels by a little
    slack = (high - low) / 10
    dump = ml.describe(loaded, names)
    return scored.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n_held_out"), F.count("second").alias("n_scored"),
        (F.avg((F.col("label") - F.col("second")) ** 2) < F.avg((F.col("label") - mean) ** 2)).alias("beats_the_mean"),
        F.every(F.col("second").between(low - slack, high + slack)).alias("inside_the_labels"),
        F.every(F.col("first") == F.col("second")).alias("same_after_loading"),
        F.lit(ml.importances(loaded, names)[0][0] in names).alias("strongest_is_a_feature"),
        F.lit("feature " not in dump and any(n in dump for n in names)).alias("dump_has_names"),
    )


@query(
    """
    SELECT 'l_returnflag' AS name, 'nominal' AS kind, count(DISTINCT l_returnflag)::BIGINT AS n_values, true AS codes_fit, true AS fits_a_tree FROM lineitem
    UNION ALL SELECT 'l_shipmode_code', 'nominal', count(DISTINCT l_suppkey % 7)::BIGINT, true, true FROM lineitem
    UNION ALL SELECT 'l_quantity', 'numeric', NULL, true, true
    """
)
def nominal_slots(t):
    """The marks of a vector's slots, with the number of values that the dictionary has; codes of the dictionary, and a tree on them."""
    names = ["l_returnflag", "l_shipmode_code"]
    rows = t.lineitem.select("l_returnflag", (F.col("l_suppkey") % 7).alias("l_shipmode_code"), "l_quantity", "l_extendedprice")
    dictionary = materialise(fit_codes(rows, names), "codes")
    counted = {r["column"]: r["n_values"] for r in cardinalities(dictionary).collect()}
    coded = apply_codes(rows, names, dictionary)
    vectors = materialise(ml.to_vectors(coded, [*names, "l_quantity"], "l_extendedprice", counted), "vectors")
    beyond = vectors.agg(*[F.max(F.col(c) >= counted[c]).alias(c) for c in names]).first()
    tree = DecisionTreeRegressor(maxDepth=2, maxBins=64, seed=1).fit(vectors)
    marks = vectors.schema["features"].metadata["ml_attr"]["attrs"]
    slots = [
        (a["name"].removeprefix("__f_"), kind, a.get("num_vals"), not beyond.asDict().get(a["name"].removeprefix("__f_"), False), tree.numFeatures == 3)
        for kind, group in marks.items() for a in group
    ]
    return t.spark.createDataFrame(slots, "name string, kind string, n_values long, codes_fit boolean, fits_a_tree boolean")


_SPLIT_SQL = """
    WITH x AS (SELECT unnest(['l_discount', 'l_quantity', 'l_tax']) AS feature, unnest([l_discount, l_quantity, l_tax])::DOUBLE AS value,
                      round(l_extendedprice * 100)::BIGINT AS y FROM lineitem),
    b AS (SELECT feature, value, count(*) AS n, sum(y) AS s FROM x GROUP BY ALL),
    w AS (SELECT feature, (value + lead(value) OVER o) / 2 AS threshold, sum(n) OVER o AS n_left, sum(s) OVER o AS sum_left,
                 sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s FROM b WINDOW o AS (PARTITION BY feature ORDER BY value)),
    g AS (SELECT feature, threshold, n_left::BIGINT AS n_left, (n - n_left)::BIGINT AS n_right, sum_left::BIGINT AS sum_left, (s - sum_left)::BIGINT AS sum_right,
                 sum_left::DOUBLE * sum_left::DOUBLE / n_left::DOUBLE + (s - sum_left)::DOUBLE * (s - sum_left)::DOUBLE / (n - n_left)::DOUBLE - s::DOUBLE * s::DOUBLE / n::DOUBLE AS gain
          FROM w WHERE threshold IS NOT NULL)
"""


@query(f"{_SPLIT_SQL} SELECT * FROM g ORDER BY gain DESC, feature, threshold LIMIT 1")
def first_split(t):
    rows = t.lineitem.select("l_discount", "l_quantity", "l_tax", scaled("l_extendedprice").alias("cents"))
    return ml.best_split(rows, ["l_discount", "l_quantity", "l_tax"], "cents")


@query(f"{_SPLIT_SQL} SELECT feature, threshold, n_left, n_right, sum_left, sum_right FROM g")
def split_table(t):
    rows = t.lineitem.select("l_discount", "l_quantity", "l_tax", scaled("l_extendedprice").alias("cents"))
    return ml.split_gains(rows, ["l_discount", "l_quantity", "l_tax"], "cents").drop("gain")


@query(
    f"""
    SELECT CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS role, count(*) AS n_scored, true AS sum_is_weighted, true AS targets_differ
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE {_HELD} GROUP BY 1
    """
)
def target_models(t):
    """A model per role and target, stored and loaded, their predictions on one row and the weighted sum."""
    targets = {"hr": "l_quantity", "sb": "l_discount"}
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(*_KEYS, "l_quantity", "l_discount", "p_size", "p_retailprice", "l_tax", "l_returnflag")
    names = ["p_size", "p_retailprice", "l_tax"]
    vectors = materialise(ml.to_vectors(rows, names), "vectors")
    out = []
    for role, chosen in (("returned", F.col("l_returnflag") == "R"), ("kept", F.col("l_returnflag") != "R")):
        train, test = ml.split_by_hash(vectors.filter(chosen), _KEYS)
        fitted = ml.train_targets(lambda target, part=train: part.withColumn("label", F.col(targets[target])), list(targets), rounds=2)
        models = {}
        for target, model in fitted.items():
            path = scratch_path(t.spark, f"model-{role}-{target}")
            ml.save_model(model, path)
            models[target] = ml.load_model(path)
        out.append(ml.combine_targets(models, test, _KEYS).withColumn("role", F.lit(role)))
    scored = out[0].unionByName(out[1])
    weighted = linear_score(ml.rules.TARGET_WEIGHTS, list(targets))
    return scored.groupBy("role").agg(
        F.count("fd_sum").alias("n_scored"), F.every(F.col("fd_sum") == weighted).alias("sum_is_weighted"), F.every(F.col("hr") != F.col("sb")).alias("targets_differ")
    )
