"""Feature vectors, boosted-tree regression and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import baseball as rules
from ..functions.score import linear_score


def feature_names(df: DataFrame, exclude: Sequence[str] = rules.NOT_FEATURES) -> list[str]:
    """Name-sorted numeric and boolean columns that are not excluded."""
    usable = (T.NumericType, T.BooleanType)
    return sorted(f.name for f in df.schema.fields if f.name not in exclude and isinstance(f.dataType, usable))


def hash_bucket(*keys) -> F.Column:
    """Bucket 0 to 9 of a key, the same on every run and engine that has MD5."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int") % 10


def is_train(*keys, train_tenths: int = 7) -> F.Column:
    return hash_bucket(*keys) < train_tenths


def split_by_hash(df: DataFrame, keys: Sequence[str], train_tenths: int = 7) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key bucket, so a key never changes sides between runs."""
    mine = is_train(*keys, train_tenths=train_tenths)
    return df.filter(mine), df.filter(~mine)


def to_vectors(
    df: DataFrame, features: Sequence[str], target: str | None = None, cardinality: Mapping[str, int] | None = None
) -> DataFrame:
    """Add ``features`` (null and NaN as 0) and ``label`` (missing target as 0).

    Columns named in ``cardinality`` are marked as nominal with that many values.
    """
    prepared = []
    for c in features:
        value = F.col(c).cast("double")
        value = F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)
        meta = {"ml_attr": {"name": c, "type": "numeric"}}
        if cardinality and c in cardinality:
            meta = {"ml_attr": {"name": c, "type": "nominal", "num_vals": int(cardinality[c])}}
        prepared.append(value.alias(f"__f_{c}", metadata=meta))
    wide = df.select("*", *prepared)
    assembled = VectorAssembler(inputCols=[f"__f_{c}" for c in features], outputCol="features").transform(wide)
    assembled = assembled.drop(*[f"__f_{c}" for c in features])
    if target is not None:
        assembled = assembled.withColumn("label", F.coalesce(F.col(target).cast("double"), F.lit(0.0)))
    return assembled


def train(vectors: DataFrame, rounds: int = rules.MODEL_ROUNDS, depth: int = rules.MODEL_DEPTH, bins: int = rules.MODEL_BINS, seed: int = rules.SEED) -> GBTRegressionModel:
    return GBTRegressor(maxIter=rounds, maxDepth=depth, maxBins=bins, seed=seed).fit(vectors.select("features", "label"))


def save_model(model: GBTRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> GBTRegressionModel:
    return GBTRegressionModel.load(path)


def predict(model: GBTRegressionModel, vectors: DataFrame, keys: Sequence[str], name: str = "prediction") -> DataFrame:
    """Keys travel with the row, so no positional pairing is needed."""
    return model.transform(vectors).select(*keys, F.col("prediction").alias(name))


def importances(model: GBTRegressionModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Feature names with their importance, most important first."""
    values = zip(features, model.featureImportances.toArray().tolist(), strict=True)
    return sorted(values, key=lambda v: (-v[1], v[0]))


def describe(model: GBTRegressionModel, features: Sequence[str]) -> str:
    """Model dump with feature names in place of feature numbers."""
    text = model.toDebugString
    for i in reversed(range(len(features))):
        text = text.replace(f"feature {i} ", f"{features[i]} ")
    return text


def train_targets(
    vectors_of, targets: Sequence[str], rounds: int = rules.MODEL_ROUNDS_PER_TARGET
) -> dict[str, GBTRegressionModel]:
    """One model per target; ``vectors_of(target)`` gives the labelled vectors."""
    return {t: train(vectors_of(t), rounds=rounds) for t in targets}


def combine_targets(
    models: Mapping[str, GBTRegressionModel], vectors: DataFrame, keys: Sequence[str], weights: Mapping[str, float] = rules.TARGET_WEIGHTS
) -> DataFrame:
    """All target predictions on one row and their weighted sum as ``fd_sum``.

    The models are applied one after the other to the same row, which replaces a join per target.
    """
    out = vectors
    for target, model in models.items():
        # every model writes the fixed column "prediction", so it is renamed before the next one runs
        out = model.transform(out).withColumnRenamed("prediction", f"__p_{target}")
    scored = out.select(*keys, *[F.col(f"__p_{t}").alias(t) for t in models])
    if len(models) == 1:
        return scored.withColumn("fd_sum", F.col(next(iter(models))))
    return scored.withColumn("fd_sum", linear_score(weights, list(models)))


def join_predictions(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Predictions of several targets side by side, joined on their keys."""
    return reduce(lambda a, b: a.join(b, list(keys)), frames)


def split_gains(df: DataFrame, features: Sequence[str], label: str, cuts: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Every possible first split of a regression tree: feature, threshold, n and sum on both sides, gain.

    Rows are added up per feature and bin before the shuffle (n and sum of an integer label; the squares cancel in a gain), so what follows has as many
    rows as there are bins.  A feature's bins are its values, so it should have a few hundred at most; others get ``cuts``,
    ascending upper ends of their bins.  The threshold is the middle between the largest value on the left and the
    smallest on the right, the gain the squared error that the split takes away.  Null and NaN count as 0.
    """
    pairs = []
    for c in features:
        value = F.col(c).cast("double")
        value = F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)
        bin_no = F.size(F.filter(F.lit([float(x) for x in cuts[c]]), lambda end: end < value)).cast("double") if cuts and c in cuts else value
        pairs.append(F.struct(F.lit(c).alias("feature"), bin_no.alias("bin"), value.alias("value")))
    y = F.coalesce(F.col(label).cast("bigint"), F.lit(0))
    bins = (
        df.select(F.explode(F.array(*pairs)).alias("p"), y.alias("y")).groupBy("p.feature", "p.bin")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.min("p.value").alias("low"), F.max("p.value").alias("high"))
    )
    # a few hundred bins per feature
    order = Window.partitionBy("feature").orderBy("bin")
    so_far, whole = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("feature")
    left = bins.select(
        "feature", ((F.col("high") + F.lead("low").over(order)) / 2).alias("threshold"), F.sum("n").over(so_far).alias("n_left"), F.sum("s").over(so_far).alias("sum_left"),
        F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("s"),
    ).filter(F.col("threshold").isNotNull())
    sides = left.select("feature", "threshold", "n_left", (F.col("n") - F.col("n_left")).alias("n_right"), "sum_left", (F.col("s") - F.col("sum_left")).alias("sum_right"))

    def square(total: str, count: str) -> F.Column:
        x = F.col(total).cast("double")
        return x * x / F.col(count).cast("double")

    total = (F.col("sum_left") + F.col("sum_right")).cast("double")
    parent = total * total / (F.col("n_left") + F.col("n_right")).cast("double")
    return sides.withColumn("gain", square("sum_left", "n_left") + square("sum_right", "n_right") - parent)


def best_split(df: DataFrame, features: Sequence[str], label: str, cuts: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """The split with the largest gain; ties go to the first feature by name and the smallest threshold."""
    return split_gains(df, features, label, cuts).orderBy(F.desc("gain"), "feature", "threshold").limit(1)
