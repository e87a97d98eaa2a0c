"""Key-based joins with fixed outcomes for missing partners."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def present_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``other``; duplicates in ``other`` do not multiply them."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def upsert(stored: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key is not being replaced, plus all updates."""
    return missing_keys(stored, updates, keys).unionByName(updates)


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join with a default for each looked-up column."""
    joined = df.join(table.select(*keys, *defaults), list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def select_joined(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join that keeps the left copy of every column both sides have."""
    extra = [c for c in right.columns if c in on or c not in left.columns]
    return left.join(right.select(*extra), list(on), how)


def merge_dictionaries(first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """Union of two key-value tables; the second wins where both have a key."""
    ranked = first.select(key, value, F.lit(0).alias("__p")).unionByName(second.select(key, value, F.lit(1).alias("__p")))
    return ranked.groupBy(key).agg(F.max_by(value, "__p").alias(value))
