"""Aliases, code systems and alternate spellings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import replacement_candidates


def alias_table(aliases: DataFrame, dimension: DataFrame, code: str, alias: str) -> DataFrame:
    """Lower-case alias to code: the alias list plus every code as its own alias.

    Where an alias is listed for several codes the smallest code is taken, so the table is unique.
    """
    pairs = aliases.select(F.lower(alias).alias("alias"), F.col(code).alias("code")).unionByName(
        dimension.select(F.lower(code).alias("alias"), F.col(code).alias("code"))
    )
    return pairs.groupBy("alias").agg(F.min("code").alias("code"))


def resolve_alias(df: DataFrame, column: str, aliases: DataFrame, name: str = "code") -> DataFrame:
    """Canonical code of a name in any case; null where it is unknown."""
    table = aliases.select(F.col("alias").alias("__alias"), F.col("code").alias(name))
    return df.join(table, F.lower(df[column]) == table["__alias"], "left").drop("__alias")


def translate(df: DataFrame, column: str, dimension: DataFrame, source: str, target: str, name: str) -> DataFrame:
    """Code of another code system of the same dimension."""
    table = dimension.select(F.col(source).alias("__source"), F.col(target).alias(name))
    return df.join(table, df[column] == table["__source"], "left").drop("__source")


def literal_lookup(value: Column, mapping: Mapping[str, str]) -> Column:
    """Fixed mapping as an expression; unknown values give null."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(table, value)


def resolve_names(
    df: DataFrame,
    key: str,
    name: str,
    known: DataFrame,
    pairs: Sequence[tuple[str, str]],
    known_name: str,
    known_id: str,
) -> DataFrame:
    """Id of the name itself or else of the first alternate spelling that is known.

    ``known`` must hold one id per name.  Spellings equal to the name are not tried again.
    """
    tried = F.array_distinct(replacement_candidates(F.upper(name), pairs))
    spelled = df.select(key, F.posexplode(tried).alias("__pos", "__try"))
    table = known.select(F.upper(known_name).alias("__try"), F.col(known_id).alias("__id"))
    hits = (
        spelled.join(table, "__try")
        .groupBy(key)
        .agg(F.min_by("__id", F.struct("__pos", "__id")).alias(known_id), F.min_by("__try", F.struct("__pos", "__id")).alias("matched_name"))
    )
    return df.join(hits, key, "left")
