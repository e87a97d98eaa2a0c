"""Exact duplicates with the frequent digests resolved map-side.

A Misra-Gries summary (the frequent-items sketch behind ``approx_top_k``) names digests that may be frequent.
Each name is verified by an exact count, and the verified winners, at most ``hot_keys`` rows, are broadcast:
rows of those digests are resolved where they are read.  All other digests take an ordinary shuffle, in which
no group can hold more than about ``4 / tracked`` of the rows.

Defined cases: a null text equals the empty text; a null id never wins against another id and a group that has
only null ids keeps none of its ids (``keep_id`` null, ``kept`` true for all its rows); rows that repeat both
the smallest id and the text are one document and are all kept by ``resolve_copies``; an empty table gives an
empty result.  Other columns are carried by ``drop_copies`` and never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

HOT_KEYS = 1_000
TRACKED = 8_192


def normalised(text: Column) -> Column:
    """Runs of white space become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_of(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def frequent_winners(digests: DataFrame, hot_keys: int = HOT_KEYS, tracked: int = TRACKED) -> DataFrame:
    """(digest, keep_id, group_size) of frequent digests with more than one row; at most ``hot_keys`` rows.

    The sketch works on 64-bit hashes and only proposes; count and smallest id are exact.
    """
    proposed = digests.agg(F.expr(f"approx_top_k(xxhash64(digest), {hot_keys}, {tracked})").alias("top"))
    names = proposed.select(F.explode("top.item").alias("name"))
    rows = digests.join(F.broadcast(names), F.xxhash64("digest") == F.col("name"), "left_semi")
    exact = rows.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return exact.filter("group_size > 1").orderBy(F.desc("group_size"), "digest").limit(hot_keys)


def resolve_copies(digests: DataFrame, hot_keys: int = HOT_KEYS, tracked: int = TRACKED) -> DataFrame:
    """From (id, digest) to (id, digest, keep_id, group_size, kept), one row per input row."""
    digests = materialise(digests.select("id", "digest"), "digests")
    winners = materialise(frequent_winners(digests, hot_keys, tracked), "winners")
    marked = digests.join(F.broadcast(winners), "digest", "left")
    hot = marked.filter(F.col("group_size").isNotNull())
    rest = marked.filter(F.col("group_size").isNull()).select("digest", "id")
    sizes = rest.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    resolved = hot.select("id", "digest", "keep_id", "group_size").unionByName(
        rest.join(sizes, "digest").select("id", "digest", "keep_id", "group_size")
    )
    return resolved.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest."""
    return resolve_copies(docs.select(F.col(id_col).alias("id"), digest_of(F.col(text_col)).alias("digest")), **limits)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows that stay, with all their columns.  A row that repeats id and text of another goes with the copies.

    Only ids and digests of rows that go are joined with the texts.
    """
    found = exact_copies(docs, id_col, text_col, **limits)
    going = found.filter("not kept").select(F.col("id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    return docs.join(
        going, docs[id_col].eqNullSafe(going["__id"]) & (digest_of(docs[text_col]) == going["__digest"]), "left_anti"
    )
