"""License scan: an exact set-similarity join of text blocks with license templates, and literal phrases.

A block is a line of at most twice the words of the longest template.  A longer line is taken apart into windows of
that many words, one beginning at every so many words as the longest template has, so every run of that length is whole in one of them and words that
are scattered over a long line match nothing.  With ``around`` the text around a line break is a block as well: up to
that many words before it and as many after it, other breaks among them.  A notice of at most ``around`` words is then in one block
however its lines are wrapped; ``AROUND`` is the length of the longest template.  Its tokens are words of digits, letters and non-ASCII characters in lower case.  A block
matches a template when it holds at least ``THRESHOLD`` of the template's distinct tokens.  Tokens are ordered
by their frequency in all blocks, rarest first.  A block with c = ceil(threshold * size) of a template's tokens
must hold one of its first size - c + 1 tokens (prefix filter), must have c template tokens in all (length
filter), and from the place of a shared prefix token there must be enough tokens left on both sides (positional
filter).  What passes is verified on the full sets, so the result is exact.

A template whose tokens are among those of another is found with it.  Only tokens of the templates matter for containment; others are dropped when the text is read.  The template
tables are of the size of the parameter and are broadcast.

Defined cases: null text counts as empty; an empty text has no words, no labels and score 0; repeated rows and
null ids get the same result as any other row with their text; other columns are not read.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

# Phrases whose consecutive words are the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Short license statements and notices as they stand in documents.
TEMPLATES = {
    "mit": ("released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    "apache": ("licensed under the apache license version 2 0", "you may not use this file except in compliance with the license"),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
    ),
    "cc-by": ("licensed under cc by 4 0", "licensed under a creative commons attribution 4 0 international license"),
    "cc-by-nc": ("licensed under cc by nc 4 0", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",),
}
THRESHOLD = 0.85
AROUND = max(len(text.split()) for texts in TEMPLATES.values() for text in texts)
_PLACES = "array<struct<at:bigint,label:string>>"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def needed(size: int, threshold: float) -> int:
    """Tokens that a block must share with a template of ``size`` tokens."""
    return math.ceil(round(size * threshold, 9))


def template_rows(templates: dict[str, tuple[str, ...]], threshold: float) -> list[tuple[str, str, list[str], int]]:
    sets = [(label, text, sorted(set(text.split()))) for label, texts in templates.items() for text in texts]
    return [(label, text, tokens, needed(len(tokens), threshold)) for label, text, tokens in sets]


def _phrase_starts(words: Column, phrases: dict[str, str]) -> Column:
    """(place, label) of each phrase occurrence, as an array of structs."""
    def places(tokens: list[str], label: str) -> Column:
        def here(i: Column) -> Column:
            return functools.reduce(lambda a, b: a & b, [F.get(words, i + k) == token for k, token in enumerate(tokens)])

        found = F.when(F.array_contains(words, tokens[-1]), F.filter(F.sequence(F.lit(0), F.size(words) - 1), here))
        marked = F.transform(found, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))
        return F.coalesce(marked, F.array().cast(_PLACES))

    return F.concat(*[places(phrase.split(), label) for phrase, label in phrases.items()])


def _around_breaks(parts: Column, around: int, known: Column) -> Column:
    """Tokens among the ``around`` words before and after each line break; ``parts`` are words and, as one, breaks."""
    # between two breaks there is a word, so twice as many parts hold enough words
    reach = 2 * around
    is_word = lambda part: ~F.startswith(part, F.lit("\n"))

    def block(i: Column) -> Column:
        before = F.filter(F.slice(parts, F.greatest(i + 1 - reach, F.lit(1)), F.least(i, F.lit(reach))), is_word)
        after = F.filter(F.slice(parts, i + 2, reach), is_word)
        before = F.slice(before, F.greatest(F.size(before) - around + 1, F.lit(1)), around)
        return F.array_intersect(F.concat(before, F.slice(after, 1, around)), known)

    breaks = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.startswith(F.get(parts, i), F.lit("\n")))
    return F.when(F.size(parts) > 0, F.transform(breaks, block))


def _line_blocks(words: Column, known: Column, templates: list[tuple[str, str, list[str], int]]) -> Column:
    """Template tokens of a line's blocks.  A long line is only taken apart if it holds enough tokens of a template in all."""
    longest = max(len(row[1].split()) for row in templates)

    def whole(block: Column) -> Column:
        tests = [F.size(F.array_intersect(block, F.array(*map(F.lit, tokens)))) >= least for _, _, tokens, least in templates]
        return functools.reduce(lambda a, b: a | b, tests)

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w), F.lit(longest))
        return F.transform(starts, lambda i: F.array_intersect(F.slice(w, i, 2 * longest), known))

    # arrays of one element give a name to what is used more than once
    bound = F.transform(F.array(words), lambda w: F.struct(w.alias("w"), F.array_intersect(w, known).alias("block")))
    made = F.transform(bound, lambda x: F.when(F.size(x["w"]) <= 2 * longest, F.array(x["block"])).when(whole(x["block"]), windows(x["w"])))
    return F.coalesce(made[0], F.array().cast("array<array<string>>"))


def scan_blocks(docs: DataFrame, id_col: str, text_col: str, phrases: dict[str, str], templates: list[tuple[str, str, list[str], int]], around: int = 0) -> DataFrame:
    """One row per document: number of words, phrase places, and the template tokens of blocks that hold enough of them."""
    known = F.array(*[F.lit(t) for t in sorted({t for row in templates for t in row[2]})])
    least = min(row[3] for row in templates)
    held = F.flatten(F.transform(F.split("text", "\n"), lambda line: _line_blocks(words_of(line), known, templates)))
    parts = F.lit(None).cast("array<string>")
    if around:
        # a break takes the signs and breaks that follow it
        parts = F.regexp_extract_all(F.lower("text"), F.lit(rf"({WORD}|\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*+)"), F.lit(1))
        held = F.concat(held, F.coalesce(_around_breaks(F.col("parts"), around, known), F.array().cast("array<array<string>>")))
    maybe = F.lower("text").rlike("|".join(sorted({p.split()[-1] for p in phrases})))
    return (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .select("id", "text", F.when(maybe, words_of(F.col("text"))).alias("words"), F.when(F.contains("text", F.lit("\n")), parts).alias("parts"))
        .select(
            "id",
            F.xxhash64("text").alias("row"),
            F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"),
            F.coalesce(F.when(F.size("words") > 0, _phrase_starts(F.col("words"), phrases)), F.array().cast(_PLACES)).alias("starts"),
            F.filter(held, lambda block: F.size(block) >= least).alias("blocks"),
        )
    )


def token_order(scanned: DataFrame, vocabulary: list[str]) -> list[str]:
    """Template tokens, rarest first by the number of blocks that hold them.  As long as the vocabulary."""
    counts = scanned.select(F.explode("blocks").alias("block")).select(F.explode("block").alias("token"))
    seen = {r["token"]: r["count"] for r in counts.groupBy("token").count().collect()}
    return sorted(vocabulary, key=lambda t: (seen.get(t, 0), t))


def matching_blocks(scanned: DataFrame, templates: list[tuple[str, str, list[str], int]], order: list[str]) -> DataFrame:
    """(id, row, label, share) for each block and template that meet the threshold."""
    rank = {token: i for i, token in enumerate(order)}
    prefixes = []
    for label, text, tokens, least in templates:
        ranked = sorted(tokens, key=rank.__getitem__)
        prefixes += [(label, text, ranked, least, len(ranked), at, ranked[at]) for at in range(len(ranked) - least + 1)]
    schema = "label string, template string, tokens array<string>, least int, size int, t_at int, token string"
    # one row per template and prefix token: as large as the parameter
    prefix = F.broadcast(scanned.sparkSession.createDataFrame(prefixes, schema))
    ordered, first = F.array(*map(F.lit, order)), F.array(*map(F.lit, sorted({p[-1] for p in prefixes})))
    blocks = scanned.select("id", "row", F.explode("blocks").alias("block")).filter(F.arrays_overlap("block", first))
    held = blocks.select("id", "row", F.array_intersect(ordered, F.col("block")).alias("block"))
    shared = held.select("id", "row", "block", F.posexplode("block").alias("b_at", "token"))
    after = F.least(F.col("size") - F.col("t_at"), F.size("block") - F.col("b_at"))
    pairs = (
        shared.join(prefix, "token")
        .filter(F.size("block") >= F.col("least"))
        .filter(F.least("t_at", "b_at") + after >= F.col("least"))
    )
    common = F.size(F.array_intersect("block", "tokens"))
    return pairs.filter(common >= F.col("least")).select("id", "row", "label", (common / F.col("size")).alias("share"))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, tuple[str, ...]] | None = None,
    phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    around: int = 0,
) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``around`` is the number of words on each side of a line break that make a block; 0 takes lines alone.
    ``score`` is 1 for a document with a phrase, else the largest containment that met the threshold, else 0.
    """
    rows = template_rows(templates if templates is not None else TEMPLATES, threshold)
    phrases = PHRASES if phrases is None else phrases
    vocabulary = sorted({t for row in rows for t in row[2]})
    scanned = materialise(scan_blocks(docs, id_col, text_col, phrases, rows, around), "license-blocks")
    found = (
        matching_blocks(scanned, rows, token_order(scanned, vocabulary))
        .groupBy("id", "row")
        .agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
        .select(F.col("id").alias("__id"), F.col("row").alias("__row"), "found", "share")
    )
    joined = scanned.drop("blocks").join(found, F.col("id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")), "left")
    base = F.array_distinct("starts.label")
    return joined.select(
        "id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts.at").alias("first_word"),
        F.array_max("starts.at").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
