"""Near duplicates by MinHash with tensored banding.

Two small collections of half keys (``HALVES`` each, of ``ROWS`` minhashes) are computed per document.  Every
pair of a half key of the first and one of the second collection is the key of a hash table, so HALVES squared
tables of 2 * ROWS minhashes each cost only 2 * HALVES * ROWS minhashes.  At the threshold a pair of documents
meets in some table with probability (1 - (1 - 0.75 ** ROWS) ** HALVES) ** 2, 0.995 with the defaults.

Half keys that only one document has cannot meet and are dropped before pairs are formed; documents with equal
shingle sets are one node.  In each table cell every node is compared with the one that shares most cells with others, and
where that leaves several components with the one that shares fewest (two pairs per entry at most, however large the
cell; near copies have the same few nodes for most of their cells).  New links join the components found before, of which
only those that they touch are followed again.  Components that then still share a cell with others go through
an exact prefix join across components (two sets that are similar enough share one of the first n - ceil(0.75 n)
+ 1 shingles of any common order, and behind the first shared one both rests must be long enough; frequent
shingles come last in that order; and the parities of the shingles in 256 classes may differ in no more classes than two such
sets can differ in shingles).  So no pairs are formed within a linked group of copies.  Variants of one text that are too
far apart to link still meet on the shingles they share; all but a few of those meetings end at these filters, inside the
join.  Links are confirmed on the full shingle sets; a comparison of the sketches, wrong at most once in a million links,
saves most of that.

Defined cases: null or empty texts have no shingles, link with nothing and are their own component; fewer than
``WORDS`` words are one shingle; rows that repeat an id are one document; a null id links with nothing, has a
null component and is kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .components import connected_components

WORDS = 5
PERCENT = 75
HALVES = 16
ROWS = 4
FREQUENT = 10_000
#: 64-bit words of the parity classes.
PARITY_WORDS = 4
_MARGIN = 0.25

_random = np.random.default_rng(20240117)
_POSITION = _random.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; A-Z lowered, words between ASCII white space."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, n)
    size = min(n, words)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += _mix(hashed[k : n - size + 1 + k]) * _POSITION[k]
    return np.unique(_mix(total))


class MinHasher:
    """Minhashes of a shingle set and the half keys made of them."""

    def __init__(self, halves: int = HALVES, rows: int = ROWS):
        random = np.random.default_rng(71)
        n = 2 * halves * rows
        self.factor = (random.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1))[:, None]
        self.shift = random.integers(0, 2**63, n, dtype=np.uint64)[:, None]
        self.weight = random.integers(1, 2**63, (2 * halves, rows), dtype=np.uint64) | np.uint64(1)
        self.salt = random.integers(0, 2**63, 2 * halves, dtype=np.uint64)
        self.shape = (2 * halves, rows)

    def sketch(self, shingles: np.ndarray, block: int = 2048) -> np.ndarray:
        """32 high bits of the minimum of each hash function."""
        least = np.full(len(self.factor), 2**64 - 1, np.uint64)
        for at in range(0, len(shingles), block):
            np.minimum(least, (shingles[at : at + block] * self.factor + self.shift).min(axis=1), out=least)
        return (least >> np.uint64(32)).astype(np.uint32)

    def half_keys(self, sketch: np.ndarray) -> np.ndarray:
        mixed = (sketch.reshape(self.shape).astype(np.uint64) * self.weight).sum(axis=1, dtype=np.uint64)
        return _mix(mixed + self.salt).view(np.int64)


def features(docs: DataFrame, id_col: str, text_col: str, words: int, halves: int, rows: int) -> DataFrame:
    """(id, n, set_key, halves, sketch): the size and a 128-bit fingerprint of the set, half keys and 16 bits of each minhash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(halves, rows)
        for batch in batches:
            sizes, keys, parts, sketches = [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), words)
                sizes.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sketch = hasher.sketch(shingles) if len(shingles) else None
                parts.append(None if sketch is None else hasher.half_keys(sketch))
                sketches.append(None if sketch is None else sketch.astype(np.uint16).tobytes())
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(parts, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "set_key", "halves", "sketch"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, n long, set_key binary, halves array<long>, sketch binary")


def table_entries(nodes: DataFrame, halves: int) -> DataFrame:
    """(node, cell): the table keys of each node, where both halves occur in more than one node."""
    parts = nodes.select("node", F.posexplode("halves").alias("at", "half"))
    repeated = parts.groupBy("half").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("half")
    shared = parts.join(repeated, "half")
    # at most 2 * halves values per node
    sides = shared.groupBy("node").agg(
        F.collect_set(F.when(F.col("at") < halves, F.col("half"))).alias("first"), F.collect_set(F.when(F.col("at") >= halves, F.col("half"))).alias("second")
    )
    return sides.select("node", "second", F.explode("first").alias("x")).select("node", F.explode(F.transform("second", lambda y: F.xxhash64("x", y))).alias("cell"))


def shingle_rows(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(node, shingles) of the wanted nodes, as sorted 64-bit integers in one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), words).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    narrow = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    return narrow.join(wanted, "node", "left_semi").mapInArrow(run, "node long, shingles binary").filter(F.length("shingles") > 0)


def confirm(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.  Sizes and sketches rule out most others first."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                float((np.frombuffer(x.as_py(), np.uint16) == np.frombuffer(y.as_py(), np.uint16)).mean()) >= percent / 100 - _MARGIN
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    small = nodes.select("node", "n", "sketch")
    left = small.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = small.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    sized = pairs.join(left, "a").join(right, "b").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    likely = materialise(sized.select("a", "b", "s_a", "s_b").mapInArrow(close, "a long, b long").distinct(), "likely")
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return likely.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(similar, "a long, b long").distinct()


def parities(shingles: np.ndarray) -> np.ndarray:
    """One bit per class of shingles (by their high bits): whether the set has an odd number of them."""
    classes = 64 * PARITY_WORDS
    odd = np.bincount((shingles >> np.uint64(64 - classes.bit_length() + 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The rows (node, label, ...) with the labels that hold after more links; only links between different labels are followed."""
    a, b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab")
    between = links.join(a, "a").join(b, "b").filter("label_a <> label_b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    moved = connected_components(between).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return labels.join(moved, "label", "left").withColumn("label", F.coalesce("to", "label")).select(*labels.columns)


def star_pairs(labelled: DataFrame, pivot) -> DataFrame:
    """Pairs (a, b): in each cell the node of every component that shares most cells, with the least or greatest (``pivot``) of them."""
    spots = labelled.groupBy("cell", "label").agg(F.max(F.struct("shared", (-F.col("node")).alias("node"))).alias("spot"))
    ends = spots.groupBy("cell").agg(pivot("spot").alias("end"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("cell", (-F.col("end.node")).alias("end"))
    met = spots.select("cell", (-F.col("spot.node")).alias("node")).join(ends, "cell").filter("node <> end")
    return met.select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct()


def open_labels(labelled: DataFrame) -> DataFrame:
    """Components that share a cell with another one.  A component counts once per cell, however many of its nodes are there."""
    spots = labelled.select("cell", "label").distinct()
    mixed = spots.groupBy("cell").agg(F.min("label").alias("first"), F.max("label").alias("last")).filter("first < last").select("cell")
    return spots.join(mixed, "cell", "left_semi").select("label").distinct()


def _prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components whose first common shingle leaves room for a link, among the nodes (node, label) given.

    Order of shingles: those that a bounded frequency sketch does not list by their hash, then the listed ones by
    frequency.  Each node sends its prefix with the places.  A pair is kept if, were this its first common
    shingle, both rests would be long enough; that holds for the first common shingle of every link.  Sets of n and m
    shingles that link differ in at most n + m - 2 * ceil(percent * (n + m) / (100 + percent)), so their parities do.
    """
    members = members.join(sets, "node")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), np.int64))], ["shingle"])

    sketch = members.select("shingles").mapInArrow(spread, "shingle long").agg(F.expr(f"approx_top_k(shingle, {FREQUENT}, {8 * FREQUENT})").alias("top"))
    listed = sorted((np.uint64(t["item"] % 2**64), t["count"]) for t in sketch.first()["top"] or () if t["count"] > 1)
    frequent = np.array([t[0] for t in listed] or [0], np.uint64)
    count = np.array([t[1] for t in listed] or [0], np.int64)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, label, x in zip(batch.column(0), batch.column(1), batch.column(2)):
                x = np.frombuffer(x.as_py(), np.uint64)
                place = np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)
                ordered = x[np.lexsort((x, np.where(frequent[place] == x, count[place], 0)))]
                first = ordered[: len(x) - (-(-percent * len(x) // 100)) + 1].view(np.int64)
                same = [pa.array(np.full(len(first), v), pa.int64()) for v in (node.as_py(), label.as_py(), len(x), *parities(x).tolist())]
                yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(len(first))), pa.array(first)], ["node", "label", "n", *words, "at", "shingle"])

    words = [f"p{i}" for i in range(PARITY_WORDS)]
    schema = f"node long, label long, n long, {', '.join(f'{w} long' for w in words)}, at long, shingle long"
    rows = members.select("node", "label", "shingles").mapInArrow(prefix, schema)
    rows = materialise(rows, "prefixes")
    # the component that holds most nodes of a shingle is only met by the others, never by itself
    most = rows.groupBy("shingle", "label").count().groupBy("shingle").agg(F.max_by("label", "count").alias("most"), F.count(F.lit(1)).alias("labels"))
    rows = materialise(rows.join(most.filter("labels > 1").drop("labels"), "shingle"), "mixed")
    other = rows.select("shingle", *[F.col(c).alias(f"{c}_2") for c in ("node", "label", "n", "at", *words)])
    together = F.col("n") + F.col("n_2")
    differ = functools.reduce(lambda a, b: a + b, [F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}_2"))) for w in words])
    near = differ <= together - 2 * F.ceil(percent * together / (100 + percent))
    room = (100 + percent) * (F.least(F.col("n") - F.col("at"), F.col("n_2") - F.col("at_2"))) >= percent * (F.col("n") + F.col("n_2"))
    sizes = 100 * F.least("n", "n_2") >= percent * F.greatest("n", "n_2")
    met = rows.filter("label <> most").join(other, "shingle").filter(F.expr("label <> label_2 AND (label_2 = most OR node < node_2)") & sizes & room & near)
    return met.select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    halves: int = HALVES,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    found = materialise(features(docs, id_col, text_col, words, halves, rows), "features")
    real = found.filter("n > 0 AND id IS NOT NULL")
    classes = real.groupBy("set_key").agg(F.min("id").alias("node"), F.max("id").alias("last")).filter("node < last").select("set_key", "node")
    classes = materialise(classes, "classes")
    named = found.select("id", "n", "set_key").join(classes, "set_key", "left")
    named = materialise(named.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("node", "id")).alias("node")), "named")
    nodes = real.join(classes, "set_key", "left").filter("node IS NULL OR id = node")
    nodes = materialise(nodes.select(F.col("id").alias("node"), "n", "halves", "sketch"), "nodes")

    entries = materialise(table_entries(nodes, halves), "entries")
    shared = entries.groupBy("cell").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("cell")
    entries = materialise(entries.join(shared, "cell", "left_semi"), "cells")
    sets = materialise(shingle_rows(docs, entries.select("node").distinct(), id_col, text_col, words), "sets")

    labels = entries.groupBy("node").agg(F.count(F.lit(1)).alias("shared")).select("node", F.col("node").alias("label"), "shared")
    labels, compared = materialise(labels, "labels"), None
    for pivot in (F.max, F.min):
        labelled = materialise(entries.join(labels, "node"), "labelled")
        star = star_pairs(labelled, pivot)
        star = materialise(star if compared is None else star.join(compared, ["a", "b"], "left_anti"), "star")
        compared = star if compared is None else compared.union(star)
        labels = materialise(merged(labels, materialise(confirm(star, nodes, sets, percent), "links")), "labels")
    labelled = materialise(entries.join(labels, "node"), "labelled")
    members = labelled.select("node", "label").distinct().join(open_labels(labelled), "label", "left_semi")
    rest = _prefix_pairs(materialise(members, "open"), sets, percent).join(compared, ["a", "b"], "left_anti")
    labels = merged(labels, materialise(confirm(rest, nodes, sets, percent), "links")).select("node", "label")

    joined = named.join(labels, "node", "left")
    component = F.coalesce("label", "node", "id")
    return joined.select("id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows whose document is the smallest id of its component, with all their columns."""
    going = near_duplicates(docs, id_col, text_col, **settings).filter("not kept").select(F.col("id").alias("__id")).distinct()
    return docs.join(going, docs[id_col] == going["__id"], "left_anti")
