"""A trie of conversation prefixes, with a sketch that keeps unshared tails out of the shuffle.

``order_turns`` deals the turns out by ranges of (conversation, turn), so that a conversation of any length is cut over
several tasks; the whole texts are shuffled once, and from then on a turn is two 64-bit hashes and a length.
``splice_openings`` puts conversations together with the opening of another one.  ``trie_nodes`` makes the nodes:

* A prefix's digest is the sum of hashes of its (place, turn) pairs, in four limbs of 32 bits, so it comes from
  running sums: within a segment first, then shifted by what the segments before add up to.
* A count-min sketch of all prefix digests, saturating at two, is built per task and merged.  It never counts too low,
  so an estimate of one proves that a prefix belongs to one conversation; with it all longer prefixes do.  Those
  nodes are written where they are, without a shuffle.  Only prefixes that may be shared are grouped, exactly, by digest,
  with partial sums before the shuffle.  The sketch grows with the number of prefixes up to ``MAX_BITS``; beyond
  that it proves less and more prefixes are grouped, with the same result.
* Sums over subtrees of shared nodes come from pointer doubling: after round k a node knows the sum of its next
  2 ** k levels, so rounds grow with the logarithm of the depth.  The root, which all have in common, is a global sum.
* The conversations that end at a node are listed in pieces of one range segment each; SHA-256 then runs over the pieces in order,
  one at a time.

Defined cases: rows with a null conversation id take no part; null roles and texts are empty; turns are ordered by turn (null first),
role and text, so ties and repeated rows have one order; a conversation may be turnless after splicing and then ends
at the root; an empty table gives no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Rows of the sketch, and the logarithm of the largest number of cells in a row.
SKETCH_ROWS = 4
MAX_BITS = 23
_CHUNK = 1 << 16
_MASK = 0xFFFFFFFF
_random = np.random.default_rng(52)
_FACTORS = _random.integers(1, 2**63, (2, 16), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EMPTY = hashlib.sha256(b"").hexdigest()


def order_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, segment, at, h1, h2, chars) and runs (conv_id, segment, first, n, before): a run's turns count from ``first``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    clean = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).filter("conv_id IS NOT NULL")
    # beginnings of role and text only place the cuts; the order below is that of whole texts
    dealt = clean.repartitionByRange("conv_id", "turn", F.substring("role", 1, 16), F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    hashes = [F.xxhash64(F.lit(seed), "role", "text").alias(f"h{seed}") for seed in (1, 2)]
    numbered = dealt.select("conv_id", F.spark_partition_id().alias("segment"), F.monotonically_increasing_id().alias("at"), *hashes, F.char_length("text").cast("long").alias("chars"))
    turns = materialise(numbered, "turns")
    runs = turns.groupBy("conv_id", "segment").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return turns, materialise(runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "runs")


def splice_openings(turns: DataFrame, runs: DataFrame, base: Column, opening: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``opening`` turns (at most ``most``) come from the conversation ``base``.

    Both are expressions of ``conv_id``; a base must not serve an unbounded number of conversations.  Returns conversations
    (conv_id, n) and turns (conv_id, segment, place, h1, h2, chars, last).
    """
    counted = runs.groupBy("conv_id").agg(F.sum("n").alias("own"), F.min("segment").alias("segment"))
    counted = counted.withColumns({"base": base, "h": opening.cast("long")})
    others = counted.select(F.col("conv_id").alias("base"), F.col("own").alias("base_n"))
    convs = counted.join(others, "base", "left").withColumn("lead", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = materialise(convs.withColumn("n", F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).select("conv_id", "segment", "base", "h", "lead", "n"), "conversations")
    facts = runs.select("conv_id", "segment", "first", "before").join(convs.drop("segment", "base"), "conv_id")
    placed = turns.join(facts, ["conv_id", "segment"]).withColumn("own", F.col("at") - F.col("first") + F.col("before") + 1)
    rest = placed.filter("own > h").withColumn("place", F.col("own") - F.col("h") + F.col("lead"))
    opened = placed.filter((F.col("own") <= most) & (F.col("conv_id") == base)).select(F.col("conv_id").alias("base"), F.col("own").alias("place"), "h1", "h2", "chars")
    heads = convs.join(opened, "base").filter("place <= h")
    columns = ["conv_id", "segment", "place", "h1", "h2", "chars", (F.col("place") == F.col("n")).alias("last")]
    return convs.select("conv_id", "n"), rest.select(*columns).union(heads.select(*columns))


def digest_prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, chars, last) of every prefix; ``up`` is the digest of the prefix one turn shorter."""
    limbs, sums = {}, [f"s{i}" for i in range(4)]
    for seed in (1, 2):
        whole = F.xxhash64(F.lit(seed), "place", "h1", "h2")
        limbs |= {f"l{2 * seed - 2}": whole.bitwiseAND(_MASK), f"l{2 * seed - 1}": F.shiftrightunsigned(whole, 32)}
    names = list(limbs)
    within = Window.partitionBy("conv_id", "segment").orderBy("place")
    summed = turns.withColumns(limbs).select("*", *[F.sum(name).over(within).alias(s) for name, s in zip(names, sums)]).drop("h1", "h2")
    summed = materialise(summed, "sums")
    # only conversations that cross a cut have something before a segment: a row per cut at most
    totals = summed.groupBy("conv_id", "segment").agg(*[F.sum(name).alias(name) for name in names])
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("conv_id", "segment", *[F.sum(name).over(earlier).alias(f"t{i}") for i, name in enumerate(names)]).filter("t0 IS NOT NULL")
    joined = summed.join(shifts, ["conv_id", "segment"], "left")
    full = [F.col(s) + F.coalesce(f"t{i}", F.lit(0)) for i, s in enumerate(sums)]

    def pair(low: Column, high: Column) -> Column:
        return F.shiftleft(high.bitwiseAND(_MASK), 32).bitwiseOR(low.bitwiseAND(_MASK))

    up = [x - F.col(name) for x, name in zip(full, names)]
    digests = [pair(full[0], full[1]).alias("a"), pair(full[2], full[3]).alias("b"), pair(up[0], up[1]).alias("up_a"), pair(up[2], up[3]).alias("up_b")]
    return joined.select("conv_id", F.col("place").alias("depth"), *digests, "chars", "last")


def _cells(a: pa.Array, b: pa.Array, rows: int, bits: int) -> np.ndarray:
    x, y = (v.to_numpy(zero_copy_only=False).view(np.uint64) for v in (a, b))
    shift = np.uint64(64 - bits)
    return np.stack([((x * _FACTORS[0, r] + y * _FACTORS[1, r]) >> shift).astype(np.int64) + (r << bits) for r in range(rows)])


def count_min(prefixes: DataFrame, rows: int = SKETCH_ROWS, max_bits: int = MAX_BITS) -> tuple[np.ndarray, int]:
    """One bit per cell, set where the cell counts two prefixes or more, and the logarithm of the row length.

    A task sends the chunks of its sketch that hold something, 2 bits a cell; the merged sketch has a bounded size.
    """
    bits = min(max_bits, max(12, (2 * prefixes.count() - 1).bit_length()))
    size = min(_CHUNK, rows << bits)

    def merge(counts: dict[int, np.ndarray], chunk: int, more: np.ndarray) -> None:
        held = counts.get(chunk)
        counts[chunk] = np.minimum(more if held is None else held + more, 2).astype(np.uint8)

    def emit(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for chunk, held in counts.items():
            packed = [np.packbits(held >= least).tobytes() for least in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *[pa.array([p], pa.binary()) for p in packed]], ["chunk", "once", "twice"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            cells, n = np.unique(_cells(batch.column(0), batch.column(1), rows, bits), return_counts=True)
            for chunk in np.unique(cells // size):
                here = cells // size == chunk
                more = np.zeros(size, np.uint8)
                more[cells[here] % size] = np.minimum(n[here], 2)
                merge(counts, int(chunk), more)
        yield from emit(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, once, twice in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                both = [np.unpackbits(np.frombuffer(x, np.uint8))[:size] for x in (once, twice)]
                merge(counts, chunk, both[0] + both[1])
        yield from emit(counts)

    schema = "chunk int, once binary, twice binary"
    merged = prefixes.select("a", "b").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    twice = np.zeros((rows << bits) // 8, np.uint8)
    # rows * 2 ** bits cells at most
    for chunk, packed in merged.select("chunk", "twice").toLocalIterator():
        twice[chunk * size // 8 : (chunk + 1) * size // 8] = np.frombuffer(packed, np.uint8)[: size // 8]
    return twice, bits


def screen(prefixes: DataFrame, rows: int = SKETCH_ROWS, max_bits: int = MAX_BITS) -> DataFrame:
    """The prefixes with ``alone`` (proved to belong to one conversation) and ``up_alone`` (the same for the one before)."""
    twice, bits = count_min(prefixes, rows, max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {name: batch.column(name) for name in batch.schema.names}
            marks = []
            for a, b in (("a", "b"), ("up_a", "up_b")):
                cells = _cells(get[a], get[b], rows, bits)
                marks.append(~((twice[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1).astype(bool).all(axis=0))
            # the root has no cells and is never alone here
            top = get["depth"].to_numpy() == 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks[0]), pa.array(marks[1] & ~top)], [*batch.schema.names, "alone", "up_alone"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema.fields)
    return prefixes.mapInArrow(run, f"{schema}, alone boolean, up_alone boolean")


def _up(nodes: DataFrame) -> DataFrame:
    """``to``: the parent, or the node itself below the root, so that those nodes do not all meet on a null key."""
    return nodes.withColumns({"to_a": F.coalesce("up_a", "a"), "to_b": F.coalesce("up_b", "b")})


def subtree_sums(nodes: DataFrame, depth: int) -> DataFrame:
    """(a, b, leaves, saved) summed over each node's subtree, by pointer doubling; a missing parent ends the way up."""
    sums = nodes.select("a", "b", "leaves", "saved", "up_a", "up_b")
    for _ in range(max(0, depth - 1).bit_length()):
        more = sums.groupBy("up_a", "up_b").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        more = more.filter("up_a IS NOT NULL").withColumnsRenamed({"up_a": "a", "up_b": "b"})
        jump = sums.select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.col("up_a").alias("next_a"), F.col("up_b").alias("next_b"))
        joined = _up(sums.join(more, ["a", "b"], "left")).join(jump, ["to_a", "to_b"], "left")
        added = [(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")]
        sums = materialise(joined.select("a", "b", *added, F.col("next_a").alias("up_a"), F.col("next_b").alias("up_b")), "subtrees")
    return sums.select("a", "b", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): SHA-256 of the comma-joined ascending conv_ids of each (a, b)."""
    dealt = materialise(ends.repartitionByRange("a", "b", "conv_id").withColumn("segment", F.spark_partition_id()), "ends")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = dealt.groupBy("a", "b", "segment").agg(listed.alias("piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, done = None, None, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["a", "b", "ends_sha256"])

        for batch in batches:
            for a, b, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (a, b) == held:
                    digest.update(b",")
                else:
                    if held:
                        done.append((*held, digest.hexdigest()))
                    held, digest = (a, b), hashlib.sha256()
                digest.update(piece.as_py().encode())
            yield out()
            done = []
        if held:
            done.append((*held, digest.hexdigest()))
            yield out()

    ordered = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "segment").select("a", "b", "piece")
    return ordered.mapInArrow(run, "a long, b long, ends_sha256 string")


def trie_nodes(convs: DataFrame, turns: DataFrame, rows: int = SKETCH_ROWS, max_bits: int = MAX_BITS) -> DataFrame:
    """All nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``convs`` are (conv_id, n), ``turns`` as ``splice_openings`` returns them.
    """
    spark = convs.sparkSession
    whole = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    if not whole[1]:
        return spark.createDataFrame([], schema)
    prefixes = materialise(digest_prefixes(turns), "prefixes")
    marked = materialise(screen(prefixes, rows, max_bits), "screened")
    local = marked.filter("alone OR up_alone")
    shared = marked.filter("NOT alone AND NOT up_alone")
    top = F.col("depth") == 1

    groups = shared.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"),
        F.min(F.when(~top, F.col("up_a"))).alias("up_a"), F.min(F.when(~top, F.col("up_b"))).alias("up_b"),
    )
    groups = materialise(groups, "shared")
    # tails whose parent may be shared; deeper parts of a tail need no other row
    hanging = local.filter("NOT up_alone")
    below = groups.select("up_a", "up_b", F.lit(0).alias("tails"), F.lit(1).alias("inner")).union(
        hanging.select(F.when(~top, F.col("up_a")), F.when(~top, F.col("up_b")), F.lit(1), F.lit(0))
    )
    below = materialise(below.groupBy("up_a", "up_b").agg(F.sum("tails").alias("tails"), F.sum("inner").alias("inner")), "children")
    counts = below.filter("up_a IS NOT NULL").withColumnsRenamed({"up_a": "a", "up_b": "b"})
    known = groups.join(counts, ["a", "b"], "left").na.fill(0, ["tails", "inner"]).withColumn("n_children", F.col("tails") + F.col("inner"))
    weighed = known.withColumns({"leaves": F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("tails")), "saved": (F.col("n_convs") - 1) * F.col("chars")})
    weighed = materialise(weighed.drop("tails", "inner", "chars"), "nodes")
    # one row: the depth of shared nodes and what the root sums up
    deepest, leaves, saved = weighed.agg(F.max("depth"), F.sum("leaves"), F.sum("saved")).first()
    at_root = below.filter("up_a IS NULL").first() or {"tails": 0, "inner": 0}

    ends = shared.filter("last").select("a", "b", "conv_id").union(convs.filter("n = 0").select(F.lit(0).cast("long"), F.lit(0).cast("long"), "conv_id"))
    digests = materialise(end_digests(ends), "end-digests")
    sums = subtree_sums(weighed, deepest or 0)
    parents = groups.select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.col("conv_id").alias("up_conv"))

    def parent(up_conv: Column) -> Column:
        # a parent that is not among the shared nodes is a node of the same conversation alone
        return F.when(top, F.lit(whole[0])).otherwise(F.coalesce(up_conv, F.col("conv_id")))

    inner = _up(weighed.join(sums, ["a", "b"]).join(digests, ["a", "b"], "left")).join(parents, ["to_a", "to_b"], "left")
    inner = inner.select("conv_id", "depth", parent(F.col("up_conv")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))

    def tail(rows: DataFrame, parent_conv: Column) -> DataFrame:
        own = F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_EMPTY))
        one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
        return rows.select("conv_id", "depth", parent_conv.alias("parent_conv_id"), one.alias("n_convs"), F.when(F.col("last"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), own.alias("ends_sha256"))

    tails = tail(local.filter("up_alone"), F.col("conv_id"))
    under = hanging.filter(~top).withColumnsRenamed({"up_a": "to_a", "up_b": "to_b"}).join(parents, ["to_a", "to_b"], "left")
    firsts = tail(under, parent(F.col("up_conv"))).union(tail(hanging.filter(top), F.lit(whole[0])))
    root_leaves = (leaves or 0) + at_root["tails"] or 1
    root = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).join(digests, ["a", "b"], "left").select(
        F.lit(whole[0]).alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(whole[1]).alias("n_convs"),
        F.lit(at_root["tails"] + at_root["inner"]).alias("n_children"), F.lit(root_leaves).alias("n_leaves"), F.lit(saved or 0).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    return inner.union(firsts).union(tails).union(root.to(inner.schema))
