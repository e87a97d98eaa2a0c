"""Hard negatives by exact tile products: per anchor the nearest rows of its label, per such positive the nearest others in a window.

Components are turned into integers (``floor(SCALE * x)``), and a score is an integer inner product.  Anchors come in packs,
candidates in blocks, and a pack meets a block in one product by Strassen's recursion: odd sides
get a zero row or column, seven half-size products take the place of eight, and additions are exact.  Integers are multiplied as
floats where no sum on the way can leave the integers that such floats hold, else in int64, where sums may wrap
around in between and the result is right wherever it fits 64 bits.  Where it might not, the tile is multiplied in integers of any size.

A *cell* is the work of one task: a group of anchors, held in memory with their heaps, and a share of the candidates, which
stream by once in blocks.  Heaps live as long as the cell, so most products are only compared with what the heaps still take, and
a task hands on at most one full heap per anchor and place, however many blocks went by.  Anchors are copied once per share
(at most ``SHARES``), candidates once per group of anchors (one that fills ``HELD_BYTES``; in the second pass ``GROUPS`` at least,
where the work is worth as many tasks); neither is copied per pack or block.

Candidates are dealt by a hash of their label into ``LABEL_PARTS`` parts.  A first pass has cells within parts, which hold all
rows of the anchors' labels, and keeps the best ``positives``; heaps of one anchor merge by its row number.  A second pass takes
the anchors, now with their positives' scores, through all candidates and keeps the best ``negatives`` in the window of each positive.

Defined cases: rows with a null id or label, a null vector, or a null or non-finite component take no part; an empty vector scores
zero; shorter vectors count as filled up with zeros; rows are told apart by their place in the table, so a row that
repeats an id is a row of its own and only the anchor row itself is left out of its positives; ties go to the
smaller id; an anchor without positives or a positive without negatives in its window has no rows; scores beyond 64 bits count
as the nearest 64-bit integer; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .tiles import BLOCK_VALUES, PACK_ROWS, arrow_limits, binary_rows, block_rows, dealt, padded, parts

POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these percentages of its positive's score.
WINDOW = (30, 90)
SCALE = 256
LABEL_PARTS = 64
LEAF = 32
#: Anchors and heaps that a task holds, pairs worth a task of their own, shares of the candidates at most, and groups of anchors
#: that the second pass makes for more tasks (its heaps that start anew in every share cost more than copies of the candidates).
HELD_BYTES = 200 << 20
CELL_PAIRS = 1 << 30
SHARES = 12
GROUPS = 4
_LEAST, _MOST = -(2**63), 2**63 - 1


def _even(matrix: np.ndarray) -> np.ndarray:
    """With a zero row or column where a side is odd."""
    n, m = matrix.shape
    if not (n % 2 or m % 2):
        return matrix
    # np.pad would put fixed-size zeros among integers of any size
    out = np.zeros((n + n % 2, m + m % 2), matrix.dtype)
    out[:n, :m] = matrix
    return out


class Room:
    """Memory that is used again from tile to tile: one array per name and type, as large as the largest asked for."""

    def __init__(self):
        self.arrays = {}

    def __call__(self, name: object, shape: tuple[int, int], kind: object) -> np.ndarray:
        kind, need = np.dtype(kind), shape[0] * shape[1]
        if len(self.arrays.get((name, kind), ())) < need:
            self.arrays[name, kind] = np.empty(need, kind)
        return self.arrays[name, kind][:need].reshape(shape)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF, room: Room | None = None, out: np.ndarray | None = None, depth: int = 0) -> np.ndarray:
    """Matrix product by seven half-size products while all sides are longer than ``leaf``; without ``out`` it lies in ``room``."""
    (n, k), m, kind = a.shape, b.shape[1], np.result_type(a, b)
    room = room or Room()
    if min(n, k, m) <= leaf:
        return np.matmul(a, b, out=room((depth, "out"), (n, m), kind) if out is None else out)
    a, b = _even(a), _even(b)
    (i, j), l = (x // 2 for x in a.shape), b.shape[1] // 2
    whole = out if out is not None and out.shape == (2 * i, 2 * l) else room((depth, "out"), (2 * i, 2 * l), kind)
    x, y = room((depth, "x"), (i, j), kind), room((depth, "y"), (j, l), kind)
    p, q = room((depth, "p"), (i, l), kind), room((depth, "q"), (i, l), kind)
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    c11, c12, c21, c22 = whole[:i, :l], whole[:i, l:], whole[i:, :l], whole[i:, l:]

    def product(left: np.ndarray, right: np.ndarray, place: np.ndarray) -> None:
        strassen(left, right, leaf, room, place, depth + 1)

    product(np.add(a11, a22, out=x), np.add(b11, b22, out=y), p)
    product(np.add(a21, a22, out=x), b11, c21)
    np.subtract(p, c21, out=c22)
    product(a11, np.subtract(b12, b22, out=y), c12)
    c22 += c12
    product(a22, np.subtract(b21, b11, out=y), q)
    c21 += q
    p += q
    product(np.add(a11, a12, out=x), b22, q)
    c12 += q
    p -= q
    product(np.subtract(a21, a11, out=x), np.add(b11, b12, out=y), q)
    c22 += q
    product(np.subtract(a12, a22, out=x), np.add(b21, b22, out=y), q)
    np.add(p, q, out=c11)
    if out is None or whole is out:
        return whole[:n, :m]
    out[...] = whole[:n, :m]
    return out


def _bounds(values: pa.Array) -> np.ndarray:
    """Where the rows of a binary column begin and end."""
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    return np.frombuffer(values.buffers()[1], kind)[values.offset : values.offset + len(values) + 1]


def _joined(values: pa.Array, kind) -> np.ndarray:
    """All bytes of a binary column as numbers."""
    data = values.buffers()[2]
    if data is None or not len(values):
        return np.zeros(0, kind)
    bounds = _bounds(values)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].copy().view(kind)


def _binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Numbers as a binary column, so many per row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * data.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _packed(vectors: np.ndarray, scale: int) -> tuple[np.ndarray, int]:
    """floor(scale * x) in 2, 4 or 8 bytes; where that may not be exact, the vectors as they are and 0."""
    with np.errstate(over="ignore"):
        whole = np.floor(vectors * scale)
    top = np.abs(whole).max() if whole.size else 0
    for width in (2, 4):
        if top < 2 ** (8 * width - 1):
            return whole.astype(f"i{width}"), width
    return (whole.astype(np.int64), 8) if top < 2**52 else (vectors, 0)


def _unpacked(vectors: pa.Array, widths: np.ndarray, dim: int, scale: int) -> np.ndarray:
    """Whole-number vectors as the rows of a matrix: the least integer type that holds all, else integers of any size."""
    lengths = np.diff(_bounds(vectors))
    out = np.zeros((len(widths), dim), object if (widths == 0).any() else f"i{widths.max()}")
    for width, length in set(zip(widths.tolist(), lengths.tolist())):
        at = np.flatnonzero((widths == width) & (lengths == length))
        some = vectors if len(at) == len(widths) else vectors.take(pa.array(at))
        rows = _joined(some, f"i{width}" if width else np.float64).reshape(len(at), -1 if length else 0)
        if not width:
            exact = [[math.floor(x * scale) if abs(x) < 1e290 else int(x) * scale for x in row] for row in rows.tolist()]
            rows = np.array(exact, object).reshape(rows.shape)
        elif out.dtype == object:
            rows = rows.astype(object)
        out[at, : rows.shape[1]] = rows
    return out


class Side:
    """One factor of a tile product, the rows of a pack or (turned) of a block, in the types that products ask for."""

    def __init__(self, whole: np.ndarray, turned: bool = False):
        self.whole, self.turned, self.kinds = whole, turned, {}
        self.top = max(abs(int(whole.max())), abs(int(whole.min()))) if whole.size else 0
        # no inner product is larger than the product of two norms; a little more than the largest one
        self.norm = math.inf if whole.dtype == object else 1.0001 * math.sqrt((whole.astype(np.float64) ** 2).sum(axis=1).max(initial=0))

    def of(self, kind) -> np.ndarray:
        if kind not in self.kinds:
            same = self.whole.astype(kind)
            self.kinds[kind] = np.ascontiguousarray(same.T) if self.turned else same
        return self.kinds[kind]


def tile_scores(pack: Side, block: Side, room: Room | None = None) -> np.ndarray:
    """Integer inner products of all rows of a pack and a block, as floats where those are exact."""
    (n, dim), m = pack.whole.shape, len(block.whole)
    most, side, levels = pack.top * block.top * dim, min(n, dim, m), 0
    while side > LEAF:
        side, levels = -(-side // 2), levels + 1
    # a level doubles both factors' components and norms and adds up four products
    bound = 4 * min(most << levels, pack.norm * block.norm * 4**levels)
    for kind, limit in ((np.float32, 2**24), (np.float64, 2**53)):
        if bound < limit:
            return strassen(pack.of(kind), block.of(kind), LEAF, room)
    if most < 2**63:
        return strassen(pack.of(np.int64), block.of(np.int64), LEAF, room)
    return np.clip(strassen(pack.of(object), block.of(object)), _LEAST, _MOST).astype(np.int64)


def best(slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and ranks (from 0) of the k highest scores of each slot, ties by smaller id."""
    # ~x turns the order around and cannot overflow
    order = np.lexsort((ids, ~scores, slots))
    first = np.flatnonzero(np.diff(slots[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k], rank[rank < k]


def windows(goals: list[list[int] | None], places: int, window: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that lie within the percentages of each goal; a place without any has the least above the greatest."""
    low, high = np.full((len(goals), places), _MOST), np.full((len(goals), places), _LEAST)
    for i, row in enumerate(goals):
        for place, goal in enumerate(row):
            least, most = -(-window[0] * goal // 100), window[1] * goal // 100
            if least <= min(most, _MOST) and most >= _LEAST:
                low[i, place], high[i, place] = max(least, _LEAST), min(most, _MOST)
    return low, high


def _limit(bounds: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Bounds that compare with exact scores of a type as the given ones do."""
    edge = {np.dtype(np.float32): 2**24, np.dtype(np.float64): 2**53}.get(kind)
    return np.clip(bounds, -edge, edge).astype(kind) if edge else bounds


class Heaps:
    """The best k entries in each slot (anchor and place) among scores from ``low`` to ``high``, in order."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        # what a score must reach, and the id that one no higher must stay below
        self.floor, self.last = low.copy(), np.full(low.shape, _MOST)
        self.filled = np.zeros(low.size, np.int32)
        self.scores, self.ids = np.zeros((2, low.size, k), np.int64)
        self.waiting, self.waits = [], 0

    def offer(self, scores: np.ndarray, ids: np.ndarray, allowed: Callable[[np.ndarray, np.ndarray], np.ndarray], room: Room) -> None:
        """Scores of all anchors with candidates in the order of their ids; ``allowed`` tells which pairs count."""
        n, m = scores.shape
        floor, last = self.floor, self.last
        hit = np.greater_equal(scores, _limit(floor.min(axis=1), scores.dtype)[:, None], out=room("hit", scores.shape, bool))
        if 64 * np.count_nonzero(hit) > hit.size:
            hit &= scores <= _limit(self.high.max(axis=1), scores.dtype)[:, None]
            hit &= allowed(np.arange(n)[:, None], np.arange(m)[None, :])
            if 64 * np.count_nonzero(hit) > hit.size and m > self.k:
                floor, last = self._raised(scores, hit)
                hit &= scores >= _limit(floor.min(axis=1), scores.dtype)[:, None]
        at, column = np.divmod(np.flatnonzero(hit), m)
        value = scores[at, column].astype(np.int64)
        right = allowed(at, column)
        at, column, value = at[right], column[right], value[right]
        entries = []
        for place in range(floor.shape[1]):
            least, name = floor[at, place], ids[column]
            taken = (value >= least) & (value <= self.high[at, place]) & ((value > least) | (name <= last[at, place]))
            row, score, name = at[taken], value[taken], name[taken]
            if len(row) > 4 * n * self.k:
                # of equal scores at the floor, the first ids will do
                level = score == floor[row, place]
                before = np.cumsum(level) - level
                start = np.searchsorted(row, np.arange(n))
                few = ~level | (before - np.append(before, 0)[start][row] < self.k)
                row, score, name = row[few], score[few], name[few]
            entries.append((row * floor.shape[1] + place, score, name))
        if found := sum(len(row) for row, _, _ in entries):
            self.waiting.append([np.concatenate(x) for x in zip(*entries)])
            self.waits += found
        if 4 * self.waits > len(self.filled) or len(self.waiting) > 16:
            self._merge()

    def _raised(self, scores: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The floors that the k best of some of these scores make."""
        floor, last = self.floor.copy(), self.last.copy()
        step = max(1, scores.shape[1] // max(1024, 8 * self.k))
        scores, hit = scores[:, ::step], hit[:, ::step]
        nothing = -np.inf if scores.dtype.kind == "f" else _LEAST
        for place in range(floor.shape[1]):
            inside = hit & (scores >= _limit(floor[:, place], scores.dtype)[:, None]) & (scores <= _limit(self.high[:, place], scores.dtype)[:, None])
            kth = np.partition(np.where(inside, scores, nothing), scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            up = np.flatnonzero(kth > nothing)
            up = up[kth[up].astype(np.int64) > floor[up, place]]
            floor[up, place], last[up, place] = kth[up].astype(np.int64), _MOST
        return floor, last

    def _merge(self) -> None:
        slots, scores, ids = map(np.concatenate, zip(*self.waiting))
        self.waiting, self.waits = [], 0
        touched = np.unique(slots)
        had = np.arange(self.k) < self.filled[touched][:, None]
        slots = np.concatenate([np.repeat(touched, self.filled[touched]), slots])
        scores, ids = np.concatenate([self.scores[touched][had], scores]), np.concatenate([self.ids[touched][had], ids])
        kept, rank = best(slots, scores, ids, self.k)
        self.scores[slots[kept], rank], self.ids[slots[kept], rank] = scores[kept], ids[kept]
        self.filled[touched] = np.diff(np.searchsorted(slots[kept], np.append(touched, touched[-1] + 1)))
        full = touched[self.filled[touched] == self.k]
        self.floor.flat[full], self.last.flat[full] = self.scores[full, -1], self.ids[full, -1]

    def batch(self, rows: np.ndarray) -> pa.RecordBatch:
        """One row per anchor: how many entries its places have, their ids and their scores."""
        if self.waits:
            self._merge()
        counts = self.filled.reshape(self.low.shape)
        there = np.arange(self.k) < self.filled[:, None]
        per_row, places = counts.sum(axis=1), np.full(len(rows), self.low.shape[1])
        columns = [pa.array(rows), _binaries(self.filled, places), _binaries(self.ids[there], per_row), _binaries(self.scores[there], per_row)]
        return pa.RecordBatch.from_arrays(columns, ["row", "n", "ids", "scores"]).filter(pa.array(per_row > 0))


class Cell:
    """One group of anchors and the candidates that stream by."""

    def __init__(self, same: bool, places: int, k: int, window: tuple[int, int] | None, dim: int, scale: int, pack_rows: int):
        self.same, self.places, self.k, self.window = same, places, k, window
        self.dim, self.scale, self.pack_rows = dim, scale, pack_rows
        self.waiting, self.packs, self.labels, self.room = [], [], None, Room()

    def _side(self, batch: pa.RecordBatch, turned: bool = False) -> Side:
        return Side(_unpacked(batch["vector"], batch["width"].to_numpy(), self.dim, self.scale), turned)

    def hold(self, anchors: pa.RecordBatch) -> None:
        self.waiting.append(anchors)

    def _pack_up(self) -> None:
        self.labels = pc.unique(pa.chunked_array([b["label"] for b in self.waiting]))
        for batch in self.waiting:
            for lo in range(0, batch.num_rows, self.pack_rows):
                some = batch.slice(lo, self.pack_rows)
                if self.window:
                    low, high = windows(some["goals"].to_pylist(), self.places, self.window)
                else:
                    low, high = np.full((some.num_rows, 1), _LEAST), np.full((some.num_rows, 1), _MOST)
                self.packs.append((some["row"].to_numpy(), self._codes(some), self._side(some), Heaps(low, high, self.k)))
        self.waiting = []

    def _codes(self, batch: pa.RecordBatch) -> np.ndarray:
        """Numbers of labels, -1 for one that no anchor has."""
        return pc.fill_null(pc.index_in(batch["label"], value_set=self.labels), -1).to_numpy(zero_copy_only=False)

    def meet(self, block: pa.RecordBatch) -> None:
        if self.waiting:
            self._pack_up()
        if not self.packs:
            return
        codes = self._codes(block)
        if self.same and (codes < 0).any():
            block, codes = block.filter(pa.array(codes >= 0)), codes[codes >= 0]
        if not block.num_rows:
            return
        block = block.take(order := pc.sort_indices(block["id"]))
        codes, rows, ids, side = codes[order.to_numpy()], block["row"].to_numpy(), block["id"].to_numpy(), self._side(block, True)
        for own_rows, own_codes, own_side, heaps in self.packs:

            def allowed(at: np.ndarray, column: np.ndarray) -> np.ndarray:
                equal = own_codes[at] == codes[column]
                return equal & (own_rows[at] != rows[column]) if self.same else ~equal

            heaps.offer(tile_scores(own_side, side, self.room), ids, allowed, self.room)

    def heaps(self) -> Iterator[pa.RecordBatch]:
        for rows, _, _, heaps in self.packs:
            yield heaps.batch(rows)


def _in_cells(batches: Iterator[pa.RecordBatch], new: Callable[[], Cell]) -> Iterator[pa.RecordBatch]:
    """Heaps of each cell, whose anchors (even slots) come before its candidates (odd slots)."""
    cell, number = None, None
    for batch in batches:
        slots = batch["slot"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(slots)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if slots[lo] // 2 != number:
                if cell:
                    yield from cell.heaps()
                cell, number = new(), slots[lo] // 2
            (cell.meet if slots[lo] % 2 else cell.hold)(batch.slice(lo, hi - lo))
    if cell:
        yield from cell.heaps()


def _merged(batches: Iterator[pa.RecordBatch], places: int, k: int) -> Iterator[pa.RecordBatch]:
    """Entries (row, place, rank, id, score) of all heaps of an anchor, of which one row holds the list."""
    for batch in batches:
        lists = batch["heaps"]
        anchor = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        n, ids, scores = lists.flatten().flatten()
        slots = np.repeat((anchor[:, None] * places + np.arange(places)).ravel(), _joined(n, np.int32))
        ids, scores = _joined(ids, np.int64), _joined(scores, np.int64)
        kept, rank = best(slots, scores, ids, k)
        row = batch["row"].to_numpy()[slots[kept] // places]
        columns = [row, slots[kept] % places + 1, (rank + 1).astype(np.int32), ids[kept], scores[kept]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "place", "rank", "id", "score"])


def _keys(spark: SparkSession, n: int) -> list[int]:
    """One number for each of n shuffle partitions, so that no two cells share one."""
    found = spark.range(20 * n, numPartitions=1).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p")).collect()
    keys = {r["p"]: r["id"] for r in found}
    return [keys.get(p, 20 * n + p) for p in range(n)]


def mine(
    vectors: DataFrame,
    label: Column | str,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    block_values: int = BLOCK_VALUES,
    pack_rows: int = PACK_ROWS,
    label_parts: int = LABEL_PARTS,
    held_bytes: int = HELD_BYTES,
    cell_pairs: int = CELL_PAIRS,
    shares: int = SHARES,
    least_groups: int = GROUPS,
) -> DataFrame:
    """One row per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    label = (F.col(label) if isinstance(label, str) else label).cast("string")
    kind = vectors.select(vector_col).schema[0].dataType
    floats = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    vector = F.col(vector_col) if floats else F.col(vector_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), label.alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    usable = usable.filter("id IS NOT NULL AND vector IS NOT NULL AND label IS NOT NULL")

    def pack_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            wide = max(pc.max(pc.list_value_length(lists)).as_py() or 0, 1)
            # a null component reads as one that is no number
            matrix = padded(lists, wide)
            good = np.isfinite(matrix).all(axis=1)
            batch, (whole, width) = batch.filter(pa.array(good)), _packed(matrix[good], scale)
            sizes = pa.array(np.full(len(whole), width, np.int32)), pa.array(np.full(len(whole), wide, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), binary_rows(whole), *sizes, batch.column(2), batch.column(3)], ["id", "vector", "width", "wide", "label", "is_anchor"])

    with arrow_limits(spark, 2_000):
        placed = usable.mapInArrow(pack_up, "id long, vector binary, width int, wide int, label string, is_anchor boolean")
        # the row numbers stay as they are once they are stored
        placed = materialise(placed.withColumn("part", dealt(F.col("label"), label_parts)).withColumn("row", F.monotonically_increasing_id()), "placed")
    # at most label_parts rows
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.col("is_anchor").cast("long")).alias("anchors"), F.max("wide").alias("wide")]
    counts = {r["part"]: r for r in placed.groupBy("part").agg(*sums).collect()}
    if not any(r["anchors"] for r in counts.values()):
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dim = max(r["wide"] for r in counts.values())

    def heaps(anchors: DataFrame, part: Column, sizes: list[tuple[int, int]], same: bool, places: int, k: int) -> DataFrame:
        """Merged heaps of anchors; sizes: rows and anchors of each part."""
        held = max(pack_rows, held_bytes // (8 * dim + places * (16 * k + 48)))
        tasks = [parts(n * a, cell_pairs) for n, a in sizes]
        groups = [max(parts(a, held), 1 if same else min(least_groups, t)) if a else 0 for (_, a), t in zip(sizes, tasks)]
        dealt_in = [min(shares, parts(t, max(g, 1))) for t, g in zip(tasks, groups)]
        first = np.cumsum([0, *(g * d for g, d in zip(groups, dealt_in))]).tolist()
        keys = F.lit(_keys(spark, first[-1])).cast("array<long>")

        def of_part(values: list[int]) -> Column:
            return F.lit(values)[part]

        def in_cell(rows: DataFrame, group: Column, share: Column, odd: int, goals: Column) -> DataFrame:
            rows = rows.select("row", "id", "label", "vector", "width", goals.alias("goals"), (of_part(first[:-1]) + group * of_part(dealt_in) + share).alias("cell"))
            return rows.withColumn("slot", F.col("cell") * 2 + odd)

        goals = F.lit(None).cast("array<long>") if same else F.col("goals")
        held_rows = anchors.withColumn("share", F.explode(F.sequence(F.lit(0), of_part(dealt_in) - 1)))
        held_rows = in_cell(held_rows, dealt(F.struct("row", F.lit(1)), of_part(groups)), F.col("share"), 0, goals)
        passing = placed.filter(of_part(groups) > 0).withColumn("group", F.explode(F.sequence(F.lit(0), of_part(groups) - 1)))
        passing = in_cell(passing, F.col("group"), dealt(F.col("row"), of_part(dealt_in)), 1, F.lit(None).cast("array<long>"))
        cells = held_rows.unionByName(passing).withColumn("key", keys[F.col("cell")]).repartition(first[-1], "key").sortWithinPartitions("slot")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _in_cells(batches, lambda: Cell(same, places, k, None if same else window, dim, scale, pack_rows))

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _merged(batches, places, k)

        found = cells.drop("cell", "key").mapInArrow(work, "row long, n binary, ids binary, scores binary")
        # an anchor has at most as many heaps as there are shares
        found = found.groupBy("row").agg(F.collect_list(F.struct("n", "ids", "scores")).alias("heaps"))
        return found.mapInArrow(merge, "row long, place long, rank int, id long, score long")

    anchors = placed.filter("is_anchor")
    by_part = [(counts[p]["n"], counts[p]["anchors"]) if p in counts else (0, 0) for p in range(label_parts)]
    with arrow_limits(spark, block_rows(dim, block_values)):
        near = heaps(anchors, F.col("part"), by_part, True, 1, positives)
        near = materialise(near.select("row", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        # at most `positives` entries per anchor
        goals = near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p")).select("row", F.col("p.positive_score").alias("goals"))
        total = tuple(map(sum, zip(*by_part)))
        found = heaps(anchors.join(goals, "row"), F.lit(0), [total], False, positives, negatives)
        found = materialise(found.select("row", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), "negatives")
    named = near.join(found, ["row", "place"])
    named = named.join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
