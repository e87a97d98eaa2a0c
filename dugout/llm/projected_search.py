"""Nearest neighbours by largest inner product, found through a few stable projections.

Every vector is divided by the largest norm of the table and gets one more component that brings its norm to one; a query
gets a zero there.  The distance in that space falls as the inner product grows.  ``DIMS`` random projections with
normal (2-stable) entries make a small image of the space: the squared image distance of two points, divided by
their squared distance, follows a chi-square distribution with ``DIMS`` degrees of freedom.

The images are indexed by a kd-tree.  Its upper part is cut on at most ``SAMPLE`` rows (by a hash of the row number)
and deals *all* rows out to leaves; a leaf is one block, or several when it is fuller than a block.  The lower part is
built in the task that holds a block, down to ``BUCKET`` rows.  A query first searches one block of its own leaf, which
bounds its k-th distance.  Then it goes to every leaf, and in it to the buckets in ascending image distance, and verifies
their rows on the full vectors, until the chi-square test holds: the image distance of what is next is so large, against
the k-th distance found, that a nearer neighbour would be mapped that far only with probability 1 - ``CONFIDENCE``.
The test is applied to whole leaves before a query is sent, and to buckets in the task.  So a true neighbour is
missed with probability 1 - CONFIDENCE at most; a whole bucket is verified where one of its rows has to be.
Queries travel in packs of near ones, a pack to a leaf if any of its queries must see it.

Scores are inner products of the original vectors, added up component by component in double precision.

Defined cases: vectors null, empty, zero, or with null or non-finite components, and rows with a null id, take no
part; shorter vectors count as filled up with zeros; rows are told apart by their place in the table, so a row that
repeats an id is a candidate of its own, equal rows come out as often as they are there, and only the query row itself
is left out; ties go to the smaller id; a query with fewer than k candidates gets all; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .tiles import BLOCK_VALUES, PACK_ROWS, arrow_limits, binary_rows, block_rows, dealt, lane, numbers, padded, parts, spread_blocks, stacked, usable_vectors

K = 20
DIMS = 8
CONFIDENCE = 0.96
SAMPLE = 20_000
MAX_LEAVES = 1_024
BUCKET = 128
_SLACK = 1e-9


def chi_square_quantile(p: float, freedom: int) -> float:
    """The value below which a chi-square variable of an even number of degrees of freedom stays with probability p."""
    if freedom % 2:
        raise ValueError("an even number of degrees of freedom has a closed form")

    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 4.0 * freedom + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


class Space:
    """The unit space of a table and its image."""

    def __init__(self, dim: int, norm: float, dims: int, seed: int = 7):
        self.dim, self.norm = dim, norm
        self.directions = np.random.default_rng(seed).standard_normal((dim + 1, dims))

    def points(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / self.norm
        rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", unit, unit)))
        return unit @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return self.units(vectors) @ self.directions[:-1]

    @staticmethod
    def units(vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Splits:
    """Upper part of the kd-tree: cuts at medians of a sample, widest axis first, down to about ``leaves`` leaves."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.axis, self.cut, self.below, self.leaves = [], [], [], 0
        self._grow(sample, leaves)

    def _grow(self, points: np.ndarray, leaves: int) -> int:
        wide = np.ptp(points, axis=0) if len(points) else np.zeros(1)
        if leaves <= 1 or not wide.max() > 0:
            self.leaves += 1
            return -self.leaves
        axis = int(wide.argmax())
        cut = float(np.median(points[:, axis]))
        under = points[:, axis] < cut
        if not under.any():  # more than half on the least value
            cut = float(points[points[:, axis] > cut, axis].min())
            under = points[:, axis] < cut
        at = len(self.axis)
        self.axis.append(axis)
        self.cut.append(cut)
        self.below.append(None)
        self.below[at] = (self._grow(points[under], leaves // 2), self._grow(points[~under], leaves - leaves // 2))
        return at

    def leaf(self, points: np.ndarray) -> np.ndarray:
        at = np.full(len(points), 0 if self.axis else -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            for node in np.unique(at[inner]):
                rows = inner[at[inner] == node]
                low, high = self.below[node]
                at[rows] = np.where(points[rows, self.axis[node]] < self.cut[node], low, high)
        return -at - 1


class Buckets:
    """Lower part of the kd-tree: rows of a block in buckets, each with the box of its images."""

    def __init__(self, images: np.ndarray, size: int = BUCKET):
        self.order, bounds = np.arange(len(images)), []
        todo = [(0, len(images))]
        while todo:
            lo, hi = todo.pop()
            if hi - lo <= size:
                bounds.append((lo, hi))
                continue
            rows = self.order[lo:hi]
            axis = np.ptp(images[rows], axis=0).argmax()
            mid = (hi - lo) // 2
            self.order[lo:hi] = rows[np.argpartition(images[rows, axis], mid)]
            todo += [(lo, lo + mid), (lo + mid, hi)]
        self.bounds = sorted(bounds)
        self.low = np.array([images[self.order[lo:hi]].min(axis=0) for lo, hi in self.bounds])
        self.high = np.array([images[self.order[lo:hi]].max(axis=0) for lo, hi in self.bounds])

    def distances(self, images: np.ndarray) -> np.ndarray:
        """Squared distance of each given image to each box."""
        return box_distances(images, self.low, self.high)


def box_distances(images: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = np.zeros((len(images), len(low)))
    for axis in range(images.shape[1]):
        x = images[:, axis, None]
        out += np.maximum(0.0, np.maximum(low[None, :, axis] - x, x - high[None, :, axis])) ** 2
    return out


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products added up from the first component to the last, the same for equal vectors wherever they stand."""
    total = np.zeros(len(vectors))
    for j in range(len(query)):
        total += vectors[:, j] * query[j]
    return total


def search_block(space: Space, quantile: float, k: int, block: tuple, tree: Buckets, queries: tuple, bounds: np.ndarray) -> Iterator[tuple]:
    """(query place, ids, scores) of each query's k best rows in a block.  ``bounds``: squared k-th distances known so far."""
    rows, ids, vectors = block
    q_rows, q_vectors = queries
    units = space.units(q_vectors)
    scaled = vectors / space.norm
    boxes = tree.distances(space.queries(q_vectors))
    nearest = np.argsort(boxes, axis=1, kind="stable")
    bound = np.array(bounds, float)
    found: list[list] = [[] for _ in q_rows]
    active = np.arange(len(q_rows))
    for step in range(len(tree.bounds)):
        bucket = nearest[active, step]
        going = boxes[active, bucket] <= quantile * bound[active]  # the chi-square test does not hold yet
        active, bucket = active[going], bucket[going]
        if not active.size:
            break
        fresh = set()
        for b in np.unique(bucket):
            who = active[bucket == b]
            lo, hi = tree.bounds[b]
            rest = 2 - 2 * (units[who] @ scaled[tree.order[lo:hi]].T)
            hits = (rest <= bound[who, None] + _SLACK).nonzero()
            for i in np.unique(hits[0]):
                at = hits[1][hits[0] == i]
                found[who[i]].append((tree.order[lo + at], rest[i, at]))
                fresh.add(int(who[i]))
        for q in fresh:
            at, rest = (np.concatenate(x) for x in zip(*found[q]))
            others = rest[rows[at] != q_rows[q]]
            if len(others) >= k:
                bound[q] = min(bound[q], np.partition(others, k - 1)[k - 1])
                near = rest <= bound[q] + _SLACK
                at, rest = at[near], rest[near]
            found[q] = [(at, rest)]
    for q, got in enumerate(found):
        at = np.concatenate([x for x, _ in got]) if got else np.empty(0, int)
        at = at[rows[at] != q_rows[q]]
        scores = exact_scores(vectors[at], q_vectors[q])
        best = np.lexsort((ids[at], -scores))[:k]
        yield q, ids[at[best]], scores[best]


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    is_query: Column | None = None,
    k: int = K,
    dims: int = DIMS,
    confidence: float = CONFIDENCE,
    block_values: int = BLOCK_VALUES,
    pack_rows: int = PACK_ROWS,
    sample: int = SAMPLE,
    max_leaves: int = MAX_LEAVES,
) -> DataFrame:
    """(query_id, rank, id, score) of each query row's k nearest other rows; all rows are queries unless told."""
    spark = vectors.sparkSession
    wanted = F.lit(True) if is_query is None else F.coalesce(is_query, F.lit(False))
    usable = usable_vectors(vectors, id_col, vector_col, wanted.alias("is_query"), zero=False)
    most = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    norm = most * F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / most) * (x / most)))
    n, dim, largest = usable.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(norm)).first()
    schema = "query_id long, rank int, id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    space = Space(dim, min(largest * (1 + 1e-12), 1.7e308), dims)
    quantile = chi_square_quantile(confidence, dims)
    block_size = block_rows(dim, block_values)

    with arrow_limits(spark, 2_000):
        def images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([binary_rows(space.points(padded(batch.column(0), dim)))], ["image"])

        share = min(1.0, sample / n)
        some = usable.withColumn("row", F.monotonically_increasing_id()).filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < share * (1 << 30)).limit(2 * sample)
        seen = [np.frombuffer(r[0], np.float64) for r in some.select("vector").mapInArrow(images, "image binary").toLocalIterator()]
        splits = Splits(np.array(seen).reshape(-1, dims), min(max_leaves, parts(n, block_size)))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                matrix = padded(batch.column(1), dim)
                image = space.points(matrix)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), binary_rows(matrix), batch.column(2), pa.array(splits.leaf(image), pa.int32()), pa.array(list(image), pa.list_(pa.float64()))],
                    ["id", "vector", "is_query", "leaf", "image"],
                )

        placed = usable.mapInArrow(place, "id long, vector binary, is_query boolean, leaf int, image array<double>")
        # the row numbers stay as they are once they are stored
        placed = materialise(placed.withColumn("row", F.monotonically_increasing_id()), "placed")
    sides = [f(F.col("image")[axis]).alias(f"{name}{axis}") for axis in range(dims) for name, f in (("low", F.min), ("high", F.max))]
    # at most max_leaves rows
    leaves = sorted(placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_query").cast("long")).alias("queries"), *sides).collect())
    numbers_of = np.array([r["leaf"] for r in leaves], np.int32)
    low, high = (np.array([[r[f"{side}{axis}"] for axis in range(dims)] for r in leaves]) for side in ("low", "high"))
    blocks_in = np.array([parts(r["n"], block_size) for r in leaves])
    by_leaf = {what: [0] * splits.leaves for what in ("first", "blocks", "packs")}
    for r, count, first in zip(leaves, blocks_in.tolist(), (np.cumsum(blocks_in) - blocks_in).tolist()):
        by_leaf["first"][r["leaf"]], by_leaf["blocks"][r["leaf"]], by_leaf["packs"][r["leaf"]] = first, count, parts(r["queries"], pack_rows)

    def of_leaf(what: str, leaf: str = "leaf") -> Column:
        return F.lit(by_leaf[what])[F.col(leaf)]

    block = of_leaf("first") + dealt(F.col("row"), of_leaf("blocks"))
    members = F.collect_list(F.struct("row", "id", "vector")).alias("m")
    blocks = placed.withColumn("block", block).groupBy("block").agg(members).select("block", "m.row", "m.id", "m.vector")
    blocks = spread_blocks(materialise(blocks, "blocks"))
    packs = placed.filter("is_query").groupBy("leaf", dealt(F.struct("row", F.lit(1)), of_leaf("packs")).alias("pack")).agg(members)
    packs = packs.select("leaf", "pack", F.col("m.row").alias("q_row"), F.col("m.id").alias("q_id"), F.col("m.vector").alias("q_vector"))
    packs = packs.withColumn("home", of_leaf("first") + F.pmod("pack", of_leaf("blocks"))).withColumn("lane", lane(F.struct("leaf", "pack")))
    found_schema = "leaf int, pack int, home int, lane int, q_row array<long>, q_id array<long>, q_vector array<binary>, bound array<double>, found array<array<struct<id:long,score:double>>>"
    names = ["leaf", "pack", "home", "lane", "q_row", "q_id", "q_vector", "bound", "found"]
    entry = pa.list_(pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float64())])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree, candidates = None, None, None
        for batch in batches:
            get = {name: batch.column(name) for name in batch.schema.names}
            for at in range(batch.num_rows):
                this = get["block"][at].as_py()
                if this != held:
                    candidates = (numbers(get["row"], at), numbers(get["id"], at), stacked(get["vector"], at, dim))
                    held, tree = this, Buckets(space.points(candidates[2]))
                q_vectors = stacked(get["q_vector"], at, dim)
                q_rows = numbers(get["q_row"], at)
                bounds = numbers(get["bound"], at) if "bound" in get else np.full(len(q_rows), np.inf)
                lengths = np.linalg.norm(q_vectors / np.abs(q_vectors).max(axis=1, keepdims=True), axis=1) * np.abs(q_vectors).max(axis=1)
                found, bound = [], []
                for q, ids, scores in search_block(space, quantile, k, candidates, tree, (q_rows, q_vectors), bounds):
                    found.append([{"id": i, "score": s} for i, s in zip(ids.tolist(), scores.tolist())])
                    bound.append(2 - 2 * (scores[-1] / lengths[q] / space.norm) if len(scores) == k else math.inf)
                fixed = [batch.column(name).slice(at, 1) for name in names[:7]]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array([bound], pa.list_(pa.float64())), pa.array([found], entry)], names)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The leaves that some query of a pack must see: the chi-square test on the leaves' boxes."""
        for batch in batches:
            out = []
            for at in range(batch.num_rows):
                far = box_distances(space.queries(stacked(batch.column("q_vector"), at, dim)), low, high)
                bound = numbers(batch.column("bound"), at)
                out.append(numbers_of[(far <= quantile * (bound[:, None] + _SLACK)).any(axis=0)].tolist())
            arrays = [batch.column(name) for name in names[:8]]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(out, pa.list_(pa.int32()))], [*names[:8], "leaves"])

    with arrow_limits(spark, 4):
        start = packs.join(blocks.withColumnRenamed("block", "home"), ["home", "lane"])
        started = materialise(start.withColumn("block", F.col("home")).mapInArrow(search, found_schema), "started")
        reach_schema = found_schema.rpartition(", found")[0] + ", leaves array<int>"
        sent = started.drop("found").mapInArrow(reach, reach_schema).withColumn("to", F.explode("leaves")).drop("leaves")
        last = of_leaf("first", "to") + of_leaf("blocks", "to") - 1
        sent = sent.withColumn("block", F.explode(F.sequence(of_leaf("first", "to"), last))).filter("block <> home").drop("to")
        rest = materialise(sent.join(blocks, ["block", "lane"]).mapInArrow(search, found_schema).select("q_row", "q_id", "found"), "searched")
    lists = started.select("q_row", "q_id", "found").union(rest)
    lines = lists.select(F.explode(F.arrays_zip("q_row", "q_id", "found")).alias("z")).select("z.q_row", "z.q_id", F.explode("z.found").alias("hit"))
    lines = lines.select("q_row", F.col("q_id").alias("query_id"), "hit.id", "hit.score")
    # the limit runs before the shuffle, so a task sends at most k rows per query
    ranked = lines.withColumn("rank", F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
