"""Vector operators against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dugout.llm import hard_negatives as hard
from dugout.llm import projected_search as near
from dugout.llm.tiles import arrow_limits

SCHEMA = "vec_id long, embedding array<double>, label int, block int, row string"


def table(spark, rows):
    """(id, vector, label) rows with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, v, l, 3, "x") for i, v, l in rows], SCHEMA).repartition(3)


def clusters(seed, n=600, dim=12, groups=6, noise=0.3):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((groups, dim))
    return (centres[random.integers(0, groups, n)] + noise * random.standard_normal((n, dim))).round(4)


def brute_nearest(rows, k, every):
    good = [(i, v) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for place, (i, v) in enumerate(good):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for other, (j, w) in enumerate(good) if other != place)
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_chi_square_quantile():
    # median and 0.95 quantiles from tables
    assert near.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert near.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert near.chi_square_quantile(0.5, 10) == pytest.approx(9.342, abs=1e-3)


def test_tree_gives_all_rows_and_true_boxes():
    images = np.random.default_rng(3).standard_normal((1000, 4))
    tree = near.Buckets(images, 50)
    assert sorted(tree.order.tolist()) == list(range(1000)) and max(hi - lo for lo, hi in tree.bounds) <= 50
    far = tree.distances(images[:20])
    for b, (lo, hi) in enumerate(tree.bounds):
        true = ((images[:20, None] - images[tree.order[lo:hi]][None]) ** 2).sum(axis=2).min(axis=1)
        assert (far[:, b] <= true + 1e-12).all()
    splits = near.Splits(images, 16)
    assert splits.leaves == 16 and set(splits.leaf(images)) == set(range(16))
    assert near.Splits(np.zeros((50, 4)), 8).leaves == 1 and near.Splits(np.zeros((0, 4)), 8).leaves == 1


def test_recall_and_scores_over_many_blocks(spark):
    vectors = clusters(1, 3000, 24, 40)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    got = near.nearest(table(spark, rows), is_query=F.col("vec_id") % 20 == 0, k=10, block_values=24 * 200, pack_rows=16).collect()
    want = brute_nearest(rows, 10, 20)
    assert len(got) == len(want) == 1500
    found = {(r["query_id"], r["id"]) for r in got}
    assert sum((q, j) in found for q, _, j, _ in want) >= 0.95 * len(want)
    scores = {(q, j): s for q, _, j, s in brute_nearest(rows, 3000, 20)}
    for r in got:
        assert r["score"] == pytest.approx(scores[r["query_id"], r["id"]], rel=1e-12)
    for q in {r["query_id"] for r in got}:
        mine = sorted((r["rank"], -r["score"], r["id"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and mine == sorted(mine, key=lambda m: m[1:])


def test_the_test_spares_most_rows_of_clustered_data():
    vectors = clusters(2, 4000, 24, 60, 0.05)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    space = near.Space(24, float(np.linalg.norm(vectors, axis=1).max()), near.DIMS)
    tree = near.Buckets(space.points(vectors), 64)
    quantile = near.chi_square_quantile(near.CONFIDENCE, near.DIMS)
    order = np.argsort(-(space.units(vectors[:50]) @ vectors.T), axis=1)
    kth = np.array([order[i][order[i] != i][9] for i in range(50)])
    bound = 2 - 2 * np.einsum("ij,ij->i", space.units(vectors[:50]), vectors[kth]) / space.norm
    seen = tree.distances(space.queries(vectors[:50])) <= quantile * bound[:, None]
    assert seen.mean() < 0.5


def test_nearest_edge_cases(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (20, [0.0, 2.0], 1), (1, [1.0, 1.0], None), (2, [1.0, 1.0], 0), (3, [2.0], 0), (40, [-1e-3, -1e-3], 0),
        (60, None, 0), (4, [], 0), (5, [0.0, 0.0], 0), (6, [1.0, None], 0), (7, [nan, 1.0], 0), (8, [math.inf, 1.0], 0), (None, [1.0, 1.0], 0),
    ]
    got = sorted(tuple(r) for r in near.nearest(table(spark, rows), is_query=F.col("vec_id") % 20 == 0, k=4).collect())
    assert got == brute_nearest(rows, 4, 20)
    assert sorted(r["id"] for r in near.nearest(table(spark, rows[:2]), k=5).collect()) == [0, 0]
    assert near.nearest(table(spark, []), k=5).collect() == []
    assert near.nearest(table(spark, rows[7:]), k=5).collect() == []
    assert near.nearest(table(spark, rows[:1]), k=5).collect() == []


def test_equal_vectors_fill_many_blocks(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(300)] + [(1000 + i, [float(i), 1.0, 0.0], 0) for i in range(20)]
    got = near.nearest(table(spark, rows), is_query=F.col("vec_id") == 100, k=5, block_values=3 * 64).collect()
    assert sorted((r["rank"], r["id"], r["score"]) for r in got) == [(k, i, s) for k, (s, i) in enumerate(sorted(((-float(v[0] + 2 * v[1] + 3 * v[2]), i) for i, v, _ in rows if i != 100))[:5], 1) for s in [-s]]


def test_limits_come_back(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(KeyError), arrow_limits(spark, 7):
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "7"
        raise KeyError
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_strassen_is_exact():
    random = np.random.default_rng(5)
    for n, k, m in [(1, 1, 1), (3, 70, 5), (65, 64, 130), (97, 101, 99), (256, 33, 300)]:
        a, b = random.integers(-(2**20), 2**20, (n, k)), random.integers(-(2**20), 2**20, (k, m))
        assert (hard.strassen(a, b, 8) == a @ b).all() and (hard.strassen(a.astype(object), b.astype(object), 16) == a @ b).all()
    # sums wrap around in between, the result fits
    big = np.full((64, 64), 2**61, np.int64)
    assert (hard.strassen(big, np.eye(64, dtype=np.int64) * 3, 8) == big * 3).all()


def brute_hard(rows, every, positives=5, negatives=10):
    good = [(i, l, [math.floor(256 * x) for x in v]) for i, v, l in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    clip = lambda x: max(-(2**63), min(2**63 - 1, x))
    out = []
    for place, (i, l, v) in enumerate(good):
        if i % every:
            continue
        scored = [(-clip(sum(a * b for a, b in zip(v, w))), j, m) for other, (j, m, w) in enumerate(good) if other != place]
        for ps, p in sorted((s, j) for s, j, m in scored if m == l)[:positives]:
            inside = sorted((s, j) for s, j, m in scored if m != l and 30 * -ps <= 100 * -s <= 90 * -ps)[:negatives]
            out += [(i, p, rank, j, -ps, -s) for rank, (s, j) in enumerate(inside, 1)]
    return sorted(out)


def test_hard_negatives_over_many_tiles(spark):
    vectors, labels = clusters(4, 900, 40), np.random.default_rng(1).integers(0, 5, 900)
    rows = [(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(vectors, labels))]
    got = hard.mine(table(spark, rows), "label", F.col("vec_id") % 10 == 0, block_values=40 * 70, pack_rows=8)
    assert sorted(tuple(r) for r in got.collect()) == brute_hard(rows, 10)


def test_hard_negative_edge_cases(spark):
    nan, big = float("nan"), 3e17
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.7, 0.2], 2), (3, [0.7, 0.2], 2), (3, [0.7, 0.2], 2), (4, [0.4], 2), (5, [], 2),
        (10, [big, 1.0], 3), (11, [big, 0.0], 3), (12, [big / 2, 3.0], 4), (20, [1.0, 1.0], 9), (6, None, 1), (7, [1.0, 1.0], None),
        (8, [1.0, None], 1), (9, [nan, 1.0], 1), (30, [math.inf, 1.0], 1), (None, [1.0, 1.0], 1), (40, [-1.0, -1.0], 5), (41, [0.5, 0.5], 5),
    ]
    got = hard.mine(table(spark, rows), "label", F.col("vec_id") % 10 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute_hard(rows, 10)
    assert hard.mine(table(spark, []), "label", F.col("vec_id") % 10 == 0).collect() == []
    assert hard.mine(table(spark, rows[12:18]), "label", F.lit(True)).collect() == []
    assert hard.mine(table(spark, rows), "label", F.lit(None).cast("boolean")).collect() == []


def dealt_out(plan):
    """Bytes that the exchanges of an executed plan have dealt out."""
    below = sum(dealt_out(plan.children().apply(i)) for i in range(plan.children().size()))
    return below + (plan.metrics().apply("dataSize").value() if plan.nodeName() == "Exchange" else 0)


def test_packs_are_not_copied_for_every_block(spark, monkeypatch):
    vectors, labels, total, stored = clusters(8, 2000, 24), np.random.default_rng(2).integers(0, 4, 2000), [], hard.materialise
    rows = [(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(vectors, labels))]

    def counted(df, name):
        df.collect()
        total[-1] += dealt_out(df._jdf.queryExecution().executedPlan())
        return stored(df, name)

    monkeypatch.setattr(hard, "materialise", counted)
    adaptive, want = spark.conf.get("spark.sql.adaptive.enabled"), brute_hard(rows, 10)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for size in (640, 64):
            total.append(0)
            got = hard.mine(table(spark, rows), "label", F.col("vec_id") % 10 == 0, block_values=24 * size, pack_rows=16)
            assert sorted(tuple(r) for r in got.collect()) == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    # ten times the blocks are the same anchors and candidates
    assert total[1] <= 1.2 * total[0]


def test_cells_of_any_size_give_the_same(spark):
    for seed, scale, kept in ((1, 0.2, 0), (2, 30, 0), (3, 1e5, 0), (4, 1e300, 0.5), (5, 1, 0.5)):
        random = np.random.default_rng(seed)
        vectors = random.standard_normal((250, 37)) * np.where(random.random((250, 1)) < kept, 1, scale)
        vectors[random.random(250) < 0.2] = vectors[0]
        rows = [(i // 2 if i % 5 == 0 else i, v[: 37 - i % 3].tolist(), i % 3) for i, v in enumerate(vectors)]
        got = hard.mine(table(spark, rows), "label", F.col("vec_id") % 4 == 0, block_values=37 * 30, pack_rows=9, held_bytes=30_000, cell_pairs=2_000, shares=3)
        assert sorted(tuple(r) for r in got.collect()) == brute_hard(rows, 4)


def test_few_entries_wait_in_heaps_however_many_scores_are_equal():
    low, high = np.full((3, 2), -5), np.array([[5, 2], [5, 2], [5, -9]])
    heaps, random = hard.Heaps(low, high, 4), np.random.default_rng(6)
    scores, ids = random.integers(-8, 8, (3, 4000)), random.permutation(4000)
    for block in np.array_split(np.arange(4000), 3):
        block = block[np.argsort(ids[block])]
        heaps.offer(scores[:, block].astype(np.float32), ids[block], lambda at, column: np.ones(np.broadcast(at, column).shape, bool), hard.Room())
        assert heaps.waits <= 200
    batch = heaps.batch(np.arange(3))
    for i in range(3):
        want = [sorted((-s, j) for s, j in zip(scores[i].tolist(), ids.tolist()) if -5 <= s <= h)[:4] for h in high[i]]
        assert np.frombuffer(batch["n"][i].as_py(), np.int32).tolist() == [len(w) for w in want]
        assert np.frombuffer(batch["ids"][i].as_py(), np.int64).tolist() == [j for w in want for _, j in w]


def test_strassen_of_odd_sides_and_integers_of_any_size():
    random = np.random.default_rng(7)
    a, b = (random.integers(-9, 9, s).astype(object) * 10**200 for s in ((35, 37), (37, 33)))
    assert (hard.strassen(a, b, 8) == a @ b).all()
