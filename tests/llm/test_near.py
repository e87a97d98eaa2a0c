"""Near duplicates and components against brute force."""

import itertools
import random

import pytest

from support import documents

from dugout.llm import near_dedup
from dugout.llm.components import connected_components


def closure(ids, links):
    label = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_components(spark):
    random.seed(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(random.randint(100, 160), random.randint(100, 160)) for _ in range(40)] + [(500, 400)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == closure(sorted({x for link in links for x in link}), links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(table):
    sets = {i: set(near_dedup.shingle_set(t).tolist()) for i, t in table}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return closure(sorted(sets), links), {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    passage = random.choices(words, k=60)
    table = []
    for group in range(12):
        base = random.choices(words, k=random.randint(6, 120))
        for _ in range(random.choice([1, 2, 5, 25])):
            text = base + (passage if group % 3 == 0 else [])
            for _ in range(random.randint(0, 4)):
                text[random.randrange(len(text))] = random.choice(words)
            table.append((len(table) + 10, " ".join(text)))
    random.shuffle(table)
    label, sizes = brute(table)
    got = near_dedup.near_duplicates(documents(spark, table)).collect()
    assert {r["id"]: r["component_id"] for r in got} == label
    assert {r["id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in got)


def test_defined_cases(spark):
    table = [(4, None), (5, ""), (6, "  \n"), (7, "a b"), (8, "A  B"), (9, "a b c"), (None, "a b"), (3, "x " * 30_000), (2, "x " * 29_000), (1, "q w e r t y"), (1, "q w e r t y")]
    got = {(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(documents(spark, table)).collect()}
    assert got == {
        (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True), (8, 1, 7, False), (9, 1, 9, True), (None, 1, None, True),
        (3, 1, 2, False), (2, 1, 2, True), (1, 2, 1, True),
    }
    extra = documents(spark, table).selectExpr("*", "1 AS node", "2 AS component_id", "3 AS id")
    kept = near_dedup.drop_near_duplicates(extra)
    assert kept.columns == extra.columns and kept.count() == 9
    assert near_dedup.near_duplicates(documents(spark, table).limit(0)).count() == 0


def test_parities_never_rule_out_a_link():
    random.seed(4)
    for _ in range(300):
        n = random.randint(1, 300)
        a = [random.getrandbits(64) for _ in range(n)]
        b = a[random.randint(0, n // 4) :] + [random.getrandbits(64) for _ in range(random.randint(0, n // 4))]
        x, y = (near_dedup.np.unique(near_dedup.np.array(s, near_dedup.np.uint64)) for s in (a, b))
        differ = sum(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(near_dedup.parities(x).tolist(), near_dedup.parities(y).tolist()))
        common = len(set(x.tolist()) & set(y.tolist()))
        assert differ <= len(x) + len(y) - 2 * common
        if 100 * common >= 75 * (len(x) + len(y) - common):
            assert differ <= len(x) + len(y) - 2 * -(-75 * (len(x) + len(y)) // 175)


def test_few_pairs_of_one_text_s_variants_meet(spark, monkeypatch):
    met = []
    pairs = near_dedup._prefix_pairs

    def counted(*args):
        found = pairs(*args)
        met.append(found.count())
        return found

    monkeypatch.setattr(near_dedup, "_prefix_pairs", counted)
    for n in (300, 600):
        random.seed(n)
        words = [f"w{i}" for i in range(5000)]
        base, table = random.choices(words, k=120), []
        for i in range(n):
            text = list(base)
            for _ in range(random.randint(1, 4)):
                text[random.randrange(120)] = random.choice(words)
            table.append((i, " ".join(text)))
        got = near_dedup.near_duplicates(documents(spark, table)).collect()
        want, _ = brute(table)
        # a pair at the threshold shares a cell with probability 0.995
        assert sum(r["component_id"] == want[r["id"]] for r in got) >= 0.98 * n
    # of 179,700 pairs of the larger table
    assert met[1] < 1_000


def test_links_are_followed_once(spark, monkeypatch):
    followed, found = [], []
    components, confirmed = near_dedup.connected_components, near_dedup.confirm

    def counted(links):
        followed.append(links.count())
        return components(links)

    def links_of(*args):
        found.append(near_dedup.materialise(confirmed(*args), "counted"))
        return found[-1]

    monkeypatch.setattr(near_dedup, "connected_components", counted)
    monkeypatch.setattr(near_dedup, "confirm", links_of)
    random.seed(5)
    words = [f"w{i}" for i in range(5000)]
    base, table = random.choices(words, k=120), []
    for i in range(300):
        text = list(base)
        for _ in range(random.randint(1, 3)):
            text[random.randrange(120)] = random.choice(words)
        table.append((i, " ".join(text)))
    near_dedup.near_duplicates(documents(spark, table)).count()
    assert len(followed) == 3 and sum(followed) <= sum(links.count() for links in found)
    # a link found later counts only where it joins two components
    assert sum(followed[1:]) < 300


def test_merged_labels(spark):
    random.seed(9)
    first, later = ([(random.randrange(80), random.randrange(80)) for _ in range(n)] for n in (30, 25))
    labels = spark.createDataFrame([(i, i, 7) for i in range(80)], "node long, label long, shared long")
    for links in (first, [], later):
        labels = near_dedup.merged(labels, spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["label"] for r in labels.collect()} == closure(range(80), first + later)
    assert labels.columns == ["node", "label", "shared"] and labels.filter("shared = 7").count() == 80
