"""Prefix trie against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dugout.llm import prefix_trie as trie
from dugout.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth int, segment string"


def rebuilt(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [t[1:] for t in sorted(found)] for c, found in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:]
    return out


def brute(rows):
    nodes = {}
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append((c, d == len(turns)))
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        childless = [k for k in below if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in below)]
        ends = ",".join(str(c) for c in sorted(c for c, e in members if e))
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in below if k)
        parent = min(c for c, _ in nodes[key[:-1]]) if key else None
        children = sum(len(k) == len(key) + 1 for k in below)
        out.append((min(c for c, _ in members), len(key), parent, len(members), children, len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, tmp_path, rows):
    folder = f"{tmp_path}/{random.random()}"
    spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    got = QUERIES["op12_prefix_trie"](spark, folder).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, tmp_path, seed):
    random.seed(seed)
    rows = []
    for c in random.sample(range(0, 420), 90):
        for turn in range(random.randint(1, 9)):
            rows.append((c, turn, random.choice(["user", "assistant"]), random.choice(["a", "bé", "ccc"][: seed])))
    assert run(spark, tmp_path, rows) == brute(rows)


def test_copies_of_one_long_conversation(spark, tmp_path):
    rows = [(c, turn, "user", f"turn {turn}") for c in range(0, 40) for turn in range(70)]
    rows += [(100 + c, turn, "user", f"turn {turn if turn < 6 * c else -turn}") for c in range(8) for turn in range(50)]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_edge_cases(spark, tmp_path):
    long = "x" * 300_000
    rows = [
        (7, None, "user", "first"), (7, 1, None, None), (7, 1, "", ""), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (None, 1, "user", "no id"),
        (0, 5, "user", long), (0, 2, "assistant", "b"), (1, 0, "user", "short"), (2, 0, "user", "short"), (-5, 0, "user", "n"), (-105, 0, "user", "n"), (205, 3, None, None),
    ]
    assert run(spark, tmp_path, rows) == brute(rows)
    assert run(spark, tmp_path, []) == []
    assert run(spark, tmp_path, [(None, 1, "user", "x")]) == []
    assert run(spark, tmp_path, [(5, 0, "user", "gone")]) == brute([(5, 0, "user", "gone")])


def test_a_full_sketch_changes_nothing(spark):
    random.seed(9)
    rows = [(c, t, "user", random.choice("abc")) for c in range(60) for t in range(8)] + [(500 + c, t, "user", f"{c} {t}") for c in range(60) for t in range(8)]
    turns, runs = trie.order_turns(spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA))
    convs, spliced = trie.splice_openings(turns, runs, F.col("conv_id"), F.lit(0), 0)
    results = [sorted(tuple(r) for r in trie.trie_nodes(convs, spliced, rows=k, max_bits=bits).collect() if r[1]) for k, bits in ((4, 23), (1, 4))]
    assert results[0] == results[1]
    prefixes = trie.digest_prefixes(spliced)
    true = {(r["a"], r["b"]) for r in prefixes.groupBy("a", "b").count().filter("count = 1").collect()}
    marked = trie.screen(prefixes).collect()
    assert all((r["a"], r["b"]) in true for r in marked if r["alone"])
    assert sum(r["alone"] for r in marked) >= 0.8 * len(true)
