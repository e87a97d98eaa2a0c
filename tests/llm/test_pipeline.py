"""Every stage of the pipeline against brute force on what the stage before kept."""

import re

import corpus_pipeline
import numpy as np
import public_tokenizers
from test_near import brute
from tokenizers import Tokenizer

from dugout.llm import decontaminate
from dugout.session import materialise

SF_DIR = "/root/testdata/sf0.001"


def expected(name, rows, items):
    """Ids that stay, from {id: text}."""
    if name == "language":
        return {i for i, t in rows.items() if any(c.isalpha() for c in t or "")}
    if name == "exact_dedup":
        first = {}
        for i in sorted(rows):
            first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i] or ""), i)
        return set(first.values())
    if name == "near_dedup":
        label, _ = brute(list(rows.items()))
        return {i for i in rows if label[i] == i}
    words = {i: [w for w in map(decontaminate.normal, (t or "").split()) if w] for i, t in rows.items()}
    whole = [" ".join(w for w in map(decontaminate.normal, t.split()) if w) for t in items]
    return {i for i, w in words.items() if not any(f" {t} " in f" {' '.join(w)} " for t in whole)}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns = docs.columns
    odd = spark.createDataFrame([(9001, None), (9002, "123 456"), (9003, "The only text.")], "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontaminate", "pack"]
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = materialise(stage(spark, docs, SF_DIR), f"test-{name}")
        assert docs.columns == columns
        assert {r["doc_id"] for r in docs.collect()} == expected(name, rows, items), name
        sizes.append(docs.count())
    assert all(a > b for a, b in zip(sizes, sizes[1:]))
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sum(r["length"] for r in pieces) == total and {r["doc_id"] for r in pieces} == set(texts)
    assert np.all([r["offset"] + r["length"] <= 2048 for r in pieces])


def test_run_and_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
