"""Registered queries against SQL or what is known of their results."""

import pytest

from check import compare, connect
from dugout.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    ok, text, _ = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert ok, text


def test_each_number_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_license_scan", "op9_exact_dedup"])
def test_main_path_is_native(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if w in plan]


def test_language_held_out(spark):
    got = QUERIES["op10_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(truth, "doc_id").collect()
    assert rows and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_toxicity_held_out(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    got = QUERIES["op8_toxicity"](spark, folder)
    rows = got.filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    hits = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert hits >= 0.9 * sum(r["predicted"] for r in rows) and hits >= 0.5 * sum(r["toxic"] for r in rows)
