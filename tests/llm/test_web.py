"""Archives and URL rules on small tables."""

import gzip

from pyspark.sql import types as T

from dugout.llm import tiles, url_filter, warc
from dugout.session import scratch_path

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def test_archive_round_trip(spark):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "é\r\n\r\nx" * 300
    rows = [(1, "http://a.example/x", tricky), (2, None, tricky), (7, "http://b.example/\r\nX: y", tricky), (None, "http://c.example/", tricky),
            (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (8, "u", "z" * 2_000_000), (8, "u", "z" * 2_000_000)]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS path", "2 AS refers_to").repartition(3)
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_pages(pages).collect())
    size = len(tricky.encode())
    assert got == [
        (0, size, "revisit", 7), (1, size, "revisit", 7), (2, size, "revisit", 7), (3, 0, "response", None), (4, 0, "response", None),
        (5, 5, "response", None), (6, 5, "response", None), (7, size, "response", None), (8, 2_000_000, "response", None), (8, 2_000_000, "response", None),
    ]
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_payloads_survive(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 200) for i in range(50)], PAGES)
    raw, clean = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    warc.write_pages(pages, raw)
    warc.deduplicate(spark, raw, clean)
    found = {}
    for row in spark.read.format("binaryFile").load(clean).collect():
        assert gzip.decompress(row["content"]).startswith(b"WARC/1.1\r\n")
        for head, block in warc.records_in(row["content"]):
            found[warc.page_of(head["warc-record-id"])] = warc.http_parts(block)[1].decode()
            assert head["warc-target-uri"].startswith("http://h/")
    assert found == {i: f"page {i} " * 200 for i in range(50)}


def test_groups_of_files_give_the_same_archives(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i % 40} " * 300) for i in range(200)], PAGES).repartition(8)
    raw = scratch_path(spark, "raw")
    warc.write_pages(pages, raw)
    found = []
    for at_once in (10**6, 30):
        clean = scratch_path(spark, "clean")
        warc.deduplicate(spark, raw, clean, at_once=at_once)
        found.append(sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.read_headers(spark, clean).collect()))
    assert found[0] == found[1] and [r[1:] for r in found[0]] == [("revisit", 160 + i % 40) if i < 160 else ("response", None) for i in range(200)]


def test_pages_of_all_sizes_share_no_file(spark):
    sizes = [(1, 10), (2, 70_000), (3, 70_000), (4, 64 << 20), (5, 2 << 20), (6, 100)]
    pages = spark.createDataFrame([(i, "http://h/", "x") for i, _ in sizes], PAGES).selectExpr("page_id", "url", "page_id AS k").repartition(1)
    length = "CASE page_id " + " ".join(f"WHEN {i} THEN {n}" for i, n in sizes) + " END"
    pages = pages.selectExpr("page_id", "url", f"repeat(chr(cast(96 + page_id AS int)), {length}) AS html")
    raw = scratch_path(spark, "raw")
    warc.write_pages(pages, raw)
    with tiles.arrow_limits(spark, 1):
        files = {}
        for r in warc.read_headers(spark, raw).collect():
            files.setdefault(r["path"], set()).add((r["page_id"], r["payload_bytes"]))
    assert sorted(map(sorted, files.values())) == [[(1, 10), (6, 100)], [(2, 70_000), (3, 70_000)], [(4, 64 << 20)], [(5, 2 << 20)]]


def brute(rules, url):
    host, path, rest = url_filter.split_url(url)
    import re

    named = [r for r in rules if r.name and re.search(r.pattern, host + path)]
    if named:
        best = max(named, key=lambda r: (len(r.name), r.name))
        return best.name, best.verdict
    fits = (host or path or rest) and any(re.search(r.pattern, host + path + rest) for r in rules if not r.name)
    return None, "block" if fits else "allow"


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://example.org/es/", "http://WWW.Example.ORG/en/12?x", "https://example.org/en/2", "http://notexample.org/en/1",
            "http://a.com/fr/x", "http://a.com/de", "http://a.com/de/", "http://com/de/#", "http://a.org?q", "http://m.a.net/fr/1?utm_source=feed", "x://y.net/cart/checkout",
            "x://y.net/a?page=2&ref=x", "x://y.net/a/ads/1", "http://y.net/" + "p/" * 50_000, "http://é.example.org/es/é", "http://y.net/a?page=1234", "http://y.net/a?page=1234"]
    rules = url_filter.all_rules()
    pages = spark.createDataFrame([(i if i else None, u, "") for i, u in enumerate(urls)], PAGES).selectExpr("*", "1 AS host", "2 AS rule").repartition(2)
    got = {r["id"]: r for r in url_filter.judge_urls(pages).collect()}
    for i, url in enumerate(urls):
        row = got[i if i else None]
        assert (row["rule"], row["verdict"]) == brute(rules, url) and (row["host"], row["path"]) == url_filter.split_url(url)[:2]
    assert got[1]["tried"] == 0 and max(r["tried"] for r in got.values()) < len(rules)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_rules_are_filed_under_the_rarest_token():
    rules = url_filter.all_rules(patterns=((r"[?&]common=rare(?:&|$)", ("common", "rare")),))
    index = url_filter.build_index(rules, {"common": 9, "rare": 1, "com": 5, "fr": 2})
    assert rules[-1] in index["rare"] and "common" not in index
    assert [r.name for r in index["fr"]] == ["com/fr/"]
