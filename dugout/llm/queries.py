"""Registered queries of the training-data operators, with the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import decontaminate, exact_dedup, hard_negatives, language_id, license_scan, near_dedup, packing, prefix_trie, projected_search, token_count, toxicity, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(table: str, sql: str | None = None):
    """Register a function of one whole table and the folder of all tables."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            folder = sf_dir.rstrip("/")
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")  # whole texts are long
            return build(tune(spark).read.parquet(f"{folder}/{table}.parquet"), folder)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


_TEMPLATES = ", ".join(
    f"('{label}', string_split('{text}', ' '))" for label, texts in license_scan.TEMPLATES.items() for text in texts
)
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM d),
x AS (SELECT doc_id, w, i FROM w, unnest(CASE WHEN list_contains(w, 'license') THEN range(1, len(w) + 1) ELSE [] END) u(i)),
p AS (
  SELECT doc_id, i - 1 AS pos, 'mit' AS label FROM x WHERE w[i] = 'mit' AND w[i + 1] = 'license'
  UNION ALL SELECT doc_id, i - 1, 'apache' FROM x WHERE w[i] = 'apache' AND w[i + 1] = 'license'
  UNION ALL SELECT doc_id, i - 1, 'gpl' FROM x WHERE w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license'),
b AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY doc_id),
tpl AS (SELECT label, list_distinct(tokens) AS tokens FROM (VALUES {_TEMPLATES}) v(label, tokens)),
lw AS (SELECT doc_id, n, regexp_extract_all(lower(line), '{_WORD}') AS lw FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS n FROM d)),
aw AS (SELECT doc_id, flatten(list(lw ORDER BY n)) AS aw FROM lw GROUP BY doc_id HAVING count(*) > 1),
br AS (SELECT doc_id, sum(len(lw)) OVER (PARTITION BY doc_id ORDER BY n)::BIGINT AS p FROM lw),
l AS (SELECT doc_id, lw AS block FROM lw WHERE len(lw) <= {2 * license_scan.AROUND}
      UNION ALL SELECT doc_id, lw[i + 1:i + {2 * license_scan.AROUND}] FROM lw, unnest(range(0, len(lw), {license_scan.AROUND})) u(i) WHERE len(lw) > {2 * license_scan.AROUND}
      UNION ALL SELECT doc_id, aw[greatest(p - {license_scan.AROUND - 1}, 1):p + {license_scan.AROUND}] FROM br JOIN aw USING (doc_id)),
s AS (SELECT doc_id, label, len(list_intersect(tokens, list_distinct(block))) / len(tokens) AS share FROM l, tpl
      WHERE len(list_intersect(tokens, list_distinct(block))) >= ceil(round(len(tokens) * {license_scan.THRESHOLD}, 9))),
m AS (SELECT doc_id, max(share) AS share FROM s GROUP BY doc_id),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT doc_id, label FROM p UNION ALL SELECT doc_id, label FROM s) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN a USING (doc_id)"""


@query("documents", OP1_SQL)
def op1_license_scan(documents: DataFrame, folder: str) -> DataFrame:
    return license_scan.scan_licenses(documents, around=license_scan.AROUND).withColumnRenamed("id", "doc_id")


def _op6_sql() -> str:
    rules = ", ".join(f"('{h}{p}', '{h}', '{p}', '{v}')" for h, p, v in url_filter.BASE_RULES)
    patterns = " OR ".join(f"regexp_matches(host || path || rest, '{p}')" for p, _ in url_filter.PATTERNS)
    return f"""
WITH c AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) END AS after FROM pages),
h AS (SELECT page_id, coalesce(translate(regexp_extract(after, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
       coalesce(regexp_extract(after, '^[^/?#]*([^?#]*)', 1), '') AS path,
       coalesce(regexp_extract(after, '^[^?#]*((?s:.*))$', 1), '') AS rest FROM c),
r(rule, rhost, rpath, verdict) AS (VALUES {rules}),
f AS (SELECT page_id, arg_max(rule, (length(rule), rule)) AS rule, arg_max(verdict, (length(rule), rule)) AS verdict
      FROM h, r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(verdict, CASE WHEN {patterns} THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN f USING (page_id)"""


@query("pages", _op6_sql())
def op6_url_filter(pages: DataFrame, folder: str) -> DataFrame:
    return url_filter.judge_urls(pages).withColumnRenamed("id", "page_id").drop("tried")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, (count(*) OVER g)::BIGINT AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""


@query("documents", OP9_SQL)
def op9_exact_dedup(documents: DataFrame, folder: str) -> DataFrame:
    found = exact_dedup.exact_copies(documents)
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS original FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to FROM m"""


@query("pages", OP3_SQL)
def op3_warc_revisits(pages: DataFrame, folder: str) -> DataFrame:
    return warc.archive_pages(pages).drop("path", "place")


@query("documents")
def op4_token_counts(documents: DataFrame, folder: str) -> DataFrame:
    import public_tokenizers

    counted = token_count.count_tokens(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumnRenamed("id", "doc_id")


@query("documents")
def op5_square_packing(documents: DataFrame, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(documents, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (min(a.n) + min(b.n) - count(*))),
r AS (SELECT doc_id AS root, doc_id AS node FROM s UNION SELECT r.root, p.b FROM r JOIN p ON r.node = p.a),
c AS (SELECT root, min(node) AS component_id FROM r GROUP BY root)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c ON s.doc_id = c.root"""


@query("documents", OP2_SQL)
def op2_near_dedup(documents: DataFrame, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(documents).withColumnRenamed("id", "doc_id")


@query("documents")
def op10_language_id(documents: DataFrame, folder: str) -> DataFrame:
    return language_id.predict_languages(documents).withColumnRenamed("id", "doc_id")


@query("documents")
def op8_toxicity(documents: DataFrame, folder: str) -> DataFrame:
    labels = documents.sparkSession.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.score_toxicity(documents, labels).withColumnRenamed("id", "doc_id")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("documents")
def op7_benchmark_leaks(documents: DataFrame, folder: str) -> DataFrame:
    benchmark = documents.sparkSession.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.find_leaks(documents, benchmark).withColumnRenamed("id", "doc_id")


@query("embeddings")
def op11_projected_neighbours(embeddings: DataFrame, folder: str) -> DataFrame:
    found = projected_search.nearest(embeddings, is_query=F.col("vec_id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


OP13_SQL = f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.r = b.r AS own, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0),
p AS (SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same AND NOT own QUALIFY place <= {hard_negatives.POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY p.r, place ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (r, anchor_id)
WHERE NOT same AND {hard_negatives.WINDOW[0]} * positive_score <= 100 * score AND 100 * score <= {hard_negatives.WINDOW[1]} * positive_score
QUALIFY rank <= {hard_negatives.NEGATIVES}"""


@query("embeddings", OP13_SQL)
def op13_hard_negatives(embeddings: DataFrame, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(embeddings, label, F.col("vec_id") % 100 == 0)


_CRC = (
    "xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''), "
    "lambda ch: list_transform(range(8), lambda i: (ascii(ch) >> i) & 1)))), "
    "lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
)
OP12_SQL = f"""
WITH t AS (SELECT conv_id, sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS e, length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, t.pos, e, chars FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), e, chars
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN c b ON b.conv_id = c.base),
l AS (SELECT c.conv_id, coalesce(list(e ORDER BY pos) FILTER (e IS NOT NULL), []) AS e, coalesce(list(chars ORDER BY pos) FILTER (e IS NOT NULL), []) AS chars
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
x AS (SELECT conv_id, d, array_to_string(e[1:d], '') AS k, CASE WHEN d > 0 THEN array_to_string(e[1:d - 1], '') END AS up, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars,
    len(e) = d AS ends FROM l, unnest(range(len(e) + 1)) u(d)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, min(up) AS up, min(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM x GROUP BY k, d),
f AS (SELECT up, count(*) AS n_children FROM n WHERE d > 0 GROUP BY up),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN f ON f.up = n.k),
s AS (SELECT m.k, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((b.n - 1) * b.chars)::BIGINT AS saved_tokens
  FROM m JOIN m b ON b.d >= m.d AND starts_with(b.k, m.k) GROUP BY m.k)
SELECT m.conv_id, m.d AS depth, p.conv_id AS parent_conv_id, m.n AS n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
FROM m JOIN s USING (k) LEFT JOIN m p ON p.k = m.up"""


@query("conversations", OP12_SQL)
def op12_prefix_trie(conversations: DataFrame, folder: str) -> DataFrame:
    ident = F.col("conv_id")
    turns, runs = prefix_trie.order_turns(conversations)
    opening = F.crc32(ident.cast("string").cast("binary")) % 6
    return prefix_trie.trie_nodes(*prefix_trie.splice_openings(turns, runs, ident - ident % 100, opening, 5))
