"""URL filters: pattern rules behind an index on their rarest literal token.

Each rule has a regular expression and the literal tokens that every URL it fits must contain as whole tokens.
How often each of those tokens occurs is counted over all URLs; a rule is filed under its rarest token.  A URL
looks up its own tokens and runs only the regular expressions filed there.  Nothing is shuffled but the counts.
The rule list travels with the tasks; its size is that of the parameter.

Rules of the base list compare host suffix and path prefix, the longest fitting one wins.  Where none fits, the
pattern rules decide: ``block`` if one fits, else ``allow``.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no base rule and no pattern rule
(``allow``); repeated rows are judged each on their own; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base rules as (host, path, verdict).
BASE_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

# Pattern rules for all other URLs as (expression over host, path and rest, literal tokens).
PATTERNS = (
    (r"^[^?#]*/(?:ads?|banners?)/", ()),
    (r"[?&]utm_source=feed(?:[&#]|$)", ("utm_source", "feed")),
    (r"[?&]ref=x(?:[&#]|$)", ("ref", "x")),
    (r"[?&]page=[0-9]{3,}(?:[&#]|$)", ("page",)),
    (r"^blog\.[^/?#]*/[a-z]{2}/[0-9]+\.html(?:[?#]|$)", ("blog", "html")),
    (r"^m\.[^/?#]*/(?:fr|de)/", ("m",)),
    (r"^[^/?#]*/login(?:[/?#]|$)", ("login",)),
    (r"^[^/?#]*/cart/checkout(?:[/?#]|$)", ("cart", "checkout")),
)

_TOKEN = re.compile(r"[^0-9a-z_\x80-\U0010ffff]+")
_PARTS = re.compile(r"^(.*?)://([^/?#]*)([^?#]*)(.*)$", re.S)
_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """``name`` is set for base rules only.  ``tokens`` must stand in each fitting URL; none: always tried."""

    name: str | None
    pattern: str
    tokens: tuple[str, ...]
    verdict: str


def _whole_tokens(host: str, path: str) -> tuple[str, ...]:
    """Tokens that end inside the rule: those of the host, and of the path up to its last slash."""
    return tuple(sorted(set(_TOKEN.split(f"{host}{path[: path.rfind('/') + 1]}".translate(_LOWER))) - {""}))


def all_rules(base=BASE_RULES, patterns=PATTERNS) -> tuple[Rule, ...]:
    named = tuple(
        Rule(host + path, rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}", _whole_tokens(host, path), verdict)
        for host, path, verdict in base
    )
    return named + tuple(Rule(None, pattern, tokens, "block") for pattern, tokens in patterns)


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host with A-Z lowered, path, and what follows; all empty without ``://``."""
    parts = _PARTS.match(url) if url else None
    return (parts[2].translate(_LOWER), parts[3], parts[4]) if parts else ("", "", "")


def url_tokens(host: str, path: str, rest: str) -> set[str]:
    return set(_TOKEN.split(f"{host}{path}{rest}".translate(_LOWER)))


def token_counts(urls: DataFrame, url_col: str, rules: tuple[Rule, ...]) -> dict[str, int]:
    """URLs that contain each rule token; one entry per token of the rule list."""
    names = sorted({t for rule in rules for t in rule.tokens})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = dict.fromkeys(names, 0)
        for batch in batches:
            for url in batch.column(0).to_pylist():
                for token in url_tokens(*split_url(url)) & seen.keys():
                    seen[token] += 1
        yield pa.RecordBatch.from_pydict({"token": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    partial = urls.select(F.col(url_col)).mapInArrow(count, "token string, n long")
    return {r["token"]: r["n"] for r in partial.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def build_index(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by rarest token, ties by name; rules without a token are filed under the empty one."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=""), []).append(rule)
    return index


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, tried (regular expressions run)."""
    rules = all_rules() if rules is None else rules
    index = build_index(rules, token_counts(pages, url_col, rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filed = {t: [(re.compile(r.pattern), r) for r in found] for t, found in index.items()}
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path, rest = split_url(url)
                tried, best, blocked = 0, None, False
                for token in (url_tokens(host, path, rest) | {""}) & filed.keys() if host or path or rest else ():
                    for pattern, rule in filed[token]:
                        tried += 1
                        if not pattern.search(f"{host}{path}{rest if rule.name is None else ''}"):
                            continue
                        if rule.name is None:
                            blocked = True
                        elif best is None or (len(rule.name), rule.name) > (len(best.name), best.name):
                            best = rule
                verdict = best.verdict if best else "block" if blocked else "allow"
                out.append((host, path, best.name if best else None, verdict, tried))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string()] * 4 + [pa.int64()]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", "host", "path", "rule", "verdict", "tried"])

    schema = f"id {pages.schema[id_col].dataType.simpleString()}, host string, path string, rule string, verdict string, tried long"
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).mapInArrow(judge, schema)
