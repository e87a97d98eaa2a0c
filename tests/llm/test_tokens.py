"""Packing and token counts against the tokenizers."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from support import documents
from tokenizers import Tokenizer, models, pre_tokenizers

from dugout.llm import packing, token_count

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "Foo bar, BAZ. x!!", "in%%% of&&& don't 'tis it's", "foo<|endoftext|> bar<|startoftext|>", "a\x1cb c\x85d", "İstanbul K ﬁ. Straße.",
    "é e\u0301 \u212b", "12 3.4 5,6", "日本語 text 🙂🙂", "tab\tnew\nline\r\n\r\n  end ", "word " * 9_000, "x" * 30_000, "a  b   c", "▁x ▁ y",
]


def test_pieces_are_whole(spark):
    table = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (99, "one two three " * 700)]
    got = packing.pack(documents(spark, table).selectExpr("*", "1 AS start", "2 AS length"), WORDS).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    texts = dict(table)
    for doc in {r["id"] for r in got}:
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r for r in got if r["id"] == doc), key=lambda r: r["start"])
        copies = [t[0] for t in table].count(doc)
        assert sum(r["length"] for r in pieces) == copies * len(ids) and {r["doc_tokens"] for r in pieces} == {len(ids)}
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        if copies == 1:
            assert [r["start"] for r in pieces] == np.cumsum([0, *[r["length"] for r in pieces][:-1]]).tolist()
    assert {r["id"] for r in got} == set(texts)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for members in sequences.values():
        members.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in members] == np.cumsum([0, *[r["length"] for r in members][:-1]]).tolist()
        total = sum(r["length"] for r in members)
        assert total <= 2048 and total & (total - 1) == 0 and {r["sequence_length"] for r in members} == {total}


def test_packing_an_empty_table(spark):
    assert packing.pack(documents(spark, []).limit(0), WORDS).count() == 0


def square_sum(packer):
    return sum(c * c for c in packer.counts[1 : packer.window])


def test_the_level_with_the_smallest_sum_of_squares_is_taken():
    random = np.random.default_rng(0)
    packer = packing.SquarePacker(16)
    for doc in range(300):
        size = int(random.integers(1, 16))
        before = packer.counts.copy()

        def after(level):
            counts = before.copy()
            if level:
                counts[level] -= 1
            if level + size < 16:
                counts[level + size] += 1
            return sum(c * c for c in counts[1:16])

        best = min(after(level) for level in range(16 - size + 1) if level == 0 or before[level] > 0)
        list(packer.add(doc, b"\0\0\0\0" * size))
        assert square_sum(packer) == best


def test_open_windows_are_bounded():
    packer = packing.SquarePacker(64, open_limit=5)
    done = [c for doc in range(100) for c in packer.add(doc, b"\0\0\0\0" * (1 + doc % 63))] + list(packer.finish())
    assert sum(len(p[2]) for p, *_ in done) == 4 * sum(1 + d % 63 for d in range(100)) and not packer.n_open


@pytest.fixture(scope="module")
def unigram():
    vocabulary = token_count.read_vocabulary(PIECES)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    fallback = [(model.id_to_piece(i), -1e12) for i in range(model.get_piece_size()) if model.is_byte(i)]
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary, *fallback], unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", True)
    return tokenizer


def test_counts_are_those_of_the_tokenizer(spark, unigram):
    table = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)]
    got = {r["id"]: r for r in token_count.count_tokens(documents(spark, table).selectExpr("*", "1 AS n_tokens"), PIECES).collect()}
    for i, text in table:
        assert got[i]["n_tokens"] == len(unigram.encode(text or "", add_special_tokens=False).ids), text
    assert got[0]["n_words"] == 0 and got[0]["score"] == 0
    assert token_count.count_tokens(documents(spark, []).limit(0), PIECES).count() == 0


def test_ties_and_scores():
    counter = token_count.WordCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -1.5), ("aba", -3.0)])
    assert counter("ab") == (1, -2.0)  # the longer piece is met first
    assert counter("aba") == (2, -2.5)
    assert counter("") == (0, 0.0)
    assert counter("é")[0] == 2


def test_cache_limit_changes_nothing():
    vocabulary = token_count.read_vocabulary(PIECES)
    small, large = token_count.TextCounter(vocabulary, 3), token_count.TextCounter(vocabulary)
    tokens = packing.ChunkTokenizer(WORDS, 3), packing.ChunkTokenizer(WORDS)
    for text in [t for t in TEXTS if t] * 2:
        assert small(text) == large(text) and tokens[0](text) == tokens[1](text)
