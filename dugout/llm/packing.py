"""Token packing with the sum-of-squares rule.

Each task packs the documents it reads, one after the other.  A document is tokenised, closed with an end id
and cut into full windows; the remainder goes to an open window of the fill level (or to a new window) for which
the sum of the squared numbers of open windows per level becomes smallest.  The level array has one counter per
fill.  At the end of a task, or when ``OPEN_LIMIT`` windows are open, the open windows are cut and joined into
full ones; what is left over is cut at powers of two, which need no padding.

Nothing is shuffled: a task holds one batch and at most ``OPEN_LIMIT`` windows.  Sequence numbers are built from
the partition number, and a repeated task reads the same rows in the same order, so they are stable.

Defined cases: null text counts as empty (only the end id); a null id is carried along; repeated rows are packed
as documents of their own; an empty table gives no piece; other columns are not read.
"""

from __future__ import annotations

import functools
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
OPEN_LIMIT = 4096
CACHED_WORDS = 700_000

# ``str.split`` also cuts at these, which the tokenizer does not take for white space
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_CHUNK = re.compile(r"[^ \t\n\r\x0b\x0c]+")


class ChunkTokenizer:
    """Ids of a text as little-endian 32-bit integers, looked up by chunk between white space.

    The tokenizer never joins across white space, so the ids of a text are those of its chunks in a row.  Letters
    with signs behind them are two of its words, and case does not matter, so such chunks are put together from what
    is known of both.  ``limit`` bounds the chunks remembered by one worker.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.limit, self.known = Tokenizer.from_file(path), limit, {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith("</w>")]] = True

    def __call__(self, text: str) -> bytes:
        chunks = _CHUNK.findall(text) if _NOT_SPACE.search(text) else text.split()
        found = list(map(self.known.get, chunks))
        if None in found:
            if len(self.known) > self.limit:
                self.known.clear()
            missing = {c for c, ids in zip(chunks, found) if ids is None}
            new = self._encode(missing)
            self.known.update(new)
            found = [new[c] if ids is None else ids for c, ids in zip(chunks, found)]
        return b"".join(found)

    def _each(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _encode(self, missing: set[str]) -> dict[str, bytes]:
        letters: dict[str, tuple[str, str]] = {}
        for c in missing:
            body = c.rstrip(string.punctuation)
            if body.isalpha():
                letters[c] = (body.lower() if body.isascii() else body, c[len(body) :])
        tails = {t for _, t in letters.values()}
        others = [c for c in missing if c not in letters] + [t for t in tails if t not in self.known and t not in missing]
        new = dict(zip(others, self._each(others)))
        words = list({w for w, _ in letters.values() if w not in self.known})
        coded = self._words(words)
        self.known.update(coded)
        for c, (word, tail) in letters.items():
            new[c] = self.known[word] + (new[tail] if tail in new else self.known[tail])
        return new

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of letters, coded as one text; each ends with a piece that closes a word."""
        if not words:
            return {}
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(ends) != len(words):  # a letter whose lower case is not a letter alone
            return dict(zip(words, self._each(words)))
        raw = ids.tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, [0, *ends], ends)}


@functools.cache
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One per worker process, so that later tasks find what earlier ones have looked up."""
    return ChunkTokenizer(path)


class SquarePacker:
    """Windows open at each fill level; yields (piece, sequence, offset, sequence length) when windows close.

    A piece is (document, start, ids as bytes, tokens of the document).
    """

    def __init__(self, window: int = WINDOW, first: int = 0, open_limit: int = OPEN_LIMIT):
        self.window, self.next, self.open_limit = window, first, open_limit
        # the count of full windows stands for "no window is left open there"
        self.counts = np.zeros(window + 1)
        self.counts[window] = -0.5
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def best_level(self, size: int) -> int:
        """Fill level whose window takes ``size`` more at the smallest sum of squares; 0 is a new window."""
        here, there = self.counts[1 : self.window - size + 1], self.counts[1 + size : self.window + 1]
        if not len(here):
            return 0
        change = np.where(here > 0, 2 * (there - here) + 2, np.inf)[::-1]
        at = int(change.argmin())
        return self.window - size - at if change[at] <= 2 * self.counts[size] + 1 else 0

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // 4
        full = total - total % self.window
        for start in range(0, full, self.window):
            yield from self._close([(doc, start, ids[4 * start : 4 * (start + self.window)], total)], self.window)
        size = total - full
        if not size:
            return
        level = self.best_level(size)
        pieces = self.open[level].pop() if level else []
        pieces.append((doc, full, ids[4 * full :], total))
        if level:
            self.counts[level] -= 1
            self.n_open -= 1
        if level + size == self.window:
            yield from self._close(pieces, self.window)
            return
        self.counts[level + size] += 1
        self.open.setdefault(level + size, []).append(pieces)
        self.n_open += 1
        if self.n_open >= self.open_limit:
            yield from self.finish()

    def finish(self) -> Iterator[tuple]:
        """Close all open windows: full ones as long as there are tokens, then lengths that are powers of two."""
        pieces = [p for level in sorted(self.open, reverse=True) for window in self.open[level] for p in window]
        left = sum(len(p[2]) for p in pieces) // 4
        self.open.clear()
        self.counts[: self.window] = 0
        self.n_open = 0
        pieces.reverse()
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            taken, room = [], size
            while room:
                doc, start, ids, total = pieces.pop()
                n = min(len(ids) // 4, room)
                taken.append((doc, start, ids[: 4 * n], total))
                if len(ids) > 4 * n:
                    pieces.append((doc, start + n, ids[4 * n :], total))
                room -= n
            yield from self._close(taken, size)
            left -= size

    def _close(self, pieces: list, size: int) -> Iterator[tuple]:
        offset = 0
        for piece in pieces:
            yield piece, self.next, offset, size
            offset += len(piece[2]) // 4
        self.next += 1


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    open_limit: int = OPEN_LIMIT,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    Sequences shorter than the window have a power of two as length.  ``window`` itself should be one.
    """
    end = np.array([end_id], "<u4").tobytes()
    id_field = docs.select(F.col(id_col).alias("id")).schema["id"].dataType
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = chunk_tokenizer(tokenizer_path)
        packer = SquarePacker(window, TaskContext.get().partitionId() << 40, open_limit)
        kind = None

        def batch_of(closed: list) -> pa.RecordBatch:
            rows = [
                (doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, size)
                for (doc, start, ids, total), sequence, offset, size in closed
            ]
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(list(c), kind if i == 0 else pa.int64()) for i, c in enumerate(columns)], names)

        for batch in batches:
            kind = batch.schema.field(0).type
            closed: list = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                closed += packer.add(doc, tokens(text.as_py() or "") + end)
                if len(closed) >= 4096:
                    yield batch_of(closed)
                    closed = []
            if closed:
                yield batch_of(closed)
        rest = list(packer.finish())
        if rest:
            yield batch_of(rest)

    schema = f"id {id_field.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
