"""Benchmark decontamination by latent semantic retrieval.

Texts are read once and stored as term numbers of the benchmark's vocabulary.  Document frequencies of the terms
are counted over all documents.  A randomised SVD of the TF-IDF matrix of the passages of all documents (two
distributed products with a thin matrix) gives a latent space of ``RANK`` dimensions.  Every window of every document and
every benchmark item belongs to it, the items being one stated query set; items of more than ``WINDOW`` words are cut into
passages of that length which hold all their words, so an item may have any length.  A window is a candidate for a passage
when it holds at least ``WEIGHT`` of the passage's inverse document frequencies (of the part that a window can hold), their
cosine is at least ``COSINE`` and the window's projection on the passage is at least ``HELD`` of it.  The weight is bounded
first, for every window and item, so that few windows need to be projected.  A candidate is a leak when the longest common subsequence of the item's words and the words around the window
covers ``SURE`` of the item, or ``LIKELY`` of it together with ``ANSWER`` of its last sentence (a paraphrase).

Only the benchmark, its vocabulary and matrices of vocabulary times rank travel with the tasks; the benchmark is
the bounded query set of the operator.

Defined cases: null and empty texts and items match nothing; an item repeated under another id is reported for
each id; null document ids are checked like others; repeated rows are checked each on their own; without
documents or items the result is empty; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

RANK = 96
WINDOW = 32
STRIDE = 8
SHORT = 24
COSINE = 0.7
HELD = 0.6
WEIGHT = 0.4
SHORT_EASE = 0.7
SURE = 0.7
LIKELY = 0.5
ANSWER = 0.75
CACHED_WORDS = 300_000
#: Words, strides and items that are worked on at once.
_WORDS, _STRIDES, _ITEMS = 1 << 16, 1 << 12, 256
#: The greatest bound of a term's weight, so that those of ``STRIDE`` terms add up in a byte.
_LEVELS = 255 // STRIDE
_STRIP = ".,;:!?\"'()[]{}<>«»„“”|*#$%&-_"
_SENTENCE = re.compile(r"[.!?]\s+")


@dataclass
class Items:
    """The benchmark as term numbers; number 0 is any other word."""

    ids: list
    terms: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[str, int]


def normal(word: str) -> str:
    return word.strip(_STRIP).lower()


def read_items(benchmark: DataFrame, id_col: str, text_col: str) -> Items:
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL").collect()
    vocabulary: dict[str, int] = {}

    def numbers(text: str) -> np.ndarray:
        words = [w for w in map(normal, text.split()) if w]
        return np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int64)

    ids, terms, answers = [], [], []
    for row in sorted(rows, key=lambda r: (r["id"] is None, r["id"], r["text"])):
        found = numbers(row["text"])
        if len(found):
            parts = [p for p in _SENTENCE.split(row["text"].strip()) if p.split()]
            ids.append(row["id"])
            terms.append(found)
            answers.append(numbers(parts[-1]))
    return Items(ids, terms, answers, vocabulary)


def term_numbers(docs: DataFrame, vocabulary: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """(id, terms): 32-bit term numbers of all words of a text in one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            out = []
            for text in batch.column(1):
                words = (text.as_py() or "").split()
                new = set(words).difference(known)
                if new:
                    if len(known) > CACHED_WORDS:
                        known.clear()
                        new = set(words)
                    for w in new:
                        plain = normal(w)
                        known[w] = vocabulary.get(plain, 0) if plain else -1
                found = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                out.append(found[found >= 0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "terms"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, terms binary")


def document_frequencies(stored: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and their number; term 0 counts all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            for terms in batch.column(0):
                found = np.unique(np.frombuffer(terms.as_py(), np.int32))
                seen[found[found > 0]] += 1
                seen[0] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(seen)], ["term", "n"])

    total = np.zeros(size + 1, np.int64)
    partial = stored.select("terms").mapInArrow(run, "term long, n long").filter("n > 0")
    for row in partial.groupBy("term").agg(F.sum("n").alias("n")).collect():
        total[row["term"]] = row["n"]
    return total, int(total[0])


def _group_sums(table: np.ndarray, index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the table's rows ``index`` by groups that start at ``first``; groups are cut into lines of ``WINDOW`` rows, summed side by side."""
    sizes = np.diff(np.append(first, len(index)))
    lines = -(-sizes // WINDOW)
    line_of = np.cumsum(lines) - lines
    starts = np.repeat(first - line_of * WINDOW, lines) + np.arange(lines.sum()) * WINDOW
    filled = np.minimum(np.repeat(first + sizes, lines) - starts, WINDOW)
    # longest lines first, so that those with a k-th row are the first ones
    order = np.argsort(-filled, kind="stable")
    starts, longer = starts[order], np.searchsorted(-filled[order], -np.arange(WINDOW))
    sums = table[index[starts]]
    for k, n in enumerate(longer[1:].tolist(), 1):
        sums[:n] += table[index[starts[:n] + k]]
    back = np.empty_like(sums)
    back[order] = sums
    return np.add.reduceat(back, line_of, axis=0)


def _projected(batches: Iterator[pa.RecordBatch], idf: np.ndarray, thin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, passage of each, A thin, norms of the passages) for about ``_WORDS`` words at a time; the rows of A have length one."""
    weighted = (idf[:, None] * thin).astype(np.float32)

    def texts() -> Iterator[list[np.ndarray]]:
        held, words = [], 0
        for batch in batches:
            for value in batch.column(0):
                terms = np.frombuffer(value.as_py(), np.int32)
                # a long text goes in pieces of whole passages
                for at in range(0, len(terms), _WORDS):
                    held.append(terms[at : at + _WORDS])
                    words += len(held[-1])
                    if words >= _WORDS:
                        yield held
                        held, words = [], 0
        if held:
            yield held

    for values in texts():
        sizes = np.array([len(v) for v in values])
        passages = -(-sizes // WINDOW)
        shift = (np.cumsum(passages) - passages) * WINDOW - (np.cumsum(sizes) - sizes)
        terms = np.concatenate(values)
        passage = (np.arange(len(terms)) + np.repeat(shift, sizes)) // WINDOW
        terms, passage = terms[terms > 0], passage[terms > 0]
        if len(terms):
            first = np.flatnonzero(np.diff(passage, prepend=-1))
            norms = np.sqrt(np.add.reduceat(idf[terms] ** 2, first)).clip(min=1e-9).astype(np.float32)
            rows = _group_sums(weighted, terms, first) / norms[:, None]
            yield terms, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(terms)))), rows, norms


def gram_product(stored: DataFrame, idf: np.ndarray, thin: np.ndarray) -> np.ndarray:
    """A'(A thin) for the TF-IDF matrix A of consecutive passages; partial sums per task, summed by term."""
    size, width = thin.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, width))
        for terms, passage, rows, norms in _projected(batches, idf, thin):
            # small numbers are sorted by digits
            order = np.argsort(terms.astype(np.uint16) if size <= 1 << 16 else terms, kind="stable")
            ordered = terms[order]
            first = np.flatnonzero(np.diff(ordered, prepend=-1))
            held = ordered[first]
            total[held] += idf[held, None] * _group_sums(rows / norms[:, None], passage[order], first)
        filled = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(filled), *[pa.array(total[filled, j]) for j in range(width)]], ["term", *[f"y{j}" for j in range(width)]])

    return _summed(stored, run, "term", size, width)


def projected_gram(stored: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """(A basis)'(A basis), which is basis' A'A basis, for the same matrix."""
    width = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for *_, rows, _ in _projected(batches, idf, basis):
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), *[pa.array(total[:, j]) for j in range(width)]], ["row", *[f"y{j}" for j in range(width)]])

    return _summed(stored, run, "row", width, width)


def _summed(stored: DataFrame, run, key: str, size: int, width: int) -> np.ndarray:
    """The sum of the partial matrices of all tasks."""
    schema = f"{key} long, " + ", ".join(f"y{j} double" for j in range(width))
    sums = stored.select("terms").mapInArrow(run, schema).groupBy(key).agg(*[F.sum(f"y{j}").alias(f"y{j}") for j in range(width)])
    out = np.zeros((size, width))
    for row in sums.collect():
        out[row[key]] = row[1:]
    return out


def latent_space(stored: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Term vectors (terms by rank), idf included, from a randomised SVD with one power step over all documents."""
    rank = min(rank, max(len(idf) - 1, 1))
    start = np.random.default_rng(5).standard_normal((len(idf), rank + 8 if len(idf) > rank + 8 else rank))
    basis, _ = np.linalg.qr(gram_product(stored, idf, start))
    _, vectors = np.linalg.eigh(projected_gram(stored, idf, basis))
    return (idf[:, None] * (basis @ vectors[:, ::-1][:, :rank])).astype(np.float32)


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each term in the first sequence."""
    full = (1 << size) - 1
    row = full
    for w in words:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def place_masks(terms: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, t in enumerate(terms.tolist()):
        masks[t] = masks.get(t, 0) | 1 << i
    return masks


def passage_starts(size: int) -> list[int]:
    """First words of the passages of an item: itself up to ``WINDOW`` words, else evenly placed ones that hold every word."""
    n = -(-size // WINDOW)
    return [i * (size - WINDOW) // (n - 1) for i in range(n)] if n > 1 else [0]


@dataclass
class _Block:
    """Some items, short ones first: the terms that they hold, numbered from 1, and the weights of these in each item."""

    items: np.ndarray
    number: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray


class Searcher:
    """Leaks of documents given as term numbers.

    Windows are sums of ``STRIDE`` words, one from each sum on.  Items of up to ``SHORT`` words are compared with
    windows of two sums, longer ones with windows of four.  A few words more or less weigh more in a short item, so
    ``SHORT_EASE`` lowers its limits for the cosine and the projection.  An item of more than ``WINDOW`` words is
    searched by its passages, whatever its length; what is near one of them is verified on the whole item.

    The weight that a window holds of each item is first added up in bytes, rounded up, for all windows; the
    windows that may hold enough are weighed exactly and then projected.
    """

    def __init__(self, items: Items, space: np.ndarray, idf: np.ndarray, cosine: float = COSINE, sure: float = SURE, likely: float = LIKELY, answer: float = ANSWER):
        self.items, self.space = items, space
        self.sure, self.likely, self.answer = sure, likely, answer
        idf = idf.astype(np.float32)
        sizes = np.array([len(t) for t in items.terms])
        cuts = [(q, t[at : at + WINDOW]) for q, t in enumerate(items.terms) for at in passage_starts(len(t))]
        item_of = np.array([q for q, _ in cuts])
        queries = np.array([space[t].sum(axis=0) for _, t in cuts], np.float32)
        lengths = np.maximum(np.linalg.norm(queries, axis=1), 1e-9)
        self.queries = queries / lengths[:, None]
        self.passages = np.bincount(item_of, minlength=len(sizes))
        self.first_passage = np.cumsum(self.passages) - self.passages
        long = sizes > SHORT
        self.parts = np.where(long, 4, 2)
        width, size = self.parts[item_of] * STRIDE, sizes[item_of]
        within = np.minimum(1.0, width / size.clip(max=WINDOW))
        ease = np.where(long[item_of], 1.0, SHORT_EASE)
        self.cosine = ease * cosine
        self.projection = (ease * HELD * lengths * within).astype(np.float32)
        weights = np.array([idf[np.unique(t)].sum() for t in items.terms])
        passage_weights = np.array([idf[np.unique(t)].sum() for _, t in cuts])
        # of the passage, or of its part of the item where that is less
        self.weight = WEIGHT * np.minimum(within * passage_weights, np.minimum(1.0, width / size) * weights[item_of])
        scale = _LEVELS / max(idf.max(), 1e-9)
        self.least = np.floor(scale * (1 - 1e-4) * np.minimum.reduceat(self.weight, self.first_passage)).astype(np.uint16)
        order = np.argsort(long, kind="stable")
        self.blocks = [self._block(order[at : at + _ITEMS], idf, scale) for at in range(0, len(order), _ITEMS)]
        self.masks = [place_masks(t) for t in items.terms]
        self.answer_masks = [place_masks(t) for t in items.answers]

    def _block(self, chosen: np.ndarray, idf: np.ndarray, scale: float) -> _Block:
        held = np.unique(np.concatenate([self.items.terms[q] for q in chosen]))
        number = np.zeros(len(idf), np.intp)
        number[held] = np.arange(1, len(held) + 1)
        weights = np.zeros((len(held) + 1, len(chosen)), np.float32)
        for column, q in enumerate(chosen):
            weights[number[self.items.terms[q]], column] = idf[self.items.terms[q]]
        return _Block(chosen, number, weights, np.ceil(weights * scale).clip(max=_LEVELS).astype(np.uint8))

    def heavy(self, block: _Block, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(strides, columns of the block) of the windows that may hold enough of an item; none starts in the last three strides."""
        numbers = np.ascontiguousarray(block.number[words].reshape(-1, STRIDE).T)
        sums = block.bounds[numbers[0]]
        for more in numbers[1:]:
            sums += block.bounds[more]
        two = sums[:-1].astype(np.uint16) + sums[1:]
        short = int((self.parts[block.items] == 2).sum())
        for of, at in ((two[:-2, :short], 0), (two[:-2, short:] + two[2:, short:], short)):
            if of.shape[1]:
                stride, column = np.divmod(np.flatnonzero(of >= self.least[block.items[at : at + of.shape[1]]]), of.shape[1])
                yield stride, column + at

    def near(self, block: _Block, column: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, passage, cosine) of the windows that weigh enough and are close to a passage of the item in this column."""
        item = block.items[column]
        words = np.where(np.arange(4 * STRIDE) < (self.parts[item] * STRIDE)[:, None], words, 0)
        weight = block.weights[block.number[words], column[:, None]].sum(axis=1)
        window = np.repeat(np.arange(len(item)), self.passages[item])
        passage = np.arange(len(window)) - np.repeat(np.cumsum(self.passages[item]) - self.passages[item] - self.first_passage[item], self.passages[item])
        enough = weight[window] >= self.weight[passage]
        window, passage = window[enough], passage[enough]
        used, at = np.unique(window, return_inverse=True)
        vectors = self.space[words[used]].sum(axis=1)
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[at]
        close = np.einsum("ij,ij->i", vectors[at], self.queries[passage])
        kept = close >= np.maximum(self.cosine[passage] * norms, self.projection[passage])
        return window[kept], passage[kept], close[kept] / norms[kept]

    def search(self, documents: list[np.ndarray]) -> list[list[tuple[int, float, float, float]]]:
        """For each document (item number, cosine, share of the item, share of its answer), the best window per item."""
        # every document starts with a stride and is followed by three empty ones, so no window reaches the next one
        strides = np.array([-(-len(t) // STRIDE) for t in documents], np.int64)
        first = np.cumsum(strides + 3) - strides - 3
        words = np.zeros((strides.sum() + 3 * len(strides)) * STRIDE, np.int32)
        for at, terms in zip(first.tolist(), documents):
            words[at * STRIDE : at * STRIDE + len(terms)] = terms
        reach = np.arange(4 * STRIDE)
        found = []
        for at in range(0, len(words) // STRIDE - 3, _STRIDES):
            part = words[at * STRIDE : (at + _STRIDES + 3) * STRIDE]
            for block in self.blocks:
                for stride, column in self.heavy(block, part):
                    for a in range(0, len(stride), _STRIDES // 4):
                        some, of = stride[a : a + _STRIDES // 4], column[a : a + _STRIDES // 4]
                        window, passage, cosine = self.near(block, of, part[some[:, None] * STRIDE + reach])
                        found.append((some[window] + at, block.items[of][window], passage, cosine))
        best: list[dict[int, tuple[float, float, float]]] = [{} for _ in documents]
        if found:
            start, item, passage, cosine = (np.concatenate(c) for c in zip(*found))
            document = np.searchsorted(first, start, side="right") - 1
            # windows that start in the empty strides belong to no document
            order = np.lexsort((passage, start, self.parts[item]))
            order = order[(start - first[document] < strides[document])[order]]
            for d, at, q, c in zip(*(x[order].tolist() for x in (document, (start - first[document]) * STRIDE, item, cosine))):
                self._verify(documents[d], at, q, c, best[d])
        return [sorted((q, *v) for q, v in b.items()) for b in best]

    def _verify(self, terms: np.ndarray, first: int, q: int, cosine: float, best: dict[int, tuple[float, float, float]]) -> None:
        """Adds the item to the best ones if the words around the window hold it."""
        if q in best and best[q][1] >= self.sure and best[q][0] >= cosine:
            return
        size, answer = len(self.items.terms[q]), len(self.items.answers[q])
        around = terms[max(first - size, 0) : first + int(self.parts[q]) * STRIDE + size].tolist()
        share = common_subsequence(self.masks[q], size, around) / size
        if share < self.likely:
            return
        answered = common_subsequence(self.answer_masks[q], answer, around) / answer
        if (share >= self.sure or answered >= self.answer) and (share, cosine) > (best.get(q, (0, 0))[1], best.get(q, (0, 0))[0]):
            best[q] = (float(cosine), share, answered)

    def __call__(self, terms: np.ndarray) -> list[tuple[int, float, float, float]]:
        return self.search([terms])[0]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rank: int = RANK,
    **limits,
) -> DataFrame:
    """One row per document and benchmark item that it contains: id, item_id, cosine, item_share, answer_share."""
    spark = docs.sparkSession
    items = read_items(benchmark, item_id_col, item_text_col)
    id_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((docs, id_col), (benchmark, item_id_col)))
    schema = f"id {id_type}, item_id {item_type}, cosine double, item_share double, answer_share double"
    if not items.ids:
        return spark.createDataFrame([], schema)
    stored = materialise(term_numbers(docs, items.vocabulary, id_col, text_col), "terms")
    frequencies, documents = document_frequencies(stored, len(items.vocabulary))
    idf = np.log((1 + documents) / (1 + frequencies))
    idf[0] = 0
    space = latent_space(stored, idf, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(items, space, idf, **limits)
        for batch in batches:
            at, rows = [], []
            for i, leaks in enumerate(search.search([np.frombuffer(value.as_py(), np.int32) for value in batch.column(1)])):
                for q, *numbers in leaks:
                    at.append(i)
                    rows.append((items.ids[q], *numbers))
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa_item, pa.float64(), pa.float64(), pa.float64()]
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "item_id", "cosine", "item_share", "answer_share"])

    pa_item = pa.int64() if item_type == "bigint" else pa.int32() if item_type == "int" else pa.string()
    return stored.mapInArrow(run, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows without a leak, with all their columns; all rows of an id with a leak go."""
    going = find_leaks(docs, benchmark, id_col, text_col, **settings).select(F.col("id").alias("__id")).distinct()
    return docs.join(going, docs[id_col].eqNullSafe(going["__id"]), "left_anti")
