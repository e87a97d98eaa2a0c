"""Token counts of a unigram tokenizer without producing the tokens.

Aho-Corasick finds all vocabulary matches within a word at once; a Viterbi pass over the end positions carries the
best score and the number of pieces only.  Ties go as in the tokenizer: candidates of one end are taken from the
earliest start on, and a later one must be strictly better.  A character without a piece of its own costs the
smallest score less 10 and counts as its UTF-8 bytes (byte fallback).

Words are what the tokenizer sees: a space becomes the mark that begins a word, a text gets one in front.  No
piece contains a line break, so words are cut there as well, which changes no count.  As in the tokenizer, which
splits at each mark, every mark begins a word: vocabulary pieces with a mark after their first character (runs of
marks, for indentation) are never used, and each further space of a run counts as a piece.  Each worker remembers a
bounded number of words.

Defined cases: null and empty texts have no words, no tokens and score 0; repeated rows and null ids are
counted each on their own; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 400_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class WordCounter:
    """(pieces, score) of a word under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def __call__(self, word: str) -> tuple[int, float]:
        best, pieces = [0.0], [0]
        matches = self.automaton.iter(word)
        end, found = next(matches, (-1, (0, 0.0)))
        for at, char in enumerate(word):
            score, count, single = float("-inf"), 0, False
            while end == at:
                size, worth = found
                start = at + 1 - size
                single |= size == 1
                if best[start] + worth > score:
                    score, count = best[start] + worth, pieces[start] + 1
                end, found = next(matches, (-1, (0, 0.0)))
            if not single and best[at] + self.unknown > score:
                score, count = best[at] + self.unknown, pieces[at] + len(char.encode("utf-8", "surrogatepass"))
            best.append(score)
            pieces.append(count)
        return pieces[-1], best[-1]


class TextCounter:
    """(words, pieces, score) of a text; remembers up to ``limit`` words."""

    def __init__(self, vocabulary: list[tuple[str, float]], limit: int = CACHED_WORDS):
        self.count, self.limit = WordCounter(vocabulary), limit
        self.pieces: dict[str, int] = {}
        self.scores: dict[str, float] = {}

    def __call__(self, text: str) -> tuple[int, int, float]:
        if not text:
            return 0, 0, 0.0
        text = text.replace(MARK, " ")
        text = text if text[0] == " " else f" {text}"
        n_words = text.count(" ")
        # a part that follows a line break keeps it and has no mark of its own
        parts = text.replace("\n", " \n").split(" ")[1:]
        new = set(parts).difference(self.pieces)
        if new:
            if len(self.pieces) > self.limit:
                self.pieces.clear()
                self.scores.clear()
                new = set(parts)
            for part in new:
                self.pieces[part], self.scores[part] = self.count(part if part[:1] == "\n" else MARK + part)
        return n_words, sum(map(self.pieces.__getitem__, parts)), sum(map(self.scores.__getitem__, parts))


@functools.cache
def text_counter(path: str, limit: int) -> TextCounter:
    """One per worker process, so that later tasks find what earlier ones have looked up."""
    return TextCounter(read_vocabulary(path), limit)


def count_tokens(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", cached_words: int = CACHED_WORDS
) -> DataFrame:
    """One row per document: id, n_words, n_tokens, score (log-probability of the best segmentation)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = text_counter(vocabulary_path, cached_words)
        for batch in batches:
            rows = [counter(text.as_py() or "") for text in batch.column(1)]
            words, pieces, scores = zip(*rows) if rows else ((), (), ())
            arrays = [batch.column(0), pa.array(words, pa.int64()), pa.array(pieces, pa.int64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n_tokens", "score"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, n_words long, n_tokens long, score double")
