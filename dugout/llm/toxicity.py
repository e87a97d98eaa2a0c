"""Toxicity of texts, with disguised words restored first.

A disguised word (letters replaced by digits and signs, letters drawn out, letters set apart by spaces or signs)
is read as the output of a noisy channel: every sign offers the letters it may stand for, every drawn-out run one
or two copies, every separator nothing.  Viterbi decoding over this lattice under a character trigram model of
all documents gives the most likely word.  Three or more single characters in a row, punctuation beside them or not,
may also be several words: between any two of them the lattice offers a word boundary, and every word of a division
whose probability comes near that of the best one is a reading.

Words, their beginnings and ends are counted in toxic and other labelled documents; those of which, with 95 %
confidence, at least half of the documents are toxic make the lexicon.  The three strongest words of the restored
text are a document's evidence, which a monotone histogram of labelled documents kept apart turns into a score.

Learned from: folds 0 and 3 (words) and 1 (scores) of the ids; fold 2 is held out.  The lexicon grows with the documents, so
it stays a table: tasks get a bit set of fixed size that knows every entry and a few others, documents give
out the features that pass it, and those are joined with the table.  Only counts per trigram, the bit set and
the histogram reach the driver, whatever the number of documents.

Defined cases: null and empty texts have no evidence and get the score of such texts; without labels every score
is 0; a null id is scored and never learned from; a label that is repeated counts once, toxic if one of them is;
repeated documents are scored each on their own; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .folds import fold_of, held_out

# Letters that a digit or sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "¡": "i", "£": "l",
}
SEPARATORS = ".-_*~'`^"
SIGN_COST = -0.5
CONFIDENCE = 1.64
LEAST_SHARE = 0.5
LEAST_RUN = 3
# letters of a divided word, and nats by which a division may be less likely than the best one
LONGEST_WORD = 24
NEAR = 6.0
BINS = 64
#: Logarithm of the bits of the set that stands for the lexicon in the tasks; a fuller set lets more features through to the join.
FILTER_BITS = 22
CACHED_WORDS = 300_000
_SYMBOLS = 64
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_PUNCTUATION = ".,;:!?\"'()[]{}<>«»„“”…"
_LETTER = re.compile(r"[^\W\d_]")
_RUN = re.compile(r"([^\W\d_])\1\1")
_SET_APART = re.compile(r"^(?:[^\W_][.\-_*~'`^]+){2,}[^\W_]$")


def _symbol_table() -> np.ndarray:
    """Code points to 64 symbols: boundary, a-z, all other letters by remainder."""
    table = (27 + np.arange(65536) % 37).astype(np.int32)
    table[97:123] = np.arange(1, 27)
    table[32] = 0
    return table


_TABLE = _symbol_table()


def symbols(text: str) -> np.ndarray:
    return _TABLE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) & 0xFFFF]


class CharModel:
    """Log-probabilities of a symbol after two others, mixed with shorter contexts."""

    def __init__(self, counts: dict[int, int]):
        three = np.zeros(_SYMBOLS**3)
        if counts:
            three[np.fromiter(counts, np.int64)] = np.fromiter(counts.values(), np.float64)
        three = three.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
        two = three.sum(axis=0)
        one = (two.sum(axis=0) + 1) / (two.sum() + _SYMBOLS)
        after_one = (two + 5 * one) / (two.sum(axis=1, keepdims=True) + 5)
        mixed = (three + 5 * after_one) / (three.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(mixed).astype(np.float32)
        self.start = np.log(after_one[0]).astype(np.float32)

    def decode(self, token: str) -> str:
        """The most likely letters behind a disguised token."""
        options: list[list[tuple[str, float]]] = []
        at = 0
        while at < len(token):
            char, run = token[at], 1
            while at + run < len(token) and token[at + run] == char:
                run += 1
            at += run
            letters = char if _LETTER.match(char) else STANDS_FOR.get(char, "")
            if not letters:
                continue
            cost = 0.0 if letters == char else SIGN_COST
            choices = [(c, cost) for c in letters]
            if run >= 2:
                twice = [(c + c, cost) for c in letters]
                choices = choices + twice if run > 2 else twice
            options.append(choices)
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for choices in options:
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, word) in sorted(states.items()):
                for letters, cost in choices:
                    x, y, total = a, b, score + cost
                    for s in symbols(letters):
                        total += float(self.log[x, y, s])
                        x, y = y, int(s)
                    if (x, y) not in after or total > after[x, y][0]:
                        after[x, y] = (total, word + letters)
            states = after
        return max(((score + float(self.log[a, b, 0]), word) for (a, b), (score, word) in states.items()), key=lambda e: e[0])[1]


    def _words_from(self, options: list[list[tuple[str, float]]], first: int) -> Iterator[tuple[int, float, str]]:
        """(end, score, letters) of the most likely word from a place on, for each of its ends."""
        states: dict[tuple[int, int], tuple[float, str]] = {}
        for at in range(first, min(first + LONGEST_WORD, len(options))):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, word) in sorted(states.items()) if states else [((0, 0), (0.0, ""))]:
                for letter, cost in options[at]:
                    key, total = (a, b), score + cost
                    if letter:
                        s = int(symbols(letter)[0])
                        key, total = (b, s), total + float(self.log[a, b, s] if word else self.start[s])
                    if word + letter and (key not in after or total > after[key][0]):
                        after[key] = (total, word + letter)
            states = after
            if not states:
                return
            yield at + 1, *max(((v + float(self.log[a, b, 0]), w) for (a, b), (v, w) in states.items()), key=lambda e: e[0])

    def divide(self, chars: list[str]) -> tuple[list[str], list[str]]:
        """Words of the most likely division of single characters, and those of all divisions that come near it."""
        options: list[list[tuple[str, float]]] = []
        runs: list[tuple[str, int]] = []
        for char in chars:
            runs.append((char, runs.pop()[1] + 1) if runs and runs[-1][0] == char else (char, 1))
        for char, run in runs:
            letters = char if _LETTER.match(char) else STANDS_FOR.get(char, "")
            if letters:
                one = [(c, 0.0 if letters == char else SIGN_COST) for c in letters]
                options += [one, [*one, ("", 0.0)] if run > 2 else one][: min(run, 2)]
        n = len(options)
        words = [list(self._words_from(options, i)) for i in range(n)]
        ahead, behind, last = [0.0] + [-np.inf] * n, [-np.inf] * n + [0.0], [(0, "")] * (n + 1)
        for i in range(n):
            for end, score, word in words[i]:
                if ahead[i] + score > ahead[end]:
                    ahead[end], last[end] = ahead[i] + score, (i, word)
        for i in reversed(range(n)):
            behind[i] = max((score + behind[end] for end, score, _ in words[i]), default=-np.inf)
        best, at = [], n
        while at:
            at, word = last[at]
            best.insert(0, word)
        near = [word for i in range(n) for end, score, word in words[i] if ahead[i] + score + behind[end] >= ahead[n] - NEAR]
        return best, list(dict.fromkeys(near))


def disguised(token: str) -> bool:
    """Letters mixed with signs that stand for letters, a letter three times in a row, or letters set apart."""
    if token.isalpha():
        return _RUN.search(token) is not None
    if not _LETTER.search(token):
        return False
    return any(c in STANDS_FOR for c in token) or _RUN.search(token) is not None or _SET_APART.match(token) is not None


def single(token: str) -> str:
    """The one character of a token, without the punctuation beside it; empty for a token of more."""
    if len(token) > 1:
        token = token.strip(_PUNCTUATION)
    return token if len(token) == 1 else ""


def single_runs(tokens: list[str]) -> Iterator[list[str]]:
    """Runs of consecutive tokens of one character."""
    run: list[str] = []
    for token in tokens:
        if char := single(token):
            run.append(char)
        elif run:
            yield run
            run = []
    if run:
        yield run


class Restorer:
    """Words of a text in lower case, those in disguise restored as well."""

    def __init__(self, model: CharModel):
        self.model = model

    def words(self, token: str) -> list[str]:
        """Words of a token without white space; a disguised one gives its letters and its reading."""
        token = token.lower()
        core = token.strip(_PUNCTUATION)
        if core.isalpha() and not _RUN.search(core):
            return [core]
        found = [w for w in _NOT_LETTERS.split(core) if w]
        for form in {core, token.strip(".,;:?\"")}:
            if disguised(form):
                found.append(self.model.decode(form))
        return found

    def spaced(self, tokens: list[str]) -> list[str]:
        """Readings of runs of at least three single characters: divided into words, and as one word."""
        found = []
        for run in single_runs(tokens):
            if len(run) >= LEAST_RUN:
                word = "".join(run).lower()
                found += [*self.model.divide(list(word))[1], self.model.decode(word)]
        return [f for f in dict.fromkeys(found) if f]

    def restore(self, text: str) -> str:
        """The text with disguised tokens replaced by their readings; set-apart letters are closed up."""
        out, run = [], []
        for token in [*text.split(), ""]:
            if single(token):
                run.append(token)
                continue
            out += self.model.divide(list("".join(map(single, run)).lower()))[0] if len(run) >= LEAST_RUN else run
            run = []
            core = token.lower().strip(_PUNCTUATION)
            out.append(self.model.decode(core) if disguised(core) else token)
        return " ".join(out).rstrip()


def word_features(word: str) -> list[str]:
    """The word, its first four and five and its last four letters."""
    found = [f"={word}"]
    if len(word) > 4:
        found += [f"<{word[:4]}", f">{word[-4:]}"]
    if len(word) > 5:
        found.append(f"<{word[:5]}")
    return found


def count_trigrams(docs: DataFrame, text_col: str) -> dict[int, int]:
    """Symbol trigrams of the letters of all documents; at most 64 cubed entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                s = symbols(f" {_NOT_LETTERS.sub(' ', (text.as_py() or '').lower())} ").astype(np.int64)
                s = np.concatenate([[0], s])
                found, n = np.unique((s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], return_counts=True)
                total[found] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["trigram", "n"])

    partial = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "trigram long, n long")
    return {r["trigram"]: r["n"] for r in partial.groupBy("trigram").agg(F.sum("n").alias("n")).collect()}


def learn_lexicon(labelled: DataFrame, model: CharModel) -> DataFrame:
    """(feature, least): weights of word features from (text, toxic) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, seen = Restorer(model), {}

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(list(seen), pa.string()), *[pa.array([v[i] for v in seen.values()], pa.int64()) for i in (0, 1)]]
            seen.clear()
            return pa.RecordBatch.from_arrays(arrays, ["feature", "toxic", "other"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                tokens = (text.as_py() or "").split()
                words = {w for t in set(tokens) for w in restorer.words(t)}
                words.update(restorer.spaced(tokens))
                for feature in {f for w in words for f in word_features(w)}:
                    pair = seen.setdefault(feature, [0, 0])
                    pair[0 if toxic else 1] += 1
            if len(seen) > CACHED_WORDS:
                yield flush()
        yield flush()

    partial = labelled.select("text", "toxic").mapInArrow(run, "feature string, toxic long, other long")
    sums = partial.groupBy("feature").agg(F.sum("toxic").alias("n1"), F.sum("other").alias("n0"))
    share = (F.col("n1") + 1) / (F.col("n1") + F.col("n0") + 2)
    least = share - CONFIDENCE * F.sqrt(share * (1 - share) / (F.col("n1") + F.col("n0") + 3))
    return sums.select("feature", least.alias("least")).filter(F.col("least") >= LEAST_SHARE)


class FeatureFilter:
    """A bit set that knows every feature of a lexicon; ``in`` is true for all of them and for few others."""

    def __init__(self, lexicon: DataFrame, bits: int = FILTER_BITS):
        self.mask, words = (1 << bits) - 1, np.zeros(max(1, (1 << bits) // 64), "<u8")
        mask = F.lit((1 << bits) - 1)
        hashed = F.xxhash64("feature")
        places = F.array(hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 32).bitwiseAND(mask))
        at = lexicon.select(F.explode(places).alias("place")).select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
        # one row per word of the set at most
        for r in at.groupBy("word").agg(F.bit_or("bit").alias("bit")).toLocalIterator():
            words[r["word"]] = r["bit"] % 2**64
        self.table = words.tobytes()

    def __contains__(self, feature: str) -> bool:
        hashed = xxhash.xxh64_intdigest(feature.encode("utf-8", "surrogatepass"), 42)
        one, two = hashed & self.mask, hashed >> 32 & self.mask
        return bool(self.table[one >> 3] >> (one & 7) & self.table[two >> 3] >> (two & 7) & 1)


class Readings:
    """The words that a text may be read as and whose features are ``known``; remembers a bounded number of tokens."""

    def __init__(self, model: CharModel, known, limit: int = CACHED_WORDS):
        self.restorer, self.known, self.limit = Restorer(model), known, limit
        self.seen: dict[str, list[tuple[str, str]]] = {}

    def features(self, words: Iterable[str]) -> list[tuple[str, str]]:
        return [(word, f) for word in words for f in word_features(word) if f in self.known]

    def __call__(self, text: str) -> list[tuple[str, str, str]]:
        """(slot, word, feature): of the words of one slot only the strongest counts.  A token is a slot, a word set apart is its own."""
        tokens = text.split()
        distinct = set(tokens)
        new = distinct.difference(self.seen)
        if new:
            if len(self.seen) > self.limit:
                self.seen.clear()
                new = distinct
            for t in new:
                self.seen[t] = self.features(self.restorer.words(t))
        found = [(t, *pair) for t in distinct if self.seen[t] for pair in self.seen[t]]
        return found + [(f" {word}", word, f) for word, f in self.features(self.restorer.spaced(tokens))]


class Evidence:
    """Weight of a text from the three strongest of its distinct words, with a lexicon at hand."""

    def __init__(self, model: CharModel, lexicon: dict[str, float]):
        self.lexicon, self.readings = lexicon, Readings(model, lexicon)

    def __call__(self, text: str) -> float:
        words: dict[tuple[str, str], float] = {}
        for slot, word, feature in self.readings(text):
            words[slot, word] = max(words.get((slot, word), 0.0), self.lexicon[feature])
        slots: dict[str, tuple[float, str]] = {}
        for (slot, word), weight in words.items():
            slots[slot] = max(slots.get(slot, (0.0, "")), (weight, word))
        rest = 1.0
        for weight in sorted({word: weight for weight, word in slots.values()}.values(), reverse=True)[:3]:
            rest *= 1 - 0.98 * weight
        return 1 - rest


def gather_evidence(docs: DataFrame, model: CharModel, lexicon: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(id, evidence) of (id, text) rows, as :class:`Evidence` has it, with the lexicon as a table."""
    known = FeatureFilter(lexicon, bits)
    kind = docs.schema["id"].dataType.simpleString()
    entry = pa.list_(pa.struct([("slot", pa.string()), ("word", pa.string()), ("feature", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readings = Readings(model, known)
        for batch in batches:
            found = [[{"slot": s, "word": w, "feature": f} for s, w, f in readings(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, entry)], ["id", "found"])

    read = docs.mapInArrow(run, f"id {kind}, found array<struct<slot:string,word:string,feature:string>>")
    # repeated ids are told apart by the stored row number
    read = materialise(read.withColumn("row", F.monotonically_increasing_id()), "readings")
    hits = read.select("row", F.explode("found").alias("h")).select("row", "h.*").join(lexicon, "feature")
    words = hits.groupBy("row", "slot", "word").agg(F.max("least").alias("least"))
    slots = words.groupBy("row", "slot").agg(F.max(F.struct("least", "word")).alias("best"))
    strongest = slots.groupBy("row").agg(F.collect_set("best").alias("best"))  # one document's words
    weights = F.slice(F.reverse(F.array_sort(F.transform("best", lambda b: b["least"]))), 1, 3)
    rest = F.aggregate(weights, F.lit(1.0), lambda rest, weight: rest * (1 - F.lit(0.98) * weight))
    weighed = strongest.select("row", (1 - rest).alias("evidence"))
    return read.select("id", "row").join(weighed, "row", "left").select("id", F.coalesce("evidence", F.lit(0.0)).alias("evidence"))


def monotone(counts: dict[int, tuple[int, int]], bins: int = BINS) -> list[float]:
    """Share of toxic documents per bin of evidence (toxic, all), made non-decreasing by pooling neighbours."""
    if not counts:
        return [0.0] * bins
    blocks: list[list[float]] = []
    for b in range(bins):
        toxic, total = counts.get(b, (0, 0))
        blocks.append([toxic, total, 1])
        while len(blocks) > 1 and (not blocks[-1][1] or not blocks[-2][1] or blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    return [(toxic + 0.1) / (total + 0.2) for toxic, total, width in blocks for _ in range(int(width))]


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per document: id, held_out, score, evidence.  ``labels`` has the id and a 0/1 label."""
    marks = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    model = CharModel(count_trigrams(narrow, "text"))
    words = marks.filter(fold_of(F.col("id")).isin(0, 3))
    # one plan at every size: the labels grow with the documents and are not broadcast
    learn = narrow.filter(fold_of(F.col("id")).isin(0, 3)).join(words.hint("merge"), "id")
    lexicon = materialise(learn_lexicon(learn, model), "lexicon")
    scored = materialise(gather_evidence(narrow, model, lexicon), "evidence")
    bin_of = F.least(F.floor(F.col("evidence") * BINS), F.lit(BINS - 1)).cast("int")
    apart = scored.filter(fold_of(F.col("id")) == 1).join(marks, "id").groupBy(bin_of.alias("bin"))
    counts = {r["bin"]: (r["n1"], r["n"]) for r in apart.agg(F.sum("toxic").alias("n1"), F.count(F.lit(1)).alias("n")).collect()}
    steps = F.array(*[F.lit(s) for s in monotone(counts)])
    return scored.select("id", held_out(F.col("id")).alias("held_out"), F.get(steps, bin_of).alias("score"), "evidence")
