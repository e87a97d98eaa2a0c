"""Language identification in two levels.

One-versus-one linear support vector machines first choose the language family and then, among the languages of
that family only, the language.  Features are hashed character n-grams of the letters of the whole text.  Languages
that no family lists make up the family ``other``; they are not closely related, so one machine per language
separates it from the rest of them.

The machines are fitted on about ``SAMPLE_ROWS`` labelled rows, the same number for each language, chosen by a hash of
the id.  At most ``MAX_LANGUAGES`` languages are learned, those with most labelled rows, and each of them with ``LEAST_ROWS``
rows at least.  These bounds are all that reaches the driver; each machine is fitted in a task, from a table of one
row per machine.  Every text is then scored where it is read.

Defined cases: a null text or one without a letter is ``und`` with score 0; without any labelled row all texts are
``und``; with one language every text with letters is of that language with score 1; a label with fewer rows than are
wanted, or beyond the most frequent ones, is not learned; null ids are scored and never learned from; repeated rows are scored each on their
own; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .folds import held_out

# Language families by language code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "mk", "bg"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "indic": ("hi", "ur", "bn", "mr", "gu", "pa", "ne"),
    "semitic": ("ar", "he", "mt", "am"),
}
OTHER = "other"
SAMPLE_ROWS = 2_000
MAX_LANGUAGES = 200
LEAST_ROWS = 1
# below: the predicted language clearly loses a comparison, the machines contradict each other
LEAST_SCORE = 0.4
BITS = 12
UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_BLOCK = 1 << 16


def letter_grams(text: str, bits: int = BITS) -> np.ndarray | None:
    """Unit vector of hashed n-grams (1 to 3) of the lower-cased letters; null without a letter."""
    letters = _NOT_LETTERS.sub(" ", text).strip().lower()
    if not letters:
        return None
    total = np.zeros(1 << bits, np.float32)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    down = np.uint32(32 - bits)
    for at in range(0, len(codes), _BLOCK):
        c = codes[at : at + _BLOCK + 2]
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (c[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
        for grams in (one[:_BLOCK], two[:_BLOCK], three[:_BLOCK]):
            total += np.bincount(grams >> down, minlength=1 << bits)
    np.sqrt(total, out=total)
    return total / np.linalg.norm(total)


def fit_svm(x: np.ndarray, y: np.ndarray, strength: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss, classes weighted alike; y is 1 or -1."""
    # single precision throughout, so that no product makes a wider copy of x
    y = y.astype(np.float32)
    share = (np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * strength).astype(np.float32)
    w = v = np.zeros(x.shape[1] + 1, np.float32)
    step, momentum = np.float32(1 / (1 + 4 * strength)), 1.0
    for _ in range(rounds):
        pull = share * y * np.maximum(0, 1 - y * (x @ v[:-1] + v[-1]))
        new = v - step * (v - 2 * np.append(pull @ x, pull.sum()))
        faster = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        v = new + np.float32((momentum - 1) / faster) * (new - w)
        w, momentum = new, faster
    return w


@dataclass
class LanguageModel:
    """Machines per pair of families, per pair of languages of one family, and per language of the family ``other``."""

    families: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray

    def predict(self, grams: np.ndarray | None) -> tuple[str, float]:
        if grams is None or not self.families:
            return UNDETERMINED, 0.0
        margins = dict(zip(self.pairs, grams @ self.weights[:-1] + self.weights[-1])) if self.pairs else {}
        family, sure = self._best(list(self.families), margins, "family:")
        if family == OTHER:
            language, surer = self._strongest(self.families[family], margins)
        else:
            language, surer = self._best(self.families[family], margins, "")
        return language, float(min(sure, surer))

    def _strongest(self, names: list[str], margins: dict) -> tuple[str, float]:
        """The name with the largest margin over the rest."""
        if len(names) == 1:
            return names[0], 1.0
        best = max(names, key=lambda n: (margins[n, None], n))
        return best, 1 / (1 + np.exp(-3 * margins[best, None]))

    def _best(self, names: list[str], margins: dict, prefix: str) -> tuple[str, float]:
        """The name with the most won comparisons, ties by margin; how sure its closest comparison is."""
        won = dict.fromkeys(names, (0, 0.0))
        closest = dict.fromkeys(names, np.inf)
        for a, b in itertools.combinations(names, 2):
            margin = float(margins[prefix + a, prefix + b])
            for name, m in ((a, margin), (b, -margin)):
                won[name] = (won[name][0] + (m > 0), won[name][1] + m)
                closest[name] = min(closest[name], m)
        best = max(names, key=lambda n: (won[n], n))
        return best, 1.0 if len(names) == 1 else 1 / (1 + np.exp(-3 * closest[best]))


def family_tree(languages: Iterable[str]) -> dict[str, list[str]]:
    """Languages by family."""
    known = {code: family for family, codes in FAMILIES.items() for code in codes}
    families: dict[str, list[str]] = {}
    for language in sorted(set(languages)):
        families.setdefault(known.get(language, OTHER), []).append(language)
    return families


def machines(families: dict[str, list[str]]) -> list[tuple[str, str | None]]:
    """The machines to fit: pairs of families (with a prefix), pairs in a family, and (language, none) in the family ``other``."""
    wanted: list[tuple[str, str | None]] = [(f"family:{a}", f"family:{b}") for a, b in itertools.combinations(families, 2)]
    for family, members in families.items():
        if family != OTHER:
            wanted += itertools.combinations(members, 2)
        elif len(members) > 1:
            wanted += [(language, None) for language in members]
    return wanted


def fit_machine(pair: tuple[str, str | None], x: np.ndarray, of: np.ndarray, families: dict[str, list[str]]) -> np.ndarray:
    """The weights of one machine from all sampled rows ``x`` with their languages."""
    sides = [set(families[name[7:]]) if name.startswith("family:") else {name} for name in pair if name is not None]
    rest = set(families[OTHER]) - sides[0] if pair[1] is None else sides[1]
    first = np.array([language in sides[0] for language in of])
    use = first | np.array([language in rest for language in of])
    return fit_svm(x[use].astype(np.float32), np.where(first[use], 1.0, -1.0))


def fit_languages(rows: list[tuple[str, np.ndarray]]) -> LanguageModel:
    """Fit on (language, grams) rows at hand, one machine after the other."""
    families = family_tree(r[0] for r in rows)
    wanted = machines(families)
    if not wanted:
        return LanguageModel(families, [], np.zeros((0, 0)))
    x, of = np.array([r[1] for r in rows], np.float16), np.array([r[0] for r in rows], object)
    return LanguageModel(families, wanted, np.array([fit_machine(pair, x, of, families) for pair in wanted]).T)


def train(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_rows: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES, least_rows: int = LEAST_ROWS
) -> LanguageModel:
    spark = docs.sparkSession
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    counted = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_rows)
    # at most max_languages rows
    counts = {r["lang"]: r["n"] for r in counted.orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    rates = spark.createDataFrame([(lang, sample_rows / len(counts) / n) for lang, n in counts.items()], "lang string, rate double")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [letter_grams(t.as_py() or "") for t in batch.column(0)]
            kept = pa.array([v is not None for v in found], pa.bool_())
            vectors = pa.array([None if v is None else v.astype(np.float16).tobytes() for v in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(1), vectors], ["lang", "grams"]).filter(kept)

    sample = labelled.join(F.broadcast(rates), "lang").filter(draw < F.col("rate")).select("text", "lang").mapInArrow(grams, "lang string, grams binary")
    rows = sorted((r["lang"], bytes(r["grams"])) for r in sample.collect())
    families = family_tree(r[0] for r in rows)
    wanted = machines(families)
    if not wanted:
        return LanguageModel(families, [], np.zeros((0, 0)))
    x, of = np.frombuffer(b"".join(r[1] for r in rows), np.float16).reshape(len(rows), -1), np.array([r[0] for r in rows], object)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                weights = fit_machine(wanted[at], x, of, families)
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([weights.tobytes()], pa.binary())], ["at", "weights"])

    tasks = min(len(wanted), 64)
    fitted = spark.range(0, len(wanted), 1, tasks).select(F.col("id").alias("at")).mapInArrow(fit, "at long, weights binary")
    weights = [np.frombuffer(r["weights"], np.float32) for r in sorted(fitted.collect())]
    return LanguageModel(families, wanted, np.array(weights).T)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of the documents, with ``lang_pred`` and ``lang_score`` in a struct column ``__lang``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(letter_grams(t.as_py() or "")) for t in batch.column(batch.schema.get_field_index("__text"))]
            names, scores = zip(*found) if found else ((), ())
            keep = [i for i, n in enumerate(batch.schema.names) if n != "__text"]
            arrays = [*[batch.column(i) for i in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*[batch.schema.names[i] for i in keep], "__lang_pred", "__lang_score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__lang_pred", T.StringType()), T.StructField("__lang_score", T.DoubleType())])
    return docs.withColumn("__text", F.col(text_col).cast("string")).mapInArrow(run, schema)


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score."""
    model = train(docs, id_col, text_col, lang_col, sample_rows)
    found = identify(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, "id", "text")
    return found.select("id", held_out(F.col("id")).alias("held_out"), F.col("__lang_pred").alias("lang_pred"), F.col("__lang_score").alias("score"))


def drop_undetermined(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    wanted: tuple[str, ...] | None = None,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """The rows whose language can be told, with all their columns.

    Texts without a letter go, and so do those with a lower score than ``least_score`` or, if ``wanted`` lists
    languages, predicted to be in another.  Without labels to learn from, all texts with a letter stay.
    """
    model = train(docs, id_col, text_col, lang_col, sample_rows)
    keep = F.col("__lang_pred") != UNDETERMINED
    if model.families:
        keep &= F.col("__lang_score") >= least_score
        if wanted is not None:
            keep &= F.col("__lang_pred").isin(*wanted)
    else:
        model = LanguageModel({"any": ["any"]}, [], np.zeros((0, 0)))
    return identify(docs, model, id_col, text_col).filter(keep).drop("__lang_pred", "__lang_score")
