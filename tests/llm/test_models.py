"""Language, toxicity and leaks on small tables."""

import random
import time
import zlib

import numpy as np
from pyspark.sql import types as T
from support import documents

from dugout.llm import decontaminate, language_id, toxicity


def sentence(words, n):
    return " ".join(random.choices(words, k=n))


EN, DE, FR = ("the of and that with was ing".split(), "der und nicht von ist zu ung".split(), "le la et dans que pour oi".split())


def test_languages(spark):
    random.seed(4)
    table = [(i, sentence({"en": EN, "de": DE, "fr": FR}[lang], 12), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    hard = [(1000, None, "en"), (1001, "", "en"), (1002, "123 !!", "de"), (1003, "THE AND " * 40_000, None), (None, "der und nicht", "de"), (5, table[5][1], table[5][2])]
    docs = documents(spark, table + hard).selectExpr("*", "1 AS lang_pred", "2 AS score")
    got = language_id.predict_languages(docs).collect()
    by = {r["id"]: r for r in got}
    assert len(got) == len(table) + len(hard)
    assert all(by[i]["lang_pred"] == lang for i, _, lang in table)
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "en", "de"]
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = language_id.drop_undetermined(docs)
    assert kept.columns == docs.columns and kept.count() == len(got) - 3


def test_languages_without_labels(spark):
    assert {r["lang_pred"] for r in language_id.predict_languages(documents(spark, [(1, "a b", None)])).collect()} == {"und"}
    assert language_id.predict_languages(documents(spark, []).limit(0)).count() == 0
    one = language_id.predict_languages(documents(spark, [(i, "a b c", "xx") for i in range(8)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in one} == {("xx", 1.0)}


def test_the_stage_acts_on_the_prediction(spark):
    random.seed(4)
    table = [(i, sentence({"en": EN, "de": DE, "fr": FR}[lang], 12), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    docs = documents(spark, table)
    kept = language_id.drop_undetermined(docs, wanted=("en", "fr")).collect()
    assert len(kept) == 80 and {r["lang"] for r in kept} == {"en", "fr"}
    assert language_id.drop_undetermined(docs).count() == 120 and language_id.drop_undetermined(docs, least_score=1.01).count() == 0
    unlabelled = documents(spark, [(1, "some text", None), (2, "12 !", None), (3, None, None)])
    assert [r["doc_id"] for r in language_id.drop_undetermined(unlabelled).collect()] == [1]


def test_a_language_of_the_other_family_is_not_considered():
    rows = [(lang, language_id.letter_grams(sentence(words, 30))) for lang, words in (("en", EN), ("de", DE), ("fr", FR)) for _ in range(30)]
    model = language_id.fit_languages(rows)
    assert set(model.pairs) == {("family:germanic", "family:romance"), ("de", "en")}


def test_restoring():
    counts = {}
    words = ["idiot", "loser", "scum", "that", "the", "not", "book", "see"] * 50
    for w in words:
        s = [0, 0, *toxicity.symbols(f" {w} ").tolist()]
        for a, b, c in zip(s, s[1:], s[2:]):
            key = (a * 64 + b) * 64 + c
            counts[key] = counts.get(key, 0) + 1
    restorer = toxicity.Restorer(toxicity.CharModel(counts))
    for disguise, word in (("1d10t", "idiot"), ("l0$er", "loser"), ("scuuuum", "scum"), ("i.d.i.o.t", "idiot"), ("boooook", "book"), ("seeee", "see")):
        assert word in restorer.words(disguise), disguise
    assert restorer.spaced("you i d i o t now".split()) == ["idiot"]
    assert restorer.restore("the 1d10t and s c u m now") == "the idiot and scum now"
    assert restorer.words("That,") == ["that"] and restorer.words("4.0") == []


def test_spaced_runs():
    counts = {}
    words = ["idiot", "scum", "you", "are", "a", "i", "the", "not", "book"] * 50
    for w in words:
        s = [0, 0, *toxicity.symbols(f" {w} ").tolist()[1:]]
        for a, b, c in zip(s, s[1:], s[2:]):
            key = (a * 64 + b) * 64 + c
            counts[key] = counts.get(key, 0) + 1
    restorer = toxicity.Restorer(toxicity.CharModel(counts))
    runs = (
        ("s c u m", "scum"), ("s c u m.", "scum"), ("what i d i o t.", "idiot"), ("y o u s c u m", "scum"), ("y o u s c u m", "you"),
        ("a i d i o t", "idiot"), ("I s c u m!", "scum"), ("(s c u m)", "scum"), ("s. c. u. m.", "scum"), ("5 c u m", "scum"), ("y o u", "you"),
    )
    for text, word in runs:
        assert word in restorer.spaced(text.split()), text
    assert restorer.spaced("a b".split()) == restorer.spaced("the not".split()) == restorer.spaced(". . .".split()) == []
    assert restorer.restore("the y o u s c u m. book") == "the you scum book"
    assert "scum" in restorer.spaced(list("scum" * 5_000))
    evidence = toxicity.Evidence(restorer.model, {"=scum": 0.9})
    assert min(map(evidence, ("s c u m.", "y o u s c u m", "a s c u m"))) > 0.8 and evidence("a b c") == 0


def test_toxicity(spark):
    random.seed(9)
    table, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        table.append((i, sentence(EN, 20) + (" you idiot " if bad and i % 2 else " 1d1ot " if bad else " ") + sentence(EN, 5)))
        labels.append((i, int(bad)))
    hard = [(1000, None), (1001, ""), (1002, "idiot " * 30_000), (None, "idiot"), (0, table[0][1])]
    docs = documents(spark, table + hard).selectExpr("*", "1 AS toxic", "2 AS evidence")
    marks = spark.createDataFrame([*labels, (0, 1), (None, 1), (7, None)], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.LongType())]))
    got = toxicity.score_toxicity(docs, marks).collect()
    by = {r["id"]: r["score"] for r in got}
    assert len(got) == 605 and all(0 <= r["score"] <= 1 for r in got)
    assert all((by[i] >= 0.3) == bool(y) for i, y in labels)
    assert by[1000] == by[1001] < 0.3 and by[1002] >= 0.3 and by[None] >= 0.3
    assert {r["score"] for r in toxicity.score_toxicity(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), marks).count() == 0


def test_monotone():
    steps = toxicity.monotone({0: (1, 100), 3: (9, 10), 5: (5, 10), 9: (10, 10)}, 12)
    assert len(steps) == 12 and steps == sorted(steps) and steps[0] < 0.05 and steps[11] > 0.9


def brute_subsequence(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    return int(table[-1, -1])


def test_subsequence():
    random.seed(2)
    for _ in range(200):
        a, b = [random.choices(range(6), k=random.randint(1, 70)) for _ in range(2)]
        assert decontaminate.common_subsequence(decontaminate.place_masks(np.array(a)), len(a), b) == brute_subsequence(a, b)


def test_leaks(spark):
    random.seed(6)
    words = ["".join(random.choices("abcdefghij", k=random.randint(2, 8))) for _ in range(3000)]
    items = [(i, f"{sentence(words, random.randint(12, 50))}. {sentence(words, 6)}.") for i in range(30)]
    table = [(1000 + i, sentence(words, random.randint(1, 400))) for i in range(150)]
    planted = []
    for i, text in items[:25]:
        tokens = text.split()
        if i % 3 == 1:  # a paraphrase: some words changed, one dropped
            for at in random.sample(range(len(tokens) - 6), len(tokens) // 8):
                tokens[at] = "other"
            tokens.pop(1)
        table.append((i, f"{sentence(words, i * 7)} {' '.join(tokens)} {sentence(words, 30)}"))
        planted.append((i, i))
    half = items[27][1].split()
    table += [(500, " ".join(half[: len(half) // 3])), (501, None), (502, ""), (None, items[28][1]), (503, sentence(words, 40_000) + " " + items[29][1])]
    bench = spark.createDataFrame([*items, (77, items[2][1]), (78, None), (79, "")], T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]))
    docs = documents(spark, table).selectExpr("*", "1 AS item_id", "2 AS cosine")
    got = {(r["id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {*planted, (2, 77), (None, 28), (503, 29)}
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(table) - 27
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0 and decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def planted_search(sizes, seed=8):
    """A search for items of random words in a random space, their terms and the generator."""
    rng = np.random.default_rng(seed)
    n = 3000
    space = rng.standard_normal((n + 1, decontaminate.RANK)).astype(np.float32)
    space[0] = 0
    terms = [rng.integers(1, n + 1, size) for size in sizes]
    items = decontaminate.Items(list(range(len(terms))), terms, [t[-6:] for t in terms], {})
    return decontaminate.Searcher(items, space, np.append(0.0, np.ones(n))), terms, rng


def missed(search, terms, rng, replaced):
    """(item, offset) of planted copies that are not reported, with this share of the words replaced."""
    found = []
    for q, t in enumerate(terms):
        for offset in range(16):
            copy = t.copy()
            copy[rng.permutation(len(t))[: int(replaced * len(t))]] = 0
            around = [rng.integers(1, 3001, 64 + offset), copy, rng.integers(1, 3001, 80)]
            if q not in {hit[0] for hit in search(np.concatenate(around).astype(np.int32))}:
                found.append((q, offset))
    return found


def test_leaks_of_33_to_60_words_at_any_offset():
    search, terms, rng = planted_search(range(33, 61))
    assert missed(search, terms, rng, 0) == []
    assert len(missed(search, terms, rng, 0.15)) <= 30  # of 448


def test_leaks_of_long_items():
    search, terms, rng = planted_search((100, 150, 220, 300, 400, 500))
    assert missed(search, terms, rng, 0) == missed(search, terms, rng, 0.2) == []
    # one passage of an item is no leak of it
    assert not search(np.concatenate([rng.integers(1, 3001, 64), terms[5][96:160], rng.integers(1, 3001, 64)]).astype(np.int32))
    assert all({int(w) for at in decontaminate.passage_starts(n) for w in range(at, min(at + 32, n))} == set(range(n)) for n in range(1, 300))


def plain_gram(texts, idf):
    """A'A of the passages, one after the other."""
    total = np.zeros((len(idf), len(idf)))
    for terms in texts:
        for at in range(0, len(terms), decontaminate.WINDOW):
            row = np.bincount(terms[at : at + decontaminate.WINDOW], minlength=len(idf)) * idf
            total += np.outer(row, row) / max((idf[terms[at : at + decontaminate.WINDOW]] ** 2).sum(), 1e-9)
    return total


def test_the_latent_space_is_fitted_on_every_document(spark, monkeypatch):
    seen = []
    product = decontaminate.gram_product

    def counted(stored, *more):
        seen.append(stored.count())
        return product(stored, *more)

    monkeypatch.setattr(decontaminate, "gram_product", counted)
    words = [f"w{i}" for i in range(40)]
    random.seed(3)
    table = [(i, sentence(words, 5)) for i in range(6_500)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    decontaminate.find_leaks(documents(spark, table), bench).count()
    assert seen and set(seen) == {6_500}


def test_products_with_the_passages_of_all_texts(spark):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 60, n).astype(np.int32) for n in (0, 1, 31, 32, 33, 500, 70_000)] + [np.zeros(40, np.int32)]
    idf = np.append(0.0, rng.random(59) + 0.1)
    thin = rng.standard_normal((60, 7))
    stored = spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "terms binary").repartition(3)
    gram = plain_gram(texts, idf)
    assert np.allclose(decontaminate.gram_product(stored, idf, thin), gram @ thin, rtol=1e-4, atol=1e-2)
    assert np.allclose(decontaminate.projected_gram(stored, idf, thin), thin.T @ gram @ thin, rtol=1e-4, atol=1e-2)


def test_leaks_of_documents_searched_together_are_those_of_each_alone():
    search, terms, rng = planted_search(range(8, 60))
    texts = [np.concatenate([rng.integers(1, 3001, k * 7), t, rng.integers(1, 3001, k % 9)]).astype(np.int32) for k, t in enumerate(terms)]
    texts[3:3] = [np.empty(0, np.int32), rng.integers(1, 3001, 40_000).astype(np.int32), terms[0][:3].astype(np.int32)]
    together = search.search(texts)
    assert [[h[0] for h in found] for found in together] == [[h[0] for h in search(t)] for t in texts]
    assert {h[0] for found in together for h in found} == set(range(len(terms))) and search.search([]) == []


def test_many_label_values_end_in_seconds(spark):
    random.seed(2)
    words = {f"q{k:03d}": [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{c}" for c in "abcdef"] for k in range(300)}
    table = [(i * 300 + k, sentence(words[f"q{k:03d}"], 12), f"q{k:03d}") for k in range(300) for i in range(3)]
    table += [(100_000 + i, sentence({"en": EN, "de": DE}[lang], 12), lang) for i, lang in enumerate(["en", "de"] * 40)]
    docs = documents(spark, table)
    started = time.time()
    model = language_id.train(docs, "doc_id", "text", "lang", max_languages=150)
    assert time.time() - started < 60
    assert sorted(model.families) == ["germanic", "other"] and sum(map(len, model.families.values())) <= 150
    assert len(model.pairs) == 1 + 1 + len(model.families["other"])
    got = language_id.predict_languages(docs.filter("doc_id >= 100000")).collect()
    assert all(r["lang_pred"] in ("en", "de") for r in got)
    assert language_id.train(docs, "doc_id", "text", "lang", least_rows=20).families == {"germanic": ["de", "en"]}


def test_machines_of_tasks_are_those_of_a_plain_loop(spark):
    random.seed(4)
    rows = [(i, sentence({"en": EN, "de": DE, "fr": FR, "xa": ["zz", "yy"], "xb": ["kk", "jj"]}[lang], 12), lang) for i, lang in enumerate(["en", "de", "fr", "xa", "xb"] * 20)]
    model = language_id.train(documents(spark, rows), "doc_id", "text", "lang", sample_rows=10**6)
    seen = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    plain = language_id.fit_languages(sorted(((lang, language_id.letter_grams(text)) for _, text, lang in seen), key=lambda r: (r[0], r[1].astype(np.float16).tobytes())))
    assert model.families == plain.families and model.pairs == plain.pairs
    for _, text, lang in rows:
        a, b = (m.predict(language_id.letter_grams(text)) for m in (model, plain))
        assert a[0] == b[0] == lang and abs(a[1] - b[1]) < 1e-4


def test_a_lexicon_as_a_table_gives_the_same_evidence(spark):
    random.seed(6)
    words = ["idiot", "loser", "scum", "that", "the", "not", "book", "see", "idiots", "pathetic"]
    counts = {}
    for w in words * 20:
        s = [0, 0, *toxicity.symbols(f" {w} ").tolist()[1:]]
        for a, b, c in zip(s, s[1:], s[2:]):
            counts[(a * 64 + b) * 64 + c] = counts.get((a * 64 + b) * 64 + c, 0) + 1
    model = toxicity.CharModel(counts)
    lexicon = {"=idiot": 0.9, "<idio": 0.6, "=scum": 0.8, "=loser": 0.7, ">etic": 0.55, "=wörd": 0.9}
    table = spark.createDataFrame(list(lexicon.items()), "feature string, least double")
    texts = [None, "", "you 1d10t", "s c u m", "the book", "idiots idiot pathetic loser scum", "wörd", "i d i o t. l0ser", "that not see " * 500]
    texts += [" ".join(random.choices(words, k=5)) for _ in range(40)]
    docs = spark.createDataFrame([(i % 45, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)
    here = toxicity.Evidence(model, lexicon)
    want = sorted((i % 45, here(t or "")) for i, t in enumerate(texts))
    for bits in (22, 6):  # a full bit set lets everything through to the join
        got = sorted((r["id"], r["evidence"]) for r in toxicity.gather_evidence(docs, model, table, bits).collect())
        assert [g[0] for g in got] == [w[0] for w in want] and all(abs(g[1] - w[1]) < 1e-12 for g, w in zip(got, want))
    assert max(w[1] for w in want) > 0.9
    known = toxicity.FeatureFilter(table)
    assert all(f in known for f in lexicon) and sum(f"={i}" in known for i in range(2_000)) < 20
    assert {r["evidence"] for r in toxicity.gather_evidence(docs, model, table.limit(0)).collect()} == {0.0}
