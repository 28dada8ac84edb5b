import math
import random
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pageloom.functions.text import singular_english, tokenize
from pageloom.operators import terms as tm
from pageloom.operators.sampling import resample
from pageloom.sources.words import default_stop_words, read_words

LARGE = tm.BROADCAST_ROWS + 1  # a bound that rules a broadcast out

TEXTS = [
    "The cat-sat on_it THE Cats 2cats naïve café Москва ab abc",
    "one",
    "two words words",
    "",
    "the the the the zebra",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    words = [chr(97 + i) * 3 for i in range(26)] + ["common"]
    data = [(i, ["common"] + rng.choices(words, k=rng.randint(1, 60))) for i in range(200)]
    return data, spark.createDataFrame(data, "doc_id long, terms array<string>").cache()


def by_id(df, value="terms"):
    return {r["doc_id"]: r[value] for r in df.collect()}


def test_tokens(docs):
    got = by_id(docs.select("doc_id", tokenize("text").alias("terms")))
    assert got[0] == ["the", "the", "cats", "caf", "abc"]
    assert got[3] == []


def test_tokens_unicode(docs):
    got = by_id(docs.select("doc_id", tokenize("text", "unicode").alias("terms")))
    assert got[0] == ["the", "the", "cats", "cats", "naïve", "café", "москва", "abc"]


def test_at_least_two_terms(docs):
    assert sorted(by_id(tm.tokenize_documents(docs))) == [0, 2, 4]
    assert sorted(by_id(tm.tokenize_documents(docs, min_terms=1))) == [0, 1, 2, 4]


def test_stop_words_keep_repeats_of_others(docs):
    got = by_id(tm.tokenize_documents(docs, stop_words=["the", "one"]))
    assert got == {0: ["cats", "caf", "abc"], 2: ["two", "words", "words"]}


def test_rule_before_or_after_stop_words(docs):
    after = by_id(tm.tokenize_documents(docs, stop_words=["word"], singular=True))
    before = by_id(tm.tokenize_documents(docs, stop_words=["word"], singular=True, stop_first=True))
    assert 2 not in after
    assert before[2] == ["two", "word", "word"]


def test_singular(spark):
    words = ["ponies", "aies", "horses", "shoes", "cats", "glass", "bus", "gas", "series"]
    df = spark.createDataFrame([(1, words), (2, [])], "doc_id long, terms array<string>")
    got = by_id(df.select("doc_id", singular_english("terms").alias("terms")))
    assert got == {1: ["pony", "aie", "horse", "shoe", "cat", "glass", "bus", "ga", "sery"], 2: []}


def test_counts_against_counter(corpus):
    data, df = corpus
    got = {(r["doc_id"], r["term"]): (r["tf"], r["n_terms"]) for r in tm.term_counts(df).collect()}
    assert got == {(i, t): (n, len(terms)) for i, terms in data for t, n in Counter(terms).items()}
    assert by_id(tm.document_lengths(df), "n_terms") == {i: len(t) for i, t in data}
    assert tm.corpus_size(df).first()["n_docs"] == len(data)


def test_counting_in_a_document_does_not_shuffle(corpus):
    plan = tm.term_counts(corpus[1])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def frequencies(data):
    return Counter(t for _, terms in data for t in set(terms))


def test_document_frequency_and_ties(corpus):
    data, df = corpus
    true = frequencies(data)
    assert {r["term"]: r["df"] for r in tm.document_frequency(df).collect()} == true
    top = [r["term"] for r in tm.vocabulary(df, 7).orderBy("idx").collect()]
    assert top == sorted(true, key=lambda t: (-true[t], t))[:7]
    rare = {r["term"] for r in tm.document_frequency(df, 5, order="rarest").collect()}
    assert rare == set(sorted(true, key=lambda t: (true[t], t))[:5])


@pytest.mark.parametrize("n", [1, 3, 26, 27, 28, 500])
def test_most_frequent_at_any_cut(corpus, n):
    data, df = corpus
    true = frequencies(data)
    order = sorted(true, key=lambda t: (-true[t], t))[:n]
    assert {r["term"] for r in tm.document_frequency(df, n).collect()} == set(order)
    assert [(r["idx"], r["term"]) for r in tm.vocabulary(df, n).orderBy("idx").collect()] == list(enumerate(order))


def test_ranking_reuses_the_counts(docs):
    df = tm.vocabulary(tm.tokenize_documents(docs), 3)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n_terms", [10, 1000])
@pytest.mark.parametrize("bound", [None, 1000, LARGE])
def test_tfidf(corpus, n_terms, bound):
    data, df = corpus
    true = frequencies(data)
    order = sorted(true, key=lambda t: (-true[t], t))[:n_terms]
    index = {t: i for i, t in enumerate(order)}
    expected = {
        (d, index[t]): math.log(len(data) / true[t]) * n / len(terms)
        for d, terms in data for t, n in Counter(terms).items() if t in index
    }
    got = {(r["doc_id"], r["idx"]): r["w"] for r in tm.tfidf(df, tm.vocabulary(df, n_terms), bound).collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-12 for k in got)
    assert all(got[k] == 0 for k in got if k[1] == 0), "a term of every document weighs nothing"

    vocab = tm.vocabulary(df, n_terms).orderBy("idx").toPandas()
    vectors = tm.document_vectors(df, vocab["term"].tolist(), vocab["idf"].tolist())
    for r in vectors.select("doc_id", vector_to_array("w").alias("w")).collect():
        for i, w in enumerate(r["w"]):
            assert abs(w - expected.get((r["doc_id"], i), 0.0)) < 1e-12


@pytest.mark.parametrize("rows", [None, 10, LARGE])
def test_lemmas(spark, rows):
    docs = spark.createDataFrame(
        [(1, "en", "x", ["mice", "mouse", "ran", "mice"]), (2, "de", "y", ["mice"]), (3, "en", "z", [])],
        "doc_id long, lang string, title string, terms array<string>",
    )
    lemmas = spark.createDataFrame([("en", "mice", "mouse"), ("en", "ran", "run")], "lang string, term string, lemma string")
    got = {(r["doc_id"], r["title"]): Counter(r["terms"]) for r in tm.normalize_terms(docs, lemmas, rows).collect()}
    assert got == {(1, "x"): Counter(mouse=3, run=1), (2, "y"): Counter(mice=1), (3, "z"): Counter()}


@pytest.mark.parametrize("rows", [None, 10, LARGE])
def test_stop_table(spark, corpus, rows):
    data, df = corpus
    table = spark.createDataFrame([("common",), ("aaa",), ("aaa",)], "term string")
    left = tm.drop_stop_terms(tm.term_counts(df), table, rows)
    assert left.count() == tm.term_counts(df).where("term NOT IN ('common', 'aaa')").count()


@pytest.mark.parametrize("measured", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_large_lookup_salts_hot_terms_only(corpus, monkeypatch, how, measured):
    data, df = corpus
    counts = tm.term_counts(df)
    table = df.sparkSession.createDataFrame([("common", 1), ("aaa", 2), ("nowhere", 3)], "term string, x int")
    expected = Counter(tuple(r) for r in counts.join(table, ["term"], how).collect())
    sizes = tm.document_frequency(df).withColumnRenamed("df", "rows") if measured else None
    look = lambda: tm.lookup(counts, table, ["term"], how, LARGE, sizes=sizes)
    plain = look()
    assert "_salt" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(tuple(r) for r in plain.collect()) == expected

    most = max(frequencies(data).values())
    monkeypatch.setattr(tm, "HOT_ROWS", max(1, most // 3))
    salted = look()
    assert salted.columns == plain.columns
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(tuple(r) for r in salted.collect()) == expected


def test_hot_keys(spark, monkeypatch):
    sizes = spark.createDataFrame([("a", 95), ("b", 30), ("c", 29), (None, 60)], "term string, rows long")
    hashes = {r["term"]: r["h"] for r in sizes.select("term", F.xxhash64("term").alias("h")).collect()}
    assert tm.hot_keys(sizes, ["term"]) is None and tm.hot_keys(sizes.limit(0), ["term"]) is None
    monkeypatch.setattr(tm, "HOT_ROWS", 30)
    got = dict(map(tuple, tm.hot_keys(sizes, ["term"]).collect()))
    assert got == {hashes["a"]: 4, hashes["b"]: 1, hashes[None]: 2}
    monkeypatch.setattr(tm, "HOT_KEYS", 3)  # 214 rows, so from 72 on
    assert dict(map(tuple, tm.hot_keys(sizes, ["term"]).collect())) == {hashes["a"]: 2}


@pytest.mark.parametrize("large", [False, True])
def test_terms_through_large_tables(spark, monkeypatch, large):
    """Hot, repeated and null terms, documents without terms, and a null id."""
    data = [(1, "en", {"k": "v"}, ["mice", "the", "mice", None]), (2, "en", None, []), (3, None, None, None), (None, "en", None, ["the", "ran"]), (5, "de", None, ["mice"])]
    docs = spark.createDataFrame(data, "doc_id long, lang string, more map<string,string>, terms array<string>")
    lemmas = spark.createDataFrame([("en", "mice", "mouse"), ("en", "ran", "run"), ("de", "x", None)], "lang string, term string, lemma string")
    stops = spark.createDataFrame([("the",), ("the",), (None,)], "term string")
    if large:
        monkeypatch.setattr(tm, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(tm, "HOT_ROWS", 1)
    mapped = tm.normalize_terms(docs, lemmas)
    left = tm.drop_stop_words(docs, stops)
    assert mapped.columns == [*docs.drop("terms").columns, "terms"] and left.columns == docs.columns
    assert {i: t or [] for i, t in by_id(mapped).items()} == {1: ["mouse", "the", "mouse", None], 2: [], 3: [], None: ["the", "run"], 5: ["mice"]}
    rows = {r["doc_id"]: r for r in left.collect()}
    assert {i: r["terms"] or [] for i, r in rows.items()} == {1: ["mice", "mice", None], 2: [], 3: [], None: ["ran"], 5: ["mice"]}
    assert rows[1]["more"] == {"k": "v"}


def test_small_tables_are_measured(spark, monkeypatch):
    table = spark.createDataFrame([("word", 1), ("longer word", 2)], "term string, x int")
    assert tm.is_small(table) and tm.is_small(table, 2) and not tm.is_small(table, LARGE)
    monkeypatch.setattr(tm, "BROADCAST_CHARS", 5)
    assert not tm.is_small(table)
    monkeypatch.setattr(tm, "BROADCAST_ROWS", 1)
    assert not tm.is_small(table)


def test_word_files(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("the\nours\tourselves\n\nthe\n")
    assert sorted(r["term"] for r in read_words(spark, str(path)).collect()) == ["ours", "ourselves", "the"]
    assert "the" in default_stop_words()


def test_resample(spark):
    df = spark.range(0, 105, 5)
    assert df.count() == 21
    drawn = resample(df, 4.0, seed=7)
    assert drawn.count() == resample(df, 4.0, seed=7).count() > 21
    assert drawn.join(df, "id", "left_anti").count() == 0
    big = resample(spark.range(20000), 4.0, seed=1).groupBy().agg(F.count("*")).first()[0]
    assert abs(big - 80000) < 2000


@pytest.mark.parametrize("chunk", [1, 7])
def test_chunks_ask_for_distinct_terms(spark, monkeypatch, chunk):
    """No row for each place of a term; chunks, repeated ids and null ids give what single rows do."""
    monkeypatch.setattr(tm, "CHUNK_TERMS", chunk)
    data = [(i, "en" if i % 2 else "de", ["mice", "x", "mice", None][: i % 5]) for i in range(12)] + [(20, "en", ["b", "mice"]), (20, "de", ["mice", "a", "z"])]
    docs = spark.createDataFrame(data, "doc_id long, lang string, terms array<string>")
    lemmas = spark.createDataFrame([("en", "mice", "mouse"), ("de", "mice", "maus"), (None, "x", "y")], "lang string, term string, lemma string")
    mapped = tm.normalize_terms(docs, lemmas, LARGE)
    left = tm.drop_stop_words(docs, lemmas.select("term"), LARGE)
    for df in (mapped, left):
        assert "posexplode" not in df._jdf.queryExecution().optimizedPlan().toString()
    word = {"en": "mouse", "de": "maus"}
    want = {i: [word[lang] if t == "mice" else t for t in terms] for i, lang, terms in data if i < 20}
    assert {r["doc_id"]: r["terms"] for r in mapped.where("doc_id < 20").collect()} == want
    assert {r["doc_id"]: r["terms"] for r in left.where("doc_id < 20").collect()} == {i: [t for t in terms if t is None] for i, _, terms in data if i < 20}
    assert [r["terms"] for r in mapped.where("doc_id = 20").collect()] == [["b", "maus", "a", "mouse", "z"]] * 2
    assert [r["terms"] for r in left.where("doc_id = 20").collect()] == [["b", "a", "z"]] * 2
