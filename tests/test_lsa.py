import math
import random
from collections import Counter

import numpy as np
import pytest

from pageloom.operators import lsa as ls


def documents(seed, n=120, words=30):
    rng = random.Random(seed)
    pool = [chr(97 + i % 26) * 3 + ("x" if i >= 26 else "") for i in range(words)]
    topics = [rng.sample(pool, 8) for _ in range(4)]
    return [(i, f"title {i}", rng.choices(topics[i % 4] + ["every"], k=25) + ["every"]) for i in range(n)]


def matrix_of(data, n_terms):
    freq = Counter(t for *_, terms in data for t in set(terms))
    order = sorted(freq, key=lambda t: (-freq[t], t))[:n_terms]
    a = np.zeros((len(data), len(order)))
    for row, (*_, terms) in enumerate(data):
        for t, n in Counter(terms).items():
            if t in order:
                a[row, order.index(t)] = math.log(len(data) / freq[t]) * n / len(terms)
    return a, order


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, title string, terms array<string>")


def factors_of(model):
    terms = sorted(model.terms.collect(), key=lambda r: r["idx"])
    docs = sorted(model.docs.collect(), key=lambda r: r["id"])
    return np.array([r["vec"] for r in docs]), np.array(model.sigma), np.array([r["vec"] for r in terms]), [r["id"] for r in terms]


@pytest.mark.parametrize("k", [4, 7])
def test_against_numpy(spark, k):
    data = documents(1)
    a, order = matrix_of(data, 50)
    u, s, v, terms = factors_of(ls.lsa(frame(spark, data), k, 50))
    assert terms == order
    nu, ns, nvt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(s, ns[:k], atol=1e-9)
    sign = np.sign((v * nvt[:k].T).sum(axis=0))
    assert np.allclose(v, nvt[:k].T * sign, atol=1e-7)
    assert np.allclose(u, nu[:, :k] * sign, atol=1e-7)
    assert np.allclose(u.T @ u, np.eye(k), atol=1e-8)
    assert np.allclose(a @ v, u * s, atol=1e-9)
    assert all(v[np.argmax(np.abs(v[:, c])), c] > 0 for c in range(k))


def test_rank_below_k_and_a_zero_row(spark):
    data = [(i, "", ["aaa", "bbb"] * 2 + ["every"]) for i in range(4)] + [(4, "", ["every", "every"])]
    model = ls.lsa(frame(spark, data), 3, 10)
    u, s, v, _ = factors_of(model)
    assert len(s) == 1 and u.shape == (5, 1) and v.shape == (3, 1)
    assert abs(u[4, 0]) < 1e-12
    assert ls.concept_strength(model).count() == 1


def test_tables(spark):
    data = documents(2)
    model = ls.lsa(frame(spark, data), 4, 50, keep=("title",))
    u, s, v, terms = factors_of(model)
    n_terms = len(terms)

    top = ls.top_terms(model, 5, 3).orderBy("concept", "rank").collect()
    expected = [
        (c, terms[i]) for c in range(3)
        for i in sorted(range(n_terms), key=lambda i: (-round(v[i, c], 6), terms[i]))[:5]
    ]
    assert [(r["concept"], r["term"]) for r in top] == expected
    best = ls.top_docs(model, 5, 3).orderBy("concept", "rank").collect()
    expected = [(c, i) for c in range(3) for i in sorted(range(len(data)), key=lambda i: (-round(u[i, c], 6), i))[:5]]
    assert [(r["concept"], r["doc_id"]) for r in best] == expected

    table = ls.relevance_table(model, top_n=None, doc_key="title")
    assert table.columns == ["data_type", "ref", "key", "score"]
    kinds = {r["data_type"]: r["count"] for r in table.groupBy("data_type").count().collect()}
    live = int((np.abs(v).sum(axis=1) > 1e-9).sum())
    assert kinds["concept_strength"] == 4
    assert kinds["term_to_concept"] == 4 * n_terms
    assert kinds["doc_to_concept"] == 4 * len(data)
    assert kinds["term_to_term"] in (live**2, n_terms**2)
    assert table.where("data_type = 'concept_strength' AND key IS NULL").count() == 4
    assert table.where("data_type = 'doc_to_concept' AND key = 'title 7'").count() == 4


def test_term_pairs(spark):
    model = ls.lsa(frame(spark, documents(3)), 4, 50)
    _, s, v, terms = factors_of(model)
    vs = v * s
    live = [i for i in range(len(terms)) if np.linalg.norm(vs[i]) > 1e-9]
    unit = vs / np.maximum(np.linalg.norm(vs, axis=1, keepdims=True), 1e-300)
    got = {(r["id"], r["other"]): r["score"] for r in ls.term_neighbors(model, None).collect()}
    for i in live:
        for j in live:
            assert abs(got[terms[i], terms[j]] - unit[i] @ unit[j]) < 2e-6


def test_nothing_weighs_anything(spark):
    data = [(i, "", ["every", "always"]) for i in range(5)]
    model = ls.lsa(frame(spark, data), 2, 10)
    assert model.sigma == []
    assert ls.relevance_table(model).count() == 0
    assert ls.top_terms(model).count() == 0 and ls.top_docs(model).count() == 0


def test_no_documents(spark):
    with pytest.raises(ValueError):
        ls.lsa(frame(spark, documents(1)).where("doc_id < 0"), 2, 5)


def test_vocabulary_too_large_for_the_driver(spark, monkeypatch):
    """Blocks of documents give the factors of a dense decomposition; ids repeat, a document has no term, and no vocabulary comes to the driver."""
    import pageloom.operators.krylov as krylov
    import pageloom.operators.lsa as module

    rng = np.random.default_rng(5)
    words = [f"w{i:03}" for i in range(150)]
    texts = [[words[int(x)] for x in rng.zipf(1.4, size=int(rng.integers(2, 40))) % 150] for _ in range(60)] + [[]]
    docs = spark.createDataFrame([(i // 2, "k", t) for i, t in enumerate(texts)], "doc_id long, key string, terms array<string>")
    monkeypatch.setattr(module, "DRIVER_TERMS", 20)
    monkeypatch.setattr(module, "_right_factor", None)
    monkeypatch.setattr(krylov, "BLOCK_TERMS", 300)
    model = module.lsa(docs, 4, None, keep=("key",))
    terms, found = model.terms.toPandas().sort_values("idx"), model.docs.toPandas()
    place = {t: i for i, t in enumerate(terms["id"])}
    counts = np.zeros((len(texts), len(terms)))
    for i, t in enumerate(texts):
        for word in t:
            counts[i, place[word]] += 1 / len(t)
    matrix = counts * np.log(len(texts) / (counts > 0).sum(axis=0))
    u, s, vt = np.linalg.svd(matrix)
    assert np.allclose(model.sigma, s[:4], rtol=1e-10)
    v = np.stack(terms["vec"])
    signs = np.sign((v * vt[:4].T).sum(axis=0))
    assert np.allclose(v, vt[:4].T * signs, atol=1e-8)
    assert (v[np.abs(v).argmax(axis=0), range(4)] > 0).all()
    best = lambda ids, vec: sorted((i, *np.round(x, 6) + 0.0) for i, x in zip(ids, vec, strict=True))
    assert np.allclose(best(found["id"], np.stack(found["vec"])), best([i // 2 for i in range(len(texts))], u[:, :4] * signs), atol=1e-5)
    assert set(found["key"]) == {"k"}
    model.close()
