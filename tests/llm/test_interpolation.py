"""Scores against a plain dictionary model of the same texts."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import interpolation as ip
from pageloom.llm.interpolation import Model, op11_interpolation, score_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return [*WORD.findall((text or "").translate(UPPER)), "</s>"]


class Plain:
    """Counts of n-grams by dictionary, and mixture weights by buckets."""

    def __init__(self, texts, kinds, order, rounds):
        self.order = order
        self.counts = {}
        for name, used in (("all", ("train", "deleted")), ("kept", ("train",))):
            grams, contexts = Counter(), Counter()
            for text, kind in zip(texts, kinds, strict=True):
                if kind in used:
                    for gram in self.grams(text):
                        grams[gram] += 1
                        contexts[gram[:-1]] += 1
            self.counts[name] = grams, contexts
        self.total = self.counts["all"][1][()]
        self.kept = self.counts["kept"][1][()]
        self.vocabulary = sum(len(g) == 1 for g in self.counts["all"][0])
        self.weights = {}
        events = Counter(t for text, kind in zip(texts, kinds, strict=True) if kind == "deleted" for t in self.last(text))
        self.events = [(n, *self.parts(g, "kept", self.kept)) for g, n in events.items()]
        likelihoods = []
        for _ in range(rounds):
            sums, seen, likelihood = defaultdict(lambda: np.zeros(order + 1)), Counter(), 0.0
            for n, bucket, p in self.events:
                mixed = p * self.share(bucket)
                sums[bucket] += n * mixed / mixed.sum()
                seen[bucket] += n
                likelihood += n * math.log(mixed.sum())
            if not seen:
                break
            for b, s in sums.items():
                s = s + ip.PRIOR_EVENTS * self.even(b[0])
                self.weights[b] = s / s.sum()
            likelihoods.append(likelihood / sum(seen.values()))
            if len(likelihoods) > 1 and likelihoods[-1] - likelihoods[-2] <= ip.LEAST_GAIN * abs(likelihoods[-2]):
                break
        self.likelihoods = likelihoods

    def last(self, text):
        padded = ["<s>"] * (self.order - 1) + tokens(text)
        return [tuple(padded[i - self.order + 1 : i + 1]) for i in range(self.order - 1, len(padded))]

    def grams(self, text):
        return [g[-n:] for g in self.last(text) for n in range(1, self.order + 1)]

    def even(self, level):
        return np.where(np.arange(self.order + 1) <= level, 1 / (level + 1), 0.0)

    def parts(self, gram, name, total):
        grams, contexts = self.counts[name]
        p, level, bits = [1 / (self.vocabulary + 1), grams[gram[-1:]] / max(1, total)], 1, 0
        for n in range(2, self.order + 1):
            context = contexts[gram[-n:-1]]
            if context:
                level, bits = n, context.bit_length()
            p.append(grams[gram[-n:]] / context if context else 0.0)
        return (level, bits), np.array(p)

    def share(self, bucket):
        if bucket in self.weights:
            return self.weights[bucket]
        near = [b for b in self.weights if b[0] == bucket[0]]
        return self.weights[min(near, key=lambda b: (abs(b[1] - bucket[1]), b))] if near else self.even(bucket[0])

    def score(self, text):
        known = sum(self.counts["all"][0][g[-1:]] > 0 for g in self.last(text))
        base = sum(math.log10((self.counts["all"][0][g[-1:]] + 1) / (self.total + self.vocabulary + 1)) for g in self.last(text))
        score = 0.0
        for gram in self.last(text):
            bucket, p = self.parts(gram, "all", self.total)
            score += math.log10(float(p @ self.share(bucket)))
        return len(tokens(text)), known, base, score


def check(docs, order=2, rounds=3, by=7):
    rest = lambda: F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(by))
    out, model = score_texts(docs, train=rest() != 2, deleted=rest() == 3, order=order, rounds=rounds)
    rows = docs.collect()
    kinds = [{2: "test", 3: "deleted"}.get((r["doc_id"] or 0) % by, "train") for r in rows]
    plain = Plain([r["text"] for r in rows], kinds, order, rounds)
    assert (model.total, model.vocabulary) == (plain.total, plain.vocabulary)
    assert {(b >> ip.BITS, b & (1 << ip.BITS) - 1) for b in model.weights} == set(plain.weights)
    assert np.allclose(model.gains, plain.likelihoods, rtol=1e-9)
    for b, w in model.weights.items():
        assert np.allclose(w, plain.weights[b >> ip.BITS, b & (1 << ip.BITS) - 1], rtol=1e-6, atol=1e-12)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[4], 6))
    got = sorted((tuple(r) for r in out.collect()), key=key)
    want = sorted(((r["doc_id"], *plain.score(r["text"])) for r in rows), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], rtol=1e-8), (a, b)
    return model


@pytest.fixture(scope="module")
def babble(make_docs):
    rng = random.Random(5)
    words = ["The", "the", "a", "é", "Stone", "house", "hill", "by", "\x85", "x" * 300, *[f"w{i}" for i in range(60)]]
    rows = [(i, rng.choice([" ", "\n ", "\t"]).join(rng.choices(words, weights=[30] * 10 + [1] * 60, k=rng.randrange(40))), "en", "a") for i in range(120)]
    return make_docs(rows + rows[:20])


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_dictionaries(babble, order):
    model = check(babble, order)
    assert all(np.diff(model.gains) > -1e-9)  # expectation-maximisation never loses likelihood, but for the prior


@pytest.mark.parametrize(("order", "chunk"), [(2, 50), (3, 7), (4, 1)])
def test_small_chunks(babble, monkeypatch, order, chunk):
    """Texts cut over many chunks, and a part of the key range for every few bytes."""
    text = babble.where("doc_id < 12")

    def small(batches, order, parts, task, id_type):
        ip.CHUNK_TOKENS, ip.RUN_BYTES = chunk, 20
        return chunk_rows(batches, order, parts, task, id_type)

    chunk_rows = ip.chunk_rows
    monkeypatch.setattr(ip, "chunk_rows", small)
    monkeypatch.setattr(ip, "PART_BYTES", 100)
    check(text, order, rounds=2)


def test_table(sample):
    check(sample[1].where("n_chars < 300"), rounds=3)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, by=4)
    out, model = score_texts(no_docs, train=F.lit(True), deleted=F.lit(False))
    assert out.count() == 0 and (model.total, model.vocabulary) == (0, 0)
    for train in (F.lit(False), F.lit(None).cast("boolean")):  # nothing learnt: every word is the unknown one
        out, model = score_texts(odd_docs, train=train, deleted=F.lit(True), rounds=1)
        assert model.weights == {} and all((r["n_known"], r["base_score"]) == (0, 0.0) for r in out.collect())
    out, model = score_texts(odd_docs, train=F.lit(True), deleted=F.lit(None).cast("boolean"))
    assert model.weights == {} and all(r["n_known"] == r["n_tokens"] and math.isfinite(r["score"]) for r in out.collect())


def test_a_distribution():
    """Probabilities of all words and the unknown one after any context add up to one."""
    model = Model(2, 100, 3, {2 << ip.BITS | 3: np.array([0.2, 0.3, 0.5])}, [])
    grams, contexts = [np.array([60, 30, 10, 0]), np.array([4, 0, 2, 0])], [np.array([6, 6, 6, 6])]
    for context in (contexts, [np.zeros(4, int)]):
        p = ip.likelihoods(grams if context[0].any() else [grams[0], np.zeros(4)], context, 100, 3) * model.shares(ip.buckets(context, 4))
        assert abs(p.sum() - 1) < 1e-12


def test_query_beats_the_base_on_held_out_texts(spark):
    got = op11_interpolation(spark, "/root/testdata/sf0.01").toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert all(h == (zlib.crc32(str(i).encode()) % 7 == 2) for i, h in zip(got["doc_id"], got["held_out"], strict=True))
    held = got[got["held_out"]]
    # Bits a token: the mixture is well below the base.
    assert held["score"].sum() > 0.95 * held["base_score"].sum() and len(held) > 50


def test_memory_of_a_chunk():
    """What a chunk asks for takes a bounded number of bytes a token beside it (81, where 133 were taken with the place of every key)."""
    rng = np.random.default_rng(1)
    n = 200_000
    words = ip.word_keys([b"w%d" % i for i in range(30_000)])
    first = np.zeros(n, bool)
    first[::400] = True
    chunk = ip.Chunk(words, rng.integers(0, len(words), n).astype(np.int32), first, np.ones(n, bool), np.ones(n, np.int8))
    tracemalloc.start()
    try:
        next(ip.asked(chunk, 2, 1))
        assert tracemalloc.get_traced_memory()[1] < 100 * n
    finally:
        tracemalloc.stop()
