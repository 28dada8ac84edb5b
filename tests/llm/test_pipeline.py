"""The pipeline against plain Python over the same rows."""

import re
from collections import Counter

import corpus_pipeline
from pageloom.llm.language import words_of


def expected(rows):
    """Ids that stay: texts with a letter; of texts alike without white space the longest, then the lowest id; of near copies the lowest id."""
    rows = [r for r in rows if words_of(r["text"])]
    best = {}
    for r in sorted(rows, key=lambda r: (-len(r["text"]), r["doc_id"])):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"]), r)
    kept = sorted(best.values(), key=lambda r: r["doc_id"])
    sets = []
    for r in kept:
        w = r["text"].encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(kept)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [r for i, r in enumerate(kept) if find(i) == i]


def test_stages(spark, sample, tmp_path):
    rows, docs = sample
    ids = Counter(r["doc_id"] for r in expected(rows))
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        docs, before = spark.read.parquet(str(tmp_path / name)), docs
        if n < 4:
            assert docs.columns == before.columns
        if name in ("near", "mixture"):
            assert Counter(r["doc_id"] for r in docs.select("doc_id").collect()) == ids
    tokens = {}
    for p in docs.collect():
        tokens[p["doc_id"]] = tokens.get(p["doc_id"], 0) + p["length"]
        assert p["doc_tokens"] > 0
    assert set(tokens) == set(ids)
    sums = Counter()
    for p in docs.collect():
        sums[p["sequence_id"]] += p["length"]
    assert all(s == 1024 or s & (s - 1) == 0 for s in sums.values())


def test_packing_follows_the_mixture(spark, make_docs, tmp_path):
    """Sequences by number hold the documents in the order of the mixture, though its files come back in another one."""
    from pageloom.llm.mixing import damped, mix

    rows = [(i, f"text number {i} " * (1 + i % 7 + 400 * (i % 50 == 0)), "en", "abc"[min(2, i % 10)]) for i in range(20_000)]
    docs = make_docs(rows)
    place = {r["doc_id"]: r["position"] for r in mix(docs, weights=damped()).select("doc_id", "position").collect()}
    path = str(tmp_path / "mixture")
    # Later parts have more bytes each, and larger files are read first.
    corpus_pipeline.mixture(spark, docs, "").repartitionByRange(6, "n_chars").write.parquet(path)
    pieces = corpus_pipeline.packing(spark, spark.read.parquet(path), "").select("doc_id", "sequence_id").collect()
    rank = {d: n for n, d in enumerate(sorted(place, key=place.get))}
    own = {}
    for p in pieces:
        own.setdefault(p["sequence_id"], []).append(rank[p["doc_id"]])
    # A sequence mixes at most 4,096 documents that follow one another, and those of later sequences don't lie before its group.
    latest = 0
    for s in sorted(own):
        assert max(own[s]) - min(own[s]) < 4400
        assert min(own[s]) > latest - 4400
        latest = max(latest, *own[s])
    assert latest > 19_000 and any(s & 1 for s in own)
