import hashlib
import random
from collections import defaultdict

import numpy as np

from pageloom.llm.chunks import GEAR, LEAST, MOST, chunk_digests, cuts, dedup_chunks, gear_hashes, repeated_runs
from pageloom.llm.spans import without


def pieces(text):
    start = 0
    for end in cuts(text):
        yield start, end, text[start:end]
        start = end


def brute(rows):
    """Expected rows by (doc_id, text); rows with one id and text are one document given twice."""
    places = defaultdict(list)
    for r in rows:
        for start, _, data in pieces((r["text"] or "").encode()):
            places[data].append(r["doc_id"])
    out = []
    for r in rows:
        text = (r["text"] or "").encode()
        repeated = []
        for start, end, data in pieces(text):
            ids = [i for i in places[data] if i is not None]
            if len(places[data]) > 1:
                repeated.append((start, end, data, r["doc_id"] == (min(ids) if ids else None)))
        removed, covered = repeated_runs(repeated)
        out.append((r["doc_id"], len(text), covered, sum(e - s for s, e in removed), len(removed), hashlib.sha256(without(text, removed)).hexdigest()))
    return sorted(out, key=repr)


def check(df):
    assert sorted((tuple(r) for r in dedup_chunks(df).collect()), key=repr) == brute(df.collect())


def test_rolling_hash():
    data = bytes(random.Random(1).randrange(256) for _ in range(300))
    h = 0
    for i, x in enumerate(gear_hashes(np.frombuffer(data, np.uint8))):
        h = (2 * h + int(GEAR[data[i]])) & 0xFFFFFFFF
        assert h == x
    assert len(gear_hashes(np.frombuffer(b"ab", np.uint8))) == 2


def test_chunks_cover_the_text_and_resist_shifts():
    text = " ".join(random.Random(2).choice(["river", "stone", "mill", "hill", "spring", "door"]) + str(i % 97) for i in range(900)).encode()
    ends = cuts(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes.max() <= MOST and sizes[:-1].min() >= LEAST and cuts(b"") == []
    moved = {tuple(d) for d in chunk_digests(b"an insertion " + text)[1]}
    same = [tuple(d) in moved for d in chunk_digests(text)[1]]
    assert sum(same) > 0.9 * len(same)


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_sample(sample):
    check(sample[1])


def test_planted_passages(make_docs):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, planted = [], set()
    for i in range(60):
        passage = prose(60)
        for k in (0, 1):
            rows.append((100 * i + k, f"{prose(rng.randrange(5, 80))} {passage} {prose(20)}", "en", "a"))
            planted.add(100 * i + k)
        rows.append((100 * i + 2, prose(120), "en", "a"))
    got = {r["doc_id"]: r for r in dedup_chunks(make_docs(rows)).collect()}
    assert sum(got[i]["n_repeated"] > 0 for i in planted) >= 0.97 * len(planted)
    assert all(r["n_repeated"] == r["n_removed"] == 0 for i, r in got.items() if i not in planted)
    assert all(got[i]["n_removed"] == 0 for i in planted if i % 100 == 0)


def test_empty(no_docs):
    assert dedup_chunks(no_docs).count() == 0
