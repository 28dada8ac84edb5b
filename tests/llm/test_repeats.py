import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pageloom.llm import repeats
from pageloom.llm.repeats import anchors, remove_repeats, repeated_windows


def brute(rows, length):
    """In the order of the rows' ids and texts, whatever the length."""
    rows = sorted(rows, key=lambda r: (repr(r["doc_id"]), r["text"] or ""))
    texts = [(r["text"] or "").encode() for r in rows]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((r["doc_id"], len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def check(df, length=repeats.LENGTH, short=None, **options):
    expected = brute(df.collect(), length)
    if short is not None:
        covered = [r[2] for r in brute(df.collect(), short)]
        expected = [(*r, n) for r, n in zip(expected, covered, strict=True)]
    got = remove_repeats(df, length=length, short=short, **options)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def overlapping(make_docs):
    """Shared passages, near copies, periods and self-repeats, with strings of 40 bytes."""
    rng = random.Random(11)
    parts = ["".join(rng.choice("abcde é") for _ in range(rng.randrange(5, 120))) for _ in range(30)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))), "en", "a") for i in range(80)]
    rows += [(100, "ab" * 300, "en", "a"), (101, "x" * 39, "en", "a"), (102, "x" * 40, "en", "a"), (103, "x" * 41, "en", "a"), (104, None, "en", "a"), (105, rows[0][1], "en", "a")]
    return make_docs(rows)


@pytest.mark.parametrize("options", [{}, {"hot_rows": 1}, {"short": 20}, {"short": 16, "hot_rows": 1}, {"short": 40}])
def test_against_every_window(overlapping, options):
    check(overlapping, 40, gram=8, **options)


def test_small_pieces_and_collections(overlapping, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE_BYTES", 64)
    monkeypatch.setattr(repeats, "COLLECTION_ROWS", 5)
    data = b"".join(b"%d " % i for i in range(200))
    assert anchors(data, 40, 8)[2].tolist()[0] == 0
    check(overlapping, 40, gram=8)


def test_odd_rows(make_docs):
    line = "Passage that is found in several places of the corpus, number "
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, line * 9, "en", "a"), (3, line * 9, "en", "a"), (None, line * 8 + "end", "en", "a"), (None, None, None, None), (4, "start " + line * 7, "en", "b"), (5, "é" * 700, "fr", "b"), (6, " ".join(map(str, range(3000))), "en", "b")]
    check(make_docs(rows))
    check(make_docs(rows), short=repeats.SHORT)


def test_sample(sample):
    check(sample[1], short=repeats.SHORT)


def test_empty(no_docs):
    assert remove_repeats(no_docs).count() == remove_repeats(no_docs, short=repeats.SHORT).count() == 0


def test_short_passages(make_docs):
    """A passage of over 50 words that has fewer bytes than a string to be removed is counted, and stays."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    passage = " ".join(word() for _ in range(52))
    assert repeats.SHORT < len(passage) < repeats.LENGTH
    text = lambda: " ".join(word() for _ in range(60))
    docs = make_docs([(i, f"{text()} {passage if i < 5 else text()} {text()}", "en", "a") for i in range(9)])
    found = {r["doc_id"]: r for r in remove_repeats(docs, short=repeats.SHORT).collect()}
    assert all(found[i]["n_repeated"] >= len(passage) and found[i]["n_removed"] == 0 for i in range(5))
    assert all(found[i]["n_repeated"] == 0 for i in range(5, 9))
    with pytest.raises(ValueError):
        remove_repeats(docs, short=repeats.LENGTH + 1)


def test_windows_cover_once():
    text = random.Random(3).randbytes(3000)
    _, place, first, last = anchors(text)
    assert first[0] == 0 and last[-1] == len(text) - repeats.LENGTH and (first[1:] == last[:-1] + 1).all()
    assert (place >= first).all() or (place >= last).all() and (place + repeats.GRAM <= first + repeats.LENGTH).all()


def test_column_wise_construction():
    """Common prefixes of neighbours against a comparison of all rows."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        rows, columns, length = 12, 40, 9
        symbols = rng.integers(0, 2, (rows, columns)).astype(np.uint8)
        symbols[6:] = symbols[rng.integers(0, 6, 6)]
        symbols[8, 13] ^= 1
        low, high = rng.integers(0, 10, rows), rng.integers(30, columns + 1, rows)
        group = np.sort(rng.integers(0, 3, rows))
        got = repeated_windows(symbols, low, high, group, length)
        for r in range(rows):
            for c in range(columns):
                full = low[r] <= c and c + length <= high[r]
                same = [q for q in range(rows) if q != r and group[q] == group[r] and low[q] <= c and c + length <= high[q] and (symbols[q, c : c + length] == symbols[r, c : c + length]).all()]
                assert got[r, c] == bool(full and same)


def test_groups_are_bounded(make_docs, monkeypatch):
    """A passage with other bytes before and after it in each text: at its edges, snippets share anchor, side and mark."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    passage, seen = word(110), []
    docs = make_docs([(i, word(rng.randrange(30, 90)) + passage + word(rng.randrange(30, 90)), "en", "a") for i in range(300)])
    deal = repeats.bounded_groups

    def dealt(rows, *args):
        out = deal(rows, *args)
        seen.extend([rows.collect(), out.collect()])
        return out

    monkeypatch.setattr(repeats, "bounded_groups", dealt)
    check(docs, 40, gram=8, hot_rows=20)
    before, after = (Counter((r["anchor"], r["side"], bytes(r["mark"])) for r in rows if r["side"] not in (repeats.KNOWN, repeats.SINGLE)) for rows in seen)
    assert max(before.values()) > 200 and max(after.values()) <= 20
    single = {(r["anchor"], bytes(r["mark"]), bytes(r["bytes"])) for r in seen[1] if r["side"] == repeats.SINGLE}
    assert single and len({s[:2] for s in single}) == len(single) and {len(s[2]) for s in single} == {40}
