import random
from collections import defaultdict

import numpy as np
import pytest

from pageloom.llm import jaccard
from pageloom.llm.jaccard import BUCKETS, Shingler, counts_of, jaccard_groups, keep_one, may_link, signatures


def shingles(text, size=4):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, size=4, num=85):
    sets = [shingles(r["text"], size) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i]["doc_id"])
    least = {k: min((m for m in v if m is not None), default=None) for k, v in members.items()}
    return sorted(((r["doc_id"], len(sets[i]), least[find(i)]) for i, r in enumerate(rows)), key=repr)


def check(df, **options):
    got = sorted((tuple(r)[:3] for r in jaccard_groups(df, **options).collect()), key=repr)
    assert got == brute(df.collect(), options.get("size", 4), options.get("num", 85))


@pytest.fixture(scope="module")
def families(make_docs):
    """A text in the middle of copies that are less alike than it is to each, chains, and texts of every small size."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, i = [], 0
    for words in (12, 60, 150):
        base = [word() for _ in range(words)]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randrange(0, 2 + words // 40)):
                own[rng.randrange(words)] = word()
            rows.append((i, " ".join(own), "en", "a"))
            i += 1
        for k in range(10):
            base[k * words // 10] = word()
            rows.append((i, "\t".join(base).upper(), "en", "a"))
            i += 1
    for words in range(1, 12):
        base = [word() for _ in range(words)]
        rows += [(i, " ".join(base), "en", "a"), (i + 1, " ".join(base[:-1]), "en", "a")]
        i += 2
    rng.shuffle(rows)
    return make_docs(rows)


@pytest.mark.parametrize("star_rounds", [0, 1])
def test_families(families, star_rounds):
    check(families, star_rounds=star_rounds)


def test_other_threshold(families):
    check(families, size=5, num=80)


@pytest.mark.parametrize("listed", [1, 4])
def test_slices_and_blocks(families, listed, monkeypatch):
    """Signatures in slices, buckets of many blocks, and trees in place of all links."""
    for name, value in (("SLICE_ROWS", 500), ("COUNT_SETS", 3), ("LISTED_SETS", listed)):
        monkeypatch.setattr(jaccard, name, value)
    check(families, star_rounds=0)


def test_links_by_chance(make_docs, monkeypatch):
    """A passage that many texts have in common does not put them all into one cluster, of which every two sets are compared."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join([*(word() for _ in range(60)), passage, *(word() for _ in range(60))]), "en", "a") for i in range(40)]
    rows += [(100 + i, f"{rows[0][1]} {i}", "en", "a") for i in range(3)]
    seen, within = set(), jaccard._within

    def counted(links, *rest):
        seen.update(x for r in links.collect() for x in r)
        return within(links, *rest)

    monkeypatch.setattr(jaccard, "_within", counted)
    check(make_docs(rows), star_rounds=0)
    assert len(seen) == 4  # of 43 texts


def test_counts_bound_what_sets_share():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    near, far = np.unique(np.r_[a[300:], a[:150] + np.uint64(1)]), np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    counts = np.frombuffer(b"".join(map(counts_of, (a, near, far))), "<u2").reshape(-1, BUCKETS)
    sizes = np.array([len(a), len(near), len(far)])
    assert may_link(counts[0], counts, sizes[0], sizes, 85, 100).tolist() == [True, True, False]
    most = np.full((2, BUCKETS), (1 << 16) - 1, np.uint16)  # sets too large to be counted may be anything
    assert may_link(most[0], most[1], np.int64(1 << 30), np.int64(1 << 30), 85, 100)


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_sample(sample):
    check(sample[1])


def test_empty(no_docs):
    assert jaccard_groups(no_docs).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for size in [*range(6, 40), 63, 64, 65, 90, 100, 400, 1000, 5000]:
        for _ in range(8):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            drop, add = rng.integers(0, size // 6 + 1), rng.integers(0, size // 6 + 1)
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if len(b) and 100 * common >= 85 * (len(a) + len(b) - common) and len(a) + len(b) > 2 * common:
                assert np.intersect1d(signatures(a), signatures(b)).size, (size, drop, add)


def test_shingler():
    sh = Shingler(4)
    assert len(sh(b"")) == len(sh(b" \t\x0b ")) == 0 and len(sh(b"a b")) == 1
    assert (sh(b"A b c d e") == sh(b"a\nB\x0cc d e")).all() and len(sh("É é É é É".encode())) == 2


def test_stage(families, odd_docs):
    for df in (families, odd_docs):
        out = keep_one(df)
        assert out.columns == df.columns
        kept = brute(out.collect())
        named = [r for r in kept if r[1]]
        assert all(r[0] == r[2] for r in named)
        assert {r[2] for r in brute(df.collect())} == {r[2] for r in kept}
