import random
import struct
import zlib
from collections import defaultdict

import pytest

from pageloom.llm.packing import Encoder, balance, default_tokenizer, merge_ranks, pack

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def words(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def check(df, plain):
    rows, pieces = df.collect(), pack(df).collect()
    expected, got = defaultdict(list), defaultdict(list)
    for r in rows:
        expected[r["doc_id"]].append(plain(r["text"]))
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
        got[p["doc_id"]].append((p["doc_tokens"], p["start"], p["length"], p["ids_crc32"]))
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    assert set(got) == set(expected)
    for doc_id, texts in expected.items():
        assert sum(n for _, _, n, _ in got[doc_id]) == sum(map(len, texts))
        for total, start, length, crc in got[doc_id]:
            assert any(len(t) == total and zlib.crc32(words(t[start : start + length])) == crc for t in texts)
    return pieces


def test_odd_rows(odd_docs, plain):
    check(odd_docs, plain)


def test_sample(sample, plain):
    check(sample[1], plain)


def test_empty(no_docs):
    assert pack(no_docs).count() == 0


def test_encoder_agrees(plain):
    random.seed(5)
    parts = ["'s", " ", "  ", "\n", "\n\n ", "a", "b's", "12", "!!", " x", "é", "　", "\x1c", "<|endoftext|>", "\t \t"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(30))) for _ in range(500)]
    coder = Encoder(default_tokenizer())
    assert coder._encode is not None and merge_ranks(default_tokenizer())
    assert list(coder.encode(texts)) == [words(plain(t)) for t in texts]


def test_balance():
    random.seed(2)
    for _ in range(50):
        pieces = [(random.choice([random.randint(1, 1023), 600, 3]), i) for i in range(random.randrange(1, 200))]
        out = balance(pieces)
        sums = [sum(n for _, _, n in s) for s in out]
        assert all(s == 1024 or s & (s - 1) == 0 for s in sums) and sum(sums) == sum(n for n, _ in pieces)
        covered = defaultdict(list)
        for s in out:
            for name, start, n in s:
                covered[name].append((start, n))
        for length, name in pieces:
            at = 0
            for start, n in sorted(covered[name]):
                assert start == at
                at += n
            assert at == length


def test_costs_are_balanced():
    out = balance([(512, i) for i in range(40)])
    assert all(len(s) == 2 for s in out)
