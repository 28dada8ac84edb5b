import random

import pytest

from pageloom.llm.packing import default_tokenizer
from pageloom.llm.token_trees import TokenTree, apply_edits, counter, sample_edits, with_trees
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
PARTS = ["'s", " ", "  ", "\n", "\n\n ", "a", "b's", "12", "!!", " x", "é", "　", "", " stone", "river. "]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def test_edits_against_a_full_count(whole):
    rng, count = random.Random(8), counter(default_tokenizer())
    texts = ["", "a", " ", "ab  cd", *["".join(rng.choice(PARTS) for _ in range(rng.randrange(2, 900))) for _ in range(40)]]
    for text in texts:
        tree = TokenTree.build(text, count)
        assert tree.tokens == whole(text)
        for _ in range(8):
            at, removed = rng.randrange(-2, len(text) + 3), rng.choice([0, 1, 2, 40, 2000])
            inserted = "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 3, 60, 3000])))
            tree.edit(at, removed, inserted, count)
            at = min(max(at, 0), len(text))
            text = text[:at] + inserted + text[at + removed :]
            assert (tree.text, tree.chars, tree.tokens) == (text, len(text), whole(text))
            assert (tree.sums[1] == tree.leaves().sum(axis=0)).all()


def test_one_edit_recounts_a_few_leaves():
    count = counter(default_tokenizer())
    tree = TokenTree.build("river and stone by the mill. " * 5000, count)
    tree.edit(60_000, 5, "a hill", count)
    assert 0 < tree.recounted < 400 < tree.sums[1, 1]


def edited(rows):
    out = []
    for r in rows:
        text = r["text"] or ""
        before = text
        for e in r["edits"] or []:
            at = min(max(e["position"], 0), len(text))
            text = text[:at] + e["inserted"] + text[at + e["removed"] :]
        out.append((r["doc_id"], before, text))
    return out


def check(df, whole):
    rows = df.collect()
    got = apply_edits(with_trees(df)).collect()
    expected = edited(rows)
    assert sorted((r["doc_id"], r["text"], r["tokens_before"], r["tokens_after"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, b, whole(a), whole(b)) for i, a, b in expected if i is not None
    )
    assert len(got) == len(rows)
    again = {r["text"]: sum(r["leaf_tokens"]) for r in got}
    assert all(again[t] == whole(t) for t in again)


def test_sample(sample, whole):
    check(sample[1].withColumn("edits", sample_edits(F.col("text"), F.col("doc_id"))), whole)


def test_odd_rows(odd_docs, whole):
    check(odd_docs.withColumn("edits", sample_edits(F.coalesce("text", F.lit("")), F.col("doc_id"))), whole)
    none = odd_docs.withColumn("edits", F.lit(None).cast("array<struct<position: int, removed: int, inserted: string>>"))
    assert all(r["tokens_before"] == r["tokens_after"] and r["recounted"] == 0 for r in apply_edits(with_trees(none)).collect())


def test_empty(no_docs):
    docs = no_docs.withColumn("edits", sample_edits(F.col("text"), F.col("doc_id")))
    assert apply_edits(with_trees(docs)).count() == 0


def test_white_space_before_a_leaf_border():
    """White space at the end of a leaf splits as it does before what the next leaf begins with, however leaves and edits fall."""
    from pageloom.llm.token_trees import Counter as PreTokens, TokenTree

    count = PreTokens(default_tokenizer())
    rng = random.Random(9)
    parts = ["\n\n \n", "\n", "'s", " a", "b", "  ", "12", "\r\n", "!?", " \t"]
    for _ in range(120):
        text = "".join(rng.choices(parts, k=rng.randrange(60, 400)))
        tree = TokenTree.build(text, count)
        for _ in range(6):
            at, gone, new = rng.randrange(len(text) + 1), rng.randrange(12), "".join(rng.choices(parts, k=rng.randrange(5)))
            text = text[:at] + new + text[at + gone :]
            tree.edit(at, gone, new, count)
            assert tree.text == text and tree.tokens == sum(count.counts(count.split(text)))
