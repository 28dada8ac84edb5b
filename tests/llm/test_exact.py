import hashlib
import re
from collections import defaultdict

from pageloom.llm.exact import exact_groups, keep_exact, misra_gries


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        t = r["text"] or ""
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).digest()].append((-len(t), r["doc_id"] is None, r["doc_id"] or 0))
    return groups


def check(df):
    rows, groups = df.collect(), brute(df.collect())
    got = exact_groups(df).collect()
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for g in got:
        own = groups[bytes(g["sha"])]
        best = min(own)
        assert g["group_size"] == len(own)
        assert g["keep_id"] == (None if best[1] else best[2])
        kept[bytes(g["sha"])] += g["kept"]
    assert all(n == 1 for n in kept.values())


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_sample(sample):
    check(sample[1])


def test_frequent_texts(make_docs):
    """A text of a third of the rows takes the broadcast path, the others the shuffle."""
    check(make_docs([(i, "same text" if i % 3 == 0 else f"text {i % 150}", "en", "a") for i in range(900)]))


def test_misra_gries_bound(make_docs):
    df = make_docs([(i, "hot" if i % 4 == 0 else f"t{i}", "en", "a") for i in range(2000)]).selectExpr("cast(text as binary) as k")
    found = {bytes(r["key"]): r["estimate"] for r in misra_gries(df.coalesce(1), "k", 10).collect()}
    assert len(found) <= 10 and 500 - 2000 / 11 <= found[b"hot"] <= 500


def test_empty(no_docs):
    assert exact_groups(no_docs).count() == 0
    assert keep_exact(no_docs).columns == no_docs.columns


def test_stage(odd_docs):
    out = keep_exact(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == len(brute(odd_docs.collect()))
    assert exact_groups(out).where("group_size > 1").isEmpty()
