from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st

from pageloom.llm.mixing import mix, mixed, phases, schedule, shares_of


@given(st.lists(st.integers(1, 30), min_size=1, max_size=12))
@settings(deadline=None, max_examples=60)
def test_lag_stays_below_one_block(shares):
    slots, period = schedule(shares), sum(shares)
    done = [0] * len(shares)
    for t, i in enumerate(slots, 1):
        done[i] += 1
        assert all(abs(Fraction(s * t, period) - d) < 1 for s, d in zip(shares, done, strict=True))
    assert done == shares


@given(st.lists(st.integers(0, 60), min_size=1, max_size=6), st.integers(1, 40))
@settings(deadline=None, max_examples=60)
def test_phases_place_every_block_once(blocks, slots):
    used = []
    for p in phases(blocks, [1.0 + i for i in range(len(blocks))], slots):
        for j in range(p["from_block"], p["to_block"]):
            nth = j - p["from_block"]
            used.append(p["first_slot"] + nth // p["share"] * p["period"] + p["at"][nth % p["share"]])
    assert sorted(used) == list(range(sum(blocks)))


def test_shares():
    assert shares_of([1, 1, 2], 8) == [2, 2, 4] and sum(shares_of([0.3, 0.3, 0.3], 100)) == 100 and min(shares_of([1e-9, 1], 10)) == 1


def check(df, block=16, **options):
    got = mix(df, block=block, **options).collect()
    assert len(got) == df.count() and len({r["position"] for r in got}) == len(got)
    by_slot = {}
    for r in got:
        assert by_slot.setdefault(r["slot"], r["source"]) == r["source"]
    return got, by_slot


def test_odd_rows(odd_docs):
    check(odd_docs, block=2)
    out = mixed(odd_docs)
    assert out.columns == odd_docs.columns
    assert sorted(out.collect(), key=repr) == sorted(odd_docs.collect(), key=repr)


def test_hot_source(make_docs):
    docs = make_docs([(i, "t", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(9000)])
    got, by_slot = check(docs, weights={"hot": 3.0})
    sources = [by_slot[s] for s in sorted(by_slot)]
    assert sorted(by_slot) == list(range(len(by_slot)))
    names = sorted(set(sources))
    weight = {n: (3.0 if n == "hot" else 1.0) for n in names}
    shares = dict(zip(names, shares_of([weight[n] for n in names], 1000), strict=True))
    done = dict.fromkeys(names, 0)
    for t, s in enumerate(sources[:80], 1):
        done[s] += 1
        assert all(abs(shares[n] * t / sum(shares.values()) - done[n]) < 1 for n in names)


def test_same_again(make_docs):
    docs = make_docs([(i % 40, "t", "en", f"s{i % 3}") for i in range(300)])
    a, b = (sorted((r["position"], r["doc_id"], r["source"]) for r in mix(d).collect()) for d in (docs, docs.repartition(3)))
    assert a == b


def test_empty(no_docs):
    assert mix(no_docs).count() == 0


def test_too_many_sources(make_docs):
    with pytest.raises(ValueError, match="sources"):
        mix(make_docs([(i, "t", "en", f"s{i}") for i in range(300)]))


def test_exact_weights_over_many_periods(spark):
    """Against the target weights themselves, in far more slots than any period; the slots stand in the tables that mix() reads."""
    from pageloom.llm.mixing import block_slots, whole_weights
    from pageloom.llm.scratch import Scratch

    for weights in ([1, 1, 1], [1] * 7, [1e-5, 1.0], [0.3, 0.3, 0.1, 1.7]):
        whole, _ = whole_weights(dict(enumerate(weights)))
        total, n = sum(whole.values()), 9000
        blocks = [max(1, n * w // total) for w in whole.values()]
        df = spark.createDataFrame([(f"={i}", str(w), b) for (i, w), b in zip(whole.items(), blocks, strict=True)], "name string, weight string, blocks long")
        got = sorted((r["slot"], int(r["planned"][1:]), r["planned_block"]) for r in block_slots(df, Scratch(spark, "test")).collect())
        assert [g[0] for g in got] == list(range(sum(blocks)))
        done = [0] * len(weights)
        for t, (_, i, j) in enumerate(got, 1):
            assert j == done[i]
            done[i] += 1
            if any(blocks[k] * total < t * w for k, w in whole.items()):
                break  # the target of one has run out
            assert all(abs(Fraction(w * t, total) - done[k]) < 1 for k, w in whole.items())
        assert t > 8000


@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 12)), min_size=1, max_size=8))
@settings(deadline=None, max_examples=60)
def test_lag_where_sources_run_out(sources):
    """Against a target that moves on block by block of time, the weights of what has run out shared by the others."""
    shares, left = [s for s, _ in sources], [min(s, n) for s, n in sources]
    slots, done, at, target = schedule(shares, left), [0] * len(left), Fraction(0), [Fraction(0)] * len(left)
    for t, i in enumerate(slots, 1):
        done[i] += 1
        room = Fraction(t) - sum(target)
        while room:
            active = [k for k in range(len(left)) if target[k] < left[k]]
            step = min(room / sum(shares[k] for k in active), min((left[k] - target[k]) / shares[k] for k in active))
            for k in active:
                target[k] += step * shares[k]
            room = Fraction(t) - sum(target)
        assert all(abs(x - d) < 1 for x, d in zip(target, done, strict=True))
    assert done == left


def test_any_number_of_sources_and_weights_of_the_table(make_docs):
    """1,200 sources of one to forty rows, one of 2,000, and null; weights by the number of rows."""
    from pageloom.llm.mixing import damped

    names = [f"s{k}" for k in range(1200) for _ in range(1 + k % 40)] + ["hot"] * 2000 + [None] * 50
    docs = make_docs([(i, "t", "en", s) for i, s in enumerate(names)])
    got, by_slot = check(docs, block=4, weights=damped(), max_sources=None)
    assert sorted(by_slot) == list(range(len(by_slot))) and len(set(by_slot.values())) == 1202
    rows = {s: names.count(s) for s in ("hot", None, "s39")}
    weight = {s: names.count(s).bit_length() for s in set(names)}
    total, first_out = sum(weight.values()), min(Fraction(-(-names.count(s) // 4), w) for s, w in weight.items())
    for s in rows:
        done = 0
        for t in range(1, int(first_out * total) + 1):
            done += by_slot[t - 1] == s
            assert abs(Fraction(weight[s] * t, total) - done) < 1
    assert len(mixed(docs).collect()) == len(names)
