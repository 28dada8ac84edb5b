import numpy as np
import pandas as pd
import pytest

from pyspark.sql import Observation

from pageloom.operators import factors


@pytest.fixture(scope="module")
def matrix():
    m = np.random.default_rng(3).normal(size=(60, 5))
    m[7] = 0
    m[11] = m[12]
    return m


@pytest.fixture(scope="module")
def rows(spark, matrix):
    return spark.createDataFrame([(f"t{i:02d}", v.tolist()) for i, v in enumerate(matrix)], "id string, vec array<double>").cache()


def dense(df):
    return np.array([r["vec"] for r in df.orderBy("id").collect()], dtype=float)


def test_scale_and_normalize(rows, matrix):
    s = [5.0, 4.0, 3.0, 2.0, 1.0]
    assert np.allclose(dense(factors.scale_rows(rows, s)), matrix * s)
    got = dense(factors.normalize_rows(rows))
    ok = np.arange(60) != 7
    assert np.allclose(got[ok], matrix[ok] / np.linalg.norm(matrix[ok], axis=1, keepdims=True))
    assert np.isnan(got[7]).all()


def test_row_and_entries(rows, matrix):
    (r,) = factors.row_of(rows, "t03").collect()
    assert np.allclose(r["vec"], matrix[3])
    assert factors.entries(rows).count() == matrix.size


def test_rows_stay_in_their_task(rows):
    for df in (factors.scale_rows(rows, [1.0] * 5), factors.normalize_rows(rows)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("concepts", [None, 2])
def test_top_entries(rows, matrix, concepts):
    got = [(r["concept"], r["rank"], r["id"]) for r in factors.top_entries(rows, 4, concepts).orderBy("concept", "rank").collect()]
    expected = [
        (c, k + 1, f"t{i:02d}")
        for c in range(concepts or 5)
        for k, i in enumerate(sorted(range(60), key=lambda i: (-matrix[i, c], i))[:4])
    ]
    assert got == expected


def test_top_entries_are_cut_before_the_shuffle(rows):
    plan = factors.top_entries(rows, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def brute_force(matrix, n):
    unit = matrix / np.where(np.linalg.norm(matrix, axis=1) > 0, np.linalg.norm(matrix, axis=1), np.nan)[:, None]
    cosine = np.round(unit @ unit.T, 6)
    live = [i for i in range(len(matrix)) if i != 7]
    return {
        (f"t{i:02d}", f"t{j:02d}", cosine[i, j])
        for i in live for j in sorted(live, key=lambda j: (-cosine[i, j], j))[:n]
    }


@pytest.mark.parametrize("block_rows", [7, 20, 1000])
@pytest.mark.parametrize("top_n", [1, 6, None])
def test_neighbors_for_any_block_size(rows, matrix, block_rows, top_n):
    got = {tuple(r) for r in factors.neighbors(rows, top_n, block_rows=block_rows).collect()}
    assert {(a, b, round(s, 6) + 0.0) for a, b, s in got} == {(a, b, s + 0.0) for a, b, s in brute_force(matrix, top_n)}


def brute_neighbors(rows, n, digits=None):
    """All products, ranked by falling score, then id."""
    rows = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if np.linalg.norm(v)]
    out = set()
    for i, v in rows:
        scores = [(float(v @ w), j) for j, w in rows]
        if digits is not None:
            scores = [(round(s, digits), j) for s, j in scores]
        out |= {(i, j, round(s, 6) + 0.0) for s, j in sorted(scores, key=lambda x: (-x[0], x[1]))[:n]}
    return out


def groups_of_directions(n, groups, seed=1, spread=0.05):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, 8))
    return [(f"t{i:04}", (base[i % groups] + spread * rng.normal(size=8)).tolist()) for i in range(n)]


def test_planes_between_centres_leave_out_blocks(spark):
    """Rows all around, whose blocks overlap as balls: planes still keep most rows at home, and none loses a neighbour."""
    m = np.random.default_rng(8).normal(size=(3000, 4))
    rows = [(f"t{i:04d}", v.tolist()) for i, v in enumerate(m)]
    found = Observation()
    df = factors.neighbors(spark.createDataFrame(rows, "id string, vec array<double>"), 3, 9, block_rows=150, observation=found)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    score = np.round(unit @ unit.T, 9)
    expected = {(f"t{i:04d}", f"t{j:04d}") for i in range(len(m)) for j in np.lexsort((np.arange(len(m)), -score[i]))[:3]}
    assert {(r["id"], r["other"]) for r in df.collect()} == expected
    assert 0 < found.get["rows"] < 3 * len(m)


def test_strangers_give_only_what_reaches():
    unit = lambda *angles: [[float(np.cos(a)), float(np.sin(a))] for a in angles]
    a = pd.DataFrame({"id": ["a", "b"], "vec": unit(0.0, 1.0), "least": [0.99, -np.inf]})
    b = pd.DataFrame({"id": ["x", "y", "z"], "vec": unit(0.1, 0.5, 2.0)})
    got = factors._best(a, b, 2, None, reaching=True)
    assert list(zip(got["id"], got["other"], strict=True)) == [("a", "x"), ("b", "y"), ("b", "x")]
    assert factors._best(a, b[:0], 2, None, reaching=True).empty and factors._best(a[:0], b, 2, None, reaching=True).empty


@pytest.mark.parametrize("digits", [None, 3])
def test_pruned_neighbors_equal_all_products(spark, digits):
    rows = groups_of_directions(600, 12)
    rows += [(f"same{i:03}", [3.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5]) for i in range(150)]  # one direction, more rows than a block has
    rows += [("zero", [0.0] * 8), ("far", [0.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id string, vec array<double>")
    found = Observation()
    got = factors.neighbors(df, 5, digits, block_rows=40, observation=found).collect()
    expected = brute_neighbors(rows, 5, digits)
    if digits is None:  # scores that differ by rounding alone may change places
        best = lambda pairs: sorted((i, s) for i, _, s in pairs)
        assert best((r["id"], r["other"], round(r["score"], 6) + 0.0) for r in got) == best(expected)
    else:
        assert {(r["id"], r["other"], round(r["score"], 6) + 0.0) for r in got} == expected
    assert 0 < found.get["products"] < 0.4 * len(rows) ** 2


def test_neighbors_without_structure(spark):
    """Rows of no common direction: hardly a block is out of reach, and nothing is lost."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    got = factors.neighbors(df, 20, 6, block_rows=25).collect()
    assert {(r["id"], r["other"], round(r["score"], 6)) for r in got} == brute_neighbors(rows, 20, 6)
    few = factors.neighbors(df.limit(60), 50, 6, block_rows=10).collect()
    assert len(few) == 60 * 50
    assert factors.neighbors(df.limit(0), 5, block_rows=10).count() == 0


def test_whole_vocabulary(spark):
    """The query over all terms against products of all pairs in concept space."""
    import __spark_entry__ as driver
    from pageloom.operators.lsa import lsa

    sf = "/root/testdata/sf0.001"
    got = driver.lsa_term_neighbors_all(spark, sf).toPandas()
    model = lsa(driver._staged_terms(spark, sf), driver.CONCEPTS, None)
    terms = factors.scale_rows(model.terms.select("id", "vec"), model.sigma).toPandas()
    vec = np.stack(terms["vec"])
    length = np.linalg.norm(vec, axis=1)
    ids, vec = terms["id"].to_numpy()[length > 0], vec[length > 0] / length[length > 0, None]
    assert len(got) == 10 * len(ids) and len(ids) > 5000
    best = got.groupby("id")["score"].apply(lambda s: sorted(s, reverse=True))
    at = {t: i for i, t in enumerate(ids)}
    for t in ids[:: len(ids) // 200]:
        want = np.sort(np.round(vec @ vec[at[t]], 6))[::-1][:10]
        assert np.allclose(best[t], want, atol=2e-6)
