import tracemalloc

import numpy as np
import pytest

from pageloom.llm import vectors as v
from pageloom.llm.vectors import near_vectors, spherical_kmeans, unit

SCHEMA = "vec_id long, embedding array<float>, label int, class long, cell int"


def brute(rows, cosine=0.98):
    def usable(e):
        return e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e)

    good = [i for i, r in enumerate(rows) if r[2] is not None and usable(r[1])]
    x = {i: np.array(rows[i][1], np.float32).astype(float) for i in good}
    x = {i: e / np.linalg.norm(e) for i, e in x.items()}
    links = {i: set() for i in range(len(rows))}
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= cosine:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, r in enumerate(rows):
        reached, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reached
            reached |= new
            todo += new
        ids = [rows[k][0] for k in reached if rows[k][0] is not None]
        component = min(ids) if ids else None
        out.append((r[0], len(links[i]), component, r[0] is not None and r[0] == component))
    return sorted(out, key=repr)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in near_vectors(df, **options).collect()), key=repr)
    assert got == brute(rows)


def cloud(n, seed=0, spread=0.13):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, 12))
    return [(i, (base[rng.integers(6)] + spread * rng.normal(size=12) * rng.random()).tolist(), int(rng.integers(2))) for i in range(n)]


def test_against_all_pairs(spark):
    check(spark, cloud(400))


def test_centres_take_little_memory():
    """4,096 cells, at the default sample: the products would be 4.3 GB at once."""
    points = unit(np.random.default_rng(1).normal(size=(v.SAMPLE_PER_CELL * v.MAX_CELLS, 8)))
    tracemalloc.start()
    try:
        centres = spherical_kmeans(points, v.MAX_CELLS, 1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(centres) > 4000 and peak < 500e6


def test_slices_give_the_same_centres(monkeypatch):
    points = unit(np.random.default_rng(2).normal(size=(500, 6)))
    whole = spherical_kmeans(points, 20)
    monkeypatch.setattr(v, "SLICE_ROWS", 7)
    assert np.allclose(spherical_kmeans(points, 20), whole)


def test_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(v, "CELL_ROWS", 8)
    monkeypatch.setattr(v, "BLOCK_ROWS", 20)
    check(spark, cloud(350, 1))


def test_odd_rows(spark):
    e = [1.0, 2.0, 3.0]
    rows = [
        (5, e, 1), (6, e, 1), (6, e, 1), (7, [2.0, 4.0, 6.0], 1), (8, e, 2), (9, e, None), (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 2.0], 1),
        (10, [float("nan"), 1.0, 1.0], 1), (11, [float("inf"), 1.0, 1.0], 1), (12, [1.0, 2.0], 1), (13, [1.0, 2.0], 1), (None, e, 1), (None, [9.0, 0.0, 0.0], 1), (14, [-0.0, 1.0, 0.0], 3), (15, [0.0, 1.0, 0.0], 3),
    ]
    check(spark, rows)


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_link_is_lost_at_cell_borders():
    rng = np.random.default_rng(3)
    x = unit(rng.normal(size=(500, 5)))
    y = unit(x + 0.08 * rng.normal(size=x.shape))
    points = np.concatenate([x, y])
    centres = spherical_kmeans(points, 40)
    home, copy = v.near_cells(points, centres, 0.98)
    for i, j in zip(*np.nonzero(points @ points.T >= 0.98), strict=True):
        assert home[i] == home[j] or copy[i, home[j]] or copy[j, home[i]]


@pytest.mark.parametrize("cosine", [0.9, 0.98])
def test_forest(cosine):
    linked = np.zeros((5, 5), bool)
    linked[0, 3] = linked[3, 0] = linked[3, 4] = linked[4, 3] = True
    assert v.forest(linked, np.array([7, 1, 2, 5, 9])).tolist() == [5, 1, 2, 5, 5]
