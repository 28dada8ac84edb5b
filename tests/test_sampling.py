import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pageloom.operators.sampling import copies, poisson_steps, resample, resample_by_key


def by_hand(key, mean, seed):
    draw = int(hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52
    return sum(s <= draw for s in poisson_steps(mean))


def test_copies_depend_on_seed_and_key_alone(spark):
    keys = [*range(500), None, -3]
    df = spark.createDataFrame([(k, "x") for k in keys], "k long, _copy string")
    for parts in (1, 7):
        got = df.repartition(parts).select("k", copies("k", 4.0, 11).alias("n")).collect()
        assert {r["k"]: r["n"] for r in got} == {k: by_hand(k, 4.0, 11) for k in keys}
    drawn = Counter(r["k"] for r in resample_by_key(df, "k", 4.0, 11).collect())
    assert drawn == Counter({k: n for k in keys if (n := by_hand(k, 4.0, 11))})
    assert resample_by_key(df, "k").columns == df.columns


@pytest.mark.parametrize("mean", [0.5, 4.0, 30.0])
def test_distribution(spark, mean):
    rows = 40_000
    counts = {r["n"]: r["count"] for r in spark.range(rows).select(copies("id", mean, 3).alias("n")).groupBy("n").count().collect()}
    chi, cells, rest = 0.0, 0, rows
    for n in range(200):
        expected = rows * math.exp(-mean + n * math.log(mean) - math.lgamma(n + 1))
        if expected >= 20:
            chi += (counts.get(n, 0) - expected) ** 2 / expected
            cells += 1
    assert chi < cells + 5 * math.sqrt(2 * cells)
    assert abs(sum(n * c for n, c in counts.items()) / rest - mean) < 6 * math.sqrt(mean / rows)


def test_edges(spark):
    df = spark.range(50)
    assert resample_by_key(df, "id", 0.0).count() == 0
    assert resample_by_key(df.limit(0), "id").count() == 0
    same = resample_by_key(df.select(F.lit(1).alias("id")), "id", 4.0, 2).count()
    assert same == 50 * by_hand(1, 4.0, 2)
    for bad in (-1.0, 1e6):
        with pytest.raises(ValueError):
            poisson_steps(bad)
    steps = poisson_steps(4.0)
    assert steps == sorted(steps) and steps[-1] > 1 - 1e-15 and steps[0] == math.exp(-4)
    assert resample(df, 4.0, seed=1).count() > 100
