"""Resampling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# A digest's first 13 hexadecimal digits are a whole number that a double holds exactly.
DIGITS, RANGE = 13, 1 << 52


def resample(df: DataFrame, multiplicity: float = 4.0, seed: int | None = None) -> DataFrame:
    """Sample with replacement; each row is expected ``multiplicity`` times.

    The draw follows the partitions, so a seed gives the same rows only as long as these are the same: see :func:`resample_by_key`.
    """
    return df.sample(True, multiplicity, seed)


def poisson_steps(mean: float) -> list[float]:
    """Values of the Poisson distribution function from 0 on, as long as they can be told from 1 by a draw."""
    if mean < 0:
        raise ValueError("a mean number of copies is not negative")
    steps, term, total, n = [], math.exp(-mean), 0.0, 0
    if not term:
        raise ValueError("the mean number of copies is too large")
    while total < 1 - 1 / RANGE:
        if n > mean and term < 1e-18:
            break
        total += term
        steps.append(min(total, 1.0))
        n += 1
        term *= mean / n
    return steps


def copies(key: Column | str, mean: float = 4.0, seed: int = 0) -> Column:
    """How often a row is drawn: a Poisson number that depends on seed and key alone.

    The MD5 digest of ``seed:key`` is a uniform draw, and the number of steps of the distribution function at or below it is the
    result, so that neither partitions nor retries nor other rows change it. A null key counts as an empty one.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(RANGE))
    steps = F.array(*[F.lit(s) for s in poisson_steps(mean)])
    return F.size(F.filter(steps, lambda s: s <= draw))


def resample_by_key(df: DataFrame, key: Column | str, multiplicity: float = 4.0, seed: int = 0) -> DataFrame:
    """A reproducible sample with replacement: each row comes as often as :func:`copies` says, without a shuffle.

    Rows with one key come equally often; pass a key that is unique for independent draws. An empty table gives an empty one.
    """
    name = "_copy" + "_" * max((len(c) for c in df.columns), default=0)
    return df.withColumn(name, F.explode(F.array_repeat(F.lit(1), copies(key, multiplicity, seed)))).drop(name)
