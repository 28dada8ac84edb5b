"""Evaluate a costly expression once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def bind(df: DataFrame, name: str, expr: Column, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add ``expr`` as column ``name``, optionally keeping only some rows.

    A filter on a projected column is pushed below the projection together with
    a second copy of its expression, so tokenising or parsing would run twice.
    The column comes out of a generator here, and no filter moves past that.
    """
    values = F.array(expr)
    if keep is not None:
        values = F.filter(values, keep)
    return df.select("*", F.explode(values).alias(name))
