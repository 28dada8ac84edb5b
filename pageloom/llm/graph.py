"""Connected components of links too many for one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def forest(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the smallest id of its component within it."""
    root, todo = ids.copy(), linked.any(axis=1)
    while todo.any():
        reached = np.zeros(len(ids), bool)
        new = np.zeros(len(ids), bool)
        new[todo.argmax()] = True
        while new.any():
            reached |= new
            new = linked[new].any(axis=0) & ~reached
        root[reached] = ids[reached].min()
        todo &= ~reached
    return root


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, component`` for every id of ``links`` (``a, b`` long): the smallest id it is linked with over any path.

    Alternates the large and small star steps of Kiveris et al. (2014): each id's neighbours are
    hung on the smallest of them until every id hangs on the smallest of its component. Minima are
    summed before the shuffle and written, so that Spark can split the rows of an id with very many links.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, seen = scratch.keep(edges, "edges"), None
    while True:
        n = edges.count() if seen is None else seen[0]
        if not n:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.keep(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "large-minima", n)
        large = scratch.keep(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large", n)
        minima = scratch.keep(large.groupBy("u").agg(F.min("v").alias("m")), "small-minima", n)
        small = large.join(minima, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch.keep(small.unionByName(minima.select("u", F.col("m").alias("v"))).distinct(), "edges", n)
        state = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())
        scratch.drop(edges, least, large, minima)
        edges = new
        if state == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        seen = state
