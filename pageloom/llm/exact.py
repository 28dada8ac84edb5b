"""Exact duplicates with a split by frequency (operator 3)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch, without_rows

COUNTERS = 1024
LEAST_FREQUENT = 32
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, sha``: code points of the whole text and SHA-256 without white space; null counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.translate(text, WHITE, "")
    return docs.select(F.col(id_col).alias("doc_id"), F.length(text).cast("long").alias("n_chars"), F.unhex(F.sha2(bare, 256)).alias("sha"))


def misra_gries(rows: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """``key, estimate``: at most ``counters`` keys for each task, summed over the tasks.

    An estimate is too low by at most rows / counters, so that every key of more rows has one.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            held.update(batch.column(0).to_pylist())
            if len(held) > counters:
                floor = sorted(held.values(), reverse=True)[counters]
                held = Counter({k: v - floor for k, v in held.items() if v > floor})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["key", "estimate"])

    parts = rows.select(key).mapInArrow(summarise, "key binary, estimate long")
    return parts.groupBy("key").agg(F.sum("estimate").alias("estimate"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, sha, n_chars``.

    Texts are equal when they are so without white space. The longest original stays, then
    the smallest id, nulls last; of wholly equal rows one stays. Misra-Gries names digests
    that may be frequent, an exact count verifies them, and the at most ``counters`` winners
    are joined by broadcast, so that no frequent digest is shuffled. All others meet in an
    ordinary shuffle, where no group has more than 2 / counters of the rows. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    marks = fingerprints(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    marks = scratch.keep(marks, "marks")
    least = max(marks.count() / counters, LEAST_FREQUENT)
    # The estimates add up to no more than all rows: at most `counters` of them reach rows / counters.
    candidates = misra_gries(marks, "sha", counters).where(F.col("estimate") >= least).select(F.col("key").alias("sha"))
    winners = scratch.keep(
        marks.join(F.broadcast(candidates), "sha").groupBy("sha").agg(F.count("*").alias("group_size"), F.min(_rank()).alias("best")), "winners"
    )
    frequent = marks.join(F.broadcast(winners), "sha")
    group = Window.partitionBy("sha")
    others = marks.join(F.broadcast(winners.select("sha")), "sha", "left_anti")
    others = others.withColumns({"group_size": F.count("*").over(group), "best": F.min(_rank()).over(group)})
    both = frequent.select(*others.columns).unionByName(others)
    return both.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "sha", "n_chars"
    )


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns. Of rows with one id and one text the first in the table stays."""
    scratch = Scratch(docs.sparkSession, "keep-exact")
    groups = scratch.keep(exact_groups(docs, id_col, text_col), "groups")
    bare = F.translate(F.coalesce(F.col(text_col), F.lit("")), WHITE, "")
    keys = {"doc_id": F.col(id_col), "sha": F.unhex(F.sha2(bare, 256)), "n_chars": F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")}
    dropped = groups.where("NOT kept")
    out = without_rows(docs, keys, scratch.keep(dropped.select(*keys).distinct(), "dropped"))
    # A row that stays may share its keys with one that goes.
    shared = scratch.keep(groups.where("kept").select(*keys).join(dropped.select(*keys).distinct(), [groups[k].eqNullSafe(dropped[k]) for k in keys], "left_semi"), "shared")
    if shared.isEmpty():
        return out
    place = F.monotonically_increasing_id().alias("place")  # in the table
    rows = docs.select(F.struct("*").alias("row"), place, *[key.alias(f"key_{name}") for name, key in keys.items()])
    rows = rows.join(shared, [F.col(f"key_{k}").eqNullSafe(shared[k]) for k in keys], "left_semi")
    one = rows.groupBy(*[f"key_{k}" for k in keys]).agg(F.min_by("row", "place").alias("row")).select("row.*")
    return out.unionByName(one)


def _rank() -> Column:
    """The least of these is the row that stays."""
    return F.struct((-F.col("n_chars")).alias("shorter"), F.isnull("doc_id").alias("unnamed"), "doc_id", "row")


def op3_exact_dedup(spark, sf):
    groups = exact_groups(spark.read.parquet(f"{sf}/documents.parquet"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, h AS text_sha256
FROM d WINDOW best AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""
