"""Intermediate tables in the shared folder, and membership filters of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageloom.staging import released, set_to, stage_path

FILTER_BITS = 1 << 24
LEAST_FILES, FILE_ROWS = 6, 100_000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Scratch:
    """A folder of written tables under ``spark.checkpoint.dir``.

    A written table cuts lineage: a lost executor costs a reread, not a recomputation.
    Tables that the returned DataFrame doesn't read are dropped as soon as they are used up.
    With ``release`` all of them are written as with the argument of :meth:`keep`.
    """

    def __init__(self, spark: SparkSession, name: str, release: bool = False) -> None:
        self.spark, self.path, self.count, self.release = spark, stage_path(spark, name), 0, release

    def new_path(self, name: str) -> str:
        self.count += 1
        return f"{self.path}/{self.count:03d}-{name}"

    def keep(self, df: DataFrame, name: str, rows: int | None = None, release: bool = False, batch_rows: int | None = None) -> DataFrame:
        """Write a table and return a scan of it; ``rows``, about how many it has, spares tasks for next to nothing.

        With ``release`` Spark deletes the shuffle files that led to it as soon as it is written, not at the driver's next collection of garbage.
        ``batch_rows`` are the most that Python functions get at once.
        """
        path = self.new_path(name)
        if rows is not None:
            df = df.coalesce(LEAST_FILES + rows // FILE_ROWS)
        with released(self.spark, release or self.release), set_to(self.spark, BATCH, batch_rows):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame | str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table if isinstance(table, str) else table.scratch_path)
            path.getFileSystem(conf).delete(path, True)


class Members:
    """Bits of the hashes of a set of keys: no member is missed, some others pass.

    The size is fixed by ``bits`` whatever the size of the set; an exact join or grouping
    always follows, so the bits only save the shuffle of most rows that can't match.
    """

    def __init__(self, keys: DataFrame, key: str, bits: int = FILTER_BITS) -> None:
        slots = keys.select(F.pmod(F.col(key), F.lit(bits)).cast("int").alias("slot"))
        words = slots.groupBy(F.expr("slot div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits"))
        table = np.zeros(bits // 64, np.uint64)
        found = words.toArrow()  # at most bits / 64 rows, whatever the input
        table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        self.bits = bits
        self.table: Broadcast = keys.sparkSession.sparkContext.broadcast(table)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """For an array of int64 keys; called inside tasks."""
        slot = keys.astype(np.int64) % self.bits
        return (self.table.value[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0


def without_rows(docs: DataFrame, keys: dict[str, Column], dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose keys, nulls equal to nulls, are in ``dropped``; all columns stay as they are."""
    rows = docs.select(F.struct("*").alias("row"), *[key.alias(f"key_{name}") for name, key in keys.items()])
    gone = dropped.select(*[F.col(name).alias(f"gone_{name}") for name in keys])
    same = [F.col(f"key_{name}").eqNullSafe(F.col(f"gone_{name}")) for name in keys]
    return rows.join(gone, same, "left_anti").select("row.*")
