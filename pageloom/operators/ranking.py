"""The first rows of a long order, without a task that receives many more of them."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

# A task ranks so many rows without a second thought.
TASK_ROWS = 100_000


def first_rows(df: DataFrame, order: list[Column], n: int, parts: int | None = None) -> DataFrame:
    """The first ``n`` rows of ``df`` by an order that tells all rows apart.

    Rows are dealt into ``parts`` by a hash of all of them, by default as many as the session has shuffle partitions, and every part is cut to ``n`` rows. The
    parts are then merged in rounds, as many at a time as make about two lots of ``n`` rows, or ``TASK_ROWS`` if that is more,
    each again cut to ``n``, until one is left. So however many rows tie at the last place, no task of a round gets more than that.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fan = max(2, TASK_ROWS // max(1, n))
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int"))
    while True:
        ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
        dealt = ranked.where(F.col("_rank") <= n).drop("_rank")
        if parts == 1:
            return dealt.drop("_part")
        parts = ceil(parts / fan)
        dealt = dealt.withColumn("_part", F.floor(F.col("_part") / fan).cast("int"))
