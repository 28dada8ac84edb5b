"""Parquet tables: source, and sink with one path per table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

REPLACE = "replace"
ROW_GROUP_BYTES = 8 << 20


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk.

    ``partition`` columns become folders, which a filter on them prunes before any file is opened. Within a folder the rows are in
    ranges of ``cluster``, over several files and sorted inside each, so that a filter on its first columns skips files and row groups by their
    statistics. ``lookup`` columns get a Bloom filter in each row group, for filters on single values. ``files`` is how many ranges
    there are in all, by default as many as the session has shuffle partitions; a folder that holds most rows has most of them.
    """

    partition: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()
    lookup: tuple[str, ...] = ()
    files: int | None = None
    row_group_bytes: int = ROW_GROUP_BYTES

    def arranged(self, df: DataFrame) -> DataFrame:
        """The rows in ranges of both kinds of columns: one dominant value is split over tasks where ``cluster`` tells its rows apart."""
        columns = [*self.partition, *self.cluster]
        if not columns:
            return df
        dealt = df.repartitionByRange(*([self.files] if self.files else []), *columns)
        return dealt.sortWithinPartitions(*columns)

    def options(self) -> dict[str, str]:
        out = {"parquet.block.size": str(self.row_group_bytes)} if self.cluster or self.lookup else {}
        for column in self.lookup:
            out[f"parquet.bloom.filter.enabled#{column}"] = "true"
        return out


def read_table(spark: SparkSession, path: str, partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Scan a Parquet table.

    A row group is read by one task. A caller who knows that a file is small and the work on its rows
    is costly may ask for ``partitions``, dealt by ``key``; nothing is shuffled otherwise.
    """
    df = spark.read.parquet(path)
    if partitions is None:
        return df
    return df.repartition(partitions, key) if key else df.repartition(partitions)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", layout: Layout | None = None) -> None:
    """Write one table in a layout.

    Mode ``replace`` needs partition columns: folders that ``df`` has rows for are replaced, all others stay, so a job can be run again
    for one language. Any other mode is Spark's own.
    """
    layout = layout or Layout()
    writer = layout.arranged(df).write.options(**layout.options())
    if layout.partition:
        writer = writer.partitionBy(*layout.partition)
    if mode == REPLACE:
        if not layout.partition:
            raise ValueError("only a table in partitions can be replaced in part")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)


def write_tables(tables: dict[str, DataFrame], output: str, mode: str = "errorifexists", layouts: Mapping[str, Layout] | None = None) -> None:
    """Write each table to ``output/<name>``, in its layout if it has one; an empty name means ``output`` itself."""
    for name, df in tables.items():
        write_table(df, f"{output}/{name}" if name else output, mode, (layouts or {}).get(name))
