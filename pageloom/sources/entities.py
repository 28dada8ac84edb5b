"""Entity dumps: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(path)


def read_entities(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Entity lines as ``value``, without blank lines and the brackets of a JSON array."""
    return entity_lines(read_lines(spark, path))


def entity_lines(lines: DataFrame) -> DataFrame:
    """Drop array brackets, blank lines and the comma after an element."""
    line = F.btrim("value", F.lit(", \t\r\n"))
    return lines.select(line.alias("value")).where(~F.col("value").isin("", "[", "]"))
