"""Stop-word lists."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession, functions as F


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of a text file as ``term``; several on a line are told apart."""
    words = spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("term"))
    return words.where("term <> ''").distinct()


def default_stop_words(language: str = "english") -> list[str]:
    return StopWordsRemover.loadDefaultStopWords(language)
