"""From raw documents to packed sequences: language, exact and near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again for the next one.
A null text counts as an empty one, ids and sources may be null or repeat, further columns pass, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pageloom.llm.exact import keep_exact
from pageloom.llm.jaccard import keep_one
from pageloom.llm.language import keep_identified
from pageloom.llm.mixing import damped, mixed
from pageloom.llm.packing import pack
from pageloom.llm.scratch import Scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, null and empty texts among them, go; no score is too low to stay."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest stays, then that of the smallest id; of rows alike one."""
    return keep_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of five-word shingles that of the smallest id stays; texts without a word all stay."""
    return keep_one(docs, size=5, num=80, den=100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of a mixture; a source's target grows with the logarithm of its rows, and one that runs out leaves its weight to the others. A null source is a source."""
    return mixed(docs, weights=damped())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, each made of documents that follow one another in the mixture.

    Files read again come in no certain order, so the places in the mixture, which don't depend on the order of the rows, are found again.
    """
    return pack(mixed(docs, weights=damped()))


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixture", mixture), ("packing", packing)]
# Tokens, signatures and the mixture can't be expressed in SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline", release=True)
    for n, (name, stage) in enumerate(STAGES):
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        if n:
            scratch.drop(before)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
