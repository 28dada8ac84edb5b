"""Concepts of a document collection by truncated singular value decomposition."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.linalg import VectorUDT
from pyspark.mllib.linalg.distributed import IndexedRowMatrix
from pyspark.sql import DataFrame, Observation, functions as F, types as T

from pageloom.operators.factors import BLOCK_ROWS, entries, neighbors, project, scale_rows, top_entries
from pageloom.operators.krylov import document_factor, document_rows, term_factor, weight_blocks
from pageloom.operators.terms import document_vectors, vocabulary
from pageloom.staging import drop_path, drop_staged, released, stage, stage_path

# The solver works on the squared matrix, so smaller values are rounding noise.
RELATIVE_RANK = 1e-7
# Vocabularies up to this size come to the driver and to MLlib's solver; larger ones stay distributed.
DRIVER_TERMS = 100_000


@dataclass
class Lsa:
    """Factors of the document-term matrix.

    ``terms``: ``id`` (term), ``idx, vec``; ``docs``: ``id`` (document id), the kept
    columns, ``vec``; ``sigma``: the strengths, fewer than asked for if the rank is lower.
    """

    terms: DataFrame
    docs: DataFrame
    sigma: list[float]
    path: str = ""

    def close(self) -> None:
        """Delete the staged rows, once ``docs`` is no longer read."""
        if self.path:
            drop_path(self.terms.sparkSession, self.path)


def lsa(docs: DataFrame, n_concepts: int = 100, n_terms: int = 50_000, keep: tuple[str, ...] = ()) -> Lsa:
    """Decompose the TF-IDF matrix of ``doc_id, terms``.

    ``docs`` is read twice, once for the vocabulary and once for the matrix rows:
    stage it when it is costly. The rows are staged and read from there by the
    solver and by the document factors. ``keep`` names further columns to carry.

    A vocabulary of more than ``DRIVER_TERMS`` terms (``n_terms=None``: all) never comes to the driver, nor do vectors of its length.
    """
    spark = docs.sparkSession
    vocab = vocabulary(docs, n_terms)
    if n_terms is None or n_terms > DRIVER_TERMS:
        vocab = stage(vocab, "vocabulary", release=True)
        if vocab.count() > DRIVER_TERMS:
            return _distributed(docs, vocab, n_concepts, keep)
    vocab = vocab.orderBy("idx").toPandas()
    if vocab.empty:
        raise ValueError("no document has enough terms")
    vectors = document_vectors(docs.select("doc_id", *keep, "terms"), vocab["term"].tolist(), vocab["idf"].tolist())

    path = stage_path(spark, "rows")
    vectors.write.parquet(path)
    rows = spark.read.schema(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("w", VectorUDT())])).parquet(path)
    v, sigma = _right_factor(rows, len(vocab), n_concepts)

    stored = "w struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    others = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    sparse = spark.read.schema(f"doc_id long, {others}{stored}").parquet(path).select(
        F.col("doc_id").alias("id"),
        *keep,
        F.coalesce("w.indices", F.transform("w.values", lambda _, i: i)).alias("indices"),
        F.col("w.values").alias("values"),
    )
    doc_factor = project(sparse, ["id", *keep], v / sigma)
    vec = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1], v.ravel())
    term_factor = spark.createDataFrame(pa.table({"id": vocab["term"], "idx": vocab["idx"], "vec": vec}))
    return Lsa(term_factor, doc_factor, sigma.tolist(), path)


def _distributed(docs: DataFrame, vocab: DataFrame, n_concepts: int, keep: tuple[str, ...]) -> Lsa:
    """The model of a staged vocabulary of any size; both factors are written, and the driver gets strengths and signs only."""
    spark, path = docs.sparkSession, stage_path(docs.sparkSession, "factors")
    matrix = weight_blocks(docs.select(F.col("doc_id").alias("id"), *keep, "terms"), vocab, ["id", *keep])
    sigma, factor = document_factor(matrix, n_concepts)
    sigma = sigma[sigma > RELATIVE_RANK * sigma[0]] if len(sigma) and sigma[0] > 0 else sigma[:0]
    placed = stage(vocab.select("term", F.col("idx").cast("long").alias("idx")).join(term_factor(matrix, factor, sigma), "idx"), "terms", release=True)
    signs = _found_signs(placed, len(sigma))
    signed = F.zip_with("vec", F.array(*[F.lit(float(s)) for s in signs]), lambda v, s: v * s)
    with released(spark):
        placed.select(F.col("term").alias("id"), "idx", signed.alias("vec")).write.parquet(f"{path}/terms")
        document_rows(matrix, factor, signs).write.parquet(f"{path}/docs")
    for table in (vocab, matrix, factor, placed):
        drop_staged(table)
    return Lsa(spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/docs"), sigma.tolist(), path)


def _found_signs(terms: DataFrame, concepts: int) -> np.ndarray:
    """As :func:`_signs`, from a table ``idx, vec``."""
    largest = [F.max_by(F.get("vec", F.lit(c)), F.struct(F.round(F.abs(F.get("vec", F.lit(c))), 12), -F.col("idx"))) for c in range(concepts)]
    return np.where(np.array(terms.agg(*largest).first(), float) < 0, -1.0, 1.0) if concepts else np.ones(0)


def _right_factor(rows: DataFrame, n_terms: int, n_concepts: int) -> tuple[np.ndarray, np.ndarray]:
    """Term factor (terms × concepts) and strengths, largest first, by MLlib's solver.

    It reads the rows many times, so they are persisted; what an executor loses is read from the staged files again.
    """
    cached = rows.select("doc_id", "w").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        svd = IndexedRowMatrix(cached, 0, n_terms).computeSVD(min(n_concepts, n_terms))
        sigma, v = svd.s.toArray(), svd.V.toArray()
    finally:
        cached.unpersist()
    real = sigma > RELATIVE_RANK * sigma[0] if len(sigma) and sigma[0] > 0 else np.zeros(len(sigma), bool)
    sigma, v = sigma[real], v[:, real]
    return v * _signs(v), sigma


def _signs(v: np.ndarray) -> np.ndarray:
    """±1 per concept, so that its largest weight in size is positive; ties go to the lowest term."""
    if v.size == 0:
        return np.ones(v.shape[1])
    largest = np.argmax(np.round(np.abs(v), 12), axis=0)
    return np.where(v[largest, np.arange(v.shape[1])] < 0, -1.0, 1.0)


def concept_strength(model: Lsa) -> DataFrame:
    spark = model.terms.sparkSession
    rows = list(enumerate(model.sigma))
    return spark.createDataFrame(rows, "concept int, sigma double")


def top_terms(model: Lsa, n: int = 10, concepts: int | None = None, digits: int | None = None) -> DataFrame:
    """``concept, rank, term, score`` for the first ``concepts`` concepts; ``digits`` rounds the scores before they are ranked."""
    return top_entries(model.terms.select("id", "vec"), n, concepts, digits).withColumnRenamed("id", "term")


def top_docs(model: Lsa, n: int = 10, concepts: int | None = None, digits: int | None = None) -> DataFrame:
    """``concept, rank, doc_id, score`` for the first ``concepts`` concepts; ``digits`` rounds the scores before they are ranked."""
    return top_entries(model.docs.select("id", "vec"), n, concepts, digits).withColumnRenamed("id", "doc_id")


def term_neighbors(
    model: Lsa, top_n: int | None = 20, digits: int | None = None, block_rows: int = BLOCK_ROWS, observation: Observation | None = None
) -> DataFrame:
    """Cosine of terms in concept space: ``id, other, score``; ``top_n=None`` gives all pairs. ``observation`` counts the products made."""
    return neighbors(scale_rows(model.terms.select("id", "vec"), model.sigma), top_n, digits, block_rows, observation)


def relevance_table(model: Lsa, top_n: int | None = 20, doc_key: str = "id", digits: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All relevances as ``data_type, ref, key, score``.

    Strengths have no key. ``doc_key`` names the column of ``model.docs`` that
    identifies a document to readers, such as a title. Scores are whole unless ``digits`` rounds them.
    """

    def kind(name: str, df: DataFrame, ref: str, key: str | None, score: str) -> DataFrame:
        key_col = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
        return df.select(
            F.lit(name).alias("data_type"),
            F.col(ref).cast("string").alias("ref"),
            key_col.alias("key"),
            (F.col(score) if digits is None else F.round(score, digits)).alias("score"),
        )

    keyed_docs = model.docs.select(F.col(doc_key).alias("id"), "vec")
    parts = [
        kind("concept_strength", concept_strength(model), "concept", None, "sigma"),
        kind("term_to_concept", entries(model.terms), "concept", "id", "score"),
        kind("doc_to_concept", entries(keyed_docs), "concept", "id", "score"),
        kind("term_to_term", term_neighbors(model, top_n, digits, block_rows), "id", "other", "score"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
