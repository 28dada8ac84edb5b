"""Substring deduplication by content-defined chunks (operator 2)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Members, Scratch
from .spans import cut_texts, merge, text_batches

LEAST, MOST = 16, 256
MASK_BITS = 4
RUN_BYTES = 100
GEAR = np.random.Generator(np.random.PCG64(20_240_601)).integers(0, 1 << 32, 256, dtype=np.uint32)
FILTER_BITS = 1 << 25


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: h = 2 h + gear[byte] in 32 bits, so the last 32 bytes count; by doubling."""
    h = GEAR[data]
    width = 1
    while width < 32:
        h = h.copy() if width >= len(h) else np.concatenate([h[:width], h[width:] + (h[:-width] << np.uint32(width))])
        width *= 2
    return h


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks: after a byte whose hash has ``MASK_BITS`` leading zeros, ``LEAST`` to ``MOST`` bytes apart."""
    if not text:
        return []
    h = gear_hashes(np.frombuffer(text, np.uint8))
    ends, last = [], 0
    for c in [*(np.flatnonzero(h < np.uint32(1 << (32 - MASK_BITS))) + 1).tolist(), len(text)]:
        while c - last > MOST:
            last += MOST
            ends.append(last)
        if c - last >= LEAST:
            ends.append(c)
            last = c
    if last < len(text):
        ends.append(len(text))
    return ends


def chunk_digests(text: bytes) -> tuple[list[int], np.ndarray]:
    """Ends and 128-bit digests of a text's chunks, as pairs of longs."""
    ends, start, out = cuts(text), 0, []
    for end in ends:
        out.append(hashlib.blake2b(text[start:end], digest_size=16).digest())
        start = end
    return ends, np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)


def repeated_runs(chunks: list[tuple], run_bytes: int = RUN_BYTES) -> tuple[list[tuple[int, int]], int]:
    """Spans to remove from one document, and the bytes of its repeated runs.

    ``chunks`` has ``(start, end, digest, first here)`` of its repeated chunks. Neighbouring ones make a run; in runs of
    ``run_bytes`` or more, all go but the first of its digest in the first document that has it.
    """
    chunks = sorted(chunks)
    removed, covered, seen, at = [], 0, set(), 0
    while at < len(chunks):
        to = at + 1
        while to < len(chunks) and chunks[to][0] == chunks[to - 1][1]:
            to += 1
        long = chunks[to - 1][1] - chunks[at][0] >= run_bytes
        covered += (chunks[to - 1][1] - chunks[at][0]) * long
        for start, end, digest, here in chunks[at:to]:
            if long and (not here or digest in seen):
                removed.append((start, end))
            elif here:
                seen.add(digest)
        at = to
    return merge(removed), covered


def dedup_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_repeated, n_removed, n_spans, kept_sha256``.

    Texts are cut where their content says so, so an insertion moves only the chunks that it touches. A chunk is repeated if
    its digest occurs twice, in one document or two. Runs of neighbouring repeated chunks of ``run_bytes`` or more are
    repeated passages; one copy of each chunk, in the document of the smallest id, stays. Shorter ones, common phrases, stay everywhere.
    Null texts are empty. Rows with the same id and text are one document given twice; each gets the same result. Null ids come last,
    and rows without one keep their chunks against each other.
    """
    scratch = Scratch(docs.sparkSession, "chunks")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("key", F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), "text"), 256)))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1, 1 << 20):
            found = [chunk_digests(t)[1] for t in texts]
            table = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
            yield pa.RecordBatch.from_arrays([pa.array(table[:, 0].copy()), pa.array(table[:, 1].copy()), ids], ["d1", "d2", "doc_id"])

    counted = rows.select("doc_id", "text").mapInArrow(digests, "d1 long, d2 long, doc_id long").groupBy("d1", "d2")
    repeated = counted.agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1").select("d1", "d2", "first")
    repeated = scratch.keep(repeated, "repeated")
    members = Members(repeated, "d1", FILTER_BITS)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1, 1 << 20):
            parts, owner = [], []
            for i, t in enumerate(texts):
                ends, table = chunk_digests(t)
                hit = members.has(table[:, 0])
                if hit.any():
                    e = np.array(ends, np.int64)
                    parts.append(np.column_stack([table, np.r_[0, e[:-1]], e])[hit])
                    owner += [i] * len(parts[-1])
            table = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(table[:, c].copy()) for c in range(4)), batch.column(0).take(take), batch.column(2).take(take)], ["d1", "d2", "start", "end", "doc_id", "key"])

    found = rows.select("doc_id", "text", "key").mapInArrow(places, "d1 long, d2 long, start long, end long, doc_id long, key binary")
    found = found.join(repeated, ["d1", "d2"]).select("key", F.struct("start", "end", "d1", F.col("first").eqNullSafe(F.col("doc_id")).alias("here")).alias("chunk"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out = [repeated_runs([tuple(c.values()) for c in own], run_bytes) for own in batch.column(1).to_pylist()]
                spans = [[{"start": s, "end": e} for s, e in removed] for removed, _ in out]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, span), pa.array([n for _, n in out], pa.int64())], ["key", "spans", "n_repeated"])

    by_text = found.groupBy("key").agg(F.collect_set("chunk").alias("chunks"))
    passages = by_text.mapInArrow(runs, "key binary, spans array<struct<start: long, end: long>>, n_repeated long").where("n_repeated > 0")
    passages = scratch.keep(passages, "passages")
    cut = scratch.keep(cut_texts(rows, "text", "key", passages.select("key", "spans")).dropDuplicates(["key"]), "cut")
    own = rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    none = F.lit(0).cast("long")
    joined = own.join(passages.select("key", "n_repeated"), "key", "left").join(cut, "key", "left")
    return joined.select("doc_id", "n_bytes", *[F.coalesce(c, none).alias(c) for c in ("n_repeated", "n_removed", "n_spans")], F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def op2_chunks(spark, sf):
    return dedup_chunks(spark.read.parquet(f"{sf}/documents.parquet"))
