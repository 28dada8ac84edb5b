"""Byte spans of texts: merging them, and texts without them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Members

BATCH_BYTES = 8 << 20


def text_batches(batches: Iterator[pa.RecordBatch], column: int, limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of about ``limit`` bytes of text with the texts as UTF-8 bytes; null is empty."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        start, held = 0, 0
        for i in range(batch.num_rows):
            held += len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
            if held >= limit or i + 1 == batch.num_rows:
                part = batch.slice(start, i + 1 - start)
                yield part, [t or b"" for t in texts.slice(start, i + 1 - start).to_pylist()]
                start, held = i + 1, 0


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return b"".join(kept) + text[at:]


def gather(spans: DataFrame, key: str) -> DataFrame:
    """``key, spans``: the spans (``start``, ``end``) of a text, as long as the text at most, in one array."""
    return spans.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def texts_with_spans(docs: DataFrame, text_col: str, key_col: str, spans: DataFrame, once: bool = False) -> DataFrame:
    """``key``, text and ``spans`` of every text that has spans.

    ``docs`` has one row for each key in ``spans`` at least; with ``once`` rows of one key are the same text, which is
    taken once, and tasks keep one of each before they send any. A filter of fixed size keeps the texts of most other rows out of the shuffle.
    """
    members = Members(spans.select(F.xxhash64("key").alias("slot")), "slot")

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(members.has(batch.column(2).to_numpy()))).select([0, 1])

    rows = docs.select(F.col(key_col).alias("key"), text_col, F.xxhash64(key_col).alias("slot"))
    kept = rows.mapInArrow(held, docs.select(F.col(key_col).alias("key"), text_col).schema)
    if once:
        kept = kept.dropDuplicates(["key"])
    return kept.join(spans, "key").select("key", text_col, "spans")


def cut_texts(docs: DataFrame, text_col: str, key_col: str, spans: DataFrame) -> DataFrame:
    """``key, n_removed, n_spans, kept_sha256`` of every text that has spans; ``docs`` has one row for each key in ``spans`` at least."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1):
            out = []
            for text, own in zip(texts, batch.column(2).to_pylist(), strict=True):
                own = merge([(s["start"], s["end"]) for s in own])
                out.append((sum(e - s for s, e in own), len(own), hashlib.sha256(without(text, own)).hexdigest()))
            removed, count, sha = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha)], ["key", "n_removed", "n_spans", "kept_sha256"])

    key_type = dict(docs.select(F.col(key_col).alias("key")).dtypes)["key"]
    joined = texts_with_spans(docs, text_col, key_col, spans)
    return joined.mapInArrow(cut, f"key {key_type}, n_removed long, n_spans long, kept_sha256 string")


def covered(spans: DataFrame) -> DataFrame:
    """``key, n_bytes`` from the result of :func:`gather`: how many bytes of a text its spans cover."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [sum(e - s for s, e in merge([(x["start"], x["end"]) for x in own])) for own in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["key", "n_bytes"])

    return spans.select("key", "spans").mapInArrow(count, f"key {dict(spans.dtypes)['key']}, n_bytes long")


def runs(docs: DataFrame, text_col: str, key_col: str, spans: DataFrame, least: int) -> DataFrame:
    """``key, start, bytes``: the maximal runs of at least ``least`` bytes that the spans of a text cover, once for each key."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1):
            keys, starts, parts = [], [], []
            for key, text, own in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), strict=True):
                for start, end in merge([(s["start"], s["end"]) for s in own]):
                    if end - start >= least:
                        keys.append(key)
                        starts.append(start)
                        parts.append(text[start:end])
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(starts, pa.int64()), pa.array(parts, pa.binary())], ["key", "start", "bytes"])

    key_type = dict(docs.select(F.col(key_col).alias("key")).dtypes)["key"]
    return texts_with_spans(docs, text_col, key_col, spans, once=True).mapInArrow(take, f"key {key_type}, start long, bytes binary")
