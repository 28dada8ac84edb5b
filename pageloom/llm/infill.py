"""Fill-in-the-middle forms of texts by displacement scatter (operator 12).

The texts of a batch lie one after the other in one run of bytes. A scan of it finds the ends of units; the two cuts
of each text make it three segments, each of which moves by a distance of its own. These distances stand as
differences at the starts of the segments, their cumulative sum is every byte's displacement, and one scatter writes
the batch's outputs. Restoring finds the marks in the outputs, makes displacements in the same way and gathers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .spans import text_batches

# The marks before prefix, suffix and middle, and the salt of the draws.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SALT = "42:"
BATCH_BYTES = 4 << 20
WINDOW = 1 << 20
NAMES = ["fim_text", "fim_form", "fim_units", "fim_prefix_chars", "fim_middle_chars"]
PLAIN, PSM, SPM = "plain", "psm", "spm"


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch, and where each text starts in them, with the end of the last."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    return np.frombuffer(b"".join(texts), np.uint8), at


def unit_ends(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ends of units in the batch: after white space and the word behind it, or after white space that ends a text."""
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    last = np.zeros(len(data) + 1, bool)
    last[at[1:]] = True
    ends = last[1:].copy()
    ends[:-1] |= ~white[:-1] & white[1:]
    return np.flatnonzero(ends) + 1


def marks(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the marks inside texts, the letter of each, and the text it is in."""
    places = np.flatnonzero(data == PREFIX[0])
    places = places[places + 2 < len(data)]
    letters = data[places + 1]
    hit = (data[places + 2] == PREFIX[2]) & np.isin(letters, [PREFIX[1], SUFFIX[1], MIDDLE[1]])
    places, letters = places[hit], letters[hit]
    text = np.searchsorted(at, places, side="right") - 1
    inside = places + 3 <= at[text + 1]
    return places[inside], letters[inside], text[inside]


def displace(source: np.ndarray, out: np.ndarray, starts: np.ndarray, shifts: np.ndarray, gather: bool = False) -> None:
    """Scatter ``source[i]`` to ``out[i + shift]``, or gather ``out[i]`` from ``source[i + shift]``.

    The segment from ``starts[k]`` on moves by ``shifts[k]``; starts ascend from 0, of equal ones the last counts. A window
    at a time gets its differences and their sum, so the working arrays don't grow with a text.
    """
    steps = np.diff(shifts, prepend=0)
    carry, moved = 0, out if gather else source
    for low in range(0, len(moved), WINDOW):
        high = min(low + WINDOW, len(moved))
        a, b = np.searchsorted(starts, [low, high])
        shift = np.zeros(high - low, np.int64)
        np.add.at(shift, starts[a:b] - low, steps[a:b])
        shift[0] += carry
        np.cumsum(shift, out=shift)
        carry = int(shift[-1])
        place = np.arange(low, high) + shift
        if gather:
            out[low:high] = source[place]
        else:
            out[place] = source[low:high]


def scatter_forms(texts: list[bytes], draws: np.ndarray, rate: int, spm_share: int) -> tuple[list[bytes], list[str], np.ndarray, list, list]:
    """Outputs, forms, numbers of units, and characters of prefix and middle (None for plain texts)."""
    data, at = joined(texts)
    ends = unit_ends(data, at)
    first = np.searchsorted(ends, at, side="right")
    units = np.diff(first)
    cuts = np.sort(draws[:, :2] % (units + 1)[:, None], axis=1)
    marked = np.zeros(len(texts), bool)
    marked[marks(data, at)[2]] = True
    plain = (units == 0) | marked | (draws[:, 2] % 100 >= rate)
    spm = ~plain & (draws[:, 3] % 100 < spm_share)

    begin, end = at[:-1], at[1:]
    padded = np.append(ends, 0)
    low, high = (np.where(cuts[:, k] > 0, padded[first[:-1] + cuts[:, k] - 1], begin) for k in (0, 1))
    prefix, suffix = low - begin, end - high
    out_at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.diff(at) + np.where(plain, 0, 9), out=out_at[1:])
    base = out_at[:-1]
    # Where a segment's first byte goes, less where it lies.
    moves = np.stack([
        np.where(plain, base - begin, np.where(spm, base + 6 + suffix, base + 3) - begin),
        np.where(plain, base - begin, base + 9 + prefix + suffix - low),
        np.where(plain, base - begin, np.where(spm, base + 3, base + 6 + prefix) - high),
    ], axis=1)
    out = np.empty(out_at[-1], np.uint8)
    displace(data, out, np.stack([begin, low, high], axis=1).ravel(), moves.ravel())
    turned = np.flatnonzero(~plain)
    for mark, places in ((PREFIX, np.where(spm, base + 3 + suffix, base)), (SUFFIX, np.where(spm, base, base + 3 + prefix)), (MIDDLE, base + 6 + prefix + suffix)):
        out[places[turned, None] + np.arange(3)] = np.frombuffer(mark, np.uint8)

    lead = (data & 0xC0) != 0x80
    chars = [[None if p else int(np.count_nonzero(lead[a:b])) for p, a, b in zip(plain, x, y, strict=True)] for x, y in ((begin, low), (low, high))]
    whole = out.tobytes()
    outputs = [whole[a:b] for a, b in zip(out_at[:-1], out_at[1:], strict=True)]
    return outputs, np.where(plain, PLAIN, np.where(spm, SPM, PSM)).tolist(), units, *chars


def gather_texts(outputs: list[bytes], forms: list[str]) -> list[bytes]:
    """The texts that the outputs were made of; outputs of another form than plain begin with a mark and have each once, and one that doesn't comes back as it is."""
    data, at = joined(outputs)
    plain = np.array([f == PLAIN for f in forms], bool)
    places, letters, text = marks(data, at)
    mark_at = np.zeros((3, len(outputs)), np.int64)
    for k, mark in enumerate((PREFIX, SUFFIX, MIDDLE)):
        own = letters == mark[1]
        mark_at[k, text[own]] = places[own] + 3
        plain |= np.bincount(text[own], minlength=len(outputs)) != 1
    begin, end = at[:-1], at[1:]
    # Segments of the output from behind a mark to the next mark or the end.
    stops = np.sort(np.concatenate([mark_at - 3, end[None]]), axis=0)
    plain |= stops[0] != begin
    sizes = [np.min(np.where(stops >= m, stops, np.iinfo(np.int64).max), axis=0) - m for m in mark_at]
    text_at = np.zeros(len(outputs) + 1, np.int64)
    np.cumsum(np.where(plain, np.diff(at), np.diff(at) - 9), out=text_at[1:])
    base = text_at[:-1]
    starts = np.stack([base, np.where(plain, base, base + sizes[0]), np.where(plain, base, base + sizes[0] + sizes[2])], axis=1)
    sources = np.stack([np.where(plain, begin, mark_at[0]), np.where(plain, begin, mark_at[2]), np.where(plain, begin, mark_at[1])], axis=1)
    out = np.empty(text_at[-1], np.uint8)
    displace(data, out, starts.ravel(), (sources - starts).ravel(), gather=True)
    whole = out.tobytes()
    return [whole[a:b] for a, b in zip(text_at[:-1], text_at[1:], strict=True)]


def draws(id_col: str, salt: str = SALT) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of salt and id; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"draw_{k}") for k in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 50, spm_share: int = 80, salt: str = SALT) -> DataFrame:
    """``docs`` with ``fim_text``, ``fim_form``, ``fim_units``, ``fim_prefix_chars`` and ``fim_middle_chars``, which replace columns of these names.

    ``rate`` % of the texts are cut in two places between units (white space with the word after it), drawn from the id, and
    written as suffix, prefix, middle (``spm_share`` % of them) or prefix, suffix, middle. Empty texts and those that hold a mark stay plain,
    with null for the numbers of characters. A null text is empty. Rows with one id have the same draws; rows never leave their task.
    """
    names = [c for c in docs.columns if c not in NAMES]
    kept = docs.select(*names)
    rows = kept.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *draws(id_col, salt))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1, BATCH_BYTES):
            drawn = np.stack([batch.column(2 + k).to_numpy() for k in range(4)], axis=1)
            outputs, forms, units, *chars = scatter_forms(texts, drawn, rate, spm_share)
            new = [pa.array(outputs, pa.binary()).cast(pa.string()), pa.array(forms, pa.string()), pa.array(units, pa.int64()), *(pa.array(c, pa.int64()) for c in chars)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *new], ["row", *NAMES])

    kinds = [StringType(), StringType(), LongType(), LongType(), LongType()]
    fields = [StructField(name, kind) for name, kind in zip(NAMES, kinds, strict=True)]
    return rows.mapInArrow(transform, StructType([rows.schema["row"], *fields])).select("row.*", *NAMES)


def restore(docs: DataFrame, output_col: str = "fim_text", form_col: str = "fim_form", into: str = "restored") -> DataFrame:
    """``docs`` with the text that each output was made of as column ``into``, from output and form alone; null gives the empty text."""
    names = [c for c in docs.columns if c != into]
    rows = docs.select(F.struct(*names).alias("row"), F.coalesce(output_col, F.lit("")).alias("text"), F.coalesce(form_col, F.lit(PLAIN)).alias("form"))

    def undo(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, outputs in text_batches(batches, 1, BATCH_BYTES):
            texts = gather_texts(outputs, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["row", into])

    return rows.mapInArrow(undo, StructType([rows.schema["row"], StructField(into, StringType())])).select("row.*", into)


def op12_infill(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    made = fill_in_middle(docs).drop("text")
    out = restore(made)
    return out.select(
        "doc_id", F.col("fim_units").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"), F.sha2("fim_text", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
n AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d),
c AS (
  SELECT doc_id, t, n,
         array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
         array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
         array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""
