"""Repeated strings by column-wise construction over aligned collections (operator 10).

A string of 400 bytes that starts in two places has the same lowest k-gram hash in both, at the same distance
from its start. So the windows of all texts are dealt by that k-gram, their anchor, and only those with a common
anchor are compared: lined up at the anchor, they form a collection of equally long rows. The collection's
transform is built from the last column to the first, one symbol of every row each round: the order of the rows
by what follows is updated by a stable sort on the new symbol, and the common prefixes of neighbours follow from the
former ones. Where a neighbour shares the whole length, the window starting at that column is repeated. Collections come
to a task one after the other, as files sorted by anchor that Spark's shuffle has written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .scratch import Members, Scratch
from .spans import covered, cut_texts, gather, merge, runs, text_batches

LENGTH = 400
SHORT = 200
GRAM = 32
PIECE_BYTES = 1 << 19
COLLECTION_ROWS = 8192
HOT_ROWS = 16_384
HOT_KEYS = 4096
SEEN_SNIPPETS = 50_000
# Sides of an anchor: a place known to be repeated, all windows, windows to the left and to the right, single windows; above it, ranges of windows.
KNOWN, SINGLE = -1, 3
SNIPPETS = "anchor long, side int, mark binary, key binary, from long, at long, bytes binary"
ROW = pa.schema({"anchor": pa.int64(), "side": pa.int32(), "mark": pa.binary(), "key": pa.binary(), "from": pa.int64(), "at": pa.int64(), "bytes": pa.binary()})
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes (a power of two), by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * FACTOR
    width = 1
    while width < gram:
        h = (h[:-width] ^ (h[:-width] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (h[width:] ^ (h[width:] >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        width *= 2
    return h ^ (h >> np.uint64(31))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least value in every ``width`` of them; values keep 44 bits."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = (values >> np.uint64(20) << np.uint64(20)) | np.arange(n, dtype=np.uint64)
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return (np.minimum(after[:count], before[width - 1 : width - 1 + count]) & np.uint64((1 << 20) - 1)).astype(np.int64)


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: hash and place of the anchor, first and last window start."""
    parts = []
    for at in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
        data = np.frombuffer(text, np.uint8, min(PIECE_BYTES + length - 1, len(text) - at), at)
        if len(data) < length:
            continue
        h = gram_hashes(data, gram)
        place = sliding_least(h, length - gram + 1)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        parts.append((h[place[first]].view(np.int64), place[first] + at, first + at, last + at))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def repeated_windows(symbols: np.ndarray, low: np.ndarray, high: np.ndarray, group: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Mask of rows by columns: the window that starts there also stands in another row of its group.

    ``symbols`` has the aligned rows, of one or more groups with ``group`` in ascending order; row r has bytes in the
    columns from ``low[r]`` to below ``high[r]``. A column without a byte is a symbol that equals no other.
    """
    rows, columns = symbols.shape
    order = np.arange(rows)
    # For the row at each place of the order, the first column in which it differs from the one before.
    differs = np.full(rows, columns)
    same_group = np.r_[False, group[1:] == group[:-1]]
    out = np.zeros((rows, columns), bool)
    outside = 256 + np.arange(rows)
    for column in range(columns - 1, -1, -1):
        inside = (low <= column) & (column < high)
        symbol = np.where(inside, symbols[:, column], outside)
        transform = symbol[order]
        key = group[order] * (256 + rows) + transform
        if np.all(key[1:] >= key[:-1]):
            joined = np.r_[False, key[1:] == key[:-1]]
            differs = np.where(joined, differs, column)
        else:
            to = np.argsort(key, kind="stable")
            key = key[to]
            joined = np.r_[False, key[1:] == key[:-1]]
            new = np.full(rows, column)
            near = joined & (to == np.r_[-1, to[:-1] + 1])
            new[near] = differs[to[near]]
            far = np.flatnonzero(joined & ~near)
            if len(far):
                ends = np.stack([to[far - 1] + 1, to[far] + 1], axis=1)
                by = np.argsort(ends[:, 0], kind="stable")
                bounds = np.minimum(ends[by].ravel(), rows - 1)
                least = np.minimum.reduceat(differs, bounds)[::2]
                new[far[by]] = np.minimum(least, differs[to[far[by]]])
            order, differs = order[to], new
        if column <= columns - length:
            shared = joined & (differs - column >= length)
            out[order, column] = shared | np.r_[shared[1:], False]
    return out


def _line_up(rows: list[tuple], length: int) -> list[tuple]:
    """Repeated spans of complete groups; rows are (key, text key, start of the bytes, anchor's place in them, bytes, number)."""
    longest = max(r[3] for r in rows)
    columns = max(longest - r[3] + len(r[4]) for r in rows)
    symbols = np.zeros((len(rows), columns), np.uint8)
    low, high = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    group = np.zeros(len(rows), np.int64)
    for i, (key, _, _, anchor, data) in enumerate(rows):
        low[i] = longest - anchor
        high[i] = low[i] + len(data)
        symbols[i, low[i] : high[i]] = np.frombuffer(data, np.uint8)
        group[i] = group[i - 1] + (key != rows[i - 1][0]) if i else 0
    found = repeated_windows(symbols, low, high, group, length)
    edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    at, start = np.nonzero(edges == 1)
    _, end = np.nonzero(edges == -1)
    return [(rows[r][1], int(rows[r][2] + s - low[r]), int(rows[r][2] + e - 1 - low[r]) + length) for r, s, e in zip(at, start, end, strict=True)]


def bounded_groups(rows: DataFrame, scratch: Scratch, length: int, gram: int, group_rows: int) -> DataFrame:
    """The rows of ``snippets``, those of groups of more than ``group_rows`` dealt again by ever more of their bytes.

    Each round halves the range of window starts, by their distance before the anchor, and marks a half by the digest of the bytes that
    all its windows cover. Windows that are equal stay together. Half of a snippet that a task has met before is passed on
    as a place. At the last, a row is one window and its mark is the digest of all of it: such a group has equal rows only, and is not cut.
    """
    kept, level = [], (length - gram).bit_length()
    keys = ["anchor", "side", "mark"]
    while level:
        large = rows.where(~F.col("side").isin(KNOWN, SINGLE)).groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > group_rows)
        large = F.broadcast(scratch.keep(large.select(*keys), "large"))
        if not large.limit(1).count():
            break
        level -= 1
        kept.append(rows.join(large, keys, "left_anti").select(*ROW.names))
        split = rows.join(large, keys, "left_semi").select(*ROW.names).mapInArrow(_halves(level, length), SNIPPETS)
        rows = scratch.keep(split, "halves")
    for part in kept:
        rows = rows.unionByName(part)
    return rows


def _halves(level: int, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows cut where the distance of a window's start from the anchor, over 2 ** ``level``, changes."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}
        for batch in batches:
            for part in (batch.slice(at, 1024) for at in range(0, batch.num_rows, 1024)):
                out = []
                for anchor, _, _, key, start, at, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    least = at - (len(data) - length)  # windows start from ``at`` down to ``least`` bytes before the anchor
                    for half in range(least >> level, (at >> level) + 1):
                        near, far = max(least, half << level), min(at, (half + 1 << level) - 1)
                        low, window = start + at - far, data[at - far : at - near + length]
                        former = seen.setdefault((anchor, far, xxhash.xxh3_128_digest(window)), [key, low, low + len(window)])
                        if former[:2] != [key, low]:
                            out.append((low, KNOWN, b"", key, low, low + len(window), b""))
                            if len(former) == 3:
                                out.append((former[1], KNOWN, b"", *former, b""))
                                former.append(True)
                            continue
                        # What all windows of the half cover, whatever this row has of them.
                        common = data[at - (half << level) : at - (half + 1 << level) + 1 + length]
                        side = SINGLE + 1 + (level << 20) + half if level else SINGLE
                        mark = xxhash.xxh3_128_digest(common) + (b"" if level else far.to_bytes(4, "big"))
                        out.append((anchor, side, mark, key, low, far, window))
                if len(seen) > SEEN_SNIPPETS:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, ROW.types, strict=True)], ROW.names)

    return halves


def repeated_spans(
    docs: DataFrame, key_col: str, text_col: str, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``key, start, end``: bytes covered by strings of ``length`` that start elsewhere too, in a text with another key or in the same one.

    Rows with one key are one text. A task leaves out texts that it has met before, and of the windows around an anchor that it
    has met before it passes on no more than the place, so a passage that very many texts or periods share reaches
    a collection once from each task. No group of over ``hot_rows`` rows is lined up, see ``bounded_groups``.
    """
    group_rows = hot_rows
    rows = docs.select(F.col(key_col).alias("key"), text_col)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1):
            hashes = [anchors(t, length, gram)[0] for t in _once(batch, texts)]
            yield pa.record_batch([pa.array(np.concatenate(hashes) if hashes else [], pa.int64())], ["anchor"])

    counted = rows.mapInArrow(places, "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    counted = scratch.keep(counted, "anchors")
    members = Members(counted, "anchor")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot_rows = max(hot_rows, total // HOT_KEYS)  # so that no more than HOT_KEYS anchors can be hot
    hot = np.sort(np.array([r["anchor"] for r in counted.where(F.col("n") > hot_rows).select("anchor").collect()], np.int64))

    def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}
        for batch, texts in text_batches(batches, 1, 1 << 20):
            out = []
            keys = batch.column(0).to_pylist()
            for i, text in _once(batch, texts, numbered=True):
                h, place, first, last = anchors(text, length, gram)
                is_hot = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
                known = []
                for j in np.flatnonzero(members.has(h)):
                    p, a, b = int(place[j]), int(first[j]), int(last[j])
                    data = text[a : b + length]
                    # What this task has met before is repeated; only the first is compared with what others have met.
                    former = seen.setdefault((p - a, xxhash.xxh3_128_digest(data)), [keys[i], a, b + length])
                    if former[:2] != [keys[i], a]:
                        known.append((a, b + length))
                        if len(former) == 3:
                            out.append((former[1], KNOWN, b"", *former, b""))
                            former.append(True)
                        continue
                    for side, low, high in _sides(p, a, b, length, bool(is_hot[j])):
                        mark = text[p + length // 2 - gram : p + length // 2] if side == 2 else text[p - length // 2 : p - length // 2 + gram] if side == 1 else b""
                        out.append((int(h[j]), side, mark, keys[i], low, p - low, text[low : high + length]))
                out += [(start, KNOWN, b"", keys[i], start, end, b"") for start, end in merge(known)]
                if len(seen) > SEEN_SNIPPETS:
                    seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, types, strict=True)], names)

    names, types = ROW.names, ROW.types
    rows = rows.mapInArrow(snippets, SNIPPETS)
    if counted.where(F.col("n") > group_rows).limit(1).count():  # no group is larger than its anchor's count
        rows = bounded_groups(scratch.keep(rows, "snippets"), scratch, length, gram, group_rows)
    dealt = rows.repartition("anchor", "side", "mark").sortWithinPartitions("anchor", "side", "mark")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64()), strict=True)], ["key", "start", "end"])

        ready, group, last = [], [], None
        for batch in batches:
            done = []
            for anchor, side, mark, key, start, at, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if side == KNOWN:
                    done.append((key, start, at))
                    continue
                name = (anchor, side, mark)
                if name == last and side == SINGLE:  # all rows of such a group are equal, and one of them is held
                    if len(group) == 1:
                        done.append((group[0][1], group[0][2], group[0][2] + length))
                        group.append(None)
                    done.append((key, start, start + length))
                    continue
                if name != last:
                    if len(group) > 1 and last[1] != SINGLE:
                        ready += group
                    group, last = [], name
                    if len(ready) >= COLLECTION_ROWS:
                        yield emit(_line_up(ready, length))
                        ready = []
                group.append((name, key, start, at, data))
            yield emit(done)
        if len(group) > 1 and last[1] != SINGLE:
            ready += group
        if ready:
            yield emit(_line_up(ready, length))

    return dealt.mapInArrow(compare, "key binary, start long, end long")


def _once(batch: pa.RecordBatch, texts: list[bytes], numbered: bool = False) -> Iterator:
    seen = set()
    for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), texts, strict=True)):
        if key not in seen:
            seen.add(key)
            yield (i, text) if numbered else text


def _sides(place: int, first: int, last: int, length: int, hot: bool) -> Iterator[tuple[int, int, int]]:
    """The windows of an anchor; those of a hot one are dealt again, by bytes half a length before it or after it, which every one of a side covers."""
    if not hot:
        yield 0, first, last
        return
    half = place - length // 2
    if first <= half:
        yield 1, first, min(last, half)
    if last > half:
        yield 2, max(first, half + 1), last


def nested_spans(
    docs: DataFrame, scratch: Scratch, length: int, short: int, gram: int, hot_rows: int
) -> tuple[DataFrame, DataFrame]:
    """The spans of ``repeated_spans`` for strings of ``short`` and of ``length`` bytes, of ``docs`` with ``key, text``.

    Every part of a repeated string is repeated too, so all places of a long one lie in runs of bytes that repeated short ones
    cover. The long ones are looked for in these runs, as texts of their own, instead of in all texts again.
    """
    own = Scratch(docs.sparkSession, "repeats-short")
    near = scratch.keep(repeated_spans(docs, "key", "text", own, short, gram, hot_rows), "short-spans", release=True)
    scratch.drop(own.path)
    parts = runs(docs, "text", "key", gather(near, "key"), length)
    # A run is named by its text's key, of 32 bytes, and its start.
    name = F.concat("key", F.unhex(F.lpad(F.hex("start"), 16, "0")))
    parts = scratch.keep(parts.select(name.alias("key"), F.col("bytes").alias("text")), "runs", release=True)
    start = F.conv(F.hex(F.substring("key", 33, 8)), 16, 10).cast("long")
    far = repeated_spans(parts, "key", "text", scratch, length, gram, hot_rows)
    return near, far.select(F.substring("key", 1, 32).alias("key"), (F.col("start") + start).alias("start"), (F.col("end") + start).alias("end"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot_rows: int = HOT_ROWS, short: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, with ``short`` also ``n_repeated``.

    Every byte covered by a string of ``length`` bytes that also starts elsewhere, in any row, is removed; overlaps count. A
    text that several rows have is compared with others once; all of it is removed from each of them if it has
    ``length`` bytes. Null is empty; ids may be null or repeat. ``n_repeated`` counts in the same way the bytes
    covered by strings of ``short`` bytes (at least 2 x ``gram``, at most ``length``), which marks passages too short to be removed; it removes nothing.
    """
    if not 2 * gram <= (length if short is None else short) <= length:  # the marks of hot anchors lie within half a string
        raise ValueError("strings need at least 2 * gram bytes, and short at most length")
    scratch = Scratch(docs.sparkSession, "repeats")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("key", F.unhex(F.sha2("text", 256)))
    marks = scratch.keep(rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes")), "marks")
    copies = scratch.keep(marks.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    if short is None:
        near, spans = None, repeated_spans(rows, "key", "text", scratch, length, gram, hot_rows)
    else:
        near, spans = nested_spans(rows.select("key", "text"), scratch, length, short, gram, hot_rows)
    spans = scratch.keep(spans, "spans")
    partial = scratch.keep(gather(spans.join(copies, "key", "left_anti"), "key"), "gathered")
    cut = scratch.keep(cut_texts(rows, "text", "key", partial), "cut")
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing
    whole = F.col("copies").isNotNull() & (F.col("n_bytes") >= length)
    nothing = F.lit(0).cast("long")
    out = marks.join(copies, "key", "left").join(cut, "key", "left")
    more = []
    if near is not None:
        sizes = covered(gather(near.join(copies, "key", "left_anti"), "key")).withColumnRenamed("n_bytes", "n_near")
        out = out.join(scratch.keep(sizes, "near"), "key", "left")
        same = F.col("copies").isNotNull() & (F.col("n_bytes") >= short)
        more = [F.when(same, F.col("n_bytes")).otherwise(F.coalesce("n_near", nothing)).alias("n_repeated")]
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", nothing)).alias("n_removed"),
        F.when(whole, nothing + 1).otherwise(F.coalesce("n_spans", nothing)).alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("key")))).alias("kept_sha256"), *more,
    )


def op10_repeats(spark, sf):
    return remove_repeats(spark.read.parquet(f"{sf}/documents.parquet"), short=SHORT)
