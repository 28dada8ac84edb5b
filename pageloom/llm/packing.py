"""Cost-balanced packing of documents into training sequences (operator 5)."""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch

SEQUENCE = 1024
GROUP_BITS = 12
END = b"\0\0\0\0"
CACHE_ENTRIES, CACHE_CHARS = 300_000, 64
# Where both neighbours of a space are white, or it ends the text after another, the run is one pre-token.
MIXED_WHITE = re.compile(r"\s \s|\s $")
SAFE_CUT = re.compile(r"(?<=\S)(?= )|(?<=\s)(?= \S)")
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECES = ", ".join(f"{name} long" for name in NAMES)
# Attention inside a piece: projections grow with its length, scores with its square.
LINEAR, QUADRATIC = 12_288, 2


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes and id of every token of a byte-level vocabulary, if its ids follow the order of its merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocabulary, merges = model.get("vocab"), model.get("merges")
    if model.get("type") != "BPE" or any(vocabulary.get(c) is None for c in byte_of):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if i < 256 + len(pairs)}


class Encoder:
    """Ids of texts as little-endian 32-bit words, with a bounded memory of what follows each space.

    A space beside a character that isn't white starts a pre-token of a byte-level vocabulary, so a text cut there
    has the same ids. The `tokenizers` file is the vocabulary; where its ids follow its merges, the same merges
    are run by `tiktoken`, which is several times as fast on single words.
    """

    def __init__(self, path: str, end: bytes = END) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ranks = merge_ranks(path)
        if ranks:
            import public_tokenizers
            import tiktoken

            fast = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._encode = lambda texts: map(fast.encode_ordinary, texts)
        else:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(path)
            slow.encode_special_tokens = True
            self._encode = lambda texts: [e.ids for e in slow.encode_batch_fast(texts, add_special_tokens=False)]
        self.end, self.known = end, {}

    def count(self, text: str) -> int:
        return len(next(iter(self._encode([text]))))

    def words(self, text: str) -> list[str]:
        if MIXED_WHITE.search(text):
            return SAFE_CUT.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Each text's ids, with the closing id."""
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known = self.known
        split = [self.words(t or "") for t in texts]
        new = list({w for words in split for w in words if w not in known})
        known.update(zip(new, (struct.pack(f"<{len(ids)}I", *ids) for ids in self._encode(new)), strict=True))
        for words in split:
            yield b"".join([known[w] for w in words]) + self.end
        for w in new:
            if len(w) > CACHE_CHARS:
                del known[w]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _number(group: int, count: int) -> int:
    """A sequence's number without its last bit: 18 bits for the task, 16 for the group in it, 28 for the count."""
    task, group = group >> 40 - GROUP_BITS, group & (1 << 40 - GROUP_BITS) - 1
    if task >> 18 or group >> 16 or count >> 28:
        raise ValueError("too many tasks, documents in a task or sequences in a group for numbers of 64 bits")
    return (task << 16 | group) << 28 | count


def cut_documents(docs: DataFrame, tokenizer: str | None, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of every document: full ones fill a sequence each, the rest of a document carries its ids.

    Sequence numbers of full pieces are odd; they join the task's number, the group of the document's end and a count within it,
    so that all numbers follow the order of the rows from group to group.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer or default_tokenizer())
        task, group, full, row = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), []
                for doc_id, ids in zip(part.column(0).to_pylist(), coder.encode(part.column(1).to_pylist()), strict=True):
                    total = len(ids) // 4
                    if row >> GROUP_BITS != group:
                        group, full = row >> GROUP_BITS, 0
                    for start in range(0, total, sequence):
                        piece = ids[4 * start : 4 * (start + sequence)]
                        length = len(piece) // 4
                        if length == sequence:
                            out.append((doc_id, start, length, zlib.crc32(piece), total, _number(task << 40 - GROUP_BITS | group, full) * 2 + 1, 0, None, None))
                            full += 1
                        else:
                            out.append((doc_id, start, length, None, total, None, None, piece, task << 40 | row))
                            row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    names = [*NAMES, "ids", "row"]
    types = [pa.int64()] * 7 + [pa.binary(), pa.int64()]
    return docs.mapInArrow(cut, PIECES + ", ids binary, row long")


def balance(pieces: list[tuple[int, int]], sequence: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(piece, from, length)`` for pieces given as ``(length, name)``.

    Longest first, each piece goes to the cheapest sequence with room for it. There are just as
    many sequences as the tokens fill; a piece that fits nowhere is cut at the room of the
    emptiest one. What is left over makes sequences of a power of two each, so nothing is padded.
    """
    count = sum(length for length, _ in pieces) // sequence
    filled, cost, room = [[] for _ in range(count)], [0] * count, [sequence] * count
    cheapest = [(0, i) for i in range(count)]
    with_room = [set() for _ in range(sequence + 1)]
    with_room[sequence].update(range(count))
    widest = sequence
    queue = [(-length, name, 0) for length, name in pieces]
    heapq.heapify(queue)
    rest = []
    while queue:
        length, name, start = heapq.heappop(queue)
        length = -length
        while widest and not with_room[widest]:
            widest -= 1
        if not widest:
            rest.append((name, start, length))
            continue
        if widest < length:
            i = min(with_room[widest])
            heapq.heappush(queue, (widest - length, name, start + widest))
            length = widest
        else:
            passed = []
            while True:
                entry = heapq.heappop(cheapest)
                i = entry[1]
                if entry[0] == cost[i] and room[i]:
                    if room[i] >= length:
                        break
                    passed.append(entry)
            for entry in passed:
                heapq.heappush(cheapest, entry)
        filled[i].append((name, start, length))
        with_room[room[i]].remove(i)
        room[i] -= length
        if room[i]:
            with_room[room[i]].add(i)
        cost[i] += LINEAR * length + QUADRATIC * length * length
        heapq.heappush(cheapest, (cost[i], i))
    left = sum(length for _, _, length in rest)
    for power in (1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1):
        filled.append([])
        while power:
            name, start, length = rest.pop()
            took = min(power, length)
            filled[-1].append((name, start, took))
            power -= took
            if took < length:
                rest.append((name, start + took, length - took))
    return filled


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: a row per piece.

    Null texts are empty and consist of the closing id; ids may be null or repeat, each row is
    packed by itself. Full pieces fill their sequence and are never shuffled. The ends of
    documents that follow one another in the table meet in groups of 2 ** ``GROUP_BITS``, whatever
    their ids, so a group's size is bounded and sequences keep to the order of the table.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.keep(cut_documents(docs.select(F.col(id_col).cast("long"), text_col), tokenizer, sequence), "cut", release=True)
    ends = cut.where("ids IS NOT NULL")

    def packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.sort_by("row").to_pylist()
        out = []
        for i, members in enumerate(balance([(r["length"], n) for n, r in enumerate(rows)], sequence)):
            offset = 0
            for name, start, length in members:
                r = rows[name]
                ids = r["ids"][4 * start : 4 * (start + length)]
                out.append((r["doc_id"], r["start"] + start, length, zlib.crc32(ids), r["doc_tokens"], _number(key[0].as_py(), i) * 2, offset))
                offset += length
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=NAMES)

    keyed = ends.withColumn("bin", F.shiftright("row", GROUP_BITS))
    tails = keyed.groupBy("bin").applyInArrow(packed, PIECES)
    return cut.where("ids IS NULL").select(*NAMES).unionByName(tails)


def op5_packing(spark, sf):
    return pack(spark.read.parquet(f"{sf}/documents.parquet"))
