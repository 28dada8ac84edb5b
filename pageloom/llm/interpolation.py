"""Language model by deleted interpolation (operator 11).

Texts are cut into chunks of a bounded number of tokens. Each chunk sends the distinct n-grams it has, with their
counts, to the parts of the key range, where the counts of all chunks are summed and sent back in the order in which they
came. So nobody holds the model: a chunk receives what it needs of it. The maximum-likelihood estimates of all orders are
mixed with weights for each bucket of context frequency. Expectation-maximisation learns these weights on
a part of the training texts, from counts that leave that part out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .scratch import Scratch
from .spans import text_batches

ORDER = 2
CHUNK_TOKENS = 1 << 20
PART_BYTES = 4 << 20
# Texts sent to a task at once; with Spark's 10,000 they take more memory than a chunk does.
BATCH_ROWS = 1000
RUN_BYTES = 4 << 20
ROUNDS = 20
LEAST_GAIN = 1e-5
PRIOR_EVENTS = 1.0
BITS = 7
# Keys of the end of a text and of the place before its start; no word has these bytes.
END, START = b" ", b"  "
WHITE = re.compile(rb"[\x20\x09-\x0D]")
TEST, TRAIN, DELETED = 0, 1, 2
CHUNK_FIELDS = "chunk long, part long, keys binary, counts binary, tokens binary, docs array<struct<doc:long,id:{id},split:boolean,kind:int,n:int>>"


# --- keys -------------------------------------------------------------------------


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def extend(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of the n-gram of a context and the word after it."""
    h = (context ^ (context >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (word ^ (word >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(30))


def gram_keys(words: np.ndarray, first: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each order the keys of the n-grams that end at each token; from order 2 on those of their contexts, which are one shorter.

    ``first`` marks the first token of a text, before which there are as many starts as needed.
    """
    start = before = word_keys([START])
    grams, contexts = [words], []
    for n in range(2, order + 1):
        # The n-gram of the order below at the token before, which is all starts before a text's first.
        former = np.roll(grams[-1], 1)
        former[first] = before[0]
        contexts.append(former)
        grams.append(extend(former, words))
        before = extend(before, start)
    return grams, contexts


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as the differences between them, byte by byte."""
    planes = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_numbers(*columns: np.ndarray) -> bytes:
    """Whole numbers of any size below 2 ** 64, byte by byte; each column has its own width."""
    out = []
    for numbers in (np.asarray(c).astype(np.uint64) for c in columns):
        width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
        planes = np.ascontiguousarray(numbers.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width].T)
        packed = pa.compress(planes, codec="zstd", asbytes=True)
        out.append(b"".join((bytes([width]), len(numbers).to_bytes(5, "little"), len(packed).to_bytes(5, "little"), packed)))
    return b"".join(out)


def unpack_numbers(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        width, n, size = data[at], int.from_bytes(data[at + 1 : at + 6], "little"), int.from_bytes(data[at + 6 : at + 11], "little")
        wide = np.zeros((n, 8), np.uint8)
        if n:
            planes = np.frombuffer(pa.decompress(data[at + 11 : at + 11 + size], width * n, codec="zstd"), np.uint8)
            wide[:, :width] = planes.reshape(width, n).T
        out.append(wide.view("<u8").ravel().astype(np.int64))
        at += 11 + size
    return out


# --- chunks -----------------------------------------------------------------------


class _Words(dict):
    """Numbers of words in the order in which they came."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


@dataclass
class Chunk:
    """Tokens of pieces of texts: the numbers of their words, from the most frequent on, and the keys of these words."""

    words: np.ndarray
    tokens: np.ndarray
    first: np.ndarray  # tokens that begin a text
    own: np.ndarray  # tokens that count; those that only lead up to them in a long text don't
    kind: np.ndarray  # TEST, TRAIN or DELETED by token

    @classmethod
    def read(cls, tokens: bytes, pieces: list[dict]) -> Chunk:
        numbers, first, own, words = unpack_numbers(tokens)
        kind = np.repeat(np.array([p["kind"] for p in pieces], np.int8), [p["n"] for p in pieces])
        return cls(words.view(np.uint64), numbers, first.astype(bool), own.astype(bool), kind)

    def starting(self) -> tuple[np.ndarray, np.ndarray]:
        """The first tokens of texts, and the first after those that lead up to them."""
        return self.first & self.own, self.own & ~self.first & np.r_[True, ~self.own[:-1]]

    def grams(self, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        return gram_keys(self.words[self.tokens], self.first, order)


def word_runs(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``RUN_BYTES`` of it, and its end."""
    at = 0
    while (cut := WHITE.search(text, at + RUN_BYTES)) is not None:
        yield text[at : cut.start()].lower().split()
        at = cut.start()
    yield [*text[at:].lower().split(), END]


def chunk_rows(batches: Iterator[pa.RecordBatch], order: int, parts: int, task: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """For each chunk a row with its tokens, in any part, and a row for each part of the key range that it has n-grams in."""
    number = task << 31
    row = task << 40
    words, ids, pieces, marks = _Words(), [], [], []
    held = 0
    doc_type = pa.list_(pa.struct([("doc", pa.int64()), ("id", id_type), ("split", pa.bool_()), ("kind", pa.int32()), ("n", pa.int32())]))

    def close() -> pa.RecordBatch:
        nonlocal number, words, held
        numbers = np.concatenate(ids)
        ids.clear()
        count = np.bincount(numbers, minlength=len(words))
        by_count = np.argsort(-count, kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[by_count] = np.arange(len(words))
        keys = word_keys(list(words))[by_count]
        words, held = _Words(), 0
        numbers = rank[numbers]
        first, own = np.zeros(len(numbers), bool), np.ones(len(numbers), bool)
        at = 0
        for piece, (begins, lead) in zip(pieces, marks, strict=True):
            first[at], own[at : at + lead] = begins, False
            at += piece["n"]
        tokens = pack_numbers(numbers, first, own, keys)
        chunk = Chunk(keys, numbers, first, own, np.repeat([p["kind"] for p in pieces], [p["n"] for p in pieces]))
        out = [(number, number % parts, None, None, tokens, list(pieces))]
        out += [(number, part, k, c, None, None) for part, k, c in asked(chunk, order, parts)]
        number += 1
        pieces.clear(), marks.clear()
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), doc_type]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["chunk", "part", "keys", "counts", "tokens", "docs"])

    for batch, texts in text_batches(batches, 1, 1 << 20):
        for doc_id, kind, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts, strict=True):
            before: list[bytes] = []  # what the n-grams of the next word need of those before it
            for run in word_runs(text):
                begin = 0
                while begin < len(run):
                    took = run[begin : begin + CHUNK_TOKENS - held]
                    begin += len(took)
                    if pieces and pieces[-1]["doc"] == row:
                        pieces[-1]["n"] += len(took)
                    else:
                        # A later piece of a text is led up to by the words before it.
                        pieces.append({"doc": row, "id": doc_id, "split": bool(before), "kind": kind, "n": len(before) + len(took)})
                        marks.append((len(before) < order - 1 or order == 1 and not before, len(before)))
                        ids.append(np.fromiter(map(words.__getitem__, before), np.int32, len(before)))
                    ids.append(np.fromiter(map(words.__getitem__, took), np.int32, len(took)))
                    held += len(took)
                    before = [*before, *took][-(order - 1) :] if order > 1 else took[-1:]
                    if held >= CHUNK_TOKENS:
                        pieces[-1]["split"] |= took[-1] != END
                        yield close()
            row += 1
    if held:
        yield close()


def asked(chunk: Chunk, order: int, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """By part of the key range the distinct keys that a chunk asks for, sorted, and how often it has them in training texts, kept and deleted."""
    keys, weight = table_keys(chunk, *chunk.grams(order))
    # Sorted by kind and counted at the edges: the place of every key would take as much memory as all else.
    sorts = [np.sort(keys[weight == kind]) for kind in (TRAIN, DELETED)]
    keys.sort()
    distinct = keys[np.r_[True, keys[1:] != keys[:-1]]]
    del keys, weight
    counts = [np.diff(np.r_[np.searchsorted(s, distinct), len(s)]) for s in sorts]
    part = ((distinct >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(part[a]), pack(distinct[a:b]), pack_numbers(counts[0][a:b], counts[1][a:b])


def table_keys(chunk: Chunk, grams: list[np.ndarray], contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All keys that a chunk asks for, and the kind of the text for those that count there.

    An n-gram counts at its last token. Contexts are n-grams of the token before; only those of starts alone are none
    of any token, and count where a text begins.
    """
    begins, led = chunk.starting()
    keys = [g[chunk.own] for g in grams] + [c[begins] for c in contexts] + [c[led] for c in contexts]
    kinds = [chunk.kind[chunk.own]] * len(grams) + [chunk.kind[begins]] * len(contexts) + [np.full(led.sum(), TEST, np.int8)] * len(contexts)
    return np.concatenate(keys), np.concatenate(kinds)


# --- counts of the corpus -----------------------------------------------------------


def total_counts(key: tuple, table: pa.Table) -> pa.Table:
    """For one part of the key range: every chunk's keys with the counts of all chunks, in the chunk's order; rows of tokens pass, as part -1."""
    asked_for = table.filter(table.column("tokens").is_null())
    passed = table.filter(table.column("tokens").is_valid())
    passed = passed.set_column(1, "part", pa.array([-1] * len(passed), pa.int64()))
    numbers = [unpack_numbers(n) for n in asked_for.column("counts").to_pylist()]
    keys = [unpack(k, len(n[0])) for k, n in zip(asked_for.column("keys").to_pylist(), numbers, strict=True)]
    if not keys:
        return passed.drop_columns(["keys"])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = [np.bincount(place, np.concatenate([n[kind] for n in numbers]), len(distinct)).astype(np.int64) for kind in (0, 1)]
    ends = np.cumsum([len(k) for k in keys])
    out = [pack_numbers(*(s[place[e - len(k) : e]] for s in sums)) for k, e in zip(keys, ends, strict=True)]
    answers = asked_for.set_column(asked_for.column_names.index("counts"), "counts", pa.array(out, pa.binary()))
    return pa.concat_tables([passed, answers]).drop_columns(["keys"])


COUNTED = "docs {docs}, counts binary, events binary, kept long, words array<struct<count:long,times:long>>"


def counted_chunks(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Chunks, sorted with the answers to them by part behind each, as rows of counts for each token: no word and no key is needed from here on."""
    held, kept = None, []

    def close() -> pa.RecordBatch:
        answer = [np.concatenate(c) for c in zip(*map(unpack_numbers, kept), strict=True)]
        pieces = held.column("docs").to_pylist()[0]
        chunk = Chunk.read(held.column("tokens")[0].as_py(), pieces)
        own = np.add.reduceat(chunk.own, np.cumsum([0, *(p["n"] for p in pieces[:-1])]), dtype=np.int64)
        found = Estimates.of(chunk, answer, order)
        docs = [{**p, "n": n} for p, n in zip(pieces, own.tolist(), strict=True)]
        kinds = chunk.kind[chunk.own]
        # A word that occurs c times is met c times in all chunks, so every token is one c-th of a word.
        every, times = np.unique(found.grams[0][0][kinds != TEST], return_counts=True)
        words = [{"count": c, "times": t} for c, t in zip(every.tolist(), times.tolist(), strict=True)]
        columns = [[docs], [found.packed(own)], [found.events(kinds == DELETED)], [int((kinds == TRAIN).sum())], [words]]
        types = [held.schema.field("docs").type, pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.struct([("count", pa.int64()), ("times", pa.int64())]))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["docs", "counts", "events", "kept", "words"])

    for batch in batches:
        for at, (part, counts) in enumerate(zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True)):
            if part < 0:
                if held is not None:
                    yield close()
                held, kept = batch.slice(at, 1), []
            else:
                kept.append(counts)
    if held is not None:
        yield close()


@dataclass
class Estimates:
    """Counts for each own token of a chunk: of its n-grams and their contexts, from all training texts and from those not deleted."""

    grams: list[list[np.ndarray]]  # by set of texts (all, not deleted) and order
    contexts: list[list[np.ndarray]]

    @classmethod
    def of(cls, chunk: Chunk, answer: list[np.ndarray], order: int) -> Estimates:
        # The answers follow the distinct keys in ascending order.
        place = np.unique(table_keys(chunk, *chunk.grams(order))[0], return_inverse=True)[1].astype(np.int32)
        sets = [answer[0] + answer[1], answer[0]]
        begins, led = chunk.starting()
        n, at = int(chunk.own.sum()), order * int(chunk.own.sum())
        places = [place[k * n : (k + 1) * n] for k in range(order)]
        before = [np.roll(p, 1) for p in places[:-1]]  # the context of a token is the n-gram of the token before it
        for mask in (begins, led):
            where = np.flatnonzero(mask[chunk.own])
            for context in before:
                context[where] = place[at : at + len(where)]
                at += len(where)
        return cls([[s[p] for p in places] for s in sets], [[s[p] for p in before] for s in sets])

    def packed(self, own: np.ndarray) -> bytes:
        """The counts from all training texts; of the contexts only the first of each piece, whose sizes are given, as others follow from the n-grams."""
        return pack_numbers(*self.grams[0], *(c[np.cumsum(own) - own] for c in self.contexts[0]))

    def events(self, chosen: np.ndarray) -> bytes | None:
        """How often each set of counts without the deleted texts comes up among some tokens, and these counts."""
        if not chosen.any():
            return None
        columns = [c[chosen] for c in (*self.grams[1], *self.contexts[1])]
        by = np.lexsort(columns)
        columns = [c[by] for c in columns]
        new = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])
        return pack_numbers(np.diff(np.r_[new, len(by)]), *(c[new] for c in columns))


def buckets(contexts: list[np.ndarray], n: int) -> np.ndarray:
    """By token the order that the longest known context allows (1: none is known), and the bits of that context's frequency."""
    level, bits = np.ones(n, np.int64), np.zeros(n, np.int64)
    for order, count in enumerate(contexts, 2):
        known = count > 0
        level[known] = order
        bits[known] = np.frexp(count[known].astype(float))[1]
    return level << BITS | bits


def likelihoods(grams: list[np.ndarray], contexts: list[np.ndarray], total: int, vocabulary: int) -> np.ndarray:
    """By component and token: the uniform share of a word, then the relative frequencies of the orders."""
    out = np.zeros((len(grams) + 1, len(grams[0])))
    out[0] = 1 / (vocabulary + 1)
    out[1] = grams[0] / max(1, total)
    for n, (gram, context) in enumerate(zip(grams[1:], contexts, strict=True), 2):
        np.divide(gram, context, out=out[n], where=context > 0)
    return out


# --- mixture weights ------------------------------------------------------------------


@dataclass
class Model:
    """What the scores need besides the answers of the corpus: it has as many numbers as there are buckets."""

    order: int
    total: int
    vocabulary: int
    weights: dict[int, np.ndarray]
    gains: list[float]

    @cached_property
    def table(self) -> np.ndarray:
        """Weights by component and bucket; a bucket without events takes those of the nearest one of its order."""
        return np.array([self._of(b) for b in range((self.order + 1) << BITS)]).T.copy()

    def shares(self, bucket: np.ndarray) -> np.ndarray:
        return self.table[:, bucket]

    def _of(self, bucket: int) -> np.ndarray:
        if bucket in self.weights:
            return self.weights[bucket]
        level = bucket >> BITS
        near = [b for b in self.weights if b >> BITS == level]
        if near:
            return self.weights[min(near, key=lambda b: (abs(b - bucket), b))]
        return even(level, self.order)


def even(level: int, order: int) -> np.ndarray:
    """The weights that learning starts from: alike for all components up to the longest known context."""
    return np.where(np.arange(order + 1) <= level, 1 / (level + 1), 0.0)


def learn(events: DataFrame, order: int, total: int, vocabulary: int, rounds: int = ROUNDS) -> tuple[dict[int, np.ndarray], list[float]]:
    """Weights by bucket and the log likelihood a token before each round, by expectation-maximisation over all events.

    ``total`` is that of the texts which the events leave in. A round sends a row for each task and bucket, and it is the last when the
    likelihood gains less than ``LEAST_GAIN`` of itself. ``PRIOR_EVENTS`` spread evenly keep a bucket of few events from ruling a component out.
    """
    weights: dict[int, np.ndarray] = {}
    gains: list[float] = []
    for _ in range(rounds):
        model = Model(order, total, vocabulary, dict(weights), [])

        def expect(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            n = (order + 1) << BITS
            sums = np.zeros((order + 3, n))
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    weight, *counts = unpack_numbers(data)
                    grams, contexts = counts[:order], counts[order:]
                    bucket = buckets(contexts, len(weight))
                    mixed = likelihoods(grams, contexts, total, vocabulary) * model.shares(bucket)
                    p = mixed.sum(axis=0)
                    for k, part in enumerate((*(weight * m / p for m in mixed), weight, weight * np.log(p))):
                        sums[k] += np.bincount(bucket, part, n)
            used = np.flatnonzero(sums[order + 1])
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[:, used].T.tolist(), pa.list_(pa.float64()))], ["bucket", "sums"])

        expected = events.mapInArrow(expect, "bucket long, sums array<double>")
        found = expected.groupBy("bucket").agg(*[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(order + 3)]).collect()  # at most 64 buckets an order
        if not found:
            break
        for r in found:
            seen = np.array(r[1 : order + 2]) + PRIOR_EVENTS * even(r["bucket"] >> BITS, order)
            weights[r["bucket"]] = seen / seen.sum()
        gains.append(sum(r[order + 3] for r in found) / sum(r[order + 2] for r in found))
        if len(gains) > 1 and gains[-1] - gains[-2] <= LEAST_GAIN * abs(gains[-2]):
            break
    return weights, gains


# --- scores -----------------------------------------------------------------------------


def score_texts(
    docs: DataFrame, train: Column, deleted: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, rounds: int = ROUNDS
) -> tuple[DataFrame, Model]:
    """``doc_id, n_tokens, n_known, base_score, score`` for each row of ``docs``, and the model.

    The tokens are the words between white space, with A to Z in lower case, and an end of the text; null is empty, and
    an empty text is its end alone. ``train`` says which rows teach the model, and ``deleted`` which of these are the held-out part that its mixture weights
    are learned on (null: no); the estimates for that part leave its counts out, those for the scores don't. ``score`` is the log10 probability of all
    tokens in the mixture of uniform share, relative frequencies of words, and of n-grams after their contexts, up to ``order``;
    ``base_score`` that of word counts with one added. ``n_known`` counts tokens that training texts have. Without
    a training row all words are one unknown word; without a deleted one the weights of components are alike. Equal ids and equal rows are scored row by row.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "interpolation")
    kind = F.when(F.coalesce(train, F.lit(False)), F.when(F.coalesce(deleted, F.lit(False)), F.lit(DELETED)).otherwise(F.lit(TRAIN))).otherwise(F.lit(TEST))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), kind.alias("kind"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = 1 + size // PART_BYTES
    id_type = rows.schema["id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is not None:
            both = (b for source in ([batch], batches) for b in source)
            yield from chunk_rows(both, order, parts, TaskContext.get().partitionId(), batch.schema.field("id").type)

    # To the parts of the key range, and back to the chunks. Either way is a job of its own, whose shuffle files go when its result is written.
    fields = CHUNK_FIELDS.format(id=id_type.simpleString())
    summed = rows.mapInArrow(cut, fields).groupBy("part").applyInArrow(total_counts, fields.replace("keys binary, ", ""))
    summed = scratch.keep(summed, "summed", release=True, batch_rows=BATCH_ROWS)
    dealt = summed.repartition("chunk").sortWithinPartitions("chunk", "part")
    schema = COUNTED.format(docs=summed.schema["docs"].dataType.simpleString())
    met = scratch.keep(dealt.mapInArrow(lambda batches: counted_chunks(batches, order), schema), "counted", release=True)
    scratch.drop(summed)

    by_count = met.select(F.inline("words")).groupBy("count").agg(F.sum("times").alias("times"))
    total, vocabulary = by_count.agg(F.coalesce(F.sum("times"), F.lit(0)), F.coalesce(F.sum(F.expr("times div count")), F.lit(0))).first()
    events = met.where("events IS NOT NULL").select("events")
    kept = met.agg(F.coalesce(F.sum("kept"), F.lit(0))).first()[0]
    weights, gains = learn(events, order, kept, vocabulary, rounds)
    model = Model(order, total, vocabulary, weights, gains)
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for at, data in enumerate(batch.column(1).to_pylist()):
                docs = batch.column(0).slice(at, 1).flatten()
                doc, doc_id, split, n = (docs.field(docs.type.get_field_index(c)) for c in ("doc", "id", "split", "n"))
                yield pa.RecordBatch.from_arrays([doc, doc_id, split, *map(pa.array, scored(data, model, n.to_numpy()))], fields.names)

    figures = {"n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}
    fields = StructType([*met.schema["docs"].dataType.elementType.fields[:2], StructField("split", BooleanType())])
    for name, sort in figures.items():
        fields = fields.add(name, sort)
    scores = scratch.keep(met.select("docs", "counts").mapInArrow(score, fields), "scores")
    pieces = scores.where("split").groupBy("doc").agg(F.first("id").alias("id"), *[F.sum(c).alias(c) for c in figures])
    out = scores.where("NOT split").select("id", *figures).unionByName(pieces.select("id", *figures))
    return out.withColumnRenamed("id", "doc_id"), model


def scored(data: bytes, model: Model, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens, known tokens, base score and score of each piece of a chunk."""
    counts = unpack_numbers(data)
    grams, contexts = counts[: model.order], []
    for gram, first in zip(grams, counts[model.order :], strict=False):
        contexts.append(np.roll(gram, 1))
        contexts[-1][np.cumsum(sizes) - sizes] = first
    bucket = buckets(contexts, len(grams[0]))
    p = (likelihoods(grams, contexts, model.total, model.vocabulary) * model.shares(bucket)).sum(axis=0)
    base = np.log10((grams[0] + 1) / (model.total + model.vocabulary + 1))
    piece, n = np.repeat(np.arange(len(sizes)), sizes), len(sizes)
    known = np.bincount(piece, grams[0] > 0, n).astype(np.int64)
    return sizes.astype(np.int64), known, np.bincount(piece, base, n), np.bincount(piece, np.log10(p), n)


def remainder(doc_id: Column, by: int) -> Column:
    """CRC-32 of an id as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def op11_interpolation(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rest = F.coalesce(remainder(F.col("doc_id"), 7), F.lit(0))
    scores, model = score_texts(docs, train=rest != 2, deleted=rest == 3)
    rest = F.coalesce(remainder(F.col("doc_id"), 7), F.lit(0))
    return scores.select("doc_id", (rest == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
