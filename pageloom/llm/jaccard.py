"""Jaccard join of word n-grams by PartEnum signatures (operator 4).

Sets of similar size share a band, in which the domain of features is cut into groups of parts. Two sets with
Jaccard similarity of at least num / den differ in at most D = (den - num) (a + b) / (den + num) features, so that
at least groups - D / (k + 1) groups of parts differ in k features at most, and in each of those the sets agree on some choice of all
parts but k. The hash of such a choice is a signature. A set may leave out as many of its weakest signatures as are
sure to be shared, less one: sets agree on what is weak, for it follows from the choice alone.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .graph import components, forest
from .scratch import Members, Scratch, without_rows
from .spans import text_batches

WORDS = 4
NUMERATOR, DENOMINATOR = 85, 100
BAND_WIDTH = 1.5
SMALL_SET = 64
SLACK = 0.15
BUCKETS, MOST_COUNTED = 256, (1 << 16) - 1
STAR_ROUNDS = 1
BLOCK_SETS, BLOCK_FEATURES = 1024, 1_000_000
# Sets of a bucket that are compared by counts at once, and of how many all links are named.
COUNT_SETS, LISTED_SETS = 4096, 32
# Signatures are grouped in up to so many slices, each of its own shuffle.
SLICES, SLICE_ROWS = 8, 8_000_000
CACHE_WORDS = 300_000
FILTER_BITS = 1 << 25
EMPTY_NODE = np.int64(0)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted 64-bit hashes of the distinct word n-grams of a text."""

    def __init__(self, size: int = WORDS) -> None:
        self.size, self.known = size, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: A-Z only, and the six white characters of ASCII
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in words], np.uint64)
        count = max(1, len(h) - self.size + 1)
        out = np.full(count, min(len(h), self.size), np.uint64)
        for i in range(min(len(h), self.size)):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + count])
        return np.unique(out)


def band_edges() -> list[tuple[int, int]]:
    out, low = [], 1
    while low < 1 << 40:
        out.append((low, max(low, int(low * BAND_WIDTH))))
        low = out[-1][1] + 1
    return out


EDGES = band_edges()


@lru_cache(maxsize=256)
def band_cut(band: int, num: int, den: int) -> dict:
    """How the domain is cut for the sets of one band.

    Parts are enumerated up to ``SMALL_SET`` only: for larger sets that about doubles the signatures, and whole partitions are exact too.
    """
    high = EDGES[band][1]
    most = (den - num) * 2 * high // (den + num)
    k, parts = (1, 3) if most and high <= SMALL_SET else (0, 1)
    groups = most // (k + 1) + 1
    groups += int(np.ceil(groups * SLACK))
    choices = np.array(list(combinations(range(parts), parts - k)))
    bounds = np.array([(i << 64) // (groups * parts) for i in range(groups * parts)], np.uint64)
    salt = mix(np.arange(groups * len(choices), dtype=np.uint64) + (np.uint64(band) << np.uint64(40)))
    return {"k": k, "groups": groups, "parts": parts, "choices": choices, "bounds": bounds, "salt": salt}


def signatures(features: np.ndarray, num: int = NUMERATOR, den: int = DENOMINATOR) -> np.ndarray:
    """Signatures of one set, of its own band and, if a larger set of the next may be similar, of that."""
    size = len(features)
    largest = size * den // num
    sums = np.r_[np.uint64(0), np.cumsum(mix(features ^ np.uint64(0xD6E8FEB86659FD93)))]
    out = []
    for number in range(bisect_left(EDGES, size, key=lambda e: e[1]), len(EDGES)):
        low, high = EDGES[number]
        if low > largest:
            break
        differ = (den - num) * (size + min(largest, high)) // (den + num)
        if not differ:
            continue  # only equal sets, which are one node
        band = band_cut(number, num, den)
        start = np.searchsorted(features, band["bounds"])
        end = np.r_[start[1:], size]
        shape = (band["groups"], band["parts"])
        content, count = (sums[end] - sums[start]).reshape(shape), (end - start).reshape(shape)
        hashes = mix(content[:, band["choices"]].sum(axis=2).ravel() + band["salt"])
        weight = count[:, band["choices"]].sum(axis=2).ravel()
        spare = band["groups"] - differ // (band["k"] + 1) - 1
        out.append(hashes[np.lexsort((hashes, weight))[max(0, spare) :]])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def node_of(features: np.ndarray) -> int:
    """64 bits of a digest of the set: sets of a hundred million texts have one chance in four thousand to share them by accident."""
    return int.from_bytes(hashlib.blake2b(features.tobytes(), digest_size=8).digest(), "little", signed=True)


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, num: int = NUMERATOR, den: int = DENOMINATOR, star_rounds: int = STAR_ROUNDS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, text_hash``.

    Texts link when den x intersection >= num x union of their sets of ``size``-word shingles; a text of fewer words is one
    shingle, one without a word or null links with nothing. Texts with one set are one node. Of the sets with a common
    signature, the one with most shared signatures is compared with all others first, which joins most copies of a text in as
    many comparisons; of sets that are still apart, those whose counts let them be similar are then compared in blocks, which give trees
    and not pairs. Null ids name a component only if all of its
    ids are null; textless rows with a null id have a null component.
    """
    scratch = Scratch(docs.sparkSession, "jaccard", release=True)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)
        for batch, texts in text_batches(batches, 1, 1 << 20):
            ids, hashes = batch.column(0), batch.column(2)
            nodes, sizes, sigs, owners, seen = [], [], [], [], set()
            for t in texts:
                features = shingle(t)
                node = node_of(features) if len(features) else 0
                nodes.append(node)
                sizes.append(len(features))
                if len(features) and node not in seen:
                    seen.add(node)
                    own = signatures(features, num, den)
                    sigs.append(own)
                    owners.append(np.full(len(own), node, np.int64))
            none = pa.nulls(len(nodes), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), hashes, pa.array(nodes, pa.int64()), none], names)
            sig = np.concatenate(sigs).view(np.int64) if sigs else np.zeros(0, np.int64)
            none = pa.nulls(len(sig), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(np.concatenate(owners) if owners else sig, pa.int64()), pa.array(sig)], names)
        pa.default_memory_pool().release_unused()  # the worker stays for other stages

    names = ["doc_id", "n_shingles", "text_hash", "node", "sig"]
    marks = scratch.keep(rows.mapInArrow(mark, ", ".join(f"{n} long" for n in names)), "marks")
    texts = scratch.keep(marks.where("sig IS NULL").select("doc_id", "n_shingles", "text_hash", "node"), "texts")
    parts = _buckets(marks.where("sig IS NOT NULL").select("sig", "node"), scratch)
    scratch.drop(marks)
    buckets = docs.sparkSession.read.schema(parts[0].schema).parquet(*[part.scratch_path for part in parts])
    scores = scratch.keep(buckets.groupBy("node").agg(F.count("*").alias("score")), "scores")
    sets = _sets(rows, texts, scores, scratch, size)

    open_ = scratch.keep(buckets.join(scores, "node").withColumns({"component": F.col("node"), "done": F.lit(False)}), "open")
    scratch.drop(*parts)
    rows_open, rows_nodes = open_.count(), scores.count()
    groups = scratch.keep(scores.select(F.col("node").alias("id"), F.col("node").alias("component")), "groups")
    for turn in range(star_rounds + 1):
        if turn < star_rounds:
            # The best place in the order is the one of the highest score; sets that have been compared with all are out.
            best = F.max(F.when(~F.col("done"), F.struct("score", "node", "component"))).alias("hub")
            apart = open_.groupBy("sig").agg(best, F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2 AND hub IS NOT NULL")
            hubs = scratch.keep(apart.select("sig", F.col("hub.node").alias("hub"), F.col("hub.component").alias("hub_component")), "hubs", rows_open)
            stars = open_.join(hubs, "sig").where("NOT done AND node <> hub")
            pairs = stars.where("component <> hub_component").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
            pairs = scratch.keep(pairs, "pairs", rows_open)
            new = scratch.keep(_verified(pairs, sets, num, den), "links", rows_nodes)
            scratch.drop(pairs)
        else:
            alike = _alike(open_.where("NOT done"), sets, scratch, rows_open, num, den)
            new = scratch.keep(_within(alike, groups, sets, scratch, rows_nodes, num, den), "links", rows_nodes)
        # What is joined already counts as a link from its component, so the graph stays small.
        known = groups.select(F.col("id").alias("a"), F.col("component").alias("b"))
        before, groups = groups, scratch.keep(components(known.unionByName(new), scratch), "groups", rows_nodes)
        scratch.drop(before, new)
        if turn < star_rounds:
            now = open_.drop("component").join(groups.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
            now = now.join(hubs.select("sig", "hub"), "sig").withColumn("done", F.col("done") | (F.col("node") == F.col("hub")))
            before, open_ = open_, scratch.keep(now.select("node", "sig", "score", "component", "done"), "open", rows_open)
            scratch.drop(before, hubs)
            rows_open = open_.count()
            if not rows_open:
                break
    named = texts.join(groups.withColumnRenamed("id", "node"), "node", "left")
    named = named.withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")))
    named = scratch.keep(named, "named")
    least = scratch.keep(named.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    scratch.drop(texts, scores, sets, open_, groups)
    return named.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each group that of the smallest id, and every text without a word.

    Of rows with that id, those of the smallest hash of their text stay.
    """
    scratch = Scratch(docs.sparkSession, "keep-one", release=True)
    groups = scratch.keep(jaccard_groups(docs, id_col, text_col, **options).where("n_shingles > 0"), "groups")
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component_id").agg(F.min("text_hash").alias("first"))
    marked = groups.join(first.withColumnRenamed("component_id", "group_id"), F.col("component_id").eqNullSafe(F.col("group_id")), "left")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("text_hash").eqNullSafe(F.col("first"))
    dropped = scratch.keep(marked.where(~stays).select("doc_id", "text_hash").distinct(), "dropped")
    keys = {"doc_id": F.col(id_col).cast("long"), "text_hash": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    return without_rows(docs, keys, dropped)


def _buckets(sigs: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Tables ``sig, node`` of the signatures that several sets have, each row once.

    Signatures go through the shuffle slice by slice, so that its files never hold most of them, and each slice has the whole filter.
    """

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(members.has(batch.column(0).to_numpy())))

    slices, out = min(SLICES, 1 + sigs.count() // SLICE_ROWS), []
    for i in range(slices):
        own = sigs.where(F.pmod(F.shiftright("sig", 32), F.lit(slices)) == i)  # the filter goes by the lower bits
        shared = own.groupBy("sig").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("sig")
        shared = scratch.keep(shared, "shared")
        members = Members(shared, "sig", FILTER_BITS)
        out.append(scratch.keep(own.mapInArrow(maybe, "sig long, node long").distinct().join(shared, "sig"), "buckets"))
        members.table.unpersist()
        scratch.drop(shared)
    return out


def _alike(members: DataFrame, sets: DataFrame, scratch: Scratch, rows: int, num: int, den: int) -> DataFrame:
    """Links ``a, b`` between sets of one bucket (``sig, node, component``) and of two components whose counts let them be similar.

    That two sets share a signature by chance gets more likely the more sets there are, and such links would join most of a large table. Of
    buckets with the same sets one is looked at, and a large bucket gives no more than a tree for each two of its blocks.
    """
    whole = members.groupBy("sig").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("all"), F.min("component").alias("c1"), F.max("component").alias("c2"))
    one = whole.where("c1 <> c2").groupBy("size", "all").agg(F.min("sig").alias("sig"))
    one = scratch.keep(one.select("sig", F.ceil(F.col("size") / COUNT_SETS).cast("int").alias("blocks")), "looked-at", rows)
    placed = members.join(one, "sig").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = ["sig", "i", "j"]
    placed = placed.select("sig", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component")
    placed = placed.join(sets.select("node", "n", "counts"), "node").select(*group, "node", "component", "n", "counts")

    def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
        """Rows of groups that are complete, and where each begins."""
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            new = np.zeros(table.num_rows, bool)
            new[0] = True
            for c in group:
                values = table.column(c).to_numpy()
                new[1:] |= values[1:] != values[:-1]
            begins = np.flatnonzero(new)
            if begins[-1]:
                yield table.slice(0, begins[-1]), begins[:-1]
            rest = table.slice(begins[-1])
        if rest is not None:
            yield rest, np.zeros(1, np.int64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in whole_groups(batches):
            node, component, n = (table.column(c).to_numpy() for c in ("node", "component", "n"))
            counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u2").reshape(-1, BUCKETS)
            sizes = np.diff(np.r_[begins, len(node)])
            for size in np.unique(sizes).tolist():
                of = begins[sizes == size]
                if size > LISTED_SETS:
                    for at in of.tolist():
                        own = slice(at, at + size)
                        linked = np.stack([may_link(counts[x], counts[own], n[x], n[own], num, den) & (component[x] != component[own]) for x in range(at, at + size)])
                        root = forest(linked, node[own])
                        hit = root != node[own]
                        yield pa.RecordBatch.from_arrays([pa.array(node[own][hit]), pa.array(root[hit])], ["a", "b"])
                    continue
                x, y = np.triu_indices(size, 1)
                for at in range(0, len(of), 1 + (1 << 15) // max(1, len(x))):
                    first = of[at : at + 1 + (1 << 15) // max(1, len(x)), None]
                    a, b = (first + x).ravel(), (first + y).ravel()
                    apart = component[a] != component[b]
                    a, b = a[apart], b[apart]
                    hit = may_link(counts[a], counts[b], n[a], n[b], num, den)
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[a], node[b])[hit]), pa.array(np.maximum(node[a], node[b])[hit])], ["a", "b"])

    return placed.repartition(*group).sortWithinPartitions(*group).mapInArrow(compare, "a long, b long")


def counts_of(features: np.ndarray) -> bytes:
    """How many features lie in each of equal parts of the domain, none over ``MOST_COUNTED``."""
    found = np.bincount((features >> np.uint64(56)).astype(np.int64), minlength=BUCKETS)
    return np.minimum(found, MOST_COUNTED).astype("<u2").tobytes()


def may_link(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of ``nx`` and ``ny`` features with the counts ``x`` and ``y`` can be similar: they have no more in common than the lesser counts."""
    most = np.minimum(x, y).sum(axis=-1, dtype=np.int64)
    return ((den + num) * most >= num * (nx + ny)) | (np.minimum(nx, ny) > MOST_COUNTED)


def _within(alike: DataFrame, groups: DataFrame, sets: DataFrame, scratch: Scratch, rows: int, num: int, den: int) -> DataFrame:
    """Links ``a, b`` that join what is apart of the clusters that ``alike`` links over any path.

    All sets of such a cluster are compared in blocks, each pair of blocks in a task of its own that counts common features by
    matrix products and gives no more than a tree of what it has joined. Blocks are bounded in sets and in features.
    """
    cluster = scratch.keep(components(alike, scratch).select(F.col("id").alias("node"), F.col("component").alias("cluster")), "clusters", rows)
    members = cluster.join(groups.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    members = members.join(sets.select("node", "n"), "node")
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK_FEATURES), F.ceil(F.count("*") / BLOCK_SETS)).cast("int").alias("blocks")
    split = members.groupBy("cluster").agg(blocks, F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("cluster", "blocks")
    placed = members.join(scratch.keep(split, "blocks", rows), "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.join(sets.select("node", "features"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "features")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        features = [np.frombuffer(f.as_buffer(), np.uint64) for f in table.column("features")]
        common, sizes = common_features(features), np.array([len(f) for f in features])
        linked = den * common >= num * (sizes[:, None] + sizes - common)
        np.fill_diagonal(linked, False)
        root = forest(linked, nodes)
        hit = root != nodes
        return pa.table({"a": nodes[hit], "b": root[hit]})

    return placed.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long")


def common_features(features: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many features each two sets have in common, some columns of the incidence matrix at a time."""
    owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
    _, column, count = np.unique(np.concatenate(features), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column = owner[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(features), len(features)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        part = slice(*np.searchsorted(column, [low, low + columns]))
        incidence = np.zeros((len(features), columns), np.float32)
        incidence[owner[part], column[part] - low] = 1
        out += incidence @ incidence.T
    return out.astype(np.int64)


def _sets(rows: DataFrame, texts: DataFrame, nodes: DataFrame, scratch: Scratch, size: int) -> DataFrame:
    """``node, n, counts, features`` of the sets that share a signature; only texts that may have one are read as words again."""
    wanted = Members(texts.join(nodes, "node", "left_semi").select("text_hash"), "text_hash")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)

        def some() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(wanted.has(batch.column(1).to_numpy())))

        for _, own in text_batches(some(), 0, 1 << 20):
            found = {node_of(f): f for f in map(shingle, own) if len(f)}
            counts = [counts_of(f) for f in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([len(f) for f in found.values()], pa.int64()), pa.array(counts, pa.binary()), pa.array([f.tobytes() for f in found.values()], pa.binary())], ["node", "n", "counts", "features"])

    read = rows.select("text", "text_hash").mapInArrow(features, "node long, n long, counts binary, features binary")
    exact = read.join(nodes.select("node"), "node", "left_semi").groupBy("node")
    return scratch.keep(exact.agg(F.first("n").alias("n"), F.first("counts").alias("counts"), F.first("features").alias("features")), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those pairs ``a, b`` that are similar, by an upper bound from counts first and then by the sets."""

    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, BUCKETS) for c in (4, 5))
            keep = may_link(x, y, batch.column(2).to_numpy(), batch.column(3).to_numpy(), num, den)
            yield batch.filter(pa.array(keep)).select([0, 1])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keep = []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(den * common >= num * (len(x) + len(y) - common))
                yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    near = pairs.join(side("a", "n"), "a").join(side("b", "n"), "b").where(f"{den} * least(a_n, b_n) >= {num} * greatest(a_n, b_n)").select("a", "b", "a_n", "b_n")
    near = near.join(side("a", "counts"), "a").join(side("b", "counts"), "b").select("a", "b", "a_n", "b_n", "a_counts", "b_counts").mapInArrow(bounded, "a long, b long")
    full = near.join(side("a", "features"), "a").join(side("b", "features"), "b").select("a", "b", "a_features", "b_features")
    return full.mapInArrow(compared, "a long, b long")


def op4_jaccard(spark, sf):
    return jaccard_groups(spark.read.parquet(f"{sf}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
