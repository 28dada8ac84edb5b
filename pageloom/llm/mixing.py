"""Mixing sources to target weights by fair scheduling (operator 8)."""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate, groupby
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch

BLOCK = 16
MAX_SOURCES = 256
BUCKET_ROWS = 4096
CHUNK_SLOTS = 1 << 16
LARGEST = 1 << 40


def schedule(shares: list[int], left: list[int] | None = None) -> list[int]:
    """The source of each slot of one period of ``sum(shares)`` slots.

    Block j of a source with weight w is released at slot floor(j / w) and due by slot
    ceil((j + 1) / w). The earliest deadline first keeps every source within less than
    one block of weight x slots at every slot. Ties go to the smaller index.

    With ``left``, a source has no more than so many blocks; from where its weight has used them up the others share
    its weight, and releases and deadlines are those of that moving target.
    """
    left = shares if left is None else left
    ends = sorted((Fraction(n, s), n, s) for n, s in zip(left, shares, strict=True) if n < s)
    times = [e[0] for e in ends]
    gone = [0, *accumulate(e[1] for e in ends)]
    rates = [sum(shares), *(sum(shares) - x for x in accumulate(e[2] for e in ends))]

    def slot_of(j: int, share: int) -> tuple[int, int]:
        """Numerator and denominator of the slot at which the target of a source is j blocks."""
        k = bisect_left(times, Fraction(j, share)) if times else 0
        return gone[k] * share + j * rates[k], share

    def window(i: int, j: int) -> tuple[int, int]:
        (a, b), (c, d) = slot_of(j, shares[i]), slot_of(j + 1, shares[i])
        return a // b, -(-c // d)

    waiting = [(*window(i, 0), i, 0) for i, n in enumerate(left) if n]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots = []
    for t in range(sum(left)):
        while waiting and waiting[0][0] <= t:
            _, due, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, i, j))
        _, i, j = heapq.heappop(ready)
        slots.append(i)
        if j + 1 < left[i]:
            heapq.heappush(waiting, (*window(i, j + 1), i, j + 1))
    return slots


def shares_of(weights: list[float], slots: int) -> list[int]:
    """Whole slots of a period for each weight: largest remainders, one slot at least."""
    total = sum(map(Fraction, weights))
    exact = [Fraction(w) * slots / total for w in weights]
    shares = [max(1, int(x)) for x in exact]
    for i in sorted(range(len(exact)), key=lambda i: (int(exact[i]) - exact[i], i))[: max(0, slots - sum(shares))]:
        shares[i] += 1
    return shares


def phases(blocks: list[int], weights: list[float], slots: int) -> list[dict]:
    """Stretches of the mixture in which the same sources last.

    Each gives the first slot, the first block and the positions in the period for every source
    that takes part. A phase ends after the last whole period in which all its sources have
    blocks; one more period ends the shortest source. There are at most twice as many phases as sources.
    """
    done, start, out = [0] * len(blocks), 0, []
    while active := [i for i in range(len(blocks)) if done[i] < blocks[i]]:
        shares = shares_of([weights[i] for i in active], max(slots, len(active)))
        order = schedule(shares)
        periods = min((blocks[i] - done[i]) // s for i, s in zip(active, shares, strict=True))
        if periods:
            for k, i in enumerate(active):
                at = [t for t, x in enumerate(order) if x == k]
                out.append({"source_no": i, "from_block": done[i], "to_block": done[i] + periods * shares[k], "first_slot": start, "share": shares[k], "period": len(order), "at": at})
                done[i] += periods * shares[k]
            start += periods * len(order)
            continue
        taken: dict[int, list[int]] = {}
        for x in order:
            i = active[x]
            if done[i] + len(taken.get(i, [])) == blocks[i]:
                break
            taken.setdefault(i, []).append(start)
            start += 1
        for i, at in taken.items():
            out.append({"source_no": i, "from_block": done[i], "to_block": done[i] + len(at), "first_slot": at[0], "share": len(at), "period": 0, "at": [t - at[0] for t in at]})
            done[i] += len(at)
    return out


def whole_weights(weights: dict) -> tuple[dict, int]:
    """Whole numbers in just the ratio of the weights, and that of a weight of 1; a float is the decimal it is written as."""
    exact = {k: Fraction(repr(w)) if isinstance(w, float) else Fraction(w) for k, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be positive")
    scale = lcm(*(w.denominator for w in exact.values()))
    return {k: int(w * scale) for k, w in exact.items()}, scale


def _slots(chunks: Iterator[tuple[int, int, list[tuple]]]) -> Iterator[pa.RecordBatch]:
    """The slot of every block of chunks given as (first slot, rounds, sources); a source is (name, weight, first block, blocks)."""
    for first, rounds, sources in chunks:
        names, weights, starts, totals = zip(*sources, strict=True)
        known: dict[tuple, list[int]] = {}
        source, block = [], []
        done = [0] * len(names)
        for _ in range(rounds):
            active = [i for i, n in enumerate(totals) if done[i] < n]
            left = tuple(min(weights[i], totals[i] - done[i]) for i in active)
            if not active:
                break
            key = (tuple(active), left)
            if key not in known:
                known = {key: schedule([weights[i] for i in active], list(left))}
            for k in known[key]:
                i = active[k]
                source.append(i)
                block.append(starts[i] + done[i])
                done[i] += 1
        slot = pa.array(range(first, first + len(source)), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(source, pa.int64())), pa.array(block, pa.int64()), slot], ["planned", "planned_block", "slot"])


def block_slots(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``planned, planned_block, slot`` of every block; ``sources`` has ``name, weight, blocks``, the weight a whole number in decimal digits.

    A round gives each source as many blocks as its weight says, or what it has left. At the end of a round every source has
    just its target, so rounds are scheduled apart, some together as a chunk in one task. Before round v come
    min(weight x v, blocks) of each source.
    """
    share = F.least(F.col("weight").cast("decimal(38,0)"), F.lit(LARGEST)).cast("long")
    sources = sources.withColumn("share", F.coalesce(share, F.lit(LARGEST)))
    rounds = max(1, int(CHUNK_SLOTS // (sources.agg(F.sum(F.col("share").cast("double"))).first()[0] or 1)))
    # No source has more blocks in a chunk than it has at all, so a share too large to multiply is cut to its blocks.
    step = F.least(F.col("share"), F.greatest("blocks", F.lit(1))) * rounds
    parts = sources.withColumn("step", step).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(blocks - 1) div step"))))
    parts = parts.withColumn("from_block", F.col("chunk") * F.col("step"))
    parts = scratch.keep(parts.select("chunk", "name", "weight", "from_block", F.least("step", F.col("blocks") - F.col("from_block")).alias("n")), "parts")
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("chunk").agg(F.sum("n").alias("size"))
    starts = starts.select(F.col("chunk").alias("of_chunk"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first_slot"))
    dealt = parts.join(starts, F.col("chunk") == F.col("of_chunk")).select("chunk", "first_slot", "name", "weight", "from_block", "n")
    dealt = dealt.repartition("chunk").sortWithinPartitions("chunk", "name")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        yield from _slots((first, rounds, [(n, int(w), f, k) for _, _, n, w, f, k in own]) for (_, first), own in groupby(rows, lambda r: r[:2]))

    return dealt.mapInArrow(place, "planned string, planned_block long, slot long")


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: dict[str | None, float] | Column | None = None,
    block: int = BLOCK, seed: int = 7, max_sources: int | None = MAX_SOURCES,
) -> DataFrame:
    """``doc_id, source, block, slot, position, row``: the place of every row in the mixture, and the row itself as a struct.

    ``weights`` gives a positive target to each source, null included; without it all sources get the same, and a
    source that isn't named gets 1. A column gives positive whole weights from a source's number of rows, ``n``. Weights are
    exact: at every slot a source is less than one block off its target, however many slots there are.
    Inside a source rows stand by a hash of their id, ``block`` to a slot; the last block may be short. When a source
    runs out, the others share its weight, so every row has a place. Repeated rows have neighbouring places.

    A source is cut in buckets of its hash, each numbered by itself and moved up by the rows before it, so one source
    may hold any share of the rows. Counts, weights and slots are tables, see ``block_slots``, so any number of sources
    fits; more than ``max_sources``, often a sign of a wrong column, are refused, unless that is None.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.struct("*").alias("row"))
    rows = rows.withColumn("place", F.xxhash64("doc_id", F.lit(seed))).withColumn("name", _name(F.col("source")))
    counts = rows.groupBy("name").agg(F.count("*").alias("n"))
    if isinstance(weights, Column):
        weighed = counts.withColumn("weight", weights.cast("string"))
    else:
        whole, one = whole_weights(weights or {})
        listed = docs.sparkSession.createDataFrame([(s, str(w)) for s, w in whole.items()], "listed string, given string")
        listed = listed.select(_name(F.col("listed")).alias("given_name"), "given")
        weighed = counts.join(F.broadcast(listed), F.col("name") == F.col("given_name"), "left").withColumn("weight", F.coalesce("given", F.lit(str(one))))
    sources = scratch.keep(weighed.select("name", "weight", "n", F.expr(f"(n + {block - 1}) div {block}").alias("blocks")), "sources")
    found, total = sources.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if max_sources is not None and found > max_sources:
        raise ValueError(f"more than {max_sources} sources: name groups of them in one column and mix those")
    bits = (total // BUCKET_ROWS).bit_length()
    bucket = F.shiftrightunsigned("place", 64 - bits) if bits else F.lit(0).cast("long")
    rows = rows.withColumn("bucket", bucket)
    sizes = rows.groupBy("name", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = scratch.keep(sizes.select("name", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "sizes")
    inside = Window.partitionBy("name", "bucket").orderBy("place", "doc_id")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1).join(sizes, ["name", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).withColumn("block", F.floor(F.col("rank") / block))
    slots = scratch.keep(block_slots(sources, scratch), "slots")
    placed = ranked.join(slots, (F.col("name") == F.col("planned")) & (F.col("block") == F.col("planned_block")))
    return placed.select("doc_id", "source", "block", "slot", (F.col("slot") * block + F.pmod("rank", F.lit(block))).alias("position"), "row")


def _name(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def damped() -> Column:
    """Weights for ``mix``: 1, and 1 more each time that a source has twice the rows."""
    return F.length(F.bin("n"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in the order of the mixture."""
    return mix(docs, **{"max_sources": None, **options}).orderBy("position").select("row.*")


def op8_mixing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return mix(docs, max_sources=None).select("doc_id", "source", "block", "slot", "position")


def op8_mixing_weighted(spark, sf):
    """The same with unequal targets, from the number of rows of each source."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return mix(docs, weights=damped(), max_sources=None).select("doc_id", "source", "block", "slot", "position")
