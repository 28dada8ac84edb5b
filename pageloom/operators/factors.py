"""Operators on row matrices: rows ``id, vec`` with ``vec array<double>``.

Scaling and normalising work inside the row and never shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

BLOCK_ROWS = 2048
PROJECT_ROWS = 64
MAX_CELLS, SAMPLE_PER_CELL = 4096, 32
# What rounding may add to an angle.
SLACK = 1e-7
# Centres closer than that have no plane between them that rounding leaves in its place.
LEAST_BETWEEN = 1e-6


def scale_rows(rows: DataFrame, diagonal: list[float]) -> DataFrame:
    """Multiply by a diagonal matrix from the right."""
    factors = F.array(*[F.lit(float(s)) for s in diagonal])
    return rows.withColumn("vec", F.zip_with("vec", factors, lambda v, s: v * s))


def squared_length(vec: Column | str) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda total, v: total + v * v)


def normalize_rows(rows: DataFrame) -> DataFrame:
    """Divide each row by its length; a zero row becomes a row of nulls."""
    lengths = rows.withColumn("_length", F.sqrt(squared_length("vec")))
    return lengths.withColumn("vec", F.transform("vec", lambda v: F.try_divide(v, F.col("_length")))).drop("_length")


def row_of(rows: DataFrame, key: object, id_col: str = "id") -> DataFrame:
    return rows.where(F.col(id_col) == F.lit(key))


def entries(rows: DataFrame) -> DataFrame:
    """``id, concept, score``: one row per matrix entry."""
    return rows.select("id", F.posexplode("vec").alias("concept", "score"))


def top_entries(rows: DataFrame, n: int, concepts: int | None = None, digits: int | None = None) -> DataFrame:
    """The ``n`` rows with the largest entry in each of the first ``concepts`` columns.

    ``concept, rank, id, score``, ties by id. The rows of each scan task are ranked by themselves
    first, for any ``n``, so a column held by all rows is no hot key.
    """
    vec = F.col("vec") if concepts is None else F.slice("vec", 1, concepts)
    long = entries(rows.select("id", vec.alias("vec")))
    if digits is not None:
        long = long.withColumn("score", F.round("score", digits))
    # Spark's own early cut stops above a limit; two ranks with a salt keep any column of any length out of one task.
    order = [F.desc("score"), "id"]
    part = Window.partitionBy("concept", "_part").orderBy(*order)
    long = long.withColumn("_part", F.spark_partition_id()).withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= n)
    best = Window.partitionBy("concept").orderBy(*order)
    return long.drop("_part", "_rank").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def neighbors(
    rows: DataFrame, top_n: int | None = 20, digits: int | None = None, block_rows: int = BLOCK_ROWS, observation: Observation | None = None
) -> DataFrame:
    """Cosine of every row with its nearest rows: ``id, other, score``.

    A row is its own first neighbour. ``top_n=None`` gives every pair. Rows of
    length zero have no direction and no neighbours. ``digits`` rounds the scores before they are ranked. Ties go to the lower id.

    Up to ``block_rows`` rows are multiplied in one task, and every pair of blocks where all pairs are asked for. Otherwise :func:`nearest`
    leaves out what can't hold a neighbour; ``observation`` then gets ``rows`` and ``products``, the numbers of rows sent to other blocks
    and of products there.
    """
    unit = normalize_rows(rows.select("id", "vec")).where(F.get("vec", F.lit(0)).isNotNull())
    blocks = max(1, ceil(rows.count() / block_rows))
    if top_n is not None and blocks > 1:
        return nearest(unit, top_n, digits, block_rows, observation)
    return _all_blocks(unit, top_n, digits, blocks)


def _all_blocks(unit: DataFrame, top_n: int | None, digits: int | None, blocks: int) -> DataFrame:
    """Products of all pairs of blocks, each pair in a task."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    own = F.col("_block")
    pairs = [
        F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.struct(own.alias("a"), i.alias("b"), F.lit(True).alias("left"))),
        F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.struct(i.alias("a"), own.alias("b"), F.lit(False).alias("left"))),
    ]
    placed = unit.withColumn("_block", block).select("id", "vec", F.inline(F.concat(*pairs)))
    id_type = unit.schema["id"].dataType.simpleString()

    def product(pair: pd.DataFrame) -> pd.DataFrame:
        return _best(pair[pair["left"]], pair[~pair["left"]], top_n, digits)

    return placed.groupBy("a", "b").applyInPandas(product, f"id {id_type}, other {id_type}, score double")


def _best(a: pd.DataFrame, b: pd.DataFrame, top_n: int | None, digits: int | None, reaching: bool = False) -> pd.DataFrame:
    """``id, other, score`` of the ``top_n`` rows of ``b`` nearest to each row of ``a``; if ``reaching``, without what doesn't come up to that row's score ``least``."""
    if a.empty or b.empty:
        return pd.DataFrame({"id": a["id"][:0], "other": a["id"][:0], "score": np.empty(0)})
    b = b.sort_values("id")
    n, m = len(b) if top_n is None else min(top_n, len(b)), len(b)
    score = np.stack(a["vec"]) @ np.stack(b["vec"]).T
    if reaching:
        hit = (score >= a["least"].to_numpy()[:, None] - SLACK).any(axis=1)
        a, score = a[hit], score[hit]
    if digits is not None:
        np.round(score, digits, out=score)
    # Of equal scores the lower ids come first, so those beyond the n-th score need no ranking.
    least = np.partition(score, m - n, axis=1)[:, m - n] if n < m else np.full(len(a), -np.inf)
    position = np.empty((len(a), n), np.int64)
    for i, row in enumerate(score):
        near = np.flatnonzero(row >= least[i])
        position[i] = near[np.argsort(-row[near], kind="stable")[:n]]
    score = np.take_along_axis(score, position, axis=1)
    found = pd.DataFrame({
        "id": np.repeat(a["id"].to_numpy(), n),
        "other": b["id"].to_numpy()[position.ravel()],
        "score": score.ravel() + 0.0,
    })
    return found[found["score"] >= np.repeat(a["least"].to_numpy(), n) - SLACK] if reaching else found


@dataclass(frozen=True)
class Blocks:
    """Rows of similar direction: for each block its cell's centre, the largest angle to it, and how many rows there are."""

    centres: np.ndarray
    parts: np.ndarray  # of each cell
    first: np.ndarray  # block of each cell's first part
    angle: np.ndarray
    size: np.ndarray

    @property
    def cell(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.parts)), self.parts)

    def place(self, vec: np.ndarray, ids: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Block of each row, and its angle to the centre."""
        cosine = vec @ self.centres.T
        cell = cosine.argmax(axis=1)
        spread = pd.util.hash_pandas_object(ids, index=False).to_numpy()
        return self.first[cell] + (spread % self.parts[cell].astype(np.uint64)).astype(np.int64), angles(cosine[np.arange(len(vec)), cell])

    def within_reach(self, vec: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Mask of rows by blocks that may hold a row of cosine ``least`` or more.

        A block's rows lie within its angle of the centre, so none is nearer to a vector than the angle between vector and centre less that one.
        They also lie on its centre's side of the plane between it and the vector's own centre, so none is nearer than that plane.
        """
        cosine = vec @ self.centres.T
        gap = angles(cosine)[:, self.cell] - self.angle
        nearest = cosine.argmax(axis=1)
        squares = np.einsum("ij,ij->i", self.centres, self.centres)
        between = np.sqrt(np.maximum(squares[nearest][:, None] + squares - 2 * self.centres[nearest] @ self.centres.T, 0))
        above = np.take_along_axis(cosine, nearest[:, None], axis=1) - cosine
        sine = np.where(between > LEAST_BETWEEN, above / np.maximum(between, LEAST_BETWEEN), 0)
        beyond = np.sqrt(np.maximum(1 - sine * sine, 0))[:, self.cell]
        return np.minimum(np.cos(np.maximum(gap, 0)), beyond) >= least[:, None] - SLACK


def angles(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def nearest(unit: DataFrame, top_n: int, digits: int | None, block_rows: int, observation: Observation | None = None) -> DataFrame:
    """The ``top_n`` nearest rows of each unit row, exactly, without the products of blocks too far away to hold one.

    Rows are dealt by direction into cells, and cells of more than ``block_rows`` rows, such as many rows of one direction, by a hash of the id into blocks.
    Each row is compared with its own block first. Its n-th best score there is what another block must reach, and only to blocks that can the
    row is sent, and only what reaches it comes back; a block's visitors come in groups of ``block_rows`` at most, each with a copy of the block. The driver and each task
    hold the centres of at most ``MAX_CELLS`` cells and three numbers of each block.
    """
    id_type = unit.schema["id"].dataType.simpleString()
    blocks = _blocks(unit, block_rows)
    sent = unit.sparkSession.sparkContext.broadcast(blocks)
    rounding = 0.0 if digits is None else 0.5 * 10.0**-digits

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(block=sent.value.place(np.stack(batch["vec"]), batch["id"])[0])

    placed = unit.mapInPandas(place, f"id {id_type}, vec array<double>, block long")

    def own(group: pd.DataFrame) -> pd.DataFrame:
        """Each row with its best in its own block, as lists, and the score that a stranger must reach."""
        found = _best(group, group, top_n, digits)
        n = len(found) // len(group)
        scores = found["score"].to_numpy().reshape(-1, n)
        least = scores[:, -1] - rounding if n == top_n else np.full(len(group), -np.inf)
        return group.assign(others=list(found["other"].to_numpy().reshape(-1, n)), scores=list(scores), least=least)

    known = placed.groupBy("block").applyInPandas(own, f"id {id_type}, vec array<double>, block long, others array<{id_type}>, scores array<double>, least double")

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), PROJECT_ROWS):
                part = batch.iloc[at : at + PROJECT_ROWS]
                mask = sent.value.within_reach(np.stack(part["vec"]), part["least"].to_numpy())
                mask[np.arange(len(part)), part["block"].to_numpy()] = False
                row, block = np.nonzero(mask)
                yield part[["id", "vec", "least"]].iloc[row].assign(block=block, rows=sent.value.size[block])

    visits = known.select("id", "vec", "block", "least").mapInPandas(reach, f"id {id_type}, vec array<double>, least double, block long, rows long")
    if observation is not None:
        visits = visits.observe(observation, F.count("*").alias("rows"), F.coalesce(F.sum("rows"), F.lit(0)).alias("products"))
    # A block that very many rows visit is no hot group: its visitors are dealt over copies of it.
    copies = visits.groupBy("block").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("copies"))
    visitors = visits.join(copies, "block").select("id", "vec", "least", "block", F.pmod(F.xxhash64("id"), "copies").alias("copy"), F.lit(True).alias("left"))
    hosts = placed.join(copies, "block").select("id", "vec", F.lit(0.0).alias("least"), "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), F.lit(False).alias("left"))

    def visit(group: pd.DataFrame) -> pd.DataFrame:
        return _best(group[group["left"]], group[~group["left"]], top_n, digits, reaching=True)

    abroad = visitors.unionByName(hosts).groupBy("block", "copy").applyInPandas(visit, f"id {id_type}, other {id_type}, score double")
    at_home = known.select("id", F.explode(F.arrays_zip("others", "scores")).alias("near")).select("id", F.col("near.others").alias("other"), F.col("near.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "other"))
    return at_home.unionByName(abroad).withColumn("_rank", rank).where(F.col("_rank") <= top_n).drop("_rank")


def _blocks(unit: DataFrame, block_rows: int) -> Blocks:
    """Centres from a bounded sample by spherical k-means, and all rows counted by cell; the sample moves the work, never a result."""
    total = unit.count()
    cells = max(1, min(MAX_CELLS, total // block_rows))
    share = min(1.0, cells * SAMPLE_PER_CELL / max(1, total))
    sample = unit.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("vec").toArrow()["vec"].to_pylist()
    centres = spherical_centres(np.array(sample), cells) if sample else np.ones((1, len((unit.first() or {"vec": [1.0]})["vec"])))
    sent = unit.sparkSession.sparkContext.broadcast(centres)
    one = lambda n: Blocks(sent.value, np.ones(n, np.int64), np.arange(n), np.zeros(n), np.zeros(n, np.int64))

    def figures(of: Callable[[], Blocks]) -> DataFrame:
        """``block, size, angle`` over all rows; each task sends one row for a block."""

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            blocks = of()
            n = int(blocks.parts.sum())
            size, angle = np.zeros(n, np.int64), np.zeros(n)
            for batch in batches:
                if len(batch):
                    block, apart = blocks.place(np.stack(batch["vec"]), batch["id"])
                    size += np.bincount(block, minlength=n)
                    np.maximum.at(angle, block, apart)
            used = np.flatnonzero(size)
            yield pd.DataFrame({"block": used, "size": size[used], "angle": angle[used]})

        return unit.mapInPandas(measure, "block long, size long, angle double").groupBy("block").agg(F.sum("size").alias("size"), F.max("angle").alias("angle"))

    def collected(found: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
        size, angle = np.zeros(n, np.int64), np.zeros(n)
        for r in found.collect():  # a row for each block
            size[r["block"]], angle[r["block"]] = r["size"], r["angle"]
        return size, angle

    n = len(centres)
    size, angle = collected(figures(lambda: one(n)), n)
    parts = np.maximum(1, -(-size // block_rows))
    blocks = Blocks(centres, parts, np.cumsum(parts) - parts, np.repeat(angle, parts), np.repeat(size, parts))
    if parts.max() == 1:
        return blocks
    split = unit.sparkSession.sparkContext.broadcast(blocks)
    size, angle = collected(figures(lambda: split.value), int(parts.sum()))
    return replace(blocks, size=size, angle=angle)


def spherical_centres(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of at most ``cells`` groups of unit rows."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample)), dtype=int)]
    for _ in range(rounds):
        sums = np.zeros_like(centres)
        for at in range(0, len(sample), BLOCK_ROWS):
            part = sample[at : at + BLOCK_ROWS]
            np.add.at(sums, (part @ centres.T).argmax(axis=1), part)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-300), centres)
    return np.unique(centres, axis=0)


def project(rows: DataFrame, keep: list[str], matrix: np.ndarray) -> DataFrame:
    """Sparse rows ``indices, values`` times a small dense matrix: ``keep…, vec``.

    The matrix has one row per vocabulary term and one column per concept, both
    bounded by their caps; it is sent to each executor once.
    """
    shared = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix))
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for whole in batches:
            for at in range(0, len(whole), PROJECT_ROWS):
                batch = whole.iloc[at : at + PROJECT_ROWS]
                sizes = batch["indices"].map(len).to_numpy()
                starts = np.cumsum(sizes) - sizes
                vec = np.zeros((len(batch), m.shape[1]))
                if sizes.sum():
                    weighted = m[np.concatenate(batch["indices"].to_list())] * np.concatenate(batch["values"].to_list())[:, None]
                    vec[sizes > 0] = np.add.reduceat(weighted, starts[sizes > 0], axis=0)
                yield batch[keep].assign(vec=list(vec))

    return rows.select(*keep, "indices", "values").mapInPandas(multiply, f"{kept}, vec array<double>")
