"""Near-duplicate vectors in the cells of spherical k-means (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .graph import components, forest
from .scratch import Scratch

CELL_ROWS = 128
MAX_CELLS = 4096
SAMPLE_PER_CELL = 32
BLOCK_ROWS = 2048
ROUNDS = 8
SLICE_ROWS = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of at most ``cells`` cells of unit vectors; products are made for ``SLICE_ROWS`` vectors at a time."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample)), dtype=int)]
    for _ in range(rounds):
        sums = np.zeros_like(centres)
        for at in range(0, len(sample), SLICE_ROWS):
            part = sample[at : at + SLICE_ROWS]
            np.add.at(sums, (part @ centres.T).argmax(axis=1), part)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-300), centres)
    return np.unique(centres, axis=0)


def near_cells(vectors: np.ndarray, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each unit vector, and a mask of the other cells in which it is compared too.

    Linked vectors lie within d = sqrt(2 - 2 cosine). If two of them have different cells, they are on
    either side of the plane between the centres, so one of them is within d / 2 of it: that
    one is copied to the other's cell, and no link is lost.
    """
    near = vectors @ centres.T
    home = near.argmax(axis=1)
    used, row = np.unique(home, return_inverse=True)
    apart = np.sqrt(np.maximum(2 - 2 * (centres[used] @ centres.T), 0))[row]
    gap = near[np.arange(len(near)), home][:, None] - near
    copy = gap <= apart * (np.sqrt(max(0.0, 2 - 2 * cosine)) / 2) + 1e-6
    copy[np.arange(len(near)), home] = False
    return home, copy


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` numbers as the rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def compare_block(a: dict, b: dict, cell: int, cosine: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` link and count in this cell; a pair met in two cells counts in the lower one."""
    linked = unit(a["x"]) @ unit(b["x"]).T >= cosine
    for copies, homes, turned in ((a, b, False), (b, a, True)):
        view = linked.T if turned else linked
        for other in np.unique(copies["home"][copies["home"] != cell]):
            rows = copies["home"] == other
            also = np.array([cell > other and other in (c or ()) for c in homes["copies"]], bool)
            view[rows] &= (homes["home"] == cell) & ~also
    return linked


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", cosine: float = 0.98, max_cells: int = MAX_CELLS
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Vectors link when their labels are equal and not null, their lengths are equal and their cosine in
    double precision reaches ``cosine``. Null, empty and zero vectors and those with null, NaN or infinite parts
    link with nothing. Equal vectors are compared once and counted by their number. Centres come from a sample of at most
    about ``SAMPLE_PER_CELL`` x ``max_cells`` vectors; every vector is assigned and compared, so the sample moves the work,
    never the result. A cell of more than ``BLOCK_ROWS`` rows is compared block by block in tasks of their own. A null id takes
    part but names no component unless all its members are null.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    label = F.col(label_col).cast("string") if label_col else F.lit("")
    rows = vectors.select(F.col(id_col).alias("vec_id"), label.alias("label"), F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists("x", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = rows.where("usable").groupBy("label", "x").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    classes = scratch.keep(classes.withColumn("class", F.monotonically_increasing_id()).withColumn("size", F.size("x")), "classes")

    # Centres serve all labels; the label with most vectors decides how many there are.
    most = classes.groupBy("size", "label").count().groupBy("size").agg(F.sum("count").alias("total"), F.max("count").alias("label"))
    size, total, largest = most.orderBy(F.desc("total"), "size").first() or (1, 0, 0)
    cells = max(1, min(max_cells, largest // CELL_ROWS))
    share = min(1.0, cells * SAMPLE_PER_CELL / max(1, total))
    sample = classes.where((F.col("size") == size) & (F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)).select("x").toArrow()
    points = unit(matrix(sample.column("x"), size)) if sample.num_rows else np.ones((1, size))
    sent = vectors.sparkSession.sparkContext.broadcast(spherical_kmeans(points, cells))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                home, copies = np.zeros(batch.num_rows, int), [[] for _ in range(batch.num_rows)]
                fits = np.flatnonzero(batch.column("size").to_numpy() == centres.shape[1])
                if len(fits):
                    x = unit(matrix(batch.column("x").take(pa.array(fits)), centres.shape[1]))
                    home[fits], mask = near_cells(x, centres, cosine)
                    for i, m in zip(fits, mask, strict=True):
                        copies[i] = np.flatnonzero(m).tolist()
                # The list of copies goes with the row in its own cell only.
                take = np.repeat(np.arange(len(home)), [1 + len(c) for c in copies])
                cell = [c for h, own in zip(home, copies, strict=True) for c in (h, *own)]
                out = batch.select(["label", "x", "n", "class", "size"]).take(pa.array(take))
                more = [pa.array(cell, pa.int32()), pa.array(home[take], pa.int32()), pa.array([own for c in copies for own in (c, *[None] * len(c))], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*out.columns, *more], [*out.schema.names, "cell", "home", "copies"])

    placed = classes.select("label", "x", "n", "class", "size").mapInArrow(assign, "label string, x array<double>, n long, class long, size int, cell int, home int, copies array<int>")
    counted = placed.groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = placed.join(scratch.keep(counted, "blocks"), ["label", "size", "cell"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        size, cell, i, j = (k.as_py() for k in key[1:])
        block = table.column("block").to_numpy()
        sides = []
        for b in (i, j):
            t = table.filter(pa.array(block == b))
            sides.append({"x": matrix(t.column("x"), size), "n": t.column("n").to_numpy(), "class": t.column("class").to_numpy(), "home": t.column("home").to_numpy(), "copies": t.column("copies").to_pylist()})
        a, b = sides
        if not len(a["n"]) or not len(b["n"]):
            return pa.table({"class": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "peer": pa.array([], pa.int64())})
        linked = compare_block(a, b, cell, cosine)
        if i == j:
            np.fill_diagonal(linked, False)
            ids, links, square = a["class"], linked @ a["n"], linked
        else:
            ids, links = np.concatenate([a["class"], b["class"]]), np.concatenate([linked @ b["n"], linked.T @ a["n"]])
            square = np.zeros((len(ids), len(ids)), bool)
            square[: len(a["n"]), len(a["n"]) :] = linked
            square[len(a["n"]) :, : len(a["n"])] = linked.T
        hit = links > 0
        return pa.table({"class": ids[hit], "links": links[hit].astype(np.int64), "peer": forest(square, ids)[hit]})

    found = placed.groupBy("label", "size", "cell", "i", "j").applyInArrow(compare, "class long, links long, peer long")
    found = scratch.keep(found, "found")
    linked = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("class").alias("a"), F.col("peer").alias("b")), scratch)
    marks = classes.select("label", "x", "class", "n", "least_id").join(linked, "class", "left").join(groups.withColumnRenamed("id", "class"), "class", "left")
    marks = scratch.keep(marks.withColumn("component", F.coalesce("component", "class")), "marks")
    names = scratch.keep(marks.groupBy("component").agg(F.min("least_id").alias("component_id")), "names")
    marks = scratch.keep(marks.join(names, "component").select("label", "x", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "named")
    joined = rows.join(marks, ["label", "x"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op1_near_vectors(spark, sf):
    return near_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))
