"""Whitening of vectors by spectral divide and conquer (operator 13).

Tasks sum exact moments of fixed-point vectors and centred products, which are merged in rounds. The covariance, as
large as the vectors are wide, is split by its spectrum: the polar factor U of the shifted matrix, from dynamically
weighted Halley iterations, gives the projector (U + I) / 2 on the eigenvectors above the shift, a basis of either
side makes the matrix two smaller ones, and so on down to single components. The whitening matrix is then broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
# Entries from here on, once scaled, have no place in fixed point and count as not finite.
LARGEST = 2.0**50
ROWS_AT_ONCE = 1024
MERGED_AT_ONCE = 32
MAX_ROUNDS = 60
TINY = np.finfo(float).eps
MOMENTS = "n long, sums array<string>, mean binary, products binary"


# --- spectral divide and conquer -------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley iterations.

    Nakatsukasa, Bai and Gygi (2010). The lower bound of the singular values starts at the smallest that double
    precision tells from zero, so six or seven rounds do for any matrix.
    """
    size = len(a)
    x = a / np.linalg.norm(a)
    low = TINY
    for _ in range(MAX_ROUNDS):
        low2 = low * low
        d = np.cbrt(4 * (1 - low2) / (low2 * low2))
        root = np.sqrt(1 + d)
        alpha = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low2) / (low2 * root))) / 2
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q = np.linalg.qr(np.concatenate([np.sqrt(gamma) * x, np.eye(size)]))[0]
        new = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * (q[:size] @ q[size:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (alpha + beta * low2) / (1 + gamma * low2))
        if moved <= np.cbrt(4 * TINY) and low >= 1 - 1e-15:
            break
    return x


def split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int, float] | None:
    """An orthogonal basis whose first k vectors span the eigenvectors above the shift; k; what is left between both parts."""
    size = len(a)
    shifted = a - shift * np.eye(size)
    if not np.linalg.norm(shifted):
        return None
    projector = (polar(shifted) + np.eye(size)) / 2
    k = round(float(np.trace(projector)))
    if not 0 < k < size:
        return None
    basis = np.linalg.qr(projector @ rng.standard_normal((size, k)), mode="complete")[0]
    # One more step of subspace iteration makes up for an unlucky start.
    basis = np.linalg.qr(projector @ basis[:, :k], mode="complete")[0]
    between = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
    return basis, k, float(between)


def divide(a: np.ndarray, wanted: int, floor: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues, at least, and their vectors; ``floor`` is a norm that rounding alone may have."""
    size = len(a)
    centre = np.trace(a) / size
    if size == 1 or np.linalg.norm(a - centre * np.eye(size)) <= floor:
        return np.diag(a).copy(), np.eye(size)
    diagonal = np.sort(np.diag(a))
    best = None
    # The mean of the eigenvalues lies strictly between the least and the largest; the others halve the matrix more evenly.
    for shift in (np.median(diagonal), centre, *(diagonal[:-1] + np.diff(diagonal) / 2)[:: max(1, size // 8)]):
        found = split(a, float(shift), rng)
        if found and (best is None or found[2] < best[2]):
            best = found
        if best and best[2] <= floor:
            break
    if best is None:  # only rounding tells the eigenvalues apart
        return np.diag(a).copy(), np.eye(size)
    basis, k, _ = best
    upper, lower = basis[:, :k], basis[:, k:]
    values, vectors = divide(_symmetric(upper.T @ a @ upper), wanted, floor, rng)
    vectors = upper @ vectors
    if k < wanted:
        more, others = divide(_symmetric(lower.T @ a @ lower), wanted - k, floor, rng)
        values, vectors = np.concatenate([values, more]), np.concatenate([vectors, lower @ others], axis=1)
    return values, vectors


def _symmetric(a: np.ndarray) -> np.ndarray:
    return (a + a.T) / 2


def eigen(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    size = len(a)
    floor = TINY * np.linalg.norm(a) * np.sqrt(size)
    if not floor:
        return np.zeros(min(wanted, size)), np.eye(size)[:, :wanted]
    _, vectors = divide(_symmetric(a), min(wanted, size), 4 * floor, np.random.default_rng(0))
    vectors = np.linalg.qr(vectors)[0]
    # What rounding has left between the vectors is turned away to first order.
    inner = _symmetric(vectors.T @ a @ vectors)
    values = np.diag(inner).copy()
    apart = values[None, :] - values[:, None]
    turn = np.where(np.abs(apart) > 1e3 * floor, inner / np.where(apart == 0, 1, apart), 0)
    np.fill_diagonal(turn, 0)
    vectors = np.linalg.qr(vectors + vectors @ turn)[0]
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


# --- moments ----------------------------------------------------------------------


class Moments:
    """Number, exact sums, mean and centred products of rows; two of them merge into those of all their rows."""

    def __init__(self, n: int, sums: list[int], mean: np.ndarray, products: np.ndarray) -> None:
        self.n, self.sums, self.mean, self.products = n, sums, mean, products

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        centred = x - mean
        exact = [int(s) for s in x.sum(axis=0, dtype=np.int64)] if x.dtype.kind == "i" else []
        return cls(len(x), exact, mean, centred.T @ centred)

    def add(self, other: Moments) -> None:
        n, apart = self.n + other.n, other.mean - self.mean
        self.products += other.products
        self.products += np.outer(apart, apart) * (self.n / n * other.n)
        self.mean = self.mean + apart * (other.n / n)
        self.sums = [a + b for a, b in zip(self.sums, other.sums, strict=True)]
        self.n = n

    def row(self) -> tuple:
        return self.n, [str(s) for s in self.sums], self.mean.tobytes(), self.products.tobytes()

    @classmethod
    def read(cls, row: tuple) -> Moments:
        n, sums, mean, products = row
        mean = np.frombuffer(mean)
        return cls(n, [int(s) for s in sums], mean.copy(), np.frombuffer(products).reshape(len(mean), len(mean)).copy())


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    n, sums, mean, products = zip(*rows, strict=True) if rows else ((),) * 4
    types = [pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((n, sums, mean, products), types, strict=True)], ["n", "sums", "mean", "products"])


def merged(parts: DataFrame, scratch: Scratch) -> Moments | None:
    """The sum of moments, one row each, merged by ``MERGED_AT_ONCE`` a task until one is left; the driver gets that one only."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if total is None:
                    total = Moments.read(row)
                else:
                    total.add(Moments.read(row))
        yield _batch_of([total.row()] if total else [])

    parts = scratch.keep(parts, "moments")
    while (count := parts.count()) > 1:
        parts = scratch.keep(parts.repartition(-(-count // MERGED_AT_ONCE)).mapInArrow(merge, MOMENTS), "moments")
    row = parts.first()
    return Moments.read((row["n"], row["sums"], bytes(row["mean"]), bytes(row["products"]))) if row else None


def moments_of(rows: DataFrame, column: str, width: int, scratch: Scratch) -> Moments | None:
    """Moments of the vectors of ``width`` numbers in a column; whole numbers are also summed exactly. None without a row."""
    whole = dict(rows.dtypes)[column] == "array<bigint>"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                x = _matrix(batch.column(0).slice(at, ROWS_AT_ONCE), width)
                own = Moments.of(x)
                if total is None:
                    total = own
                else:
                    total.add(own)
        if total and not whole:
            total.sums = []
        yield _batch_of([total.row()] if total else [])

    return merged(rows.select(column).mapInArrow(sums, MOMENTS), scratch)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


# --- whitening --------------------------------------------------------------------


@dataclass
class Whitening:
    """What the vectors were fitted to; ``offset`` is inside ``sums`` but not inside ``centre``."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    offset: int

    @property
    def explained(self) -> list[float]:
        """Share of each component in the total variance; 0 where there is none."""
        return [float(v / self.trace) if self.trace else 0.0 for v in self.values]

    @property
    def usable(self) -> np.ndarray:
        """Components with a variance that rounding alone can't make."""
        return self.values > 64 * TINY * max(self.values, default=0.0) * max(1, len(self.vectors))


def fixed_point(vectors: DataFrame, id_col: str, vector_col: str, scale: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """``vec_id, x`` with x = floor(scale * entry), for vectors of finite entries and of the length that most have; that length."""
    scaled = F.transform(vector_col, lambda c: F.lit(float(scale)) * c.cast("double"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), scaled.alias("scaled"))
    usable = F.forall("scaled", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)) & (F.size("scaled") > 0)
    rows = rows.where(F.coalesce(usable, F.lit(False))).select("vec_id", F.transform("scaled", lambda c: F.floor(c).cast("long")).alias("x"))
    rows = scratch.keep(rows, "fixed")
    most = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = most["width"] if most else 0
    return rows.where(F.size("x") == width), width


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums over the dimensions of (n * x - sum) ** 2 for each row."""
    # n * x - sum is n * (x - quotient) - remainder; the first factor is small for most rows.
    quotients, remainders = zip(*(divmod(s, n) for s in sums), strict=True)
    near = x - np.array(quotients, np.int64)
    bound = (n + 1) * (int(np.abs(near).max(initial=0)) + 1)
    if bound * bound * x.shape[1] < 1 << 63:
        return ((n * near - np.array(remainders, np.int64)) ** 2).sum(axis=1).tolist()
    remainders = np.array(remainders, object)
    return [int(sum((n * row.astype(object) - remainders) ** 2)) for row in near]


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> tuple[DataFrame, Whitening | None, float]:
    """``vec_id, deviation, whitened`` for each vector; the fit; the largest entry of the result's covariance less the identity.

    An entry c becomes the whole number floor(scale * c) + offset, so that sums are exact however the rows are dealt. ``whitened``
    has up to ``components`` numbers, the centred vector projected on the unit eigenvectors of the covariance (divisor n) over the
    square roots of the eigenvalues; a component without variance has null. ``deviation``, a decimal of 38 digits, is the exact sum of
    (n * x - sum) ** 2 over the dimensions, null beyond 38 digits. Null and empty vectors and those with null, NaN or infinite entries, or with one of 2 ** 50 or more once scaled,
    have no row, nor have those of another length than most (of equally frequent lengths the shorter counts). Ids may be null or repeat, each
    row counts. No vector gives no row, no fit and an error of 0.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    rows, width = fixed_point(vectors, id_col, vector_col, scale, scratch)
    moments = moments_of(rows, "x", width, scratch)
    if moments is None:
        return rows.select("vec_id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")), None, 0.0
    covariance = moments.products / moments.n
    values, basis = eigen(covariance, components)
    fit = Whitening(moments.n, [s + offset * moments.n for s in moments.sums], values, basis, float(np.trace(covariance)), offset)
    usable = fit.usable
    quotients, remainders = zip(*(divmod(s, moments.n) for s in moments.sums), strict=True)
    weights = np.where(usable, basis / np.sqrt(np.where(usable, values, 1.0)), 0.0)
    sent = vectors.sparkSession.sparkContext.broadcast((moments.n, moments.sums, np.array(quotients, np.int64), np.array(remainders, float) / moments.n, weights))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, quotient, rest, weights = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                x = _matrix(batch.column(1), width)
                projected = ((x - quotient) - rest) @ weights
                ends = pa.array(np.arange(0, projected.size + 1, projected.shape[1], dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(projected.ravel()))
                exact = pa.array([Decimal(d) if d < 10**38 else None for d in deviations(x, n, sums)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([batch.column(0), exact, lists], ["vec_id", "deviation", "whitened"])

    id_type = dict(rows.dtypes)["vec_id"]
    out = scratch.keep(rows.mapInArrow(project, f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>"), "whitened")
    spread = moments_of(out, "whitened", len(values), scratch)
    error = np.abs(spread.products / spread.n - np.eye(len(values)))[np.ix_(usable, usable)].max(initial=0.0)
    if not usable.all():
        kept = F.array(*[F.lit(bool(u)) for u in usable])
        out = out.withColumn("whitened", F.zip_with("whitened", kept, lambda z, k: F.when(k, z)))
    return out, fit, float(error)


def op13_whitening(spark, sf):
    out, fit, error = whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))
    shares = fit.explained if fit else []
    share = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    rows = out.select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(fit.n if fit else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
