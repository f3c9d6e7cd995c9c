"""Whitening embeddings along refined eigenvectors of their covariance.

The covariance is summed up in tasks, so the driver sees one matrix of the dimensions
whatever the number of vectors. Its eigenvectors are found in float32 and corrected to
double precision by Ogita and Aishima's iteration, which is matrix multiplications
only. That iteration divides by differences of eigenvalues; where some lie closer
together than the error they still have, the cluster's own small problem is solved
after its common part is taken off, which makes its differences large again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.scaling import Staging

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
TILE_ROWS = 4096
"""Vectors multiplied at a time."""

LARGEST = float(1 << 60)
"""Scaled entries beyond this, which float32 can hold, count as this."""


# ---------------------------------------------------------------------------
# Eigenvectors
# ---------------------------------------------------------------------------
def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Positions of eigenvalues that lie together, neighbours at most ``width`` apart."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return np.split(order, cuts)


def eigenvectors(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    From eigenvectors in float32, each round multiplies matrices in float64: ``r`` says
    how far ``x`` is from orthonormal, ``s`` how far from diagonal it makes ``a``.
    """
    dims = len(a)
    scale = np.abs(a).max(initial=0.0)
    if scale == 0.0:
        return np.zeros(dims), np.eye(dims)
    a = a / scale
    norm = np.linalg.norm(a, 2)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    eps = np.finfo(np.float64).eps
    for _ in range(rounds):
        r = np.eye(dims) - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1.0 - np.diag(r))
        error = 2.0 * (np.linalg.norm(s - np.diag(values), 2) + norm * np.linalg.norm(r, 2))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > error
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1.0), r / 2.0)
        x = x + x @ step
        for cluster in _clusters(values, error):
            if 1 < len(cluster) < dims or (len(cluster) == dims and error > dims * eps * norm):
                x[:, cluster] = _solved_apart(a, x[:, cluster], norm)
        if np.abs(step).max() <= 4 * eps and error <= 4 * dims * eps * norm:
            break
    for _ in range(2):
        # small differences leave vectors a little oblique
        x = x + x @ (np.eye(dims) - x.T @ x) / 2.0
    s = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-s, kind="stable")
    x = x[:, order]
    return s[order] * scale, x / np.linalg.norm(x, axis=0)


def _solved_apart(a: np.ndarray, x: np.ndarray, norm: float) -> np.ndarray:
    """The basis of a cluster turned to its eigenvectors.

    Without the mean of the cluster's eigenvalues what is left is as small as their
    differences, so float32 tells them apart as well as it told the others.
    """
    x = np.linalg.qr(x)[0]
    inner = x.T @ a @ x
    mean = np.trace(inner) / len(inner)
    left = x.T @ (a @ x - mean * x)
    left = (left + left.T) / 2.0
    width = np.abs(left).max()
    if width <= 4 * len(a) * np.finfo(np.float64).eps * norm:
        return x
    return x @ np.linalg.eigh((left / width).astype(np.float32))[1].astype(np.float64)


# ---------------------------------------------------------------------------
# Sums in tasks
# ---------------------------------------------------------------------------
def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The integers of a batch's vectors, one row each."""
    values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    scaled = np.floor(values.astype(np.float64) * SCALE)
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64) + SHIFT


def _tiles(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, TILE_ROWS):
            tile = batch.slice(start, TILE_ROWS)
            yield tile, _vectors(tile, dims)


def _sums(dims: int):
    """Exact sums of a task's vectors by dimension, as decimal text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for _, x in _tiles(batches, dims):
            n += len(x)
            # halves, so that no sum of a tile leaves 64 bits
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 32) + k for t, h, k in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(dims), pa.int32()),
                    pa.array([n] * dims, pa.int64()),
                    pa.array([str(t) for t in total], pa.string()),
                ],
                names=["dim", "n", "total"],
            )

    return run


def _products(dims: int, mean: np.ndarray):
    """Sums of a task's centred products: a row of the matrix for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for _, x in _tiles(batches, dims):
            centred = x - mean
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            names=["dim", "products"],
        )

    return run


def _matrix(df: DataFrame, run, dims: int) -> np.ndarray:
    """Sum of the tasks' matrices; cells are added up in Spark, only the sum is collected."""
    parts = df.mapInArrow(run, "dim int, products array<double>")
    cells = (
        parts.select("dim", F.posexplode("products").alias("other", "v"))
        .groupBy("dim", "other")
        .agg(F.sum("v").alias("v"))
    )
    out = np.zeros((dims, dims))
    for r in cells.collect():
        out[r["dim"], r["other"]] = r["v"]
    return (out + out.T) / 2.0


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of ``(n * x - sum) ** 2``, exact; None beyond 64 bits."""
    rough = ((n * x.astype(np.float64) - np.array([float(s) for s in sums])) ** 2).sum(axis=1)
    small = float(n) * np.abs(x).max(initial=0) < 2**61 and max(map(abs, sums)) < 2**61
    out: list[int | None] = [None] * len(x)
    exact = np.flatnonzero(rough < 2**61) if small else np.zeros(0, np.int64)
    off = n * x[exact] - np.array(sums if small else [0] * len(sums), np.int64)
    for i, d in zip(exact.tolist(), (off * off).sum(axis=1).tolist()):
        out[i] = d
    known = set(exact.tolist())
    for i in np.flatnonzero(rough < 2**64).tolist():
        if i not in known:
            d = sum((n * v - s) ** 2 for v, s in zip(x[i].tolist(), sums))
            out[i] = d if d < 2**63 else None
    return out


def _whiten(dims: int, n: int, sums: list[int], mean: np.ndarray, basis: np.ndarray, kept: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, x in _tiles(batches, dims):
            white = (x - mean) @ basis
            yield pa.RecordBatch.from_arrays(
                [
                    *(tile.column(c) for c in kept),
                    pa.array(_deviations(x, n, sums), pa.int64()),
                    pa.array(list(white), pa.list_(pa.float64())),
                ],
                names=[*kept, "deviation", "white"],
            )

    return run


def _spread(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            w = batch.column("white").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            # a column of ones, so that the sums come along
            w = np.hstack([w, np.ones((len(w), 1))])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            names=["dim", "products"],
        )

    return run


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------
def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, has entries, and these are all finite numbers."""
    v = F.col(f"`{vector}`")
    # NaN is greater than any number
    finite = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    return df.filter(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))


def whiten(
    df: DataFrame,
    staging: Staging,
    vector: str = "embedding",
    keep: list[str] | None = None,
    components: int = COMPONENTS,
) -> DataFrame:
    """``keep`` and ``(n, deviation, white, explained, identity_error)`` for every usable row.

    An entry ``c`` counts as the whole number ``floor(1024 * c) + 100000``; ``white[k]`` is
    the centred vector along the eigenvector of the ``k``-th largest eigenvalue ``e``, over
    the root of ``e``; ``explained[k]`` is ``e`` over the sum of all. ``identity_error`` is
    measured on the whitened rows: the largest entry of their covariance minus the
    identity. Vectors that are null, empty or hold a null or non-finite entry are left out,
    as are those whose length is not the most frequent one (of two the longer). Repeated
    rows and ids count one by one. Along a direction without variance - constant
    dimensions, fewer vectors than dimensions - ``white`` is null, ``explained`` 0.
    ``deviation`` is null where it is beyond 64 bits. Columns of ``df`` whose names are
    added here are replaced. An empty table gives an empty one. The driver holds matrices
    of the dimensions only.
    """
    added = ("n", "deviation", "white", "explained", "identity_error")
    kept = tuple(c for c in (df.columns if keep is None else keep) if c not in (*added, "v"))
    found = usable(df, vector).select(*[f"`{c}`" for c in kept], F.col(f"`{vector}`").alias("v"))
    sizes = (
        found.groupBy(F.size("v").alias("dims"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.max(F.struct("rows", "dims")).alias("most"))
        .first()["most"]
    )
    dims = sizes["dims"] if sizes else 1
    found = found.filter(F.size("v") == dims)
    only = found.select("v")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    by_dim = only.mapInArrow(_sums(dims), "dim int, n bigint, total string").groupBy("dim")
    rows = sorted(by_dim.agg(F.sum("n").alias("n"), total).collect(), key=lambda r: r["dim"])
    n, sums = (rows[0]["n"], [int(r["total"]) for r in rows]) if rows else (1, [0] * dims)
    mean = np.array([s / n for s in sums])
    covariance = _matrix(only, _products(dims, mean), dims) / n
    values, vectors = eigenvectors(covariance)
    top = min(components, dims)
    trace = float(np.trace(covariance))
    # below this an eigenvalue is rounding
    real = values[:top] > max(values[0], 0.0) * dims * np.finfo(np.float64).eps * 8
    basis = np.where(real, vectors[:, :top] / np.sqrt(np.where(real, values[:top], 1.0)), 0.0)

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    schema = f"{fields}{', ' if fields else ''}deviation bigint, white array<double>"
    white = staging.table(
        found.mapInArrow(_whiten(dims, n, sums, mean, basis, kept), schema), "white"
    )
    spread = _matrix(white.select("white"), _spread(top), top + 1)
    sums_white = spread[:top, top] / n
    off = spread[:top, :top] / n - np.outer(sums_white, sums_white) - np.eye(top)
    error = float(np.abs(off[np.ix_(real, real)]).max(initial=0.0))
    numbers = F.array(*[F.lit(bool(r)) for r in real])
    return white.select(
        *[f"`{c}`" for c in kept],
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.zip_with("white", numbers, lambda w, r: F.when(r, w)).alias("white"),
        F.array(*[F.lit(float(v / trace) if r else 0.0) for v, r in zip(values, real)]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_whitening(spark, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    white = whiten(vectors, Staging(spark), keep=["vec_id"])
    each = F.posexplode(F.arrays_zip("white", "explained")).alias("k", "c")
    return white.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("c.white").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )


QUERIES = {"op12_whitening": op12_whitening}
# Eigenvectors are beyond SQL; tested against a direct decomposition of all rows.
ORACLE: dict[str, str] = {}
