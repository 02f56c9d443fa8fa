"""Embedding whitening (11): PCA whitening by a weighted multiplicity covariance.

Vectors become integer vectors x (``floor(scale * c) + offset``) and identical ones are
grouped, with their number of copies. The fit list holds each distinct x once, with weight one
or with its copies as weight. Its sums are exact integers; the covariance is a GEMM of the
centred vectors, numpy per Arrow batch, one partial matrix per task, summed up by Spark. The
driver gets only the summed matrix (dimensions squared) for its eigenvectors. Each distinct
vector is whitened once and joined back to its rows by a SHA-256 digest, so that of the rows
only (id, digest) is shuffled. A vector that a third of the rows hold is pre-aggregated to one
row per task, and AQE splits its rows in the join, whose other side has been written out.

Centring is exact in x: with m the integer nearest to the mean, x - m is an integer and only
the remaining fraction is rounded.

Defined results:
* a row whose vector is null, empty, or holds a null, NaN or infinite entry is left out;
* vectors of several lengths have no common space: an error;
* repeated ids and null ids: a result per row; vectors that occur often count once per
  distinct x (``weights='one'``) or with their copies (``'copies'``);
* components whose variance is zero to double precision (fewer distinct vectors than
  dimensions, constant dimensions) have null ``whitened`` and are not part of
  ``identity_error``; without any variance ``explained`` and ``identity_error`` are null;
* a ``deviation`` that does not fit a long is null; equal eigenvalues: any of their bases;
* empty table: empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, checkpoint

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
BATCH_BYTES = 4 << 20
SCHEMA = ("component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def vector_rows(df: DataFrame, id_col: str, vec_col: str, scale: int, offset: int) -> DataFrame:
    """(id, x): the rows with a whole finite vector, as integers."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where(F.coalesce(finite & (F.size(v) > 0), F.lit(False))).select(
        F.col(f"`{id_col}`").alias("id"), F.transform(v, lambda c: F.floor(c * scale) + offset).alias("x"))


def _digest(x: str):
    return F.unhex(F.sha2(F.concat_ws(",", F.col(x).cast("array<string>")), 256))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(table: DataFrame, column: str, dims: int, kind: str) -> tuple[int, list]:
    """Weighted number of the vectors and their sum per dimension (``kind`` long: exact)."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            w = b.column("weight").to_numpy(zero_copy_only=False)
            part = (_matrix(b.column(column), dims) * w[:, None]).sum(axis=0)
            n, total = n + int(w.sum()), part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dims), pa.int32()), "n": pa.array([n] * dims, pa.int64()),
                                              "total": pa.array(total.tolist(), pa.int64() if kind == "long" else pa.float64())})

    got = (table.select(column, "weight").mapInArrow(partial, f"dim int, n long, total {kind}")
           .groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())  # a row per dimension
    got = sorted(got, key=lambda r: r.dim)
    return (got[0].n, [r.total for r in got]) if got else (0, [])


def _covariance(table: DataFrame, column: str, n: int, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Covariance (divisor ``n``) about the centre ``whole + part``, taken off one after the other."""
    dims = len(part)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            c = (_matrix(b.column(column), dims) - whole).astype(float) - part
            total += c.T @ (c * b.column("weight").to_numpy(zero_copy_only=False)[:, None])
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(dims), pa.int32()), "row": pa.array(total.tolist(), pa.list_(pa.float64()))})

    cells = (table.select(column, "weight").mapInArrow(partial, "i int, row array<double>")
             .select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")))
    out = np.zeros((dims, dims))
    for r in cells.collect():  # dimensions squared
        out[r.i, r.j] = r.v
    return (out + out.T) / (2 * n)


def _components(cov: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors (columns), the largest entry of each positive."""
    e, vectors = np.linalg.eigh(cov)
    e, vectors = e[::-1][:limit], vectors[:, ::-1][:, :limit]
    return e, vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])] < 0, -1, 1)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of (n x - S)^2 per vector; null where it does not fit a long."""
    centre = [round(s / n) for s in sums]
    rest = [n * m - s for m, s in zip(centre, sums)]
    near = x - np.array(centre, dtype=np.int64)
    bound = n * int(np.abs(near).max(initial=0)) + max(map(abs, rest))
    if x.shape[1] * bound * bound < 1 << 63:
        return ((n * near + np.array(rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((near.astype(object) * n + np.array(rest, dtype=object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
           offset: int = OFFSET, components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """One row per remaining row and component (see the module)."""
    if weights not in ("one", "copies"):
        raise ValueError("weights must be 'one' or 'copies'")
    spark = df.sparkSession
    rows = vector_rows(df, id_col, vec_col, scale, offset)
    empty = rows.select(F.col("id").alias(id_col)).limit(0).selectExpr(
        f"`{id_col}`", *[f"CAST(NULL AS {f.split()[1]}) AS {f.split()[0]}" for f in SCHEMA.split(", ")])
    distinct = checkpoint(rows.groupBy("x").agg(F.count("*").alias("copies")).select(
        "x", _digest("x").alias("key"), (F.col("copies") if weights == "copies" else F.lit(1).cast("long")).alias("weight")))
    low, high = distinct.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if low is None:
        return empty
    if low != high:
        raise ValueError(f"vectors of several lengths: {low} to {high}")
    with arrow_batches(spark, max(1, BATCH_BYTES // (8 * high))):
        n, sums = _sums(distinct, "x", high, "long")
        whole = np.array([round(s / n) for s in sums], dtype=np.int64)
        part = np.array([(s - n * int(m)) / n for s, m in zip(sums, whole)])
        cov = _covariance(distinct, "x", n, whole, part)
        e, vectors = _components(cov, min(components, high))
        trace = float(np.trace(cov))
        real = e > high * np.finfo(float).eps * max(e[0], 0.0)
        scaled = vectors[:, real] / np.sqrt(e[real])

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _matrix(b.column("x"), high)
                y = ((x - whole).astype(float) - part) @ scaled
                yield pa.RecordBatch.from_pydict({
                    "key": b.column("key"), "weight": b.column("weight"), "deviation": pa.array(_deviation(x, n, sums), pa.int64()),
                    "y": pa.array(list(y), pa.list_(pa.float64()))})

        white = checkpoint(distinct.mapInArrow(project, "key binary, weight long, deviation long, y array<double>"))
        error, size = None, int(real.sum())
        if size:
            mean = np.array(_sums(white, "y", size, "double")[1]) / n
            error = float(np.abs(_covariance(white, "y", n, np.zeros(size), mean) - np.eye(size)).max())
    # Components without variance come last (eigenvalues fall) and find no entry in y.
    explained = F.array(*[F.lit(float(v / trace) if trace > 0 else None).cast("double") for v in e])
    j = rows.select("id", _digest("x").alias("key")).join(white, "key")
    return j.select("id", "deviation", "y", F.posexplode(explained).alias("_k", "explained")).select(
        F.col("id").alias(id_col), (F.col("_k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.get("y", F.col("_k")).alias("whitened"), "explained", F.lit(error).cast("double").alias("identity_error"))
