"""Embedding whitening (12): shifted CholeskyQR.

Vectors become whole numbers x = floor(SCALE * c).  The fit list is every distinct x once (n rows, per-dimension sums S); its
centred rows (n * x - S) / n form the tall matrix A, which is never gathered:

1. *Shifted pass.*  The Gram matrix of A is summed over the partitions (one d x d partial for each task, added up in a tree);
   R1 is the Cholesky factor of Gram + shift * I.  The shift, 11 (n d + d (d + 1)) u |A|^2, keeps the factorisation alive
   however ill-conditioned A is.
2. *Passes.*  Q = A R1^-1 R2^-1 ... is formed block by block through triangular solves, its Gram matrix is summed, and the
   next R is its Cholesky factor (shifted again where columns of A depend on each other), until Q is orthonormal or
   ``PASSES`` passes are done; columns in the null space of A never become so, their part of R goes to zero instead.
3. A = Q R with R the product of the factors, so the singular values and right singular vectors of the small R are those of A:
   eigenvalues s^2 / n and eigenvectors of the covariance, without ever squaring A's condition.

The driver holds d x d matrices (d: vector length) and one d-vector, whatever the number of rows.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are dropped; of several vector lengths
that with the most distinct vectors is whitened (ties: the shorter), the others are dropped; repeated rows give rows each but count once in
the fit list; null ids are kept.  Components without variance (constant tables, fewer distinct rows than components) are
not reported.  ``deviation`` is null where a 64-bit integer can't hold it.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import written

SCALE = 256
COMPONENTS = 4
PASSES = 6
#: Q counts as orthonormal when its Gram matrix differs from the identity by no more.
ORTHONORMAL = 1e-13
#: Partials that one task adds up in a round of the tree.
FAN = 64


@dataclass
class Whitening:
    n: int
    sums: list[int]
    #: Unit eigenvectors in columns and eigenvalues of the covariance, falling.
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    passes: int = 0
    identity_error: float = 0.0

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.vectors / np.sqrt(self.values)


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, x) of the rows that take part."""
    c = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("c")).where("c is not null and size(c) > 0")
    bad = F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return c.where(~bad).select("id", F.transform("c", lambda v: F.floor(v * scale).cast("long")).alias("x"))


def _centred(column: pa.Array, n: int, sums: np.ndarray) -> np.ndarray:
    d = len(sums)
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)
    return (n * x - sums) / n


def _solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a r^-1 for an upper triangular r, by forward substitution over the columns."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def summed(partials: DataFrame, tasks: int) -> np.ndarray:
    """Sum of the (part, values) rows: a tree of rounds in which a task adds up ``FAN`` arrays in the order of their parts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for part, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = values.values.to_numpy(zero_copy_only=False)
                if at is not None and part // FAN != at:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["part", "values"])
                    total = None
                at, total = part // FAN, v.copy() if total is None else total + v
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["part", "values"])

    level = partials
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        level = level.repartitionByRange(tasks, F.floor(F.col("part") / FAN)).sortWithinPartitions("part").mapInArrow(add, "part long, values array<double>")
    rows = sorted(level.collect(), key=lambda r: r["part"])  # at most FAN arrays (twice that where a range cuts a run)
    return np.sum([np.array(r["values"]) for r in rows], axis=0) if rows else np.empty(0)


def _gram(fit: DataFrame, tasks: int, form: Callable[[np.ndarray], np.ndarray], n: int, sums: np.ndarray, width: int) -> np.ndarray:
    """Gram matrix of the rows that ``form`` makes of the centred rows."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                q = form(_centred(batch.slice(at, 4096).column(0), n, sums))
                total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.reshape(-1)], pa.list_(pa.float64()))], names=["part", "values"])

    return summed(fit.select("x").mapInArrow(run, "part long, values array<double>"), tasks).reshape(width, width)


def cholesky_qr(gram: Callable[[list[np.ndarray]], np.ndarray], n: int, d: int) -> tuple[np.ndarray, float, int]:
    """(R, squared Frobenius norm, passes) of the matrix whose ``gram(factors)`` is that of A R1^-1 R2^-1 ...

    The norm is that of A scaled to its largest column, whose scale is the first factor."""
    factors: list[np.ndarray] = []
    first = gram(factors)
    norm = float(np.trace(first))
    if norm <= 0:
        return np.zeros((d, d)), 0.0, 0
    unit = np.finfo(np.float64).eps / 2
    g, r = first, np.eye(d)
    for _ in range(PASSES):
        shift = 11 * (n * d + d * (d + 1)) * unit * float(np.linalg.norm(g, 2)) if not factors else 0.0
        while True:
            try:
                step = np.linalg.cholesky(g + shift * np.eye(d)).T
                break
            except np.linalg.LinAlgError:  # dependent columns
                shift = max(10 * shift, 11 * (d * d + d * (d + 1)) * unit * float(np.linalg.norm(g, 2)))
        factors.append(step)
        r = step @ r
        g = gram(factors)
        if np.abs(g - np.eye(d)).max() <= ORTHONORMAL:
            break
    return r, norm, len(factors)


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors ``fit_list`` (x array<long>, all of one length); None for no rows.

    ``fit_list`` is read once a pass: pass a written table."""
    d_row = fit_list.select(F.size("x").alias("d")).first()
    if d_row is None:
        return None
    d = d_row["d"]
    total = fit_list.agg(F.count("*").alias("n"), F.array(*[F.sum(F.element_at("x", i + 1).cast("decimal(19,0)")) for i in range(d)]).alias("s")).first()
    n, exact = int(total["n"]), [int(v) for v in total["s"]]
    sums = np.array(exact, dtype=np.float64)
    tasks = fit_list.rdd.getNumPartitions()

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        steps = list(factors)

        def form(a: np.ndarray) -> np.ndarray:
            for r in steps:
                a = _solved(a, r)
            return a

        return _gram(fit_list, tasks, form, n, sums, d)

    r, norm, passes = cholesky_qr(gram, n, d)
    _, s, vt = np.linalg.svd(r)
    # directions below the rounding of the whole matrix have no variance
    held = min(components, int((s > max(n, d) * np.finfo(np.float64).eps * max(s[0], 0)).sum()) if norm > 0 else 0)
    model = Whitening(n, exact, vt[:held].T, s[:held] ** 2 / n, norm / n, passes)
    if held:
        centre = _gram(fit_list, tasks, model.project, n, sums, held) / n
        model.identity_error = float(np.abs(centre - np.eye(held)).max())
    return model


def _deviation(x: Column, n: int, sums: list[int]) -> Column:
    """Sum over dimensions of (n x - S)^2 in whole numbers; null where they leave 64 bits."""
    if any(abs(s) >= 1 << 63 for s in sums):
        return F.lit(None).cast("long")
    off = lambda v, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), v), s)
    squares = F.zip_with(x, F.array(*[F.lit(s).cast("long") for s in sums]), lambda v, s: F.try_multiply(off(v, s), off(v, s)))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda a, v: F.try_add(a, v))


def whitened(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row for each remaining row and component."""
    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    x = written(whole_vectors(rows, id_col, vec_col, scale), "whole")
    lists = x.select("x").distinct()
    lengths = lists.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    model = fit(written(lists.where(F.size("x") == lengths["d"]), "fit"), components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    n, sums, held = model.n, np.array(model.sums, dtype=np.float64), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            w = model.project(_centred(batch.column(1), n, sums))
            each = np.repeat(np.arange(batch.num_rows), held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, held + 1, dtype=np.int32), batch.num_rows)), batch.column(2).take(pa.array(each)), pa.array(w.reshape(-1))],
                names=["id", "component", "deviation", "whitened"])

    kept = x.where(F.size("x") == lengths["d"]).select("id", "x", _deviation(F.col("x"), n, model.sums).alias("deviation"))
    out = kept.mapInArrow(run, "id long, component int, deviation long, whitened double")
    share = F.element_at(F.array(*[F.lit(float(v / model.trace)) for v in model.values]), F.col("component"))
    return out.select("id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(model.identity_error).alias("identity_error"))
