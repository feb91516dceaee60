"""Exact top-k search (8): vector-approximation files.

Vectors are whole numbers floor(SCALE * x).  The approximation file holds, for every vector, the number of the grid cell
of each component (``2 ** BITS`` cells between the component's smallest and largest value).  A search

1. scans the approximations in blocks: a block of queries against a block of cells gives, by two products, an upper and a
   lower bound of every inner product; a row stays only if its upper bound reaches the k-th best lower bound of its block,
2. keeps over all blocks the rows whose upper bound reaches the k-th best lower bound of the query,
3. reads exact vectors in order of their upper bounds: first the best ``2 * (k + 1)`` of every query; then only rows whose
   upper bound still reaches the k-th exact score.  After that the k-th result is certain.

Ids may repeat, so a query's own rows may be many: wherever a k-th score bounds what is left, the (k + 1)-th best id is taken,
of which at most one is the query's own.  Of rows with identical vectors only the k + 1 smallest ids can be among any query's
k best, so the others (a hot vector's copies) leave before the scan; equal rows of one id are one row with a count, and
identical query vectors are searched once.  Rows and query vectors have keys of their own.  Both sides of a scan are blocks of bounded size;
the number of blocks grows with the tables, no side is broadcast, and candidates are never capped.

Defined results: vectors null or with null or non-finite components, and rows without id, take no part; only vectors of the same
length meet; repeated ids are rows of their own (a query meets no row of its own id); fewer than k candidates: all.
Components must stay below 2**24 in size (whole numbers of 31 bits; larger ones raise an error).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm.store import written

SCALE = 64
BITS = 6
K = 20
QUERY_BLOCK = 1024
ROW_BLOCK = 8192


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, v) of the rows that take part."""
    x = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x")).where("id is not null and x is not null")
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return x.where(~bad).select("id", F.size("x").alias("dim"), F.transform("x", lambda c: F.floor(c * SCALE).cast("int")).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim)


def _cells(grid: dict[int, tuple[np.ndarray, np.ndarray]]):
    def run(batches):
        for b in batches:
            out = []
            for dim, v in zip(b.column(2).to_pylist(), b.column(3), strict=True):
                low, width = grid[dim]
                out.append((((np.array(v.as_py(), dtype=np.int64)) - low) // width).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.binary())], names=["rid", "id", "dim", "cells"])

    return run


def _scan(grid: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Bounds of a block of queries against a block of approximations; ``k`` counts ids."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))]
        if queries.num_rows and rows.num_rows:
            dim = queries.column("dim")[0].as_py()
            low, width = grid[dim]
            q = _matrix(queries.column("v"), dim).astype(np.float64)
            cells = np.frombuffer(b"".join(rows.column("cells").to_pylist()), dtype=np.uint8).reshape(rows.num_rows, dim)
            half = (width - 1) / 2.0
            centre = low + cells * width + half
            slack = np.abs(q) @ half
            qid, rid, ids = queries.column("qid").to_numpy(), rows.column("rid").to_numpy(), rows.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            runs = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) != 0]))
            for at in range(0, len(q), 128):
                mid = q[at : at + 128] @ centre.T
                best = mid if len(runs) == len(ids) else np.maximum.reduceat(mid[:, order], runs, axis=1)  # of each id
                kth = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k] if best.shape[1] >= k else np.full(len(mid), -np.inf)
                # lower bound of the k-th against upper bounds: mid + slack >= kth - slack
                s = slack[at : at + 128]
                r, c = np.nonzero(mid >= (kth - 2 * s - 1e-6)[:, None])
                found.append((qid[at + r], rid[c], ids[c], mid[r, c] + s[r], mid[r, c] - s[r]))
        return pa.table({n: np.concatenate(x) for n, x in zip(("qid", "rid", "id", "upper", "lower"), zip(*found, strict=True), strict=True)})

    return run


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, id, score): the k largest inner products of every query row with all other rows, ties to smaller ids.

    ``is_query`` is a condition on the column ``id``.
    """
    need = k + 1  # ids: a query's own may be among its best
    every = written(whole_vectors(vectors, id_col, vec_col), "vectors")
    first = W.partitionBy("dim", "v").orderBy("id")
    counted = every.groupBy("dim", "v", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    rows = written(counted.withColumn("n", F.row_number().over(first)).where(F.col("n") <= need)
                   .select(F.monotonically_increasing_id().alias("rid"), "id", "dim", "v", "copies"), "rows")
    asked = every.where(is_query)
    queries = written(asked.select("dim", "v").distinct().withColumn("qid", F.monotonically_increasing_id()), "queries")

    # the grid: two numbers per component
    edge = rows.select("dim", F.posexplode("v").alias("at", "x")).groupBy("dim", "at").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()
    counts = rows.groupBy("dim").agg(F.count("*").alias("n")).join(queries.groupBy("dim").agg(F.count("*").alias("q")), "dim", "left").collect()
    grid = {c["dim"]: (np.zeros(c["dim"], np.int64), np.ones(c["dim"], np.int64)) for c in counts}
    for e in edge:
        low, width = grid[e["dim"]]
        low[e["at"]], width[e["at"]] = e["low"], -(-(e["high"] - e["low"] + 1) // (1 << BITS))
    spark = vectors.sparkSession
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    blocks = spark.createDataFrame([(c["dim"], -(-(c["q"] or 0) // QUERY_BLOCK), -(-c["n"] // ROW_BLOCK)) for c in counts], "dim int, qs int, rs int").where("qs > 0")
    approximations = written(rows.select("rid", "id", "dim", "v").mapInArrow(_cells(grid), "rid long, id long, dim int, cells binary"), "cells")
    right = (approximations.join(blocks, "dim").withColumn("rb", F.pmod(F.xxhash64("rid"), F.col("rs")).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qs") - 1))).select("dim", "qb", "rb", "rid", "id", "cells"))
    left = (queries.join(blocks, "dim").withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("qs")).cast("int"))
            .withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("rs") - 1))).select("dim", "qb", "rb", "qid", "v"))
    key = ["dim", "qb", "rb"]
    bounds = written(left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(_scan(grid, need), "qid long, rid long, id long, upper double, lower double"), "bounds")

    def bound(scores: DataFrame, column: str) -> DataFrame:
        """The ``need``-th best id's value of every query that has as many ids."""
        best = scores.groupBy("qid", "id").agg(F.max(column).alias("kth"))
        return best.withColumn("n", F.row_number().over(W.partitionBy("qid").orderBy(F.col("kth").desc()))).where(F.col("n") == need).select("qid", "kth")

    def left_over(pairs: DataFrame, kth: DataFrame) -> DataFrame:
        return pairs.join(kth, "qid", "left").where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth") - 1e-6))

    by_upper = W.partitionBy("qid").orderBy(F.col("upper").desc(), "id", "rid")
    near = written(left_over(bounds, bound(bounds, "lower")).select("qid", "rid", "upper", F.row_number().over(by_upper).alias("n")), "candidates")

    def exact(pairs: DataFrame) -> DataFrame:
        both = pairs.select("qid", "rid").join(rows.select("rid", "id", "v", "copies"), "rid").join(queries.select("qid", F.col("v").alias("q")), "qid")
        dot = F.aggregate(F.zip_with("v", "q", lambda a, b: a.cast("long") * b.cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
        return both.select("qid", "id", "copies", dot.alias("score"))

    start = written(exact(near.where(F.col("n") <= 2 * need)), "exact")
    rest = left_over(near.where(F.col("n") > 2 * need), bound(start, "score"))
    scores = start.union(exact(rest))
    ids = asked.join(queries, ["dim", "v"]).select(F.col("id").alias("query_id"), "qid")
    final = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    met = ids.join(scores, "qid").where("id != query_id").select("query_id", "id", "score", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return met.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
