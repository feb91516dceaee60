"""Exact k nearest neighbours (R5) over equal-frequency leaves.

1. *Equal vectors are one point* with its k + 1 smallest keys (more can't be neighbours of anything), so a hot vector is one
   point whatever its rows.
2. *Leaves.*  Round by round every oversized leaf is cut at quantiles of its widest coordinate into up to ``WAYS`` parts
   (a value that fills a whole part becomes one of its own), until no leaf holds more than ``leaf`` points.  The rounds
   form a tree; each node keeps its count and box.  Narrow vectors are their own coordinates; wide ones
   (over ``WIDE`` entries) get their distances to ``PIVOTS`` far-apart vectors, whose differences never exceed
   the distance (triangle inequality).
3. *Pairs of nodes*, from the root down: children of a pair that may hold neighbours are paired again; a node's bound is the
   least radius within which other nodes surely hold k + 1 points, and pairs farther apart than it are dropped.
   Every level is an equi-join on the level before, never all pairs of leaves.
4. *Points.*  First against the leaves that make up the bound: the k-th distance found there is the point's own radius.  Then
   against the leaves of the remaining pairs whose box comes within that radius.  What is dropped is farther than k found
   points, so the result is exact; in wide vectors without structure the bounds exclude little, and the work approaches that of all pairs.
   Wide vectors therefore have larger leaves, which meet as blocks: one matrix product per pair of leaves finds what may be near, and
   only that gets its exact distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

WAYS = 8
WIDE = 8
PIVOTS = 8
#: Vectors (the smallest hashes) that the pivots are chosen from, farthest first.
PIVOT_SAMPLE = 256
#: Rounding that bounds are widened by.
SLACK = 1e-9
#: Wide vectors: a leaf holds the points of one of so many, at most LEAF_MOST, at least ``leaf``.
LEAVES = 32
LEAF_MOST = 4096
#: Rows of a block whose distances, and candidates whose differences, are held at a time.
BLOCK_ROWS = 256
BLOCK_CANDIDATES = 65_536


def dist2(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def _pivots(points: DataFrame) -> list[list[float]]:
    few = [r["v"] for r in points.orderBy(F.xxhash64("v"), "g").limit(PIVOT_SAMPLE).collect()]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    chosen = few[:1]
    while few and len(chosen) < PIVOTS:
        chosen.append(max(few, key=lambda v: min(apart(v, c) for c in chosen)))
    return chosen


class _Metric:
    """Bounds of the squared distance between boxes of coordinates."""

    def __init__(self, wide: bool):
        self.wide = wide

    def _fold(self, parts: Column) -> Column:
        return F.pow(F.array_max(parts), F.lit(2)) if self.wide else F.aggregate(parts, F.lit(0.0), lambda a, v: a + v * v)

    def gap(self, lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
        ahead = F.zip_with(lo_b, hi_a, lambda x, y: x - y)
        behind = F.zip_with(lo_a, hi_b, lambda x, y: x - y)
        return self._fold(F.zip_with(ahead, behind, lambda x, y: F.greatest(x, y, F.lit(0.0))))

    def reach(self, lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
        if self.wide:  # over a pivot: no farther than both distances to it
            return F.pow(F.array_min(F.zip_with(hi_a, hi_b, lambda x, y: x + y)), F.lit(2))
        return self._fold(F.zip_with(F.zip_with(hi_b, lo_a, lambda x, y: x - y), F.zip_with(hi_a, lo_b, lambda x, y: x - y), lambda x, y: F.greatest(x, y)))


def _leaves(points: DataFrame, width: int, leaf: int) -> tuple[DataFrame, list[DataFrame]]:
    """(points with their node of every level l0, l1, ..., boxes of every level); the last level's nodes are the leaves."""
    boxes: list[DataFrame] = []
    held, level = points.withColumn("l0", F.lit("")), 0
    while True:
        here, above = f"l{level}", f"l{max(level - 1, 0)}"
        at = [F.element_at("c", i + 1) for i in range(width)]
        box = cut_lineage(held.groupBy(F.col(here).alias("node"), F.col(above).alias("parent"))
                          .agg(F.count(F.lit(1)).alias("n"), F.array(*[F.min(x) for x in at]).alias("lo"), F.array(*[F.max(x) for x in at]).alias("hi")))
        boxes.append(box)
        if not (box.agg(F.max("n")).first()[0] or 0) > leaf:
            return held, boxes
        spread = F.zip_with("hi", "lo", lambda a, b: a - b)
        split = box.where(F.col("n") > leaf).select(F.col("node").alias(here), F.least(F.lit(WAYS), F.ceil(F.col("n") / leaf)).cast("int").alias("ways"),
                                                    F.array_position(spread, F.array_max(spread)).cast("int").alias("dim"))
        valued = held.join(split, here, "left").withColumn("x", F.element_at("c", F.coalesce("dim", F.lit(1))))
        marks = (valued.where("dim is not null").groupBy(here).agg(F.percentile_approx("x", [i / 64 for i in range(1, 64)], 1000).alias("q"), F.first("ways").alias("w"))
                 .select(here, F.transform(F.sequence(F.lit(1), F.col("w") - 1), lambda i: F.element_at("q", F.floor(i * 64 / F.col("w")).cast("int"))).alias("cuts")))
        part = 2 * F.size(F.filter("cuts", lambda c: c < F.col("x"))) + F.array_contains("cuts", F.col("x")).cast("int")
        level += 1
        held = cut_lineage(valued.join(marks, here, "left").withColumn(f"l{level}", F.concat_ws(".", here, F.coalesce(part, F.lit(0)).cast("string"))).drop("ways", "dim", "x", "cuts"))


def _node_pairs(boxes: list[DataFrame], metric: _Metric, k: int) -> DataFrame:
    """(a, b, sure): pairs of leaves that may hold neighbours; ``sure`` ones make up the bound of a."""
    pairs = None
    by_reach = Window.partitionBy("a").orderBy("reach", "b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for box in boxes:
        side = lambda s: box.select(F.col("node").alias(s), F.col("parent").alias(f"p{s}"), F.col("n").alias(f"n{s}"), F.col("lo").alias(f"lo{s}"), F.col("hi").alias(f"hi{s}"))  # noqa: E731, B023
        a, b = side("a"), side("b")
        above = box.select(F.col("parent").alias("pa"), F.col("parent").alias("pb")) if pairs is None else pairs.select(F.col("a").alias("pa"), F.col("b").alias("pb"))
        met = above.join(a, "pa").join(b, "pb")
        ends = [F.col(c) for c in ("loa", "hia", "lob", "hib")]
        met = met.select("a", "b", "nb", metric.gap(*ends).alias("gap"), metric.reach(*ends).alias("reach")).withColumn("held", F.sum("nb").over(by_reach))
        bound = F.coalesce(F.min(F.when(F.col("held") > k, F.col("reach"))).over(Window.partitionBy("a")), F.lit(float("inf")))
        pairs = cut_lineage(met.withColumn("bound", bound).where(F.col("gap") <= F.col("bound") * (1 + SLACK))
                            .select("a", "b", (F.col("reach") <= F.col("bound")).alias("sure")))
    return pairs


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1)


def _nearest_in_block(ids: np.ndarray, rows: np.ndarray, radius: np.ndarray, others: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(row, other, squared distance) of each row's ``k`` nearest points of a block, itself left out, ties by the smaller
    id, none farther than its radius.  Products give distances but for rounding; what they leave in doubt is computed as
    ``dist2`` does."""
    kept, rank = [], np.unique(others, return_inverse=True)[1]
    norms = (points * points).sum(axis=1)
    # |x|^2 + |y|^2 - 2xy is off by no more than this share of |x|^2 + |y|^2
    share = 4 * (points.shape[1] + 4) * np.finfo(float).eps
    for at in range(0, len(rows), BLOCK_ROWS):
        part = slice(at, at + BLOCK_ROWS)
        own, x = (rows[part] * rows[part]).sum(axis=1)[:, None], rows[part]
        with np.errstate(invalid="ignore", over="ignore"):
            near = own + norms - 2 * (x @ points.T)
            doubt = share * (own + norms.max())
        near[ids[part][:, None] == others] = np.inf
        limit = radius[part] * (1 + SLACK)
        if len(points) > k:
            kth = np.partition(near, k - 1, axis=1)[:, k - 1]
            limit = np.fmin(limit, np.where(np.isnan(kth), np.inf, kth + 2 * doubt[:, 0]))
        i, j = np.nonzero(~(near > (limit[:, None] + doubt)) & (ids[part][:, None] != others))
        d = np.empty(len(i))
        for c in range(0, len(i), BLOCK_CANDIDATES):
            some = slice(c, c + BLOCK_CANDIDATES)
            total = np.zeros(len(i[some]))
            for u, v in zip(x[i[some]].T, points[j[some]].T, strict=True):  # in the order of the entries, as dist2 adds
                total += (u - v) * (u - v)
            d[some] = total
        order = np.lexsort((rank[j], d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        kept.append((ids[part][i[first]], others[j[first]], d[first]))
    return tuple(np.concatenate(c) for c in zip(*kept, strict=True))


def _blocks(met: DataFrame, pairs: DataFrame, p: DataFrame, k: int, key_type: str) -> DataFrame:
    """(q, p, d): of every pair of leaves the ``k`` nearest points for each of its rows ``met`` (a, b, q, qv, r)."""
    other = pairs.join(p.where("p is not null"), "b").select(F.col("a").alias("oa"), F.col("b").alias("ob"), "p", "pv")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"q": pa.array([], left["q"].type), "p": pa.array([], left["q"].type), "d": pa.array([], pa.float64())})
        q, o, d = _nearest_in_block(left["q"].to_numpy(), _matrix(left["qv"]), left["r"].to_numpy(), right["p"].to_numpy(), _matrix(right["pv"]), k)
        return pa.table({"q": pa.array(q, left["q"].type), "p": pa.array(o, left["q"].type), "d": pa.array(d)})

    return met.where("q is not null").groupBy("a", "b").cogroup(other.groupBy("oa", "ob")).applyInArrow(run, f"q {key_type}, p {key_type}, d double")


def knn(points: DataFrame, key: str, vec: str, k: int = 5, leaf: int = 12, counts: dict | None = None) -> DataFrame:
    """Exact k nearest neighbours (Euclidean, ties by neighbour key) of every point among the other points.
    Output (key, j, nb_key, dist2), j = 1..k.  Rows without vector take no part; ``counts`` is given what the search did: points, compared
    pairs, largest leaf."""
    rows = points.select(F.col(key).alias("_k"), F.col(vec).cast("array<double>").alias("v")).where("v is not null")
    first = rows.first()
    width = len(first["v"]) if first else 0
    if width == 0:
        return points.sparkSession.createDataFrame([], "key long, j int, nb_key long, dist2 double").withColumnRenamed("key", key)
    nth = Window.partitionBy("v").orderBy("_k")
    distinct = (rows.withColumn("i", F.row_number().over(nth)).where(F.col("i") <= k + 1)
                .groupBy("v").agg(F.min("_k").alias("g"), F.sort_array(F.collect_list("_k")).alias("keys")))
    distinct = cut_lineage(distinct)
    metric = _Metric(width > WIDE)
    if metric.wide:
        pivots = _pivots(distinct)
        coordinates = F.array(*[F.sqrt(dist2(F.col("v"), F.array(*[F.lit(float(x)) for x in p]))) for p in pivots])
        leaf = max(leaf, min(LEAF_MOST, distinct.count() // LEAVES))
    else:
        pivots, coordinates = [], F.col("v")
    held, boxes = _leaves(distinct.withColumn("c", coordinates), len(pivots) or width, leaf)
    pairs = _node_pairs(boxes, metric, k)

    last = f"l{len(boxes) - 1}"
    q = held.select(F.col(last).alias("a"), F.col("g").alias("q"), F.col("v").alias("qv"), F.col("c").alias("qc"))
    p = held.select(F.col(last).alias("b"), F.col("g").alias("p"), F.col("v").alias("pv"))
    top = Window.partitionBy("q").orderBy("d", "p")

    def compared(met: DataFrame) -> DataFrame:
        return met.join(p, "b").where(F.col("q") != F.col("p")).select("q", "p", dist2(F.col("qv"), F.col("pv")).alias("d"))

    def nearest(found: DataFrame) -> DataFrame:
        return found.withColumn("j", F.row_number().over(top)).where(F.col("j") <= k).drop("j")

    def searched(met: DataFrame, leaves: DataFrame) -> DataFrame:
        return _blocks(met.select("a", "b", "q", "qv", "r"), leaves, p, k, dict(distinct.dtypes)["g"]) if metric.wide else compared(met)

    sure_pairs, other_pairs = pairs.where("sure").select("a", "b"), pairs.where("not sure").select("a", "b")
    sure_met = sure_pairs.join(q.withColumn("r", F.lit(float("inf"))), "a")
    near = cut_lineage(nearest(searched(sure_met, sure_pairs)))
    radius = near.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).select("q", F.when(F.col("n") >= k, F.col("d")).otherwise(float("inf")).alias("r"))
    box = boxes[-1].select(F.col("node").alias("b"), "lo", "hi")
    maybe = other_pairs.join(box, "b").join(q.join(radius, "q", "left").withColumn("r", F.coalesce("r", F.lit(float("inf")))), "a")
    maybe_met = maybe.where(metric.gap(F.col("qc"), F.col("qc"), F.col("lo"), F.col("hi")) <= F.col("r") * (1 + SLACK)).select("a", "b", "q", "qv", "r")
    best = nearest(near.unionByName(searched(maybe_met, other_pairs)))
    if counts is not None:
        counts |= {"points": distinct.count(), "pairs": compared(sure_met).count() + compared(maybe_met).count(), "largest_leaf": boxes[-1].agg(F.max("n")).first()[0]}

    # neighbours of a vector: its own keys at distance 0 and those of its neighbours; a row leaves itself out
    others = best.join(distinct.select(F.col("g").alias("p"), F.col("keys").alias("theirs")), "p").groupBy("q").agg(
        F.flatten(F.collect_list(F.transform("theirs", lambda x: F.struct(F.col("d").alias("d"), x.alias("key"))))).alias("far"))
    own = F.transform("keys", lambda x: F.struct(F.lit(0.0).alias("d"), x.alias("key")))
    listed = distinct.join(others.withColumnRenamed("q", "g"), "g", "left").select("v", F.array_sort(F.when(F.col("far").isNull(), own).otherwise(F.concat(own, "far"))).alias("near"))
    mine = rows.join(listed, "v").select("_k", F.posexplode(F.slice(F.filter("near", lambda e: e["key"] != F.col("_k")), 1, k)).alias("j", "e"))
    return mine.select(F.col("_k").alias(key), (F.col("j") + 1).alias("j"), F.col("e.key").alias("nb_key"), F.col("e.d").alias("dist2"))
