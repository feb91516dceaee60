"""Second moments of column pairs by products of column blocks.

Every task multiplies its Arrow batches (``n x a`` by ``n x b``) and keeps one state per pair of column blocks, so a row is
never repeated for the pairs it takes part in.  A state holds, for each pair, the count, means and centred sums over the rows
where *both* columns are present; states merge by the exact update for centred sums.  Memory of a task and rows that leave it
depend on the number of columns only.  The states of all tasks meet in two steps, so no task reads those of every other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block.
BLOCK = 32
#: Groups that the tasks' states are first summed in.
SLOTS = 64

_N, _MEAN_X, _MEAN_Y, _XX, _YY, _XY, _RAW_X, _RAW_Y = range(8)
_STATE = "block int, slot int, part int, state binary"
_PAIRS = "a int, b int, n long, xx double, yy double, xy double, raw_x double, raw_y double"


def _centred(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(presence, differences from the first present value, that value) of each column; a constant column gives exact zeros."""
    held = np.isfinite(v)
    origin = np.where(held.any(axis=0), v[held.argmax(axis=0), np.arange(v.shape[1])], 0.0)
    return held.astype(np.float64), np.where(held, v - origin, 0.0), origin


def _state(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    (mx, dx, ox), (my, dy, oy) = _centred(x), _centred(y)
    n, sx, sy = mx.T @ my, dx.T @ my, mx.T @ dy
    raw_x, raw_y = (dx * dx).T @ my, mx.T @ (dy * dy)
    some = np.maximum(n, 1)
    return np.stack([n, np.where(n > 0, ox[:, None] + sx / some, 0), np.where(n > 0, oy[None, :] + sy / some, 0),
                     np.maximum(raw_x - sx * sx / some, 0), np.maximum(raw_y - sy * sy / some, 0), dx.T @ dy - sx * sy / some, raw_x, raw_y])


def _merged(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    out = p + q
    share = q[_N] / np.maximum(out[_N], 1)
    dx, dy = q[_MEAN_X] - p[_MEAN_X], q[_MEAN_Y] - p[_MEAN_Y]
    between = p[_N] * share
    out[_MEAN_X], out[_MEAN_Y] = p[_MEAN_X] + dx * share, p[_MEAN_Y] + dy * share
    for at, d in ((_XX, dx * dx), (_YY, dy * dy), (_XY, dx * dy), (_RAW_X, dx * dx), (_RAW_Y, dy * dy)):
        out[at] += d * between
    return out


def _partial(blocks: list[tuple[list[int], list[int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            with np.errstate(over="ignore", invalid="ignore"):
                for k, (x, y) in enumerate(blocks):
                    s = _state(v[:, x], v[:, y])
                    held[k] = _merged(held[k], s) if k in held else s
        part = TaskContext.get().partitionId()
        for k, s in held.items():
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([k], pa.int32()), "slot": pa.array([part % SLOTS], pa.int32()), "part": pa.array([part], pa.int32()),
                "state": pa.array([s.tobytes()], pa.binary())})

    return run


def _summed(shapes: list[tuple[int, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(block, slot, state) of rows sorted by (block, slot)."""
    at, held = None, None
    for batch in batches:
        for block, slot, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
            s = np.frombuffer(state).reshape(8, *shapes[block])
            if at == (block, slot):
                held = _merged(held, s)
            else:
                if at is not None:
                    yield *at, held
                at, held = (block, slot), s
    if at is not None:
        yield *at, held


def _slots(shapes: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, slot, s in _summed(shapes, batches):
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int32()), "slot": pa.array([0], pa.int32()), "part": pa.array([slot], pa.int32()),
                "state": pa.array([s.tobytes()], pa.binary())})

    return run


def _pairs(blocks: list[tuple[list[int], list[int]]], shapes: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, s in _summed(shapes, batches):
            x, y = blocks[block]
            a, b = np.repeat(x, len(y)), np.tile(y, len(x))
            flat = s.reshape(8, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(flat[_N].astype(np.int64)),
                 *[pa.array(flat[k]) for k in (_XX, _YY, _XY, _RAW_X, _RAW_Y)]],
                names=["a", "b", "n", "xx", "yy", "xy", "raw_x", "raw_y"])

    return run


def pair_moments(df: DataFrame, left: Sequence[str], right: Sequence[str] | None = None) -> DataFrame:
    """(a, b, n, xx, yy, xy, raw_x, raw_y) for each pair of a ``left`` and a ``right`` column, given by their places in those lists,
    or for the pairs a <= b of ``left`` (``right`` None): count of rows where both are present, centred sums of squares and
    products, and the sums before centring (what of xx, yy is lost to cancellation is small against them).  Null, NaN and
    infinite values are missing.  An empty table gives no rows.  Reruns over the same partitions add in the same order."""
    cut = lambda n, start: [list(range(start + i, start + min(i + BLOCK, n))) for i in range(0, n, BLOCK)]
    rows, names = cut(len(left), 0), list(left)
    if right is None:
        blocks = [(x, y) for k, x in enumerate(rows) for y in rows[k:]]
    else:
        names += list(right)
        blocks = [(x, y) for x in rows for y in cut(len(right), len(left))]
    shapes = [(len(x), len(y)) for x, y in blocks]
    wide = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(names)])
    states = wide.mapInArrow(_partial(blocks), _STATE)
    slots = states.repartition("block", "slot").sortWithinPartitions("block", "slot", "part").mapInArrow(_slots(shapes), _STATE)
    out = slots.repartition("block").sortWithinPartitions("block", "slot", "part").mapInArrow(_pairs(blocks, shapes), _PAIRS)
    if right is None:
        return out.where("a <= b")
    return out.withColumn("b", F.col("b") - len(left))
