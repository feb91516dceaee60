"""Distributed ranks, running totals and exact quantiles.

Spark only distributes a window over its ``partitionBy`` keys; a window ordered over a
whole table (or over one huge group, e.g. one class label) runs in a single task.  All
global orderings in this library therefore go through ``running_totals``:

1. the caller gives a *bucket* column that is monotone in the sort order (md5 prefix,
   or a binary-search bucket over approximate quantile bounds);
2. totals per (group, bucket) form a small table (groups x buckets rows);
3. an exclusive running sum over that small table gives each bucket's offset;
4. the running sum inside a bucket is an ordinary window partitioned by (group, bucket),
   so the heavy sort is spread over all buckets;
5. offset + in-bucket running sum = the exact global value.

Buckets come from uniform hashes or approximate quantiles, so they are balanced even
when one group (e.g. a class label) holds most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.exprs import md5_bucket

# Offsets tables are (groups x buckets) rows; broadcast them below this many rows.
OFFSETS_BROADCAST_MAX_ROWS = 2_000_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null equal to null; the keys come from ``left``."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(r[f"_r_{k}"])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    sum_cols: Sequence[str],
    order_cols: Sequence[str | Column],
    bucket_col: str,
    partition_cols: Sequence[str] = (),
    prefix: str = "cum_",
    offsets_rows_bound: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` within ``partition_cols`` in ``order_cols``
    order.  ``bucket_col`` must be non-decreasing in that order within each group.
    ``offsets_rows_bound``: a proven upper bound on groups x buckets; when given and
    small the offsets table is broadcast."""
    parts = list(partition_cols)
    unbounded = Window.unboundedPreceding
    w_in = Window.partitionBy(*parts, bucket_col).orderBy(*order_cols).rowsBetween(unbounded, Window.currentRow)
    local = df.select("*", *[F.sum(c).over(w_in).alias(f"_loc_{c}") for c in sum_cols])
    tot = df.groupBy(*parts, bucket_col).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    # Window over the small totals table only (groups x buckets rows).
    w_off = Window.partitionBy(*parts).orderBy(bucket_col).rowsBetween(unbounded, -1)
    off = tot.select(
        *parts, bucket_col,
        *[F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
    )
    if offsets_rows_bound is not None and offsets_rows_bound <= OFFSETS_BROADCAST_MAX_ROWS:
        off = F.broadcast(off)
    joined = null_safe_join(local, off, [*parts, bucket_col])
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"{prefix}{c}") for c in sum_cols],
    )


def hash_rank(
    df: DataFrame,
    hex_col: str,
    tie_cols: Sequence[str],
    partition_cols: Sequence[str] = (),
    name: str = "rank",
    hex_digits: int = 4,
    groups_bound: int | None = None,
) -> DataFrame:
    """Exact 1-based rank by (hex_col, *tie_cols) within ``partition_cols``, where
    ``hex_col`` is an md5 hex string.  The md5 prefix is the bucket, so every bucket
    holds ~n/16^digits rows regardless of group sizes."""
    b = "_hbkt"
    d = df.withColumn(b, md5_bucket(F.col(hex_col), hex_digits)).withColumn("_one", F.lit(1).cast("long"))
    bound = None if groups_bound is None else groups_bound * (16 ** hex_digits)
    r = running_totals(d, ["_one"], [F.col(hex_col), *[F.col(t) for t in tie_cols]], b, partition_cols,
                       prefix="_cum", offsets_rows_bound=bound)
    return r.withColumnRenamed("_cum_one", name).drop(b, "_one")


def value_histogram(df: DataFrame, cols: Sequence[str], cast: str = "double") -> DataFrame:
    """Long (column, value, cnt) histogram of non-null values; map-side partial
    aggregation collapses hot values before the shuffle."""
    structs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value")) for c in cols]
    long = df.select(F.inline(F.array(*structs))).where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


#: Relative accuracy of the approximate pass, and values inside a bracket that are ranked rather than bracketed again.
BRACKET_ACCURACY = 2000
BRACKET_ROWS = 200_000


def present(c: str) -> Column:
    """The column as double; null and NaN are missing."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


class _Bracket:
    """Where the order statistics ``first`` .. ``last`` (from 0) of a column lie: ``below`` values are smaller than ``lo``,
    ``inside`` lie in [lo, hi]."""

    def __init__(self, column: str, prob: float, n: int, lo: float, hi: float):
        h = (n - 1) * prob
        self.column, self.prob, self.first, self.below, self.inside = column, prob, int(h // 1), 0, n
        self.frac = h - self.first
        self.last = self.first + 1 if self.frac > 0 else self.first
        self.lo, self.hi, self.found = lo, hi, {}

    def within(self) -> Column:
        v = present(self.column)
        return F.when((v >= F.lit(self.lo)) & (v <= F.lit(self.hi)), v)

    def settled(self) -> bool:
        return self.lo == self.hi

    def value(self) -> float:
        a = self.lo if self.settled() else self.found[self.first]
        b = self.lo if self.settled() else self.found[self.last]
        return a + self.frac * (b - a)


def _narrowed(df: DataFrame, brackets: list[_Bracket]) -> None:
    """One approximate pass for narrower brackets and one pass that counts below and inside them; a bracket that would miss
    its order statistics (an estimate farther off than its accuracy) is left as it was."""
    probs = []
    for b in brackets:
        ends = [(b.first - b.below) / b.inside - 2 / BRACKET_ACCURACY, (b.last - b.below + 1) / b.inside + 2 / BRACKET_ACCURACY]
        probs.append([min(max(e, 0.0), 1.0) for e in ends])
    row = df.agg(*[F.percentile_approx(b.within(), p, BRACKET_ACCURACY).alias(f"p{i}") for i, (b, p) in enumerate(zip(brackets, probs, strict=True))]).first()
    tries = [(b.lo if p[0] == 0 else row[f"p{i}"][0], b.hi if p[1] == 1 else row[f"p{i}"][1]) for i, (b, p) in enumerate(zip(brackets, probs, strict=True))]
    counts = []
    for i, (b, (lo, hi)) in enumerate(zip(brackets, tries, strict=True)):
        v = present(b.column)
        counts += [F.count_if(v < F.lit(lo)).alias(f"b{i}"), F.count_if((v >= F.lit(lo)) & (v <= F.lit(hi))).alias(f"n{i}")]
    row = df.agg(*counts).first()
    for i, (b, (lo, hi)) in enumerate(zip(brackets, tries, strict=True)):
        below, inside = int(row[f"b{i}"]), int(row[f"n{i}"])
        if below <= b.first and b.last < below + inside:
            b.lo, b.hi, b.below, b.inside = lo, hi, below, inside


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (position (n-1)p, as pandas ``quantile`` and DuckDB ``quantile_cont``) for
    many columns; null and NaN are missing.  Returns (column, prob, value), null for columns without values.

    Selection by brackets: an approximate pass with known rank error gives a lower and an upper value around every
    quantile, a counting pass proves that the wanted order statistics lie between them, and only the values inside are
    ranked.  Both passes are plain aggregates without a shuffle of rows.  Brackets that still hold more than
    ``BRACKET_ROWS`` values are narrowed again; one that closes on a single (hot) value is done.  ``df`` is read three
    times as a rule: persist it if it is costly to compute."""
    spark, cols = df.sparkSession, list(dict.fromkeys(cols))
    schema = "column string, prob double, value double"
    if not cols or not probs:
        return spark.createDataFrame([], schema)
    ends = df.agg(*[f(present(c)).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    brackets = [_Bracket(c, float(p), int(ends[f"n{i}"]), ends[f"lo{i}"], ends[f"hi{i}"]) for i, c in enumerate(cols) if ends[f"n{i}"] for p in probs]
    while open_ := [b for b in brackets if not b.settled() and b.inside > BRACKET_ROWS]:
        before = [(b.lo, b.hi) for b in open_]
        _narrowed(df, open_)
        if before == [(b.lo, b.hi) for b in open_]:  # no narrower by estimates: their values are ranked as they are
            break
    left = [b for b in brackets if not b.settled()]
    if left:
        values = [F.struct(F.lit(i).alias("b"), b.within().alias("value")) for i, b in enumerate(left)]
        held = df.select(F.inline(F.array(*values))).where("value is not null").groupBy("b", "value").agg(F.count(F.lit(1)).alias("cnt"))
        upto = F.sum("cnt").over(Window.partitionBy("b").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        wanted = F.element_at(F.array(*[F.array(*[F.lit(k - b.below).cast("long") for k in (b.first, b.last)]) for b in left]), F.col("b") + 1)
        hits = held.withColumn("upto", upto).withColumn("k", F.explode(F.array_distinct(wanted))).where("k < upto and k >= upto - cnt")
        for r in hits.select("b", "k", "value").collect():  # two rows for each column and quantile at most
            left[r["b"]].found[r["k"] + left[r["b"]].below] = r["value"]
    done = {(b.column, b.prob): b.value() for b in brackets}
    return spark.createDataFrame([(c, float(p), done.get((c, float(p)))) for c in cols for p in probs], schema)


def quantile_dict(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    """{(column, prob): value} — a bounded (columns x probs) summary."""
    return {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, cols, probs).collect()}


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column, ties -> smallest value (pandas
    ``mode()[0]``).  Partial aggregation handles hot values; the final pick is a
    ``min(struct(-count, value))`` aggregate, not a window.  Returns (column, value)."""
    hist = value_histogram(df, cols, cast="string")
    best = F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value").alias("v")))
    return hist.groupBy("column").agg(best.alias("m")).select("column", F.col("m.v").alias("value"))
