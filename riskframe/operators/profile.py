"""Profiling and EDA operators A1-A18.

Every statistic over many columns is computed in one aggregation pass (columns are
unpivoted with ``inline`` where the output is long), never one job per column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskframe.functions.moments import pair_moments
from riskframe.functions.ranking import exact_quantiles, present


def shape(df: DataFrame) -> DataFrame:
    """A1: (n_rows, n_cols, columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """A2: first n rows in key order (TakeOrderedAndProject: a per-task top-n)."""
    return df.orderBy(key).limit(n)


def info(df: DataFrame) -> DataFrame:
    """A3: (column, dtype, non_null) — one aggregation for all columns."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    structs = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(c).alias("non_null"))
               for c, t in df.dtypes]
    return counts.select(F.inline(F.array(*structs)))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by schema type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: count, mean, sample sd, min, exact quartiles, max per column (long); null and NaN are missing."""
    cols = list(cols)
    moments = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), present(c).alias("v")) for c in cols
    ]))).groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    )
    return moments.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def null_counts(df: DataFrame) -> DataFrame:
    """A5: (column, n_null) for columns with at least one null; NaN counts as null."""
    missing = {c: F.col(c).isNull() | (F.isnan(c) if t in ("float", "double") else F.lit(False)) for c, t in df.dtypes}
    agg = df.agg(*[F.count_if(missing[c]).alias(c) for c in df.columns])
    structs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in df.columns]
    return agg.select(F.inline(F.array(*structs))).where(F.col("n_null") > 0)


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of rows that repeat an earlier row = sum(group size - 1)."""
    cols = list(cols) if cols else df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def value_counts(df: DataFrame, c: str, by: str = "count") -> DataFrame:
    """(value, count) ordered by count desc (ties by value) or by value."""
    g = df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(F.desc("count"), "value") if by == "count" else g.orderBy("value")


def value_shares(df: DataFrame, c: str, decimals: int = 2) -> DataFrame:
    """(value, count, percent) with percent rounded; the total is a scalar."""
    total = df.count()
    g = df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return g.withColumn("percent", F.round(F.col("count") * F.lit(100.0) / F.lit(float(total)), decimals))


def histogram(df: DataFrame, cols: Sequence[str], label: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the (column, label) group's min and max, last bin
    closed.  Output (column, label, bin, lo, hi, count)."""
    long = df.select(F.col(label).alias("label"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols
    ]))).where(F.col("v").isNotNull())
    rng = long.groupBy("column", "label").agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    # (columns x labels) rows: a bounded table, broadcast
    j = long.join(F.broadcast(rng), ["column", "label"])
    width = F.col("mx") - F.col("mn")
    raw = F.floor((F.col("v") - F.col("mn")) * F.lit(float(bins)) / width).cast("long") + 1
    b = F.when(width == 0, F.lit(1).cast("long")).otherwise(F.least(raw, F.lit(bins).cast("long")))
    g = j.groupBy("column", "label", b.alias("bin"), "mn", "mx").agg(F.count(F.lit(1)).alias("count"))
    step = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    return g.select("column", "label", "bin",
                    (F.col("mn") + (F.col("bin") - 1) * step).alias("lo"),
                    (F.col("mn") + F.col("bin") * step).alias("hi"), "count")


def positive_rate(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """A10: positive rate (%) per (column, level), all columns in one pass, sorted by
    rate descending within each column."""
    long = df.select(F.col(label).alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols
    ])))
    g = long.groupBy("column", "level").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.col("_y").cast("double")) * F.lit(100.0)).alias("rate_pct"))
    return g.orderBy("column", F.desc("rate_pct"), "level")


def box_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (most extreme points inside the fences), outlier count."""
    q = exact_quantiles(df, cols, [0.25, 0.75]).groupBy("column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    fences = q.select("column", "q1", "q3", (F.col("q1") - F.lit(k) * iqr).alias("lower"),
                      (F.col("q3") + F.lit(k) * iqr).alias("upper"))
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols
    ]))).where(F.col("v").isNotNull())
    j = long.join(F.broadcast(fences), "column")  # one row per column: bounded
    inside = (F.col("v") >= F.col("lower")) & (F.col("v") <= F.col("upper"))
    return j.groupBy("column", "q1", "q3", "lower", "upper").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )


def clip_report(df: DataFrame, fences: dict) -> DataFrame:
    """Outliers and max before / after clipping, per column."""
    rows = []
    for c, (lo, hi) in fences.items():
        v = F.col(c).cast("double")
        clipped = F.least(F.greatest(v, F.lit(lo)), F.lit(hi))
        rows.append(F.struct(
            F.lit(c).alias("column"),
            F.count_if((v < F.lit(lo)) | (v > F.lit(hi))).alias("outliers_before"),
            F.max(v).alias("max_before"),
            F.count_if((clipped < F.lit(lo)) | (clipped > F.lit(hi))).alias("outliers_after"),
            F.max(clipped).alias("max_after"),
        ))
    return df.agg(*[r.alias(f"_s{i}") for i, r in enumerate(rows)]).select(
        F.inline(F.array(*[F.col(f"_s{i}") for i in range(len(rows))])))


#: Part of a sum of squares that must be left after centring; pairs below it are taken again by central moments.
LEFT = 1e-9


def _central_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> dict:
    """Correlations of few pairs by running central moments (rows are repeated for every pair)."""
    held = lambda c: F.when(F.abs(present(c)) < float("inf"), present(c))
    structs = [F.struct(F.lit(k).alias("pair"), held(a).alias("x"), held(b).alias("y")) for k, (a, b) in enumerate(pairs)]
    long = df.select(F.inline(F.array(*structs))).where("x is not null and y is not null")
    corr = F.try_divide(F.covar_samp("x", "y"), F.stddev_samp("x") * F.stddev_samp("y"))
    return {pairs[r["pair"]]: r["corr"] for r in long.groupBy("pair").agg(corr.alias("corr")).collect()}


def _correlations(df: DataFrame, left: Sequence[str], right: Sequence[str] | None = None) -> dict:
    """{(a, b): correlation or None} over rows where both are present; the driver gets one row for each pair of columns."""
    second, out, again = left if right is None else right, {}, []
    for r in pair_moments(df, left, right).collect():
        pair = (left[r["a"]], second[r["b"]])
        if r["n"] < 2 or r["xx"] <= 0 or r["yy"] <= 0:
            out[pair] = None
        elif min(r["xx"] / r["raw_x"], r["yy"] / r["raw_y"]) < LEFT:
            again.append(pair)
        else:
            out[pair] = max(-1.0, min(1.0, r["xy"] / (math.sqrt(r["xx"]) * math.sqrt(r["yy"]))))
    return {**out, **(_central_correlations(df, again) if again else {})}


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, long (col_a, col_b, corr), one pass of block products; null, NaN and infinite
    values are missing, no variance gives null."""
    cols = list(cols)
    corr = _correlations(df, cols)
    rows = [(a, b, corr.get((a, b) if i <= j else (b, a))) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def target_correlations(df: DataFrame, cols: Sequence[str], target: str, top_n: int = 10) -> DataFrame:
    """Correlations with the target, top n by absolute value."""
    corr = _correlations(df, list(cols), [target])
    long = df.sparkSession.createDataFrame([(a, v) for (a, _), v in corr.items() if v is not None], "feature string, corr double")
    return long.orderBy(F.desc(F.abs("corr")), "feature").limit(top_n)


def group_means(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """Mean of each column per group of ``by`` (e.g. the label or a flag)."""
    return df.groupBy(by).agg(*[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in cols])


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Class counts ordered by class."""
    return df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("count")).orderBy("class")


def split_rates(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """Rows and positive rate (%) per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"),
                                     (F.avg(F.col(label).cast("double")) * F.lit(100.0)).alias("positive_pct"))
