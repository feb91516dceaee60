"""Split, folds, class weights and SMOTE.

Determinism: every draw is an md5 of ``seed:key`` (never ``rand()``), so results do
not depend on partitioning, retries or the number of executors, and DuckDB can replay
them.  Ranks over whole classes use ``hash_rank`` (md5-prefix buckets + offsets), so
no window ever holds a whole class in one task.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskframe.functions.exprs import lookup, md5_bucket, md5_uniform, seeded_md5
from riskframe.functions.ranking import hash_rank
from riskframe.operators.neighbours import knn
from riskframe.session import cut_lineage


# ------------------------------------------------------------------ quotas ---
def largest_remainder(counts: dict, total_draw: int) -> dict:
    """Split ``total_draw`` over classes proportionally: floors, then +1 to the largest
    remainders (ties -> smaller class value)."""
    n = sum(counts.values())
    if n == 0:
        return {k: 0 for k in counts}
    cont = {k: total_draw * v / n for k, v in counts.items()}
    out = {k: int(math.floor(c)) for k, c in cont.items()}
    left = total_draw - sum(out.values())
    order = sorted(counts, key=lambda k: (-(cont[k] - out[k]), str(k)))
    for k in order[:left]:
        out[k] += 1
    return out


def test_quotas(counts: dict, test_size: float) -> dict:
    """Stratified hold-out sizes: n_test = ceil(test_size * n); the train part is
    apportioned first and each class's test quota is the rest of the class."""
    n = sum(counts.values())
    n_test = int(math.ceil(test_size * n))
    train = largest_remainder(counts, n - n_test)
    return {k: counts[k] - train[k] for k in counts}


def _class_counts(df: DataFrame, label: str, nulls: bool = False) -> dict:
    """Rows per class (bounded: one row per class); rows without a label are no class unless ``nulls``."""
    return {r[0]: int(r[1]) for r in df.groupBy(label).count().collect() if nulls or r[0] is not None}


# ------------------------------------------------------------------ R2/R3 ----
def split(df: DataFrame, key: str, label: str | None, test_size: float = 0.2, seed: int = 42,
          stratify: bool = True, split_col: str = "split") -> DataFrame:
    """R2 (stratified) / R3 (plain) hold-out split with exact sizes.

    In the order of md5(seed:key) the first ``quota`` rows of each class (or of the table) are the test part.  Rows are
    counted per class and md5 bucket, which finds the bucket that the quota ends in; only rows of that bucket (one of
    65,536) are ranked, to find the last test row.  The split itself then compares each row with that one: no row of the
    table is moved."""
    cls = F.col(label) if stratify and label else F.lit(0)
    d = df.select(cls.alias("_c"), F.col(key).alias("_k"), seeded_md5(seed, key).alias("_h"))
    counted = d.groupBy("_c", md5_bucket(F.col("_h")).alias("_b")).agg(F.count("*").alias("_n"))
    totals = {r[0]: int(r[1]) for r in counted.groupBy("_c").agg(F.sum("_n")).collect()}  # one row per class
    quotas = test_quotas(totals, test_size)
    spark = df.sparkSession
    if not totals:
        return df.withColumn(split_col, F.lit("train"))
    wanted = spark.createDataFrame([(c, q) for c, q in quotas.items()], StructType([d.schema["_c"], StructField("_q", LongType())]))
    upto = F.sum("_n").over(Window.partitionBy("_c").orderBy("_b"))
    ends = (counted.withColumn("_upto", upto).join(F.broadcast(wanted.toDF("_qc", "_q")), F.col("_c").eqNullSafe(F.col("_qc")))
            .where((F.col("_upto") >= F.col("_q")) & (F.col("_upto") - F.col("_n") < F.col("_q")))
            .select("_c", "_b", (F.col("_q") - F.col("_upto") + F.col("_n")).alias("_left")).collect())
    if not ends:
        return df.withColumn(split_col, F.lit("train"))
    at_end = F.lit(False)
    left = F.lit(None).cast("long")
    for e in ends:  # one per class
        here = F.col("_c").eqNullSafe(F.lit(e["_c"])) & (md5_bucket(F.col("_h")) == e["_b"])
        at_end = at_end | here
        left = F.when(here, F.lit(e["_left"])).otherwise(left)
    rank = F.row_number().over(Window.partitionBy("_c").orderBy("_h", "_k"))
    last = d.where(at_end).withColumn("_left", left).withColumn("_r", rank).where("_r = _left").collect()
    test = F.lit(False)
    h = seeded_md5(seed, key)
    for r in last:
        up_to = (h < r["_h"]) | ((h == r["_h"]) & (F.col(key) <= F.lit(r["_k"])))
        test = test | (cls.eqNullSafe(F.lit(r["_c"])) & up_to)
    return df.withColumn(split_col, F.when(test, F.lit("test")).otherwise(F.lit("train")))


# ------------------------------------------------------------------ M8 -------
def assign_folds(df: DataFrame, key: str, label: str | None, k: int = 5, seed: int = 42,
                 fold_col: str = "fold") -> DataFrame:
    """M8: stratified fold id = (rank within class by md5(seed:key) - 1) mod k, int."""
    d = df.withColumn("_h", seeded_md5(seed, key))
    parts = [label] if label else []
    bound = len(_class_counts(df, label, nulls=True)) if label else 1
    ranked = hash_rank(d, "_h", [key], parts, name="_rk", groups_bound=bound)
    return ranked.withColumn(fold_col, ((F.col("_rk") - 1) % k).cast("int")).drop("_h", "_rk")


# ------------------------------------------------------------------ M4 -------
def balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """M4: weight = n / (n_classes * n_class) from a per-class count table (bounded by
    the number of classes, applied as a literal map)."""
    counts = _class_counts(df, label)
    n, kcls = sum(counts.values()), len(counts)
    w = {c: n / (kcls * v) for c, v in counts.items() if c is not None}
    return df.withColumn(weight_col, lookup(F.col(label), w).cast("double"))


# ------------------------------------------------------------------ R4-R7 ----
def smote(df: DataFrame, key: str, label: str, vec: str, k: int = 5, seed: int = 42,
          minority=None, synthetic_col: str = "is_synthetic") -> DataFrame:
    """Oversample the minority class to the majority count.

    Synthetic row s (s = 0 .. n_needed-1): h = md5(seed:smote:s); pick = floor(u(h,0) *
    m * k) chooses base = pick div k (in md5(seed:key) order of the minority rows) and
    neighbour j = pick mod k + 1; gap = u(h,8) in [0,1); value = base + gap * (nb -
    base) per coordinate (R6).  Output = input rows + synthetic rows (R7), with
    ``is_synthetic``; synthetic keys are negative (-(s+1))."""
    spark = df.sparkSession
    counts = _class_counts(df, label)
    if not counts:
        return df.withColumn(synthetic_col, F.lit(False))
    if minority is None:
        minority = min(counts, key=lambda c: (counts[c], str(c)))
    m = counts.get(minority, 0)
    n_needed = max(counts.values()) - m
    base = df.withColumn(synthetic_col, F.lit(False))
    if n_needed <= 0 or m < 2:
        return base
    k_eff = min(k, m - 1)
    # read by the ranks, by the neighbour search and as neighbours: computed once
    mino = cut_lineage(df.where(F.col(label) == F.lit(minority)).select(key, vec))
    ranked = hash_rank(mino.withColumn("_h", seeded_md5(seed, key)), "_h", [key], [], name="_idx", groups_bound=1) \
        .select(F.col(key).alias("b_key"), F.col(vec).alias("b_v"), (F.col("_idx") - 1).alias("b_idx"))
    nn = knn(mino, key, vec, k_eff).select(F.col(key).alias("b_key"), "j", "nb_key")
    syn = spark.range(n_needed).withColumnRenamed("id", "s")
    hcol = seeded_md5(seed, F.lit("smote"), F.col("s"))
    syn = syn.withColumn("_hs", hcol)
    pick = F.floor(md5_uniform(F.col("_hs"), 0) * F.lit(float(m * k_eff))).cast("long")
    syn = syn.select("s", pick.alias("pick"), md5_uniform(F.col("_hs"), 13).alias("gap"))
    syn = syn.select("s", "gap", (F.col("pick") / k_eff).cast("long").alias("b_idx"),
                     ((F.col("pick") % k_eff) + 1).cast("int").alias("j"))
    j1 = syn.join(ranked, "b_idx").join(nn, ["b_key", "j"])
    nbv = mino.select(F.col(key).alias("nb_key"), F.col(vec).alias("nb_v"))
    j2 = j1.join(nbv, "nb_key")
    new_v = F.zip_with("b_v", "nb_v", lambda b, nb: b + F.col("gap") * (nb - b))
    synth = j2.select((-(F.col("s") + 1)).cast(df.schema[key].dataType).alias(key), new_v.alias(vec),
                      F.lit(minority).cast(df.schema[label].dataType).alias(label),
                      F.lit(True).alias(synthetic_col))
    others = [c for c in df.columns if c not in (key, vec, label)]
    for c in others:
        synth = synth.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    return base.unionByName(synth.select(*base.columns))


def smote_if(df: DataFrame, enabled: bool, **kw) -> DataFrame:
    """SMOTE switch."""
    return smote(df, **kw) if enabled else df.withColumn(kw.get("synthetic_col", "is_synthetic"), F.lit(False))
