import numpy as np
from pyspark.sql import functions as F

from riskframe.plans import training


def _vectors(spark, n=600):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 5 == 0), [float(v) for v in rng.normal(size=3) + (i % 5 == 0)]) for i in range(n)]
    return spark.createDataFrame(rows, "k long, y int, v array<double>").repartition(40)


def test_partitions_follow_rows():
    assert [training.partitions(n) for n in (0, 1, 2_000, 14_000, 100_000, 1_000_000)] == [1, 1, 1, 7, 16, 50]


def test_prepared_tables_are_cut_from_their_plans(spark):
    """Fits run thousands of tasks over the training part: few partitions, and no join or aggregate in their past."""
    for smote in (True, False):
        train, test = training.prepare(_vectors(spark), "k", "y", "v", smote, folds=3)
        counts = {(r["label"], r["is_synthetic"]): r["count"] for r in train.groupBy("label", "is_synthetic").count().collect()}
        assert counts == {(0.0, False): 384, (1.0, False): 96} | ({(1.0, True): 288} if smote else {}) and test.count() == 120
        assert train.rdd.getNumPartitions() == 1
        for part in (train, test):
            past = part._jdf.queryExecution().withCachedData().toString() + part._jdf.queryExecution().executedPlan().toString()
            assert "ExistingRDD" in past and "Exchange" not in past and "Join" not in past and "md5" not in past
        train.unpersist()
        test.unpersist()


def test_prepared_rows_are_the_same_on_any_partitioning(spark):
    one, other = (training.prepare(df, "k", "y", "v", folds=3)[0] for df in (_vectors(spark), _vectors(spark).repartition(3)))
    assert list(map(str, one.collect())) == list(map(str, other.collect()))
    assert one.where(F.col("fold").isNull()).count() == 0
