import pytest
from pyspark.sql import functions as F

from riskframe.plans import pipeline
from riskframe.plans.queries_pipeline import NAMES, ONE_SETTING
from riskframe.spec import Roles

ROLES = Roles(target="left", key="id", numerical=("age", "pay"), categorical=("team",), onehot=("team",), outlier=("pay",),
              drop=("id", "const"), target_map={"Yes": 1, "No": 0})


@pytest.fixture(scope="module")
def raw(spark):
    u = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    return spark.range(240).select(
        "id", (20 + F.col("id") % 41).cast("double").alias("age"),
        F.when(F.col("id") % 16 != 3, 1000 + 10 * (F.col("id") % 97) + u).alias("pay"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("team"), F.lit(1).alias("const"),
        F.when(F.col("id") % 50 == 7, None).when((F.col("id") % 41 < 10) & (u < 0.9), "Yes").otherwise("No").alias("left"))


@pytest.fixture(scope="module")
def folder(raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models"))
    pipeline.fit(raw, ROLES, path, ONE_SETTING, smote=False)
    return path


def test_scores_keep_raw_columns(raw, folder):
    want = sorted(map(str, raw.collect()))
    for name in NAMES:
        got = pipeline.score(raw, ROLES, folder, name)
        assert got.columns == [*raw.columns, "Prediction", "Probability"]
        assert sorted(map(str, got.select(raw.columns).collect())) == want
        assert got.where("Probability is null or Probability not between 0 and 1").count() == 0
    # without the label column, by the default model
    assert pipeline.score(raw.drop("left"), ROLES, folder).count() == 240


def test_model_learned(raw, folder):
    got = pipeline.score(raw, ROLES, folder).where("left is not null")
    assert got.where("left = Prediction").count() >= 0.85 * got.count()


def test_unknown_name(spark, folder):
    with pytest.raises(pipeline.UnknownModelError, match="nothing"):
        pipeline.load(spark, folder, "nothing")


def test_top_contributions(raw, folder):
    for name in NAMES:
        top = pipeline.explain_rows(raw, ROLES, folder, name, top_n=2)
        assert set(top.columns) == {"id", "rank", "feature", "phi", "direction"}
        assert top.count() == 480
        whole = pipeline.explain_rows(raw, ROLES, folder, name, top_n=None).groupBy("id").agg(F.max(F.abs("phi")).alias("m"))
        assert top.where("rank = 1").join(whole, "id").where("abs(abs(phi) - m) > 1e-9").count() == 0


def test_queries_by_name_count_in_the_texts_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from riskframe.plans import pipeline, queries_pipeline

    rows = [(i, "a b\nc" * i, "en", "web", 5 * i) for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(4)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plans = []
    seen = lambda df: plans.append(df._jdf.queryExecution().toString()) or df
    monkeypatch.setattr(pipeline, "fit", lambda raw, *a, **k: seen(raw))
    monkeypatch.setattr(pipeline, "score", lambda raw, *a, **k: seen(raw).withColumns({"Prediction": F.lit("Yes"), "Probability": F.lit(0.5)}))
    out = queries_pipeline.p2_score_by_name(spark, str(tmp_path))
    assert len(plans) == 4 and not any("text" in p for p in plans)
    assert out.count() == 18 and {r["consistent"] for r in out.collect()} == {True}
