"""Raw rows in, raw rows out: the key stays, values are not rewritten, missing is missing."""
import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import clean, encode, sample, score
from riskframe.sources.tables import read_csv
from riskframe.spec import EMPLOYEE, Roles


def test_employee_key_survives_cleaning_and_split(spark):
    rows = [(i, "Yes" if i % 5 == 0 else "No", float(20 + i % 40), 1, 2, "Sales") for i in range(200)]
    raw = spark.createDataFrame(rows, "EmployeeNumber long, Attrition string, Age double, EmployeeCount int, Education int, Department string")
    cleaned = clean.clean_raw(raw, EMPLOYEE)
    assert "EmployeeNumber" in cleaned.columns and "EmployeeCount" not in cleaned.columns
    deduped = clean.remove_duplicates(cleaned, EMPLOYEE.key)
    assert "EmployeeNumber" in deduped.columns
    parts = {(r[0], r[1]): r[2] for r in sample.split(cleaned, "EmployeeNumber", "Attrition").groupBy("split", "Attrition").count().collect()}
    assert parts == {("test", 1): 8, ("train", 1): 32, ("test", 0): 32, ("train", 0): 128}


def test_split_without_labels_empty_and_null_class(spark):
    d = spark.createDataFrame([(i, None if i < 10 else i % 2) for i in range(50)], "k long, y int")
    out = sample.split(d, "k", "y", 0.2).groupBy("split").count().collect()
    assert {r[0]: r[1] for r in out} == {"test": 10, "train": 40}
    assert sample.split(d.limit(0), "k", "y").count() == 0
    assert sample.split(d, "k", None, 0.5).where("split = 'test'").count() == 25


def test_score_table_returns_rows_as_they_came(spark):
    raw = spark.createDataFrame([(1, 2, 30.0, "Yes", 80), (2, 5, float("nan"), "No", 80)], "EmployeeNumber long, Education int, Age double, Attrition string, StandardHours int")
    out = score.score_table(raw, EMPLOYEE, lambda d: d.withColumn("_p", F.when(F.col("Education") == "College", 0.9).otherwise(0.1)), ["Age"])
    assert out.columns == [*raw.columns, "Prediction", "Probability"]
    got = {r["EmployeeNumber"]: r for r in out.collect()}
    assert got[1]["Education"] == 2 and got[1]["Prediction"] == "Yes" and got[2]["Prediction"] == "No" and math.isnan(got[2]["Age"])
    with pytest.raises(encode.MissingColumnsError):
        score.score_table(raw, EMPLOYEE, lambda d: d, ["absent"])


def test_csv_without_the_label(spark, tmp_path):
    schema = "id long, label int, x double"
    spark.createDataFrame([(1, 0.5), (2, 1.5)], "id long, x double").coalesce(1).write.option("header", True).csv(str(tmp_path / "a"))
    rows = read_csv(spark, str(tmp_path / "a"), schema, label_optional=True)
    assert rows.columns == ["id", "label", "x"] and sorted(map(tuple, rows.collect())) == [(1, None, 0.5), (2, None, 1.5)]


def test_smote_ignores_rows_without_label(spark):
    rows = [(i, 0 if i < 12 else 1 if i < 16 else None, [float(i), float(i % 3)]) for i in range(19)]
    out = sample.smote(spark.createDataFrame(rows, "k long, y int, v array<double>"), "k", "y", "v", k=2)
    assert out.where("is_synthetic").count() == 8 and out.where("is_synthetic and y = 1").count() == 8
    assert sample.balanced_weights(spark.createDataFrame(rows, "k long, y int, v array<double>"), "y").where("y = 1").first()["weight"] == 2.0


def test_nan_counts_as_missing(spark):
    d = spark.createDataFrame([(float(x),) for x in ("1", "2", "nan", "nan", "nan")], "x double")
    cleaned = clean.clean_raw(d, Roles(target=None, key=None, numerical=("x",)))
    assert cleaned.where("x is null").count() == 3
    assert clean.fit_impute(cleaned, ["x"], []).medians == {"x": 1.5}


def test_too_many_levels_raise(spark):
    d = spark.range(30).selectExpr("cast(id as string) as c")
    with pytest.raises(ValueError, match="levels"):
        encode.fit_encoder(d, {}, ["c"], [], max_levels=10)
