import pytest
from pyspark.sql import functions as F

from riskframe.operators import clean
from riskframe.spec import EMPLOYEE, Roles


def test_fences_golden_and_null_stays_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    f = clean.iqr_fences(df, ["x"]).first()
    assert (f["q1"], f["q3"], f["iqr"]) == (1.75, 5.5, 3.75)
    assert (f["lower"], f["upper"]) == (-3.875, 11.125)
    clipped = clean.clip_outliers(df, {"x": (f["lower"], f["upper"])}).collect()
    assert sorted([r.x for r in clipped if r.x is not None]) == [1.0, 2.0, 4.0, 10.0]
    assert sum(r.x is None for r in clipped) == 1
    big = spark.createDataFrame([(100.0,), (-100.0,)], "x double")
    assert sorted(r.x for r in clean.clip_outliers(big, {"x": (-3.875, 11.125)}).collect()) == [-3.875, 11.125]


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    p = clean.fit_impute(df, [], ["c"])
    assert p.modes == {"c": "a"}
    assert [r.c for r in clean.apply_impute(df, p).collect()].count("a") == 3


def test_median_linear_interpolation(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (10,), (None,)], "x int")
    p = clean.fit_impute(df, ["x"], [])
    assert p.medians["x"] == 3.0
    assert 3.0 in [r.x for r in clean.apply_impute(df, p).collect()]


def test_target_map_cast_and_code_labels(spark):
    df = spark.createDataFrame([("Yes", 2, 5), ("No", 3, 1), ("Maybe", None, 9)],
                               "Attrition string, JobLevel int, Education int")
    out = clean.clean_raw(df, EMPLOYEE).collect()
    assert [r.Attrition for r in out] == [1, 0, None]
    assert [r.JobLevel for r in out] == ["2", "3", None]
    assert [r.Education for r in out] == ["Doctor", "Below College", None]


def test_drop_ignores_absent(spark):
    df = spark.createDataFrame([(1, "Y", 5)], "EmployeeNumber int, Over18 string, Age int")
    assert clean.drop_columns(df, EMPLOYEE.drop).columns == ["Age"]


def test_validate_errors(spark):
    roles = Roles(target="y", key=None, numerical=("a",), categorical=("b",))
    with pytest.raises(clean.ValidationError, match="to predict"):
        clean.validate(spark.createDataFrame([(1, "x")], "a int, b string"), roles)
    with pytest.raises(clean.ValidationError, match=r"lacks \['b'\]"):
        clean.validate(spark.createDataFrame([(1, 0)], "a int, y int"), roles)
    with pytest.raises(clean.ValidationError, match="no rows"):
        clean.validate(spark.createDataFrame([], "a int, b string, y int"), roles)
    rep = {r.check: r.passed for r in clean.validation_report(spark.createDataFrame([(1, 0)], "a int, y int"), roles).collect()}
    assert rep == {"non_empty": True, "target_present": True, "required_present": False}


def test_dedup_keeps_min_key_and_nulls_equal(spark):
    df = spark.createDataFrame([(5, "a", None), (3, "a", None), (4, "b", 1.0)], "k int, c string, x double")
    out = sorted(tuple(r) for r in clean.remove_duplicates(df, key="k").collect())
    assert out == [(3, "a", None), (4, "b", 1.0)]


def test_preprocess_order_fences_after_dedup(spark):
    roles = Roles(target="y", key="k", numerical=("x",), categorical=("c",), outlier=("x",), target_map={"Yes": 1, "No": 0})
    rows = [(i, "Yes" if i % 2 else "No", float(i), "u") for i in range(1, 9)] + [(99, "No", None, None)]
    df = spark.createDataFrame(rows, "k int, y string, x double, c string")
    out, prof = clean.preprocess(df, roles)
    assert prof.medians["x"] == 4.5 and prof.modes["c"] == "u"
    assert out.count() == 9
    assert out.where(F.col("x").isNull()).count() == 0
