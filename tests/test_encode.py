import pytest

from riskframe.operators import encode
from riskframe.spec import EMPLOYEE_ORDINAL


def test_scaler_population_sd_golden(spark):
    df = spark.createDataFrame([(25, 2000), (35, 5000), (45, 10000), (55, 20000)], "Age int, MonthlyIncome int")
    enc = encode.fit_encoder(df, {}, [], ["Age", "MonthlyIncome"])
    out = enc.transform(df).orderBy("scaler__Age").collect()
    assert [round(r.scaler__Age, 4) for r in out] == [-1.3416, -0.4472, 0.4472, 1.3416]
    assert [round(r.scaler__MonthlyIncome, 4) for r in out] == [-1.0611, -0.622, 0.1098, 1.5733]


def test_ordinal_positions_unknown_minus_one(spark):
    df = spark.createDataFrame([("Doctor",), ("Below College",), ("Nope",), (None,)], "Education string")
    enc = encode.EncoderModel(ordinal={"Education": EMPLOYEE_ORDINAL["Education"]})
    assert [r[0] for r in enc.transform(df).collect()] == [4.0, 0.0, -1.0, -1.0]


def test_onehot_sorted_drop_first_unseen_zero(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "g string")
    enc = encode.fit_encoder(train, {}, ["g"], [])
    assert enc.feature_names() == ["onehot__g_b", "onehot__g_c"]
    test = spark.createDataFrame([("a",), ("c",), ("zz",), (None,)], "g string")
    assert [tuple(r) for r in enc.transform(test).collect()] == [(0.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_constant_column_scale_one(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    enc = encode.fit_encoder(df, {}, [], ["x"])
    assert enc.scaler["x"] == (3.0, 1.0)


def test_missing_columns_error(spark):
    enc = encode.EncoderModel(scaler={"x": (0.0, 1.0), "y": (0.0, 1.0)})
    with pytest.raises(encode.MissingColumnsError, match="y"):
        enc.transform(spark.createDataFrame([(1.0,)], "x double"))
    with pytest.raises(encode.MissingColumnsError):
        encode.align_columns(spark.createDataFrame([(1.0,)], "x double"), ["x", "z"])


def test_pipeline_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "g string, x double")
    enc = encode.fit_encoder(df, {}, ["g"], ["x"])
    pm = enc.to_pipeline_model(df)
    pm.write().overwrite().save(str(tmp_path / "enc"))
    from pyspark.ml import PipelineModel
    back = PipelineModel.load(str(tmp_path / "enc"))
    a = [r.features.toArray().tolist() for r in pm.transform(df).collect()]
    b = [r.features.toArray().tolist() for r in back.transform(df).collect()]
    assert a == b == [[0.0, -1.0], [1.0, 1.0]]
