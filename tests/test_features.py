import pytest
from conftest import rows
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from touchline.operators import features as X


def test_top_categories_ties_nulls_and_unseen(spark, tmp_path):
    train = spark.createDataFrame([(v,) for v in ["a"] * 3 + ["b", "b", "c", "c", "d", None]], "v string")
    model = X.TopKCategories(columns=["v"], k=2).fit(train)
    assert model.vocabulary() == {"v": ["a", "b"]}
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("new",), (None,)], "v string")
    want = [("a",), ("b",), ("Other",), ("Other",), ("Other",)]
    assert rows(model.transform(test)) == want
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "m"))
    assert rows(PipelineModel.load(str(tmp_path / "m")).transform(test)) == want


def test_dummies(spark):
    train = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "v string, n int")
    model = X.DummyColumns(columns=["v"]).fit(train)
    assert model.dummy_names() == ["v_a", "v_b"]
    assert rows(model.transform(train), "n") == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]
    unseen = spark.createDataFrame([("z", 4)], "v string, n int")
    assert rows(model.transform(unseen)) == [(4, 0, 0)]


def test_dummies_refuse_many_values(spark):
    many = spark.range(30).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError):
        X.DummyColumns(columns=["v"], limit=20).fit(many)


def test_fills_live_in_the_pipeline(spark):
    train = spark.createDataFrame([("a", 1.0), (None, None), ("b", 3.0)], "c string, n double")
    stages = [X.FillCategories(columns=["c"]), X.CastToDouble(columns=["n"]), Imputer(inputCols=["n"], outputCols=["n"])]
    got = Pipeline(stages=stages).fit(train).transform(spark.createDataFrame([(None, None)], "c string, n double"))
    assert rows(got) == [("N/A", 2.0)]


def test_numeric_fill_leaves_text_and_flags(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, i int, d double, b boolean")
    assert rows(df.na.fill(0)) == [(None, 0, 0.0, None)]


def test_hash_split_does_not_depend_on_order(spark):
    df = spark.range(2000)
    train, test = X.hash_split(df, "id", 67)
    again, _ = X.hash_split(df.repartition(9), "id", 67)
    assert rows(train, "id") == rows(again, "id")
    assert train.count() + test.count() == 2000 and 1250 < train.count() < 1430


def test_ordered_split(spark):
    df = spark.range(57).select((F.col("id") * 13 % 57).alias("o"), "id")
    train, test = X.ordered_split(df, "o", "id", slices=4)
    assert [r[0] for r in rows(train, "o")] == list(range(40)) and test.count() == 17


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert rows(X.with_class_weight(df, "y"), "y") == [(0, 1.0)] * 3 + [(1, 3.0)]
    assert rows(X.with_class_weight(df, "y", 2.0), F.col("y").desc())[0] == (1, 2.0)
    assert rows(X.with_class_weight(df.where("y = 0"), "y")) == [(0, 1.0)] * 3


def test_contract(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "i int, s string, d double")
    contract = X.input_contract(df, ["s", "d"])
    assert X.enforce_contract(df, contract) is df
    with pytest.raises(ValueError, match="d: expected double, got nothing"):
        X.enforce_contract(df.drop("d"), contract)
    with pytest.raises(ValueError, match="s: expected string, got int"):
        X.enforce_contract(df.withColumn("s", F.lit(1)), contract)


def test_columns_by_type(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "label int, s string, d double")
    assert X.string_columns(df) == ["s"] and X.other_columns(df, ["label"]) == ["d"]
