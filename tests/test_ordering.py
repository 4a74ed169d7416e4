import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline.functions.scores import above_half, propensity_label
from touchline.operators import ordering as O


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, v double")


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = [float(x) for x in np.round(rng.exponential(size=997), seed)]
    got = O.exact_quantiles(frame(spark, values), "v", [0.1, 0.5, 0.9], slices=16)
    assert got == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.9])), rel=1e-12)


def test_deciles_equal_equal_sized_cut(spark):
    rng = np.random.default_rng(1)
    values = [float(x) for x in rng.normal(size=500)]
    df = frame(spark, values)
    codes = df.select("id", O.bin_code(F.col("v"), O.decile_edges(df, "v")).alias("c"))
    assert [c for _, c in rows(codes, "id")] == list(pd.qcut(values, 10, labels=False))


def test_deciles_with_repeated_edges_and_nulls(spark):
    df = frame(spark, [0.5] * 95 + [0.9] * 4 + [None, float("nan")])
    decile = O.bin_code(F.col("v"), O.decile_edges(df, "v"))
    got = df.select(F.col("v").cast("string"), propensity_label(decile).alias("label")).distinct()
    assert set(rows(got)) == {("0.5", "Low"), ("0.9", "High"), (None, None), ("NaN", None)}


def test_few_rows_and_no_rows(spark):
    df = frame(spark, [1.0, 2.0, 3.0])
    assert len(O.decile_edges(df, "v")) == 9
    assert O.decile_edges(df.where("false"), "v") == []


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    values = random.Random(0).sample(range(1000), 200)
    df = spark.createDataFrame([(float(v), v) for v in values], "v double, n bigint")
    _, bounds = O.value_summary(df, "v", 8)
    got = rows(O.running_totals(df, "v", ["n"], bounds, descending).select("v", "cum_n"), F.col("v").desc() if descending else "v")
    expected = np.cumsum(sorted(values, reverse=descending))
    assert [c for _, c in got] == list(expected)


def test_ordinals_per_group_with_null_group(spark):
    df = spark.createDataFrame([(g, i) for i in range(50) for g in ("a", "b", None)], "g string, i bigint")
    sliced = df.withColumn("s", F.floor(F.col("i") / 7))
    got = O.ordinals(sliced, ["g"], "s", ["i"], "n")
    assert got.where("n <> i + 1").count() == 0 and got.count() == 150


def test_labels_and_threshold(spark):
    df = spark.createDataFrame([(d, d / 10) for d in range(10)] + [(None, None)], "d int, p double")
    got = rows(df.select(propensity_label(F.col("d")), above_half(F.col("p"))))
    assert [g[0] for g in got] == ["Low"] * 8 + ["Medium", "High", None]
    assert [g[1] for g in got] == [0] * 6 + [1] * 4 + [None]
