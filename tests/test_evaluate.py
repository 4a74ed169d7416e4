import math
import random

import pytest
from conftest import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from touchline.operators import evaluate as V


def scored(spark, n=400, seed=0, digits=2):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        y = int(rng.random() < 0.2)
        made.append((y, round(min(1.0, max(0.0, rng.gauss(0.3 + 0.2 * y, 0.2))), digits)))
    return made, spark.createDataFrame(made, "y int, s double").withColumn("p", (F.col("s") > 0.5).cast("double"))


@pytest.mark.parametrize("digits", [1, 2, 12])
def test_average_precision_by_hand(spark, digits):
    made, df = scored(spark, digits=digits)
    total, area, last = sum(y for y, _ in made), 0.0, 0.0
    for cut in sorted({s for _, s in made}, reverse=True):
        hit = sum(y for y, s in made if s >= cut)
        recall = hit / total
        area += (recall - last) * hit / sum(s >= cut for _, s in made)
        last = recall
    assert V.average_precision(df, "y", "s", slices=8).first()[0] == pytest.approx(area, rel=1e-12)


def test_area_under_roc_equals_spark(spark):
    _, df = scored(spark)
    want = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0).evaluate(df.withColumn("y", F.col("y").cast("double")))
    assert V.area_under_roc(df, "y", "s", slices=8).first()[0] == pytest.approx(want, rel=1e-9)


def test_f_measures_equal_spark(spark):
    _, df = scored(spark)
    doubles = df.withColumn("y", F.col("y").cast("double"))
    for beta in (1.0, 2.0):
        judge = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName="fMeasureByLabel", metricLabel=1.0, beta=beta)
        assert V.f_beta(df, "y", "p", beta).first()[0] == pytest.approx(judge.evaluate(doubles))


def test_confusion_has_empty_cells(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0)], "y int, p double")
    assert rows(V.confusion(df, "y", "p"), "label", "prediction") == [(0, 0, 2), (0, 1, 0), (1, 0, 0), (1, 1, 0)]
    assert V.f_beta(df, "y", "p").first()[0] == 0.0


def test_report_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 0.0), (0, 0.0)], "y int, p double")
    report = {r["class"]: r for r in V.classification_report(df, "y", "p").collect()}
    assert report["1"]["precision"] == 1.0 and report["1"]["recall"] == 0.5 and report["0"]["support"] == 2
    assert report["accuracy"]["f1"] == 0.75 and set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}


def test_no_positives(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, s double")
    assert V.average_precision(df, "y", "s").first()[0] is None


def test_ndcg_by_hand(spark):
    data = [("q", 3, 0.1, 1), ("q", 0, 0.9, 2), ("q", 1, 0.5, 3), ("none", 0, 0.3, 4)]
    df = spark.createDataFrame(data, "q string, y int, s double, t int")
    got = V.ndcg(df, "q", "y", "s", "t", (1, 3)).first()
    dcg = 1 / math.log2(3) + 7 / math.log2(4)
    ideal = 7 + 1 / math.log2(3)
    assert got["ndcg_at_1"] == pytest.approx((0 + 1) / 2) and got["ndcg_at_3"] == pytest.approx((dcg / ideal + 1) / 2)


def test_regression(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    got = V.regression_statistics(df, "y", "p").first()
    assert got["mse"] == pytest.approx(2 / 3) and got["mae"] == pytest.approx(2 / 3) and got["r2"] == pytest.approx(0.75)
    assert V.pinball_loss(df, "y", "p", 0.2).first()["coverage"] == pytest.approx(2 / 3)
