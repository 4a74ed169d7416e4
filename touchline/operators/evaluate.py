"""Metrics of scores and predictions as DataFrames.

Curve metrics count rows per distinct score first and then use sliced running
totals, so no metric needs one global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.ordering import running_totals, value_summary
from touchline.sources.tables import staged


def _score_counts(df: DataFrame, label: str, score: str, slices: int | None) -> DataFrame:
    """Per distinct score, from the highest: rows, positives, and both up to there. Null and NaN scores are left out.

    The scores are read once: what follows works on their counts, which are written.
    """
    pairs = df.select(F.col(score).cast("double").alias("_score"), (F.col(label) == 1).cast("bigint").alias("_pos"))
    pairs = pairs.where("_score IS NOT NULL AND NOT isnan(_score) AND _pos IS NOT NULL")
    counted = staged(pairs.groupBy("_score").agg(F.sum("_pos").alias("pos"), F.count(F.lit(1)).alias("n")), "score_counts")
    _, bounds = value_summary(counted, "_score", slices)
    return running_totals(counted, "_score", ["pos", "n"], bounds, descending=True)


def average_precision(df: DataFrame, label: str, score: str, slices: int | None = None) -> DataFrame:
    """Step-wise area under the precision-recall curve, without interpolation."""
    steps = _score_counts(df, label, score, slices)
    precision = F.col("cum_pos").cast("double") / F.col("cum_n").cast("double")
    area = F.try_divide(F.sum(precision * F.col("pos")), F.sum("pos").cast("double"))
    return steps.agg(area.alias("average_precision"))


def area_under_roc(df: DataFrame, label: str, score: str, slices: int | None = None) -> DataFrame:
    """Area under the ROC curve; equal scores count half."""
    steps = _score_counts(df, label, score, slices)
    negatives = (F.col("n") - F.col("pos")).cast("double")
    above = F.col("cum_pos") - F.col("pos") / 2
    area = F.try_divide(F.sum(negatives * above), F.sum("pos").cast("double") * F.sum(negatives))
    return steps.agg(area.alias("area_under_roc"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """All four cells, empty ones included."""
    cells = [(actual, predicted) for actual in (0, 1) for predicted in (0, 1)]
    counts = df.agg(
        *[F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(f"c{a}{p}") for a, p in cells]
    )
    rows = F.array(
        *[F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"c{a}{p}").alias("count")) for a, p in cells]
    )
    return counts.select(F.inline(rows))


def _counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit, said = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(hit & said).cast("double").alias("tp"),
        F.count_if(~hit & said).cast("double").alias("fp"),
        F.count_if(hit & ~said).cast("double").alias("fn"),
        F.count_if(~hit & ~said).cast("double").alias("tn"),
    )


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the denominator is 0, as is usual for precision and recall."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _f(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b = beta * beta
    return _ratio((1 + b) * tp, (1 + b) * tp + b * fn + fp)


def f_beta(df: DataFrame, label: str, prediction: str, beta: float = 1.0) -> DataFrame:
    """F-measure of the positive class; beta above 1 favours recall."""
    counts = _counts(df, label, prediction)
    return counts.select(_f(F.col("tp"), F.col("fp"), F.col("fn"), beta).alias("f_beta"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted rows."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    classes = {
        "0": (_ratio(tn, tn + fn), _ratio(tn, tn + fp), _f(tn, fn, fp, 1), tn + fp),
        "1": (_ratio(tp, tp + fp), _ratio(tp, tp + fn), _f(tp, fp, fn, 1), tp + fn),
    }
    total = tp + fp + fn + tn
    accuracy = _ratio(tp + tn, total)
    negative, positive = classes["0"], classes["1"]
    macro = [(a + b) / 2 for a, b in zip(negative[:3], positive[:3])]
    weighted = [_ratio(a * negative[3] + b * positive[3], total) for a, b in zip(negative[:3], positive[:3])]
    lines = [("0", *negative), ("1", *positive), ("accuracy", accuracy, accuracy, accuracy, total)]
    lines += [("macro avg", *macro, total), ("weighted avg", *weighted, total)]
    rows = [
        F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.cast("bigint").alias("support")
        )
        for name, p, r, f, s in lines
    ]
    return _counts(df, label, prediction).select(F.inline(F.array(*rows)))


def classification_statistics(df: DataFrame, label: str, prediction: str, score: str) -> DataFrame:
    """Accuracy, precision, recall and area under ROC as one row."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = _counts(df, label, prediction).select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
    )
    # Two one-row tables with different columns, folded into one row.
    both = rates.unionByName(area_under_roc(df, label, score), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def regression_statistics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean squared, root mean squared and mean absolute error, and R squared."""
    error = F.col(label) - F.col(prediction)
    sums = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(label).alias("_var")
    )
    return sums.select(
        "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2")
    )


def pinball_loss(df: DataFrame, label: str, prediction: str, alpha: float) -> DataFrame:
    """Loss of a quantile forecast, and the share of labels at or below it."""
    error = F.col(label) - F.col(prediction)
    loss = F.greatest(alpha * error, (alpha - 1) * error)
    below = (F.col(label) <= F.col(prediction)).cast("double")
    return df.agg(F.avg(loss).alias("pinball_loss"), F.avg(below).alias("coverage"))


def ndcg(df: DataFrame, query: str, label: str, score: str, tie: str, at: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Mean NDCG at each cut-off, gain 2 ** relevance - 1.

    Only the first ``max(at)`` rows per query and order are ever needed; Spark
    cuts to those before the shuffle. A query without relevant rows counts 1.
    """
    top = max(at)
    by_score = Window.partitionBy(query).orderBy(F.col(score).desc(), tie)
    by_label = Window.partitionBy(query).orderBy(F.col(label).desc(), tie)
    gain = (F.pow(F.lit(2.0), F.col(label)) - 1) / F.log2(F.col("_rank") + 1)

    def totals(window: Window, prefix: str) -> DataFrame:
        ranked = df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= top)
        return ranked.groupBy(query).agg(*[F.sum(F.when(F.col("_rank") <= k, gain)).alias(f"{prefix}{k}") for k in at])

    both = totals(by_score, "_dcg").join(totals(by_label, "_ideal"), query)
    return both.agg(
        *[F.avg(F.when(F.col(f"_ideal{k}") > 0, F.col(f"_dcg{k}") / F.col(f"_ideal{k}")).otherwise(1.0)).alias(f"ndcg_at_{k}") for k in at]
    )


def prediction_counts(df: DataFrame, prediction: str) -> DataFrame:
    return df.groupBy(prediction).count()


class AveragePrecision(Evaluator):
    """Average precision for Spark's tuning classes; larger is better."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "probability column, positive class second", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol: str = "label", scoreCol: str = "probability"):  # noqa: N803
        super().__init__()
        self._setDefault(labelCol="label", scoreCol="probability")
        self._set(**self._input_kwargs)

    def isLargerBetter(self) -> bool:  # noqa: N802
        return True

    def _evaluate(self, dataset: DataFrame) -> float:
        score = vector_to_array(F.col(self.getOrDefault("scoreCol")))[1]
        scored = dataset.select(F.col(self.getOrDefault("labelCol")).alias("label"), score.alias("score"))
        return average_precision(scored, "label", "score").first()[0] or 0.0
