"""Propensity, quantile and ranking models on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.boosting import few_partitions, fit_squared_trees
from touchline.operators.features import CastToDouble, DummyColumns, FillCategories, TopKCategories

SEED = 55


# ---- propensity --------------------------------------------------------------


def featurizer(
    categorical: Sequence[str],
    continuous: Sequence[str],
    k: int = 50,
    features: str = "features",
) -> Pipeline:
    """Fills, rare-value cut, indexing and assembly as one fitted thing.

    Fills are part of it, so scoring treats gaps as training did.
    """
    stages = [FillCategories(columns=list(categorical)), CastToDouble(columns=list(continuous))]
    stages.append(Imputer(strategy="mean", inputCols=list(continuous), outputCols=[f"{c}_filled" for c in continuous]))
    if categorical:
        stages.append(TopKCategories(columns=list(categorical), k=k))
        stages.append(
            StringIndexer(
                inputCols=list(categorical),
                outputCols=[f"{c}_ix" for c in categorical],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
    inputs = [f"{c}_ix" for c in categorical] + [f"{c}_filled" for c in continuous]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features))
    return Pipeline(stages=stages)


def dummy_featurizer(train: DataFrame, categorical: Sequence[str], continuous: Sequence[str]) -> PipelineModel:
    """The variant with 0/1 columns per value, for linear models and for the short feature list."""
    dummies = DummyColumns(columns=list(categorical)).fit(train)
    inputs = [*continuous, *dummies.dummy_names()]
    return PipelineModel(
        stages=[CastToDouble(columns=list(continuous)), dummies, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")]
    )


def boosted_trees(label: str, **params) -> GBTClassifier:
    """Boosted trees with logistic loss. Bins must outnumber the values of every category."""
    return GBTClassifier(labelCol=label, featuresCol="features", seed=SEED, **{"maxBins": 64, **params})


def boosted_trees_with_stop(label: str, validation: str, tolerance: float = 0.01, **params) -> GBTClassifier:
    """Boosted trees that stop when the rows flagged by ``validation`` improve no further."""
    return boosted_trees(label, validationIndicatorCol=validation, validationTol=tolerance, **params)


def logistic(label: str, **params) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol="features", **params)


def linear_svm(label: str, **params) -> LinearSVC:
    return LinearSVC(labelCol=label, featuresCol="features", **params)


def propensity_model(
    train: DataFrame,
    label: str,
    categorical: Sequence[str],
    continuous: Sequence[str],
    classifier,
    k: int = 50,
) -> PipelineModel:
    """Featurizer and classifier fitted on the training rows alone.

    The vectors are kept while the classifier is fitted, as it reads them very
    often, in as few partitions as their number asks for.
    """
    for name in (*categorical, *continuous):
        if name == label:
            raise ValueError("the label must not be a feature")
    prepared = featurizer(categorical, continuous, k).fit(train)
    others = [c for c in train.columns if c not in (*categorical, *continuous)]
    made = prepared.transform(train).select(*others, "features").persist()
    vectors = few_partitions(made).persist()
    model = classifier.fit(vectors)
    vectors.unpersist()
    made.unpersist()
    return PipelineModel(stages=[*prepared.stages, model])


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows with ``propensity_score`` and ``prediction``; works on batches and streams."""
    scored = model.transform(df)
    positive = vector_to_array("probability")[1]
    return scored.select(*keep, positive.alias("propensity_score"), "prediction")


def feature_importances(model: PipelineModel, sample: DataFrame, top: int | None = None) -> DataFrame:
    """Importance per feature, largest first. Names come from the assembled vector's attributes."""
    attributes = model.transform(sample.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a.get("name", str(a["idx"])) for group in attributes.values() for a in group}
    weights = model.stages[-1].featureImportances
    rows = sorted(((names[i], float(weights[i])) for i in range(weights.size)), key=lambda r: (-r[1], r[0]))
    return sample.sparkSession.createDataFrame(rows[:top], "feature string, importance double")


# ---- quantile regression ------------------------------------------------------


@dataclass
class QuantileModel:
    """A regression tree whose leaves answer with a quantile of their training labels."""

    pipeline: PipelineModel
    leaves: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        # One row per leaf, 2 ** depth at most: the tree's depth bounds the broadcast.
        scored = self.pipeline.transform(df).drop("prediction")
        return scored.join(F.broadcast(self.leaves), "leaf", "left")


def fit_quantile(
    train: DataFrame, label: str, features: Sequence[str], alpha: float, max_depth: int = 5, min_rows: int = 20
) -> QuantileModel:
    """Quantile regression forest idea (Meinshausen 2006) with one tree.

    The leaf quantile is a mergeable sketch, so a leaf that holds most of the
    rows is aggregated in parts like any other.
    """
    if max_depth > 12:
        raise ValueError("a depth above 12 gives too many leaves to broadcast")
    tree = DecisionTreeRegressor(
        labelCol=label, featuresCol="features", leafCol="leaf", maxDepth=max_depth, minInstancesPerNode=min_rows, seed=SEED
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    pipeline = Pipeline(stages=[assembler, tree]).fit(train)
    leaves = (
        pipeline.transform(train)
        .groupBy("leaf")
        .agg(F.percentile_approx(F.col(label).cast("double"), alpha, 10_000).alias("prediction"))
    )
    rows = leaves.collect()  # one row per leaf
    return QuantileModel(pipeline, train.sparkSession.createDataFrame(rows, leaves.schema))


# ---- ranking ------------------------------------------------------------------


def fit_ranker(train: DataFrame, label: str, features: str = "features", **params) -> PipelineModel:
    """Pointwise ranking: boosted trees learn the relevance grade, the score orders the rows.

    This is not a pairwise or listwise ranker. Rows need no grouping by query
    for it, so a query that holds most rows is no burden. Settings are those of
    Spark's ``GBTRegressor``, which does the work if one is asked for that packed
    partitions do not know.
    """
    known = {"maxIter": "rounds", "maxDepth": "depth", "stepSize": "rate", "minInstancesPerNode": "min_rows", "maxBins": "max_bins"}
    if set(params) <= set(known):
        model = fit_squared_trees(train, label, features, **{known[k]: v for k, v in params.items()})
        return PipelineModel(stages=[model.setPredictionCol("preds").setLeafCol("leaf_preds")])
    ranker = GBTRegressor(
        labelCol=label, featuresCol=features, predictionCol="preds", leafCol="leaf_preds", seed=SEED, **params
    )
    return Pipeline(stages=[ranker]).fit(train)


def best_per_query(scored: DataFrame, query: str, score_col: str, tie: str, top: int) -> DataFrame:
    """The ``top`` rows of each query with their rank; cut on the map side first."""
    order = Window.partitionBy(query).orderBy(F.col(score_col).desc(), tie)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
