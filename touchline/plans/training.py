"""Gold table to registered model, and registered model to score table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators import evaluate as V
from touchline.operators import features as X
from touchline.operators import models as M
from touchline.operators import tuning as U
from touchline.operators.audiences import high_propensity, score_table
from touchline.operators.boosting import PenalisedTrees, few_partitions
from touchline.sources.models import ModelStore
from touchline.sources.tables import staged, write_table


def train_and_register(
    gold: DataFrame,
    store: ModelStore,
    name: str,
    label: str = "converted_user",
    key: str = "domain_userid",
    categorical: Sequence[str] = tuple(X.CATEGORICAL),
    continuous: Sequence[str] = tuple(X.CONTINUOUS),
    settings: list[dict] | None = None,
    evaluations: int = 20,
    trials: U.TrialLog | None = None,
    train_percent: int = 67,
    k: int = 50,
    weight: float | None = None,
) -> int:
    """Split, prepare, search, evaluate on held-out rows, log, register and promote.

    The search is sequential, over the whole space with leaf penalties, and goes
    on with what ``trials`` holds of it. ``settings`` for Spark's own boosted trees
    are tried instead where they are given.
    """
    train, test = X.hash_split(gold, key, train_percent)
    train = X.with_class_weight(train, label, weight)
    features = M.featurizer(categorical, continuous, k).fit(train)
    validation = X.hash_percent(F.col(key), "validation") >= train_percent
    vectors = staged(features.transform(train).select(label, "features", "weight", validation.alias("validation")), "vectors")
    prepared = X.materialised(few_partitions(vectors))
    bins = max(32, k + 3)
    if settings:
        found = U.random_search(M.boosted_trees(label, weightCol="weight", maxBins=bins), prepared, U.f_measure(label), settings)
    else:
        trees = PenalisedTrees(labelCol=label, weightCol="weight", maxBins=bins)
        found = U.sequential_search(trees, prepared, U.f_measure(label), U.PENALISED_SPACE, evaluations, log=trials, search=name)
    prepared.unpersist()
    model = PipelineModel(stages=[*features.stages, found.model])
    held_out = staged(M.score(model, test, [label]), "held_out")
    metrics = {
        "average_precision": V.average_precision(held_out, label, "propensity_score").first()[0] or 0.0,
        "f1": V.f_beta(held_out, label, "prediction").first()[0],
        "f2": V.f_beta(held_out, label, "prediction", 2.0).first()[0],
    }
    store.log_run(name, found.best, {"search_f1": found.metric, **metrics})
    version = store.register(name, model, X.input_contract(gold, [*categorical, *continuous]), metrics)
    store.promote(name, version)
    return version


def score_users(gold: DataFrame, store: ModelStore, name: str, key: str = "domain_userid") -> DataFrame:
    """(key, score, prediction) from the production model."""
    model, contract = store.load(name)
    return M.score(model, X.enforce_contract(gold, contract), [key])


def score_and_label(gold: DataFrame, store: ModelStore, name: str, key: str = "domain_userid") -> DataFrame:
    """The score table. Scores are written once, as deciles need several passes over them."""
    return score_table(staged(score_users(gold, store, name, key), "scores"), key)


def save_scores(gold: DataFrame, store: ModelStore, name: str, target: str, key: str = "domain_userid") -> None:
    """Replace the score table with scores of the production model."""
    write_table(score_and_label(gold, store, name, key), target)


def save_high_propensity(gold: DataFrame, store: ModelStore, name: str, target: str, key: str = "domain_userid") -> None:
    """Replace the table of users whom the production model expects to convert."""
    write_table(high_propensity(score_users(gold, store, name, key), key, "prediction"), target)
