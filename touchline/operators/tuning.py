"""Search over model settings."""

from __future__ import annotations

import json
import math
import random
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.scores import hash_number

Draw = Callable[[random.Random], float]


@dataclass(frozen=True)
class Range:
    """An even draw between two bounds, which are exponents of e if ``log``; ``step`` rounds to its multiples."""

    low: float
    high: float
    log: bool = False
    step: int = 0

    def __call__(self, rng: random.Random) -> float:
        return self.outer(rng.uniform(self.low, self.high))

    def inner(self, value: float) -> float:
        """Where a value lies on the scale that is drawn from."""
        at = (math.log(value) if value > 0 else self.low) if self.log else value
        return min(max(at, self.low), self.high)

    def outer(self, at: float) -> float:
        value = math.exp(at) if self.log else at
        return float(round(value / self.step) * self.step) if self.step else value


def whole_step(low: int, high: int, step: int = 1) -> Range:
    return Range(low, high, step=step)


def even(low: float, high: float) -> Range:
    return Range(low, high)


def log_even(low: float, high: float) -> Range:
    """exp of an even draw between the two exponents."""
    return Range(low, high, log=True)


# The search space of the propensity model, in terms that GBTClassifier and
# PenalisedTrees share. Leaf penalties have no counterpart in the former and are left out.
# "gamma" is the least loss reduction of a split, summed over all rows; see ``as_params``.
SPACE: dict[str, Draw] = {
    "maxDepth": whole_step(2, 8),
    "stepSize": log_even(-3, 0),
    "gamma": even(0, 5),
    "minInstancesPerNode": log_even(-1, 3),
    "maxIter": whole_step(50, 200),
}

# The same space in terms of PenalisedTrees, with the leaf penalties.
PENALISED_SPACE: dict[str, Draw] = {
    "maxDepth": whole_step(2, 8),
    "stepSize": log_even(-3, 0),
    "gamma": even(0, 5),
    "alpha": log_even(-5, -1),
    "lambda_": log_even(-6, -1),
    "minChildWeight": log_even(-1, 3),
    "maxIter": whole_step(50, 200),
}
_WHOLE = {"maxDepth": 1, "maxIter": 1, "minInstancesPerNode": 1, "minChildWeight": 0}


def _setting(drawn: dict[str, float]) -> dict[str, float | int]:
    """Whole numbers where the parameter is one, of the least value it may have at least."""
    return {k: max(_WHOLE[k], int(v)) if k in _WHOLE else v for k, v in drawn.items()}


def draw_settings(n: int, seed: int, space: dict[str, Draw] | None = None) -> list[dict[str, float | int]]:
    """``n`` random settings; the same seed gives the same list."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(n):
        drawn.append(_setting({name: draw(rng) for name, draw in (space or SPACE).items()}))
    return drawn


def as_params(setting: dict[str, float | int], rows: int, classifier: Estimator | None = None) -> dict[str, float | int]:
    """A setting in the classifier's own terms: where its least gain is a mean over rows, gamma is divided by their number."""
    if classifier is not None and classifier.hasParam("gamma"):
        return {k: float(v) if k == "minChildWeight" else v for k, v in setting.items()}
    return {("minInfoGain" if k == "gamma" else k): (v / max(rows, 1) if k == "gamma" else v) for k, v in setting.items()}


def with_fold(df: DataFrame, key: str, folds: int, salt: str = "fold", name: str = "fold") -> DataFrame:
    """A fold number per row by a hash of its key: the same folds in every run and on every cluster."""
    return df.withColumn(name, (hash_number(F.col(key), salt) % folds).cast("int"))


def f_measure(label: str, beta: float = 1.0) -> MulticlassClassificationEvaluator:
    """F-measure of the positive class as a tuning goal."""
    return MulticlassClassificationEvaluator(
        labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0, beta=beta
    )


@dataclass
class SearchResult:
    model: Model
    best: dict[str, float | int]
    metric: float
    trials: list[tuple[dict[str, float | int], float]] = field(default_factory=list)


def random_search(
    classifier: Estimator,
    prepared: DataFrame,
    evaluator: Evaluator,
    settings: list[dict[str, float | int]],
    validation: str = "validation",
    parallelism: int | None = None,
) -> SearchResult:
    """Fit one model per setting on the same rows, keep the best, refit it on all rows.

    The settings do not depend on each other: as many are tried at a time as there are
    cores, unless ``parallelism`` says otherwise. A fit of few rows keeps one core busy.

    ``validation`` is a boolean column that marks the rows to judge on.
    ``prepared`` is read once per tree level and model: pass it cached.
    """
    judge = _judge(classifier, prepared, evaluator, validation)
    cores = prepared.sparkSession.sparkContext.defaultParallelism
    with ThreadPoolExecutor(parallelism or max(1, min(cores, len(settings)))) as pool:
        metrics = list(pool.map(judge, settings))
    return _best(classifier, prepared, evaluator, list(zip(settings, metrics)))


def _judge(classifier: Estimator, prepared: DataFrame, evaluator: Evaluator, validation: str) -> Callable[[dict], float]:
    """Fits a setting on the rows that are not marked and measures it on those that are."""
    marked = F.col(validation)
    fit_on, judge_on = prepared.where(~marked), prepared.where(marked)
    rows = fit_on.count()
    fit = getattr(classifier, "fit_for_trial", classifier.fit)

    def judge(setting: dict[str, float | int]) -> float:
        params = {classifier.getParam(k): v for k, v in as_params(setting, rows, classifier).items()}
        return evaluator.evaluate(fit(fit_on, params).transform(judge_on))

    return judge


def _best(classifier: Estimator, prepared: DataFrame, evaluator: Evaluator, trials: list[tuple[dict, float]]) -> SearchResult:
    """The best trial's setting, fitted on all rows."""
    pick = max if evaluator.isLargerBetter() else min
    setting, metric = pick(trials, key=lambda t: t[1])
    params = {classifier.getParam(k): v for k, v in as_params(setting, prepared.count(), classifier).items()}
    return SearchResult(classifier.fit(prepared, params), setting, metric, trials)


# ---- sequential search --------------------------------------------------------


class _Parzen:
    """A density over a range: one bell per point, as wide as the gap to its neighbours, and a flat one for what was not tried."""

    def __init__(self, points: list[float], within: Range):
        self.low, self.high = within.low, within.high
        span = (self.high - self.low) or 1.0
        middle = (self.low + self.high) / 2
        at = sorted([*points, middle])
        prior = at.index(middle)
        edges = [self.low, *at, self.high]
        self.bells = []
        for i, p in enumerate(at):
            wide = max(edges[i + 1] - edges[i], edges[i + 2] - edges[i + 1])
            self.bells.append((p, span if i == prior else min(max(wide, span / min(100, len(at) + 1)), span)))

    def draw(self, rng: random.Random) -> float:
        center, width = rng.choice(self.bells)
        for _ in range(100):
            x = rng.gauss(center, width)
            if self.low <= x <= self.high:
                return x
        return center

    def at(self, x: float) -> float:
        total = 0.0
        for center, width in self.bells:
            inside = (math.erf((self.high - center) / (width * math.sqrt(2))) - math.erf((self.low - center) / (width * math.sqrt(2)))) / 2
            total += math.exp(-(((x - center) / width) ** 2) / 2) / (width * max(inside, 1e-12))
        return total / len(self.bells)


def propose(
    trials: list[tuple[dict, float]], space: dict[str, Range], rng: random.Random, larger: bool = True, good_share: float = 0.25,
    candidates: int = 24, pending: list[dict] | None = None,
) -> dict[str, float | int]:
    """The next setting by tree-structured Parzen estimation: where good settings are dense and bad ones are not.

    ``pending`` are settings under trial, whose metric is not known: they count as
    bad, which keeps proposals of one batch apart.
    """
    ranked = sorted(trials, key=lambda t: -t[1] if larger else t[1])
    n_good = max(1, math.ceil(good_share * len(ranked)))
    good, bad = [s for s, _ in ranked[:n_good]], [s for s, _ in ranked[n_good:]] + (pending or [])
    drawn = {}
    for name, within in space.items():
        dense, sparse = (_Parzen([within.inner(s[name]) for s in group], within) for group in (good, bad))
        tried = [dense.draw(rng) for _ in range(candidates)]
        drawn[name] = within.outer(max(tried, key=lambda x: dense.at(x) / max(sparse.at(x), 1e-300)))
    return _setting(drawn)


@dataclass
class TrialLog:
    """Trials of named searches in a folder that all executors reach; a search that stopped goes on from there."""

    spark: SparkSession
    path: str

    def read(self, search: str) -> dict[int, tuple[dict, float]]:
        schema = "search string, number int, setting string, metric double"
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/*").where(F.col("search") == search).collect()  # one row per trial
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r["number"]: (json.loads(r["setting"]), r["metric"]) for r in rows}

    def add(self, search: str, number: int, setting: dict, metric: float) -> None:
        row = [(search, number, json.dumps(setting), float(metric))]
        # A folder of its own: jobs that append to one folder at the same time undo each other's work.
        self.spark.createDataFrame(row, "search string, number int, setting string, metric double").coalesce(1).write.parquet(f"{self.path}/{uuid.uuid4().hex}")


def sequence(
    judge: Callable[[dict], float], space: dict[str, Range], evaluations: int = 20, parallelism: int = 4, start: int = 8, seed: int = 55,
    larger: bool = True, log: TrialLog | None = None, search: str = "search",
) -> list[tuple[dict, float]]:
    """Judge ``evaluations`` settings, ``parallelism`` at a time: the first ``start`` drawn at random, the others proposed from all batches before.

    The seed and the trials before decide a proposal, so with a log a search that
    stopped goes on as if it had not, and a finished one judges nothing.
    """
    known = log.read(search) if log else {}
    trials: list[tuple[dict, float]] = []
    first = draw_settings(start, seed, space)
    for low in range(0, evaluations, parallelism):
        numbers = range(low, min(low + parallelism, evaluations))
        batch: list[dict] = []
        for number in numbers:
            rng = random.Random(f"{seed}/{number}")
            batch.append(first[number] if number < start else propose(trials, space, rng, larger, pending=batch))

        def one(number: int) -> tuple[dict, float]:
            setting = batch[number - low]  # noqa: B023
            if number in known and known[number][0] == setting:
                return known[number]
            metric = judge(setting)
            if log:
                log.add(search, number, setting, metric)
            return setting, metric

        with ThreadPoolExecutor(parallelism) as pool:
            trials += list(pool.map(one, numbers))
    return trials


def sequential_search(
    classifier: Estimator,
    prepared: DataFrame,
    evaluator: Evaluator,
    space: dict[str, Range],
    evaluations: int = 20,
    validation: str = "validation",
    parallelism: int = 4,
    seed: int = 55,
    log: TrialLog | None = None,
    search: str = "search",
) -> SearchResult:
    """Like ``random_search``, with settings that learn from the trials before; see ``sequence``."""
    judge = _judge(classifier, prepared, evaluator, validation)
    trials = sequence(judge, space, evaluations, parallelism, seed=seed, larger=evaluator.isLargerBetter(), log=log, search=search)
    return _best(classifier, prepared, evaluator, trials)


def grid_search(
    classifier: Estimator,
    prepared: DataFrame,
    label: str,
    grid: dict[str, list],
    fold: str = "fold",
    folds: int = 5,
    parallelism: int = 4,
    seed: int = 55,
) -> CrossValidatorModel:
    """All combinations of the grid, cross-validated on area under ROC over the folds of the column ``fold``."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(classifier.getParam(name), values)
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
    validator = CrossValidator(
        estimator=classifier, estimatorParamMaps=builder.build(), evaluator=evaluator,
        numFolds=folds, foldCol=fold, parallelism=parallelism, seed=seed,
    )
    return validator.fit(prepared)


# The grid of the cross-validated variant.
GRID = {"stepSize": [0.1, 0.01, 0.001], "maxDepth": [2, 4, 8]}
