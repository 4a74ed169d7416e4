"""Boosted trees for losses and penalties that Spark's own boosted trees lack.

Every round fits one of Spark's regression trees to the loss's Newton steps
``-g / h``, weighted by ``h``, where g and h are the first and second
derivatives of the loss by the score. The tree keeps the sums of g and h of each
node, so leaf values with penalties, and the pruning of splits that gain too
little, need no pass over the data. The result is one of Spark's own ensemble
models: it scores in the JVM, gives leaf indexes and importances, and is saved
and loaded like others.

The trees grow on packed partitions (see ``grown``). Only rankings with a query
that is too large for one task are fitted job by job (``boost``). There scores are not
kept per round: the rows' scores are those at the last fold plus the trees since then,
and each fold writes the rows to the shared folder.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import SparkContext, cloudpickle, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators import grown
from touchline.session import cut_lineage

# What runs in Python tasks is sent to them, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 55

#: Rounds between two folds: so many trees are applied anew in each pass.
FOLD_EVERY = 10

#: A tree without a split, and with a value below this, ends the rounds: those after it would be like it.
SETTLED = 1e-6

ROWS_PER_PARTITION = 500_000

#: Rows of a query that are ranked together in one task; a larger query is dealt to several.
ROWS_PER_QUERY_PART = 100_000

#: A loss: adds ``_target`` and ``_weight`` to rows that have the score ``_score``.
Loss = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Penalty:
    """What leaves and splits cost.

    A leaf over rows with the sums G and H has the value ``-soft(G, l1) / (H + l2)``
    and the gain ``soft(G, l1) ** 2 / (H + l2)``, where ``soft`` moves a sum by
    ``l1`` towards 0. A split stays if its leaves gain at least ``least_gain``
    more than their parent, and have an H of ``least_weight`` or more.
    """

    l1: float = 0.0
    l2: float = 0.0
    least_gain: float = 0.0
    least_weight: float = 0.0

    def _soft(self, g: float) -> float:
        return max(abs(g) - self.l1, 0.0) * (1 if g > 0 else -1)

    def value(self, g: float, h: float) -> float:
        return -self._soft(g) / (h + self.l2) if h + self.l2 > 0 else 0.0

    def gain(self, g: float, h: float) -> float:
        return self._soft(g) ** 2 / (h + self.l2) if h + self.l2 > 0 else 0.0

    def keeps(self, left: tuple[float, float], right: tuple[float, float]) -> bool:
        both = (left[0] + right[0], left[1] + right[1])
        gained = self.gain(*left) + self.gain(*right) - self.gain(*both)
        return min(left[1], right[1]) >= self.least_weight and gained >= self.least_gain


# ---- trees ------------------------------------------------------------------


def _sums(node) -> tuple[float, float]:
    """(G, H) of a node: a regression tree of targets -g / h with weights h holds their sums."""
    total = node.impurityStats().stats()
    return -float(total[1]), float(total[0])


class _Nodes:
    """Makes nodes of Spark's trees. The classes are looked up once, as each look-up is a call to the JVM."""

    def __init__(self, jvm):
        package = jvm.org.apache.spark.ml.tree
        self.leaf_class, self.split_class = package.LeafNode, package.InternalNode
        self.by_number, self.by_category = package.ContinuousSplit, package.CategoricalSplit

    def leaf(self, node, value: float):
        return self.leaf_class(float(value), float(node.impurity()), node.impurityStats())

    def split(self, node, left, right):
        return self.split_class(float(node.prediction()), float(node.impurity()), float(node.gain()), left, right, node.split(), node.impurityStats())

    def pruned(self, node, depth: int, penalty: Penalty, rate: float):
        """(subtree, (G, H), whether it is a leaf): splits checked from the leaves upwards, leaves revalued."""
        sums = _sums(node)
        if depth == 0 or node.subtreeDepth() == 0:
            return self.leaf(node, rate * penalty.value(*sums)), sums, True
        left, at_left, left_ends = self.pruned(node.leftChild(), depth - 1, penalty, rate)
        right, at_right, right_ends = self.pruned(node.rightChild(), depth - 1, penalty, rate)
        if left_ends and right_ends and not penalty.keeps(at_left, at_right):
            return self.leaf(node, rate * penalty.value(*sums)), sums, True
        return self.split(node, left, right), sums, False

    def unbinned(self, node, edges: list[np.ndarray], arity: dict[int, int]):
        """The subtree with thresholds in place of bin numbers."""
        if node.subtreeDepth() == 0:
            return node
        split, left, right = node.split(), *(self.unbinned(x, edges, arity) for x in (node.leftChild(), node.rightChild()))
        f = int(split.featureIndex())
        split = split if f in arity else self.by_number(f, float(edges[f][int(split.threshold())]))
        return self.split_class(float(node.prediction()), float(node.impurity()), float(node.gain()), left, right, split, node.impurityStats())

    def revalued(self, node, values: list[float], at: list[int]):
        """The subtree with new values for its leaves, from left to right."""
        if node.subtreeDepth() == 0:
            at[0] += 1
            return self.leaf(node, values[at[0] - 1])
        left, right = (self.revalued(x, values, at) for x in (node.leftChild(), node.rightChild()))
        return self.split(node, left, right)


def _tree(jvm, root, features: int):
    made = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    return made(jvm.org.apache.spark.ml.util.Identifiable.randomUID("dtr"), root, features)


def _ensemble(jvm, kind, name: str, trees: list, weight: float):
    gateway = SparkContext._active_spark_context._gateway
    listed = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        listed[i], weights[i] = tree, weight
    return kind(jvm.org.apache.spark.ml.util.Identifiable.randomUID(name), listed, weights)


def _made(jvm, grown_trees: list[list], features: int, arity: dict[int, int]) -> list:
    """Trees from ``grown.grow`` as Spark's, nodes with the sums that Spark keeps."""
    nodes = _Nodes(jvm)
    copy = jvm.java.util.Arrays.copyOfRange
    held = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    array = SparkContext._active_spark_context._gateway.new_array

    def doubles(values: list[float]):
        out = array(jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    def build(tree: list, stats, i: int):
        n = tree[i]
        rows, h, g, squares = (float(v) for v in n.sums)
        impurity = max(0.0, squares - g * g / h) / h if h > 0 else 0.0
        kept, value = held(copy(stats, 3 * i, 3 * i + 3), int(rows)), float(n.value)
        if n.left < 0:
            return nodes.leaf_class(value, impurity, kept)
        if n.feature in arity:
            split = nodes.by_category(n.feature, doubles(n.bins.nonzero()[0]), arity[n.feature])
        else:
            split = nodes.by_number(n.feature, n.threshold)
        return nodes.split_class(value, impurity, float(n.gain), build(tree, stats, n.left), build(tree, stats, n.right), split, kept)

    out = []
    for tree in grown_trees:
        flat = [x for n in tree for x in (n.sums[1], -n.sums[2], n.sums[3])]
        out.append(_tree(jvm, build(tree, _py2java(SparkContext._active_spark_context, Vectors.dense(flat)).toArray(), 0), features))
    return out


def _packed(rows: DataFrame, derive, rounds: int, depth: int, rate: float, penalty: Penalty, min_rows: int, max_bins: int, **more) -> tuple:
    """(trees, number of features, how they were grown) over ``features`` of rows that are dealt; the other columns are what ``derive`` reads."""
    arity = grown.nominal(rows, "features")
    grower = grown.Grower(derive, rounds, depth, rate, penalty, min_rows, max_bins, arity, SETTLED, SEED, **more)
    return *grown.grow(rows, "features", grower), grower


def _grow(rows: DataFrame, *settings, **more) -> list:
    """The same as trees of Spark's."""
    trees, features, grower = _packed(rows, *settings, **more)
    return _made(rows.sparkSession.sparkContext._jvm, trees, features, grower.arity)


def regression_ensemble(trees: list, features: str, prediction: str = "prediction") -> GBTRegressionModel:
    """The sum of the trees as one of Spark's models."""
    jvm = SparkContext._active_spark_context._jvm
    model = GBTRegressionModel(_ensemble(jvm, jvm.org.apache.spark.ml.regression.GBTRegressionModel, "gbtr", trees, 1.0))
    return model.setFeaturesCol(features).setPredictionCol(prediction)


def leaf_values(model) -> list[list[float]]:
    """The values of each tree's leaves, by leaf index."""

    return [_values(t._call_java("rootNode")) for t in model.trees]


def _values(node) -> list[float]:
    return [float(node.prediction())] if node.subtreeDepth() == 0 else _values(node.leftChild()) + _values(node.rightChild())


def with_score(state: DataFrame, trees: list, features: str) -> DataFrame:
    """The rows with the trees' sum added to ``_score``."""
    if not trees:
        return state
    jvm = SparkContext._active_spark_context._jvm
    model = _ensemble(jvm, jvm.org.apache.spark.ml.regression.GBTRegressionModel, "gbtr", trees, 1.0)
    found = DataFrame(model.setFeaturesCol(features).setPredictionCol("_more").transform(state._jdf), state.sparkSession)
    return found.withColumn("_score", F.col("_score") + F.col("_more")).drop("_more")


def boost(
    data: DataFrame,
    loss: Loss,
    rounds: int,
    features: str = "features",
    depth: int = 5,
    rate: float = 0.3,
    penalty: Penalty = Penalty(),
    min_rows: int = 1,
    max_bins: int = 64,
    refit: Callable[[DataFrame], dict[int, float]] | None = None,
    seed: int = SEED,
) -> list:
    """The trees of ``rounds`` rounds, values times ``rate``; fewer if nothing is left to learn.

    ``refit`` takes the graded rows with their ``_leaf`` and gives the value of
    each leaf, for losses whose best leaf value is no Newton step.
    """
    jvm = data.sparkSession.sparkContext._jvm
    nodes = _Nodes(jvm)
    state = cut_lineage(data.withColumn("_score", F.lit(0.0))).persist()
    trees: list = []
    folded = 0
    for number in range(rounds):
        if number - folded == FOLD_EVERY:
            old, folded = state, number
            state = cut_lineage(with_score(old, trees[number - FOLD_EVERY :], features)).persist()
            old.unpersist()
        graded = loss(with_score(state, trees[folded:], features)).persist()
        # Straight in the JVM: the Python classes copy all parameters there and back, which takes longer than a small fit.
        learner = jvm.org.apache.spark.ml.regression.DecisionTreeRegressor()
        learner = learner.setFeaturesCol(features).setLabelCol("_target").setWeightCol("_weight").setPredictionCol("_fitted")
        learner.setLeafCol("_leaf")
        learner.setMaxDepth(depth).setMinInstancesPerNode(min_rows).setMaxBins(max_bins).setSeed(seed + number)
        fitted = learner.fit(graded._jdf)
        root = fitted.rootNode()
        if refit is None:
            root, _, _ = nodes.pruned(root, depth, penalty, rate)
        else:
            values = refit(DataFrame(fitted.transform(graded._jdf), data.sparkSession))
            leaves = int(fitted.numLeave())
            root = nodes.revalued(root, [rate * values.get(i, 0.0) for i in range(leaves)], [0])
        graded.unpersist()
        trees.append(_tree(jvm, root, int(fitted.numFeatures())))
        if root.subtreeDepth() == 0 and abs(root.prediction()) < SETTLED:
            break
    state.unpersist()
    return trees


def few_partitions(df: DataFrame, *by: str) -> DataFrame:
    """As many partitions as the number of rows asks for: every round runs several short jobs over all of them."""
    rows = df.count()
    wanted = max(-(-rows // ROWS_PER_PARTITION), min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // 10_000)), 1)
    return df.repartition(wanted, *by)


# ---- classes ----------------------------------------------------------------


def logistic_steps(columns: dict[str, np.ndarray], score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the logistic loss: scores are log odds."""
    share = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
    weight = columns.get("weight", 1.0)
    return weight * (share - columns["label"]), weight * np.maximum(share * (1 - share), 1e-12)


class PenalisedTrees(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees with logistic loss, second-order leaf values, and penalties on leaves and splits.

    ``fit`` gives one of Spark's own boosted-tree models. With all penalties 0
    leaves are plain Newton steps. See ``Penalty`` for ``alpha`` (l1), ``lambda_``
    (l2), ``gamma`` (least gain) and ``minChildWeight``. Splits are chosen by
    the gain without penalties and checked with them afterwards, from the
    leaves upwards.
    """

    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weight, empty for none", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a leaf value that is taken", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a split, summed over its rows", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "l1 penalty of leaf values", TypeConverters.toFloat)
    lambda_ = Param(Params._dummy(), "lambda_", "l2 penalty of leaf values", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least sum of second derivatives in a leaf", TypeConverters.toFloat)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a node", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, labelCol: str = "label", weightCol: str = "", maxIter: int = 100, maxDepth: int = 5, maxBins: int = 64,  # noqa: N803
        stepSize: float = 0.3, gamma: float = 0.0, alpha: float = 0.0, lambda_: float = 0.0, minChildWeight: float = 0.0,  # noqa: N803
        minInstancesPerNode: int = 1,  # noqa: N803
    ):
        super().__init__()
        self._setDefault(labelCol="label", weightCol="", maxIter=100, maxDepth=5, maxBins=64, stepSize=0.3, gamma=0.0, alpha=0.0, lambda_=0.0, minChildWeight=0.0, minInstancesPerNode=1)
        self._set(**self._input_kwargs)

    def _rows(self, dataset: DataFrame) -> DataFrame:
        label, weight = self.getOrDefault("labelCol"), self.getOrDefault("weightCol")
        return grown.dealt(dataset.select("features", F.col(label).alias("label"), *([F.col(weight).alias("weight")] if weight else [])))

    def _settings(self) -> tuple:
        get = self.getOrDefault
        penalty = Penalty(get("alpha"), get("lambda_"), get("gamma"), get("minChildWeight"))
        return logistic_steps, get("maxIter"), get("maxDepth"), get("stepSize"), penalty, get("minInstancesPerNode"), get("maxBins")

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        trees = _grow(self._rows(dataset), *self._settings())
        jvm = dataset.sparkSession.sparkContext._jvm
        # Spark's model takes 1 / (1 + exp(-2 s)) for a probability.
        made = _ensemble(jvm, jvm.org.apache.spark.ml.classification.GBTClassificationModel, "gbtc", trees, 0.5)
        return GBTClassificationModel(made).setFeaturesCol("features")

    def fit_for_trial(self, dataset: DataFrame, params: dict | None = None) -> TrialModel:
        """Like ``fit``, for a model that scores a few rows and is thrown away.

        Spark's model is made node by node through calls to the JVM, which takes longer than a small fit.
        """
        mine = self.copy(params)
        trees, _, grower = _packed(mine._rows(dataset), *mine._settings())
        return TrialModel(grown.scorer(trees, grower))


@dataclass
class TrialModel:
    """Scores rows with trees as they were grown, by the columns of Spark's own model."""

    score: Callable[[np.ndarray], np.ndarray]

    def transform(self, df: DataFrame) -> DataFrame:
        score = self.score

        def run(x: pd.Series) -> pd.Series:
            return pd.Series(score(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

        run.__annotations__ = {"x": pd.Series, "return": pd.Series}
        found = df.withColumn("_score", F.pandas_udf(run, "double")(vector_to_array("features")))
        share = 1 / (1 + F.exp(-F.col("_score")))
        columns = {"rawPrediction": array_to_vector(F.array(-F.col("_score"), F.col("_score"))), "probability": array_to_vector(F.array(1 - share, share))}
        return found.withColumns(columns | {"prediction": (F.col("_score") > 0).cast("double")}).drop("_score")


# ---- quantiles --------------------------------------------------------------


def fit_quantile_trees(
    train: DataFrame, label: str, alpha: float, features: str = "features", rounds: int = 100, rate: float = 0.3, depth: int = 5,
    min_rows: int = 20, accuracy: int = 10_000, max_bins: int = 64,
) -> GBTRegressionModel:
    """Boosted quantile regression: trees on the slope of the pinball loss.

    The value of a leaf is the ``alpha`` quantile of the residuals in it, which all
    tasks narrow down together, so a leaf that holds most rows is no single task.
    ``accuracy`` is that of the value to start from. Null labels are left out.
    """
    rows = train.select(features, F.col(label).cast("double").alias("_label")).where(F.col("_label").isNotNull())
    start = rows.agg(F.percentile_approx("_label", alpha, accuracy)).first()[0]
    start = 0.0 if start is None else float(start)

    def steps(columns: dict[str, np.ndarray], score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.where(columns["label"] - score > 0, -alpha, 1 - alpha), np.ones(len(score))

    left = grown.dealt(rows.select(F.col(features).alias("features"), (F.col("_label") - start).alias("label")))
    trees = _grow(left, steps, rounds, depth, rate, Penalty(), min_rows, max_bins, alpha=alpha)
    jvm = train.sparkSession.sparkContext._jvm
    first = trees[0].rootNode()
    values = _values(first)
    trees[0] = _tree(jvm, _Nodes(jvm).revalued(first, [start + v for v in values], [0]), int(trees[0].numFeatures()))
    return regression_ensemble(trees, features)


# ---- squares ----------------------------------------------------------------


def squared_steps(columns: dict[str, np.ndarray], score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the squared loss as Spark's own learner has them: twice the residual, of weight 1."""
    return 2 * (score - columns["label"]), np.ones(len(score))


def squared_sums(rows: np.ndarray, label: np.ndarray, square: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The same, added up over the rows of a cell from the sums of their labels and of the squares of these."""
    return 2 * (rows * score - label), rows.astype(np.float64), 4 * float((rows * score * score - 2 * score * label + square).sum())


def fit_squared_trees(
    train: DataFrame, label: str, features: str = "features", rounds: int = 20, rate: float = 0.1, depth: int = 5, min_rows: int = 1, max_bins: int = 32,
) -> GBTRegressionModel:
    """What Spark's ``GBTRegressor`` learns with the same settings, grown on packed partitions.

    The first tree counts in full, the others by ``rate``. A null label is an error, as it is there.
    """
    value = F.col(label).cast("double")
    none = F.raise_error(F.lit("labels must not be null or NaN")).cast("double")
    rows = train.select(F.col(features).alias("features"), F.when(value.isNull() | F.isnan(value), none).otherwise(value).alias("label"))
    arity = grown.nominal(rows, "features")
    grower = grown.Grower(squared_steps, rounds, depth, rate, Penalty(), min_rows, max_bins, arity, 0.0, SEED, added=squared_sums, first_rate=0.5)
    trees, number = grown.grow(grown.dealt(rows), "features", grower)
    return regression_ensemble(_made(train.sparkSession.sparkContext._jvm, trees, number, arity), features)


# ---- ranking ----------------------------------------------------------------


def _gain(label: Column) -> Column:
    return F.pow(F.lit(2.0), label) - 1


def _discount(rank: Column) -> Column:
    return 1 / F.log2(rank + 1)


def _first(rows: DataFrame, by: list[str], order: list, cut: int, name: str = "_rank") -> DataFrame:
    """The first ``cut`` rows of each key with their rank."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= cut)


def pair_slopes(group: np.ndarray, label: np.ndarray, score: np.ndarray, ideal: np.ndarray, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives by the score, for rows of whole queries that follow each other.

    ``group`` numbers the queries from 0 on, without gaps. Equal scores keep the order of the rows.
    """
    n = len(group)
    order = np.lexsort((np.arange(n), -score, group))
    first = np.searchsorted(group[order], np.arange(group[-1] + 1)) if n else np.zeros(0, int)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n) - first[group[order]]
    size = np.bincount(group)
    gain = 2.0**label - 1
    place = np.where(rank < cut, 1 / np.log2(rank + 2.0), 0.0)
    g, h = np.zeros(n), np.zeros(n)
    for k in range(cut):
        row = np.flatnonzero((size[group] > k) & (ideal > 0))
        head = order[first[group[row]] + k]
        differ = label[row] != label[head]
        row, head = row[differ], head[differ]
        sign = np.where(label[row] > label[head], 1.0, -1.0)
        doubt = 1 / (1 + np.exp(np.clip(sign * (score[row] - score[head]), -500, 500)))
        change = np.abs(gain[row] - gain[head]) * np.abs(place[row] - place[head]) / ideal[row]
        change *= np.where(rank[row] < cut, 0.5, 1.0)  # two rows in first places meet twice
        slope, bend = -sign * change * doubt, change * doubt * (1 - doubt)
        g += np.bincount(row, slope, n) - np.bincount(head, slope, n)
        h += np.bincount(row, bend, n) + np.bincount(head, bend, n)
    return g, h


#: Rows of a query up to which all its pairs are formed at once, with all queries of that size.
PAIRED = 32


def by_size(cut: int):
    """Puts rows in an order in which queries of one size lie as a table, a query in each column; larger ones come last, as they are.

    ``gain`` is that of the row's label as a share of the best its query can have at ``cut``, ``ideal``.
    """

    def best(label: np.ndarray) -> np.ndarray:
        """The most that each column can have."""
        first = -np.sort(-label, axis=0)[:cut]
        return ((2.0**first - 1) / np.log2(np.arange(len(first)) + 2.0)[:, None]).sum(axis=0)

    def run(columns: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        query, label = columns["query"], columns["label"]
        starts = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, dtype=np.int64)
        size = np.diff(np.append(starts, len(query)))
        ideal = np.zeros(len(query))
        order, tables = [np.zeros(0, dtype=np.int64)], []
        for s in np.unique(size[size <= PAIRED]).tolist():
            rows = starts[size == s] + np.arange(s)[:, None]
            ideal[rows] = best(label[rows])
            order.append(rows.ravel())
            tables.append((s, rows.shape[1]))
        for begin, s in zip(starts[size > PAIRED], size[size > PAIRED]):
            ideal[begin : begin + s] = best(label[begin : begin + s, None])
        large = np.repeat(size > PAIRED, size)
        order = np.concatenate([*order, np.flatnonzero(large)])
        gain = np.where(ideal > 0, (2.0**label - 1) / np.where(ideal > 0, ideal, 1.0), 0.0)
        rest = {"query": query[large], "label": label[large], "ideal": ideal[large]}
        return order, {"gain": gain[order], "tables": np.array(tables, dtype=np.int64).reshape(-1, 2), **rest}

    return run


def table_slopes(gain: np.ndarray, score: np.ndarray, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """``pair_slopes`` of queries of one size, a query in each column, by all pairs of rows."""
    size = len(gain)
    rank = np.zeros(gain.shape, dtype=np.int64)
    for i in range(size - 1):
        behind = score[i] >= score[i + 1 :]
        rank[i + 1 :] += behind
        rank[i] += size - 1 - i - behind.sum(axis=0)
    places = np.append(1 / np.log2(np.arange(min(cut, size)) + 2.0), np.zeros(max(0, size - cut)))
    place = places[rank]
    g, h = np.zeros(gain.shape), np.zeros(gain.shape)
    for i in range(size - 1):
        differ = gain[i] - gain[i + 1 :]
        sign = np.sign(differ)
        doubt = score[i] - score[i + 1 :]
        doubt *= sign
        np.clip(doubt, -500, 500, out=doubt)
        np.exp(doubt, out=doubt)
        doubt += 1
        np.reciprocal(doubt, out=doubt)
        differ *= place[i] - place[i + 1 :]
        np.abs(differ, out=differ)
        differ *= doubt  # the slope without its sign
        bend = 1 - doubt
        bend *= differ
        differ *= sign
        g[i] -= differ.sum(axis=0)
        g[i + 1 :] += differ
        h[i] += bend.sum(axis=0)
        h[i + 1 :] += bend
    return g, h


def listwise_steps(cut: int):
    """``listwise_loss`` in the tasks that grow the trees, some thousand rows of whole queries at a time, laid out by ``by_size``."""

    def run(columns: dict[str, np.ndarray], score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        g, h = np.zeros(len(score)), np.zeros(len(score))
        at = 0
        for size, queries in columns["tables"].tolist():
            end = at + size * queries
            gain, now, slope, bend = (x[at:end].reshape(size, queries) for x in (columns["gain"], score, g, h))
            step = max(256, 16_384 // size)
            for low in range(0, queries if size > 1 else 0, step):
                part = slice(low, low + step)
                slope[:, part], bend[:, part] = table_slopes(gain[:, part], now[:, part], cut)
            at = end
        query, before = columns["query"], at
        first = np.append(True, query[1:] != query[:-1]) if len(query) else np.zeros(0, dtype=bool)
        starts, at = np.flatnonzero(first), 0
        while at < len(query):
            next_ = np.searchsorted(starts, at + 50_000)
            end = int(starts[next_]) if next_ < len(starts) else len(query)
            part, place = slice(at, end), slice(before + at, before + end)
            group = np.cumsum(first[part]) - 1
            g[place], h[place] = pair_slopes(group, columns["label"][part], score[place], columns["ideal"][part], cut)
            at = end
        # What has no slope to follow takes no part in a tree.
        return np.where(h > 0, g, 0.0), h

    return run


def listwise_loss(cut: int) -> Loss:
    """Derivatives of NDCG at ``cut`` through pairs of which one stands in the first ``cut`` places.

    A pair with different labels pulls apart by the change of NDCG that swapping
    the two would make, times the logistic loss of their score difference. A row
    meets the rows in the first ``cut`` places of its query only, so a query of n
    rows costs ``cut * n``. Rows of a query follow each other in one partition,
    as ``fit_listwise_ranker`` lays them out, and stay there.
    """

    def run(batches):
        held: pd.DataFrame | None = None
        for query, label, score, ideal in batches:
            rows = pd.DataFrame({"query": query, "label": label, "score": score, "ideal": ideal})
            held = rows if held is None else pd.concat([held, rows], ignore_index=True)
            # The last query may go on in the next batch.
            whole = int((held["query"] != held["query"].iloc[-1]).to_numpy()[::-1].argmax())
            whole = len(held) - whole if whole else 0
            if whole:
                yield slopes(held.iloc[:whole])
                held = held.iloc[whole:].reset_index(drop=True)
        if held is not None and len(held):
            yield slopes(held)

    def slopes(rows: pd.DataFrame) -> pd.DataFrame:
        query = rows["query"].to_numpy()
        group = np.cumsum(np.append(False, query[1:] != query[:-1]))
        g, h = pair_slopes(group, *[rows[c].to_numpy(dtype=np.float64) for c in ("label", "score", "ideal")], cut)
        return pd.DataFrame({"g": g, "h": h})

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    derive = F.pandas_udf(run, "g double, h double")

    def loss(scored: DataFrame) -> DataFrame:
        found = scored.withColumn("_d", derive("_query", "_label", "_score", "_ideal")).where("_d.h > 0")
        return found.select("features", (-F.col("_d.g") / F.col("_d.h")).alias("_target"), F.col("_d.h").alias("_weight"))

    return loss


def dealt_listwise_loss(query: str, label: str, key: str, cut: int) -> Loss:
    """The same for queries that are dealt to several parts.

    Rows lie by (query, ``_part``) and stay there: first places are found per part,
    then per query, and go back to all parts. What a first place gets from all
    rows is added up per part before it is shuffled, and is given to the tree as
    a row of its own: the sums that make splits and leaves are the same.
    """

    def run(scored: DataFrame) -> DataFrame:
        order = [F.desc("_score"), key]
        nearly = _first(scored, [query, "_part"], order, cut)
        first = _first(nearly, [query], order, cut)
        item = F.struct(F.col("_rank").alias("rank"), F.col(key).alias("key"), F.col(label).alias("label"), F.col("_score").alias("score"), F.col("features"))
        heads = first.groupBy(query).agg(F.sort_array(F.collect_list(item), asc=True).alias("_items"), F.max("_parts").alias("_parts"))  # ``cut`` items at most
        bare = F.transform("_items", lambda h: h.dropFields("features"))
        dealt = heads.select(query, bare.alias("_heads"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
        met = scored.drop("_parts").join(dealt, [query, "_part"])
        met = met.withColumn("_rank", F.array_position(F.transform("_heads", lambda h: h["key"]), F.col(key)))  # 0: not among them
        here = F.when(F.col("_rank") > 0, _discount(F.col("_rank").cast("double"))).otherwise(0.0)

        def pair(h: Column) -> Column:
            """(g, h) of the row from one head; the head gets -g and the same h. Pairs of two heads are met twice, so each time by half."""
            better = F.col(label) > h["label"]
            doubt = 1 / (1 + F.exp(F.when(better, 1.0).otherwise(-1.0) * (F.col("_score") - h["score"])))
            change = F.abs(_gain(F.col(label)) - _gain(h["label"])) * F.abs(here - _discount(h["rank"].cast("double"))) / F.col("_ideal")
            share = F.when(F.col("_rank") > 0, 0.5).otherwise(1.0) * change
            none = (F.col(label) == h["label"]) | (h["key"] == F.col(key)) | (F.col("_ideal") <= 0)
            slope = F.when(better, -1.0).otherwise(1.0) * share * doubt
            return F.struct(F.when(none, 0.0).otherwise(slope).alias("g"), F.when(none, 0.0).otherwise(share * doubt * (1 - doubt)).alias("h"))

        met = met.withColumn("_pairs", F.transform("_heads", pair))
        total = lambda f: F.aggregate("_pairs", F.lit(0.0), lambda a, p: a + p[f])
        own = met.select("features", total("g").alias("_g"), total("h").alias("_h"))
        parts = [F.sum(F.get("_pairs", F.lit(i))[f]).alias(f"_{f}{i}") for i in range(cut) for f in ("g", "h")]
        sums = met.groupBy(query).agg(*parts)
        back = heads.join(sums, query).select(
            F.inline(F.transform("_items", lambda x, i: F.struct(
                x["features"].alias("features"),
                (-F.get(F.array(*[f"_g{n}" for n in range(cut)]), i)).alias("_g"),
                F.get(F.array(*[f"_h{n}" for n in range(cut)]), i).alias("_h"),
            )))
        )
        both = own.unionByName(back).where(F.col("_h") > 0)
        return both.select("features", (-F.col("_g") / F.col("_h")).alias("_target"), F.col("_h").alias("_weight"))

    return run


def fit_listwise_ranker(
    train: DataFrame, query: str, label: str, key: str, features: str = "features", rounds: int = 200, rate: float = 0.1, depth: int = 5,
    cut: int = 5, penalty: Penalty = Penalty(l2=1e-3, least_weight=1e-3), min_rows: int = 20, max_bins: int = 64,
) -> GBTRegressionModel:
    """Boosted trees that learn an order within queries; ``prediction`` is the score to sort by.

    ``key`` tells the rows of a query apart and settles equal scores. ``cut`` is
    the largest cut-off that NDCG is wanted at. Rows without a query or a label
    are left out.
    """
    rows = train.select(F.col(features).alias("features"), F.col(query).alias("_query"), F.col(label).cast("double").alias("_label"), F.col(key).alias("_key"))
    rows = rows.where(F.col("_query").isNotNull() & F.col("_label").isNotNull())
    sizes = rows.groupBy("_query").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_QUERY_PART).cast("int").alias("_parts"))
    if (sizes.agg(F.max("_parts")).first()[0] or 0) <= 1:
        of = grown.dealt(rows, "_query").sortWithinPartitions("_query", "_key")
        of = of.select("features", F.xxhash64("_query").alias("query"), F.col("_label").alias("label"))
        return regression_ensemble(_grow(of, listwise_steps(cut), rounds, depth, rate, penalty, min_rows, max_bins, prepare=by_size(cut)), features)
    best = _first(rows, ["_query"], [F.desc("_label"), "_key"], cut)
    ideal = best.groupBy("_query").agg(F.sum(_gain(F.col("_label")) * _discount(F.col("_rank").cast("double"))).alias("_ideal"))
    known = rows.join(sizes.join(ideal, "_query"), "_query").withColumn("_part", F.pmod(F.xxhash64("_key"), F.col("_parts")).cast("int"))
    known = cut_lineage(known)
    # The same bins as above, as numbers: Spark's learner then has the same splits to choose from.
    arity = grown.nominal(known, "features")
    array = vector_to_array("features")
    edges = grown.sampled_edges(known.select(array), arity, max_bins, SEED)
    bin_ = lambda f, e: F.size(F.filter(F.lit(e.tolist()).cast("array<double>"), lambda x: x < array[f])).cast("double")
    binned = array_to_vector(F.array(*[array[f] if f in arity else bin_(f, e) for f, e in enumerate(edges)]))
    known = known.withColumn("features", binned.alias("features", metadata=known.schema["features"].metadata))
    dealt = few_partitions(known, "_query", "_part").sortWithinPartitions("_query", "_part", "_key")
    whole, apart = listwise_loss(cut), dealt_listwise_loss("_query", "_label", "_key", cut)

    def loss(scored: DataFrame) -> DataFrame:
        return whole(scored.where("_parts = 1")).unionByName(apart(scored.where("_parts > 1")))

    jvm = train.sparkSession.sparkContext._jvm
    trees = boost(dealt, loss, rounds, "features", depth, rate, penalty, min_rows, max_bins)
    trees = [_tree(jvm, _Nodes(jvm).unbinned(t.rootNode(), edges, arity), len(edges)) for t in trees]
    return regression_ensemble(trees, features)
