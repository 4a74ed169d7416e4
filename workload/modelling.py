"""Models: training, search, scoring, importances, quantiles, ranking, oversampling.

A fitted model has no SQL counterpart, but what holds for any right model has:
which rows are scored, that scores are probabilities and decisions follow from
them, that importances are sorted shares, that a search keeps to its space.
The queries give such facts next to the keys. ``tests/test_models.py`` checks
that models learn.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators import aggregates, boosting
from touchline.operators import evaluate as V
from touchline.operators import features as X
from touchline.operators import models as M
from touchline.operators import oversample, tuning
from touchline.plans import training
from touchline.session import work_path
from touchline.sources.models import ModelStore
from touchline.sources.tables import staged
from workload import ctes, inputs
from workload.registry import query

LABEL = "converted_user"
CATEGORICAL = ["refr_medium", "mkt_medium", "mkt_source", "device_family", "os_family", "geo_region"]
CONTINUOUS = [*X.ENGAGEMENT, "page_views"]

#: Trees of the propensity model, evaluations of a search, rounds of the grid, of the ranker and of the quantile model.
TREES = 100
TRIALS, ROUNDS = 20, 5
RANKING_ROUNDS, QUANTILE_ROUNDS = 200, 100

_TEST = f"{ctes.HASH_PERCENT.format('domain_userid')} >= 67"


def prospects(spark, sf):
    """The gold table: one row per user seen on the site, few of whom converted."""
    return staged(inputs.gold(spark, sf), "prospects")


def _parts(spark, sf):
    """Training rows with the class weight learned on them, and test rows."""
    train, test = X.hash_split(prospects(spark, sf), "domain_userid", 67)
    return X.with_class_weight(train, LABEL), test


def _fit(train, **params):
    trees = M.boosted_trees(LABEL, weightCol="weight", maxBins=64, **{"maxIter": TREES, "maxDepth": 5, **params})
    return M.propensity_model(train, LABEL, CATEGORICAL, CONTINUOUS, trees)


def _checked(scored):
    """Scores as facts: they are probabilities, and the decision is that for more than one half."""
    score = F.col("propensity_score")
    return scored.withColumns(
        {"is_probability": score.between(0.0, 1.0), "is_decided": F.col("prediction") == (score > 0.5).cast("double")}
    ).drop("propensity_score", "prediction")


@query(f"WITH {ctes.GOLD_CTE} SELECT domain_userid, converted_user, true AS is_probability, true AS is_decided FROM gold WHERE {_TEST}")
def boosted_tree_scores(spark, sf):
    train, test = _parts(spark, sf)
    return _checked(M.score(_fit(train), test, ["domain_userid", LABEL]))


@query(f"WITH {ctes.GOLD_CTE} SELECT domain_userid, true AS is_probability, true AS is_decided, true AS within_budget FROM gold WHERE {_TEST}")
def boosted_trees_with_early_stop(spark, sf):
    train, test = _parts(spark, sf)
    marked = train.withColumn("validation", X.hash_percent(F.col("domain_userid"), "stop") < 25)
    trees = M.boosted_trees_with_stop(LABEL, "validation", maxIter=200, maxDepth=3, maxBins=64)
    model = M.propensity_model(marked, LABEL, CATEGORICAL, CONTINUOUS, trees)
    kept = 1 <= model.stages[-1].getNumTrees <= 200
    return _checked(M.score(model, test, ["domain_userid"])).withColumn("within_budget", F.lit(kept))


def _planted_buyers(spark, sf):
    """Customers with a label that follows from two columns but for a tenth of them, which is turned around."""
    key = F.col("c_custkey")
    taste, chance = X.hash_percent(key, "taste") / 100.0, X.hash_percent(key, "chance")
    buys = (F.col("c_acctbal") / 10_000 + taste) > 0.95
    label = F.when(chance < 10, ~buys).otherwise(buys).cast("int")
    rows = inputs.read(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("balance"), taste.alias("taste"), "c_mktsegment", label.alias("buys"))
    return staged(rows, "planted")


@query(
    "SELECT classifier, true AS is_share, true AS beats_saying_yes FROM "
    "(VALUES ('logistic regression'), ('linear svm'), ('boosted trees'), ('penalised trees')) v(classifier)"
)
def compare_classifiers(spark, sf):
    """F1 on held-out customers against that of saying yes to everybody."""
    train, test = X.hash_split(_planted_buyers(spark, sf), "c_custkey", 67)
    features = M.featurizer(["c_mktsegment"], ["balance", "taste"]).fit(train)
    fit_on, judge_on = X.materialised(boosting.few_partitions(features.transform(train).select("buys", "features"))), features.transform(test)
    naive = V.f_beta(judge_on.withColumn("prediction", F.lit(1.0)), "buys", "prediction").first()[0]
    rows = []
    for name, classifier in {
        "logistic regression": M.logistic("buys"),
        "linear svm": M.linear_svm("buys"),
        "boosted trees": M.boosted_trees("buys", maxIter=20, maxDepth=3),
        "penalised trees": boosting.PenalisedTrees(labelCol="buys", maxIter=20, maxDepth=3, lambda_=1.0),
    }.items():
        f1 = V.f_beta(classifier.fit(fit_on).transform(judge_on), "buys", "prediction").first()[0]
        rows.append((name, bool(0.0 <= f1 <= 1.0), bool(f1 > naive + 0.05)))
    return spark.createDataFrame(rows, "classifier string, is_share boolean, beats_saying_yes boolean")


@query(
    f"SELECT CAST(r + 1 AS INTEGER) AS rank, true AS is_named, true AS is_share, true AS is_sorted, true AS add_up FROM range({len(CATEGORICAL) + len(CONTINUOUS)}) t(r)"
)
def feature_importance(spark, sf):
    train, _ = _parts(spark, sf)
    table = M.feature_importances(_fit(train), train, top=15).collect()  # one row per feature
    shares = [r["importance"] for r in table]
    names = {f"{c}_ix" for c in CATEGORICAL} | {f"{c}_filled" for c in CONTINUOUS}
    adds_up = abs(sum(shares) - 1) < 1e-9
    rows = [
        (i + 1, r["feature"] in names, 0 <= shares[i] <= 1, i == 0 or shares[i] <= shares[i - 1], adds_up) for i, r in enumerate(table)
    ]
    return spark.createDataFrame(rows, "rank int, is_named boolean, is_share boolean, is_sorted boolean, add_up boolean")


@query(f"WITH {ctes.GOLD_CTE} SELECT domain_userid, converted_user, true AS is_class FROM gold WHERE {_TEST}")
def dummy_feature_model(spark, sf):
    train, test = X.hash_split(prospects(spark, sf), "domain_userid", 67)
    features = M.dummy_featurizer(train, ["refr_urlhost", "mkt_medium"], X.ENGAGEMENT)
    model = M.logistic(LABEL).fit(features.transform(train))
    predicted = model.transform(features.transform(test))
    return predicted.select("domain_userid", LABEL, F.col("prediction").isin(0.0, 1.0).alias("is_class"))


def _prepared(spark, sf):
    """Training rows as vectors, with hash-marked folds and validation rows, in as few partitions as their number asks for."""
    train, _ = _parts(spark, sf)
    marked = tuning.with_fold(train, "domain_userid", 5).withColumn("validation", X.hash_percent(F.col("domain_userid"), "validation") >= 67)
    vectors = M.featurizer(CATEGORICAL, CONTINUOUS).fit(train).transform(marked)
    return X.materialised(boosting.few_partitions(staged(vectors.select(LABEL, "weight", "features", "fold", "validation"), "vectors")))


def _within(setting, space):
    """Whether a setting has a value for each range of the space, inside it; whole ones may be cut to the least that is allowed."""
    return set(setting) == set(space) and all(
        abs(r.outer(r.inner(v)) - v) < 1e-9 or (isinstance(v, int) and r.outer(r.low) - 1 <= v <= r.outer(r.high)) for (k, r) in space.items() for v in [setting[k]]
    )


@query(
    f"SELECT CAST(r AS INTEGER) AS trial, true AS in_space, true AS is_share, true AS differs, true AS best_is_best FROM range({TRIALS}) t(r)"
)
def random_hyperparameter_search(spark, sf):
    settings = tuning.draw_settings(TRIALS, seed=55)
    trees = boosting.PenalisedTrees(labelCol=LABEL, weightCol="weight", maxBins=64)
    found = tuning.random_search(trees, _prepared(spark, sf), V.AveragePrecision(labelCol=LABEL), settings)
    best = found.metric == max(m for _, m in found.trials)
    rows = [(i, _within(s, tuning.SPACE), 0.0 <= m <= 1.0, settings.count(s) == 1, best) for i, (s, m) in enumerate(found.trials)]
    return spark.createDataFrame(rows, "trial int, in_space boolean, is_share boolean, differs boolean, best_is_best boolean")


@query(
    f"SELECT CAST(r AS INTEGER) AS trial, true AS in_space, true AS is_logged, true AS resumes, true AS best_is_best FROM range({TRIALS}) t(r)"
)
def sequential_hyperparameter_search(spark, sf):
    """Twenty trials over the whole space with leaf penalties, four at a time, each batch proposed from those before; logged, and gone on with."""
    prepared = _prepared(spark, sf)
    log = tuning.TrialLog(spark, work_path(spark, "trials"))
    trees = boosting.PenalisedTrees(labelCol=LABEL, weightCol="weight", maxBins=64)
    found = tuning.sequential_search(trees, prepared, V.AveragePrecision(labelCol=LABEL), tuning.PENALISED_SPACE, TRIALS, log=log, search="propensity")
    logged = log.read("propensity")
    judged = []  # a search that was finished judges nothing anew
    again = tuning.sequence(lambda s: judged.append(s) or 0.0, tuning.PENALISED_SPACE, TRIALS, log=log, search="propensity")
    best = found.metric == max(m for _, m in found.trials)
    rows = [
        (i, _within(s, tuning.PENALISED_SPACE), logged.get(i) == (s, m), again[i] == (s, m) and not judged, best)
        for i, (s, m) in enumerate(found.trials)
    ]
    return spark.createDataFrame(rows, "trial int, in_space boolean, is_logged boolean, resumes boolean, best_is_best boolean")


def _newton_leaves(model, rows, penalty):
    """Whether the first tree's leaves are what the rows in them ask for, computed anew from the rows."""
    # One row per leaf.
    leaf = vector_to_array(F.col("_leaves"))[0].cast("int").alias("leaf")
    half = F.col(LABEL).cast("double") - 0.5  # the first round starts at a score of 0
    sums = model.setLeafCol("_leaves").transform(rows).groupBy(leaf).agg(F.sum(-half * F.col("weight")).alias("g"), F.sum(0.25 * F.col("weight")).alias("h"))
    wanted = {r["leaf"]: 0.3 * penalty.value(r["g"], r["h"]) for r in sums.collect()}
    values = boosting.leaf_values(model)[0]
    return set(wanted) == set(range(len(values))) and all(abs(values[i] - v) < 1e-6 * max(1.0, abs(v)) for i, v in wanted.items())


@query(
    f"WITH {ctes.GOLD_CTE} SELECT domain_userid, converted_user, true AS is_probability, true AS is_decided, "
    f"true AS plain_leaves_fit, true AS penalised_leaves_fit, true AS penalties_shrink FROM gold WHERE {_TEST}"
)
def penalised_tree_scores(spark, sf):
    """Scores of boosted trees with leaf penalties; their leaves, and those without penalties, against sums over the rows."""
    train, test = _parts(spark, sf)
    features = M.featurizer(CATEGORICAL, CONTINUOUS).fit(train)
    rows = X.materialised(features.transform(train).select(LABEL, "weight", "features"))
    make = lambda **penalties: boosting.PenalisedTrees(labelCol=LABEL, weightCol="weight", maxIter=TREES, **penalties).fit(rows)
    plain, shrunk = make(), make(alpha=0.3, lambda_=5.0)
    fits = _newton_leaves(plain, rows, boosting.Penalty()), _newton_leaves(shrunk, rows, boosting.Penalty(0.3, 5.0))
    most = [max(abs(v) for v in boosting.leaf_values(m)[0]) for m in (plain, shrunk)]
    scored = _checked(M.score(PipelineModel(stages=[*features.stages, shrunk]), test, ["domain_userid", LABEL]))
    return scored.withColumns(
        {"plain_leaves_fit": F.lit(fits[0]), "penalised_leaves_fit": F.lit(fits[1]), "penalties_shrink": F.lit(most[1] < most[0])}
    )


@query(
    "SELECT CAST(d AS DOUBLE) AS max_depth, CAST(s AS DOUBLE) AS step_size, true AS is_share "
    "FROM (VALUES (2), (4), (8)) a(d), (VALUES (0.1), (0.01), (0.001)) b(s)"
)
def grid_search_cross_validated(spark, sf):
    trees = M.boosted_trees(LABEL, weightCol="weight", maxIter=ROUNDS, maxBins=64)
    fitted = tuning.grid_search(trees, _prepared(spark, sf), LABEL, tuning.GRID, folds=5)
    rows = [
        (*[float(v) for _, v in sorted((p.name, v) for p, v in point.items())], bool(0.0 <= m <= 1.0))
        for point, m in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics)
    ]
    return spark.createDataFrame(rows, "max_depth double, step_size double, is_share boolean")


@query(f"WITH {ctes.GOLD_CTE} SELECT domain_userid, true AS is_probability, true AS label_fits FROM gold")
def train_register_and_score(spark, sf):
    store = ModelStore(spark, work_path(spark, "store"))
    table = prospects(spark, sf)
    training.train_and_register(table, store, "propensity", categorical=CATEGORICAL, continuous=CONTINUOUS, evaluations=TRIALS)
    scored = training.score_and_label(table, store, "propensity")
    wanted = F.when(F.col("propensity_decile") <= 7, "Low").when(F.col("propensity_decile") <= 8, "Medium").otherwise("High")
    return scored.select(
        "domain_userid",
        F.col("propensity_score").between(0.0, 1.0).alias("is_probability"),
        (F.col("propensity_label") == wanted).alias("label_fits"),
    )


@query("SELECT * FROM (VALUES (CAST(1 AS INTEGER), 'Archived', true, true), (2, 'Production', true, true)) v(version, stage, is_logged, differs)")
def model_versions_and_runs(spark, sf):
    """Two different fits, each registered and logged with its own setting and measured metric."""
    store = ModelStore(spark, work_path(spark, "store"))
    train, test = _parts(spark, sf)
    contract = X.input_contract(train, [*CATEGORICAL, *CONTINUOUS])
    texts = []
    for ridge in (0.0, 0.5):
        model = M.propensity_model(train, LABEL, CATEGORICAL, CONTINUOUS, M.logistic(LABEL, weightCol="weight", regParam=ridge))
        judged = M.score(model, test.unionByName(train.drop("weight")), [LABEL])
        metrics = {"average_precision": V.average_precision(judged, LABEL, "propensity_score").first()[0] or 0.0}
        version = store.register("propensity", model, contract, metrics)
        store.promote("propensity", version)
        store.log_run("logistic", {"ridge": ridge, "version": version}, metrics)
        texts.append(json.dumps([float(v) for v in model.stages[-1].coefficients]))
    runs = store.runs().groupBy("run_id").agg(
        F.max(F.when(F.col("key") == "version", F.col("value"))).cast("int").alias("version"),
        F.max(F.when(F.col("key") == "average_precision", F.col("value"))).cast("double").alias("logged"),
    )
    both = store.versions("propensity").join(runs, "version")
    return both.select("version", "stage", (F.col("metrics")["average_precision"] == F.col("logged")).alias("is_logged"), F.lit(texts[0] != texts[1]).alias("differs"))


@query(f"WITH {ctes.GOLD_CTE} SELECT domain_userid, true AS same_as_before_saving FROM gold")
def score_saved_model(spark, sf):
    store = ModelStore(spark, work_path(spark, "store"))
    table = prospects(spark, sf)
    train, _ = X.hash_split(table, "domain_userid", 67)
    model = M.propensity_model(train, LABEL, CATEGORICAL, CONTINUOUS, M.logistic(LABEL))
    store.promote("saved", store.register("saved", model, X.input_contract(table, [*CATEGORICAL, *CONTINUOUS])))
    saved = training.score_users(table, store, "saved").toDF("domain_userid", "_score", "_prediction")
    both = M.score(model, table, ["domain_userid"]).join(saved, "domain_userid")
    same = (F.col("_score") == F.col("propensity_score")) & (F.col("_prediction") == F.col("prediction"))
    return both.select("domain_userid", same.alias("same_as_before_saving"))


def _oversampled(spark, sf):
    train, _ = _parts(spark, sf)
    filled = X.FillCategories(columns=CATEGORICAL).transform(train).na.fill(0.0, CONTINUOUS)
    cut = staged(X.TopKCategories(columns=CATEGORICAL, k=50).fit(filled).transform(filled), "filled")
    return cut, staged(oversample.smote_nc(cut, "domain_userid", LABEL, CONTINUOUS, CATEGORICAL), "oversampled")


@query(
    f"WITH {ctes.GOLD_CTE}, t AS (SELECT domain_userid, converted_user FROM gold WHERE NOT ({_TEST})), "
    "s AS (SELECT count(*) FILTER (converted_user = 1) AS few, count(*) FILTER (converted_user = 0) AS many FROM t), "
    "r AS (SELECT domain_userid, row_number() OVER (ORDER BY md5(domain_userid), domain_userid) AS place FROM t WHERE converted_user = 1), "
    "n AS (SELECT domain_userid AS source, (many - few) // few + CASE WHEN place <= (many - few) % few THEN 1 ELSE 0 END AS times "
    "FROM r, s WHERE few >= 2 AND many > few) "
    "SELECT source, i AS number, true AS starts_at_source, true AS lies_among_positives, true AS categories_exist "
    "FROM n, unnest(generate_series(1, times)) u(i)"
)
def oversample_minority(spark, sf):
    """Every synthetic row against its source: its key, a place between positives, and categories that positives have."""
    cut, made = _oversampled(spark, sf)
    positives = cut.where(F.col(LABEL) == 1)
    edges = positives.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in CONTINUOUS])
    known = positives.agg(*[F.collect_set(F.col(c).cast("string")).alias(f"_{c}") for c in CATEGORICAL])  # 50 values at most
    bounds, values = edges.first(), known.first()
    fake = made.where("domain_userid LIKE '%~%'").withColumn("source", F.substring_index("domain_userid", "~", 1))
    real = positives.select(F.col("domain_userid").alias("source"), F.lit(True).alias("_there"))
    among, exist = F.lit(True), F.lit(True)
    for c in CONTINUOUS:
        among = among & F.col(c).between(bounds[c]["lo"] or 0.0, bounds[c]["hi"] or 0.0)
    for c in CATEGORICAL:
        exist = exist & F.col(c).isin(values[f"_{c}"] or [""])
    return fake.join(real, "source", "left").select(
        "source",
        F.substring_index("domain_userid", "~", -1).cast("bigint").alias("number"),
        F.coalesce("_there", F.lit(False)).alias("starts_at_source"),
        among.alias("lies_among_positives"),
        exist.alias("categories_exist"),
    )


@query(
    f"WITH {ctes.GOLD_CTE}, c AS (SELECT converted_user, count(*) AS n FROM gold WHERE NOT ({_TEST}) GROUP BY 1) "
    "SELECT converted_user, CASE WHEN min(CASE WHEN converted_user = 1 THEN n END) OVER () >= 2 THEN max(n) OVER () ELSE n END AS count FROM c"
)
def class_sizes_after_oversampling(spark, sf):
    return aggregates.class_counts(_oversampled(spark, sf)[1], LABEL)


@query(
    "SELECT l_orderkey, l_linenumber, true AS covers_a_fifth, true AS beats_one_tree "
    f"FROM lineitem WHERE {ctes.HASH_PERCENT.format('l_orderkey')} >= 85"
)
def quantile_regression(spark, sf):
    """The lower fifth of a planted value: a sum of three columns and a lopsided noise. Held-out rows say how well it is met."""
    inputs_ = ["l_quantity", "l_discount", "l_tax"]
    noise = -F.log(1 - (X.hash_percent(F.concat_ws(":", "l_orderkey", "l_linenumber"), "noise") + 0.5) / 100)
    value = 2.0 * F.col("l_quantity") + 400.0 * F.col("l_discount") + 400.0 * F.col("l_tax") + 5.0 * noise
    lines = inputs.read(spark, sf, "lineitem").withColumns({c: F.col(c).cast("double") for c in inputs_}).withColumn("value", value)
    lines = staged(lines.select("l_orderkey", "l_linenumber", *inputs_, "value"), "lines")
    train, test = X.hash_split(VectorAssembler(inputCols=inputs_, outputCol="features").transform(lines), "l_orderkey", 85)
    boosted = boosting.fit_quantile_trees(train, "value", alpha=0.2, rounds=QUANTILE_ROUNDS)
    single = M.fit_quantile(train.drop("features"), "value", inputs_, alpha=0.2)
    met = V.pinball_loss(boosted.transform(test), "value", "prediction", 0.2).first()
    plain = V.pinball_loss(single.transform(test.drop("features")), "value", "prediction", 0.2).first()
    covers = abs(met["coverage"] - 0.2) < 0.02 + 0.8 / math.sqrt(max(test.count(), 1))  # two standard errors of a share beside the 0.02
    better = met["pinball_loss"] < 0.9 * plain["pinball_loss"]
    return test.select("l_orderkey", "l_linenumber", F.lit(covers).alias("covers_a_fifth"), F.lit(better).alias("beats_one_tree"))


def _graded(spark, sf):
    """Lines with a planted grade: orders differ more than their lines do, and within an order the lower ``level`` is the better one.

    Across orders the level rises with the grade, so a model of single rows learns the wrong order.
    """
    order = X.hash_percent(F.col("l_orderkey"), "order") * 3 / 100.0
    line = X.hash_percent(F.concat_ws(":", "l_orderkey", "l_linenumber"), "line") / 100.0
    columns = ["level", "l_quantity", "l_discount", "l_tax"]
    lines = inputs.read(spark, sf, "lineitem").withColumns(
        {"level": order + line, "labels": (F.floor(order) + (line < 0.5).cast("int")).cast("double"), **{c: F.col(c).cast("double") for c in columns[1:]}}
    )
    return staged(VectorAssembler(inputCols=columns, outputCol="features").transform(lines).select("l_orderkey", "l_linenumber", "labels", "features"), "graded")


_rankers: dict[tuple[str, str], tuple] = {}


def _ranker(spark, sf):
    """(graded lines, the ranker fitted on four fifths of the orders), fitted once per session and scale."""
    graded = _graded(spark, sf)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _rankers:
        train, _ = X.hash_split(graded, "l_orderkey", 80)
        _rankers[key] = boosting.fit_listwise_ranker(train, "l_orderkey", "labels", "l_linenumber", rounds=RANKING_ROUNDS)
    return graded, _rankers[key]


@query(
    f"WITH t AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE {ctes.HASH_PERCENT.format('l_orderkey')} >= 80 GROUP BY 1) "
    "SELECT l_orderkey, CAST(r AS INTEGER) AS rank, true AS is_ordered, true AS above_pointwise_at_1, true AS above_pointwise_at_3, "
    "true AS above_pointwise_at_5 FROM t, unnest(generate_series(1, least(n, 5))) u(r)"
)
def rank_within_queries(spark, sf):
    """The best five lines of each held-out order, and whether the mean NDCG there is above that of a model of single rows."""
    graded, ranker = _ranker(spark, sf)
    train, test = X.hash_split(graded, "l_orderkey", 80)
    scored = staged(ranker.setPredictionCol("preds").transform(test).select("l_orderkey", "l_linenumber", "labels", "preds"), "ranked")
    single = M.fit_ranker(train, "labels", maxIter=RANKING_ROUNDS, maxDepth=5)
    mine = V.ndcg(scored, "l_orderkey", "labels", "preds", "l_linenumber").first()
    other = V.ndcg(single.transform(test), "l_orderkey", "labels", "preds", "l_linenumber").first()
    above = {f"above_pointwise_at_{k}": F.lit(mine[f"ndcg_at_{k}"] > other[f"ndcg_at_{k}"] + 0.05) for k in (1, 3, 5)}
    best = M.best_per_query(scored, "l_orderkey", "preds", "l_linenumber", 5)
    before = F.lag("preds").over(Window.partitionBy("l_orderkey").orderBy("rank"))
    return best.select("l_orderkey", "rank", F.coalesce(before >= F.col("preds"), F.lit(True)).alias("is_ordered")).withColumns(above)


@query("SELECT l_orderkey, l_linenumber, true AS one_leaf_a_tree, true AS leaves_give_the_score FROM lineitem")
def leaf_indexes(spark, sf):
    """The ranker's leaf of each tree; the values of these leaves add up to the score."""
    graded, ranker = _ranker(spark, sf)
    values = boosting.leaf_values(ranker)
    # Trees times leaves numbers, as constants.
    first = F.lit([0, *itertools.accumulate(len(v) for v in values)]).cast("array<int>")
    flat = F.lit([x for v in values for x in v]).cast("array<double>")
    found = ranker.setPredictionCol("preds").setLeafCol("leaf_preds").transform(graded).withColumn("leaves", vector_to_array(F.col("leaf_preds")))
    numbers = F.transform("leaves", lambda x, i: F.get(first, i) + x.cast("int"))
    total = F.aggregate(numbers, F.lit(0.0), lambda a, i: a + F.get(flat, i))
    return found.select(
        "l_orderkey",
        "l_linenumber",
        (F.size("leaves") == len(values)).alias("one_leaf_a_tree"),
        (F.abs(total - F.col("preds")) < 1e-6).alias("leaves_give_the_score"),
    )
