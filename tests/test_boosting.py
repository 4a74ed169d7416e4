import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from touchline.operators import boosting as B
from touchline.operators import evaluate as V
from touchline.operators import models as M
from touchline.operators import tuning as U
from touchline.session import work_path
from touchline.sources.tables import staged


def vectors(spark, pdf, inputs):
    return staged(VectorAssembler(inputCols=inputs, outputCol="features").transform(spark.createDataFrame(pdf)), "vectors")


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    n = 1500
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1])))).astype(int)
    return vectors(spark, pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y, "weight": np.where(y == 1, 2.0, 1.0)}), ["a", "b", "c"])


def newton(model, data, penalty, rate, weight=None):
    """Leaf values of the first two trees, from the rows."""
    found = model.setLeafCol("leaves").transform(data).select("label", "weight", vector_to_array("leaves").alias("leaves")).collect()
    score = np.zeros(len(found))
    y = np.array([r.label for r in found])
    w = np.array([r.weight for r in found]) if weight else np.ones(len(found))
    for tree in range(2):
        leaf = np.array([int(r.leaves[tree]) for r in found])
        p = 1 / (1 + np.exp(-score))
        g, h = w * (p - y), w * p * (1 - p)
        wanted = {i: rate * penalty.value(g[leaf == i].sum(), h[leaf == i].sum()) for i in np.unique(leaf)}
        yield B.leaf_values(model)[tree], wanted
        score = score + np.array([wanted[i] for i in leaf])


@pytest.mark.parametrize("penalty, weight", [(B.Penalty(), None), (B.Penalty(l1=3.0, l2=10.0), "weight")])
def test_leaves_are_newton_steps(labelled, penalty, weight):
    trees = B.PenalisedTrees(weightCol=weight or "", maxIter=3, maxDepth=3, alpha=penalty.l1, lambda_=penalty.l2)
    model = trees.fit(labelled)
    for values, wanted in newton(model, labelled, penalty, 0.3, weight):
        assert set(wanted) == set(range(len(values)))
        assert all(values[i] == pytest.approx(v, abs=1e-6) for i, v in wanted.items())


def test_penalties_shrink_and_prune(labelled):
    fit = lambda **k: B.leaf_values(B.PenalisedTrees(maxIter=2, maxDepth=4, **k).fit(labelled))
    plain = fit()
    largest = lambda leaves: max(abs(v) for v in leaves[0])
    assert largest(fit(lambda_=50.0)) < largest(plain) and largest(fit(alpha=20.0)) < largest(plain)
    sizes = [len(fit(gamma=g)[0]) for g in (0.0, 5.0, 40.0, 1e9)]
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3] == 1
    assert len(fit(minChildWeight=100.0)[0]) < len(plain[0])


def test_a_kept_split_gains_enough(labelled):
    """No pair of leaves that hang on one node gains less than asked for."""
    model = B.PenalisedTrees(maxIter=1, maxDepth=4, gamma=6.0, lambda_=1.0).fit(labelled)
    penalty = B.Penalty(l2=1.0, least_gain=6.0)

    def walk(node):
        if node.subtreeDepth() == 0:
            return 0
        left, right = node.leftChild(), node.rightChild()
        if left.subtreeDepth() == right.subtreeDepth() == 0:
            assert penalty.keeps(B._sums(left), B._sums(right))
            return 1
        return walk(left) + walk(right)

    assert walk(model.trees[0]._call_java("rootNode")) > 0


def test_penalised_trees_learn_and_are_saved(labelled, tmp_path):
    from pyspark.ml import PipelineModel

    model = B.PenalisedTrees(maxIter=15, maxDepth=3, lambda_=1.0).fit(labelled)
    scored = model.transform(labelled).select("label", vector_to_array("probability")[1].alias("s"), "prediction")
    assert V.area_under_roc(scored, "label", "s").first()[0] > 0.85
    PipelineModel(stages=[model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(labelled)
    assert rows(again.select("prediction")) == rows(scored.select("prediction"))
    assert model.featureImportances[0] > model.featureImportances[2]


def test_rounds_end_when_nothing_is_left(spark):
    pdf = pd.DataFrame({"a": [1.0] * 40, "label": [0, 1] * 20})
    assert len(B.PenalisedTrees(maxIter=50).fit(vectors(spark, pdf, ["a"])).trees) == 1


def test_boosted_quantile_beats_one_tree(spark):
    rng = np.random.default_rng(5)
    n = 12_000
    x = rng.random((n, 3))
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": 10 * x[:, 0] + 8 * x[:, 1] + 6 * x[:, 2] + rng.exponential(size=n)})
    data = vectors(spark, pdf, ["a", "b", "c"]).withColumn("held", F.col("a") * 1000 % 1 < 0.3)
    train, test = data.where("NOT held"), data.where("held")
    boosted = V.pinball_loss(B.fit_quantile_trees(train, "y", 0.2, rounds=30, rate=0.2, min_rows=100).transform(test), "y", "prediction", 0.2).first()
    single = M.fit_quantile(train.drop("features"), "y", ["a", "b", "c"], 0.2)
    plain = V.pinball_loss(single.transform(test.drop("features")), "y", "prediction", 0.2).first()
    assert abs(boosted["coverage"] - 0.2) < 0.03 and boosted["pinball_loss"] < 0.9 * plain["pinball_loss"]


# ---- ranking ------------------------------------------------------------------


def brute_slopes(label, score, ideal, cut):
    """Derivatives of one query by all pairs with a member in the first places."""
    n = len(label)
    order = sorted(range(n), key=lambda i: (-score[i], i))
    rank = {i: r for r, i in enumerate(order)}
    place = lambda i: 1 / math.log2(rank[i] + 2) if rank[i] < cut else 0.0
    g, h = np.zeros(n), np.zeros(n)
    for i in range(n):
        for j in range(n):
            if label[i] > label[j] and min(rank[i], rank[j]) < cut and ideal > 0:
                change = (2 ** label[i] - 2 ** label[j]) * abs(place(i) - place(j)) / ideal
                doubt = 1 / (1 + math.exp(score[i] - score[j]))
                g[i] -= change * doubt
                g[j] += change * doubt
                h[[i, j]] += change * doubt * (1 - doubt)
    return g, h


def test_slopes_equal_all_pairs():
    rng = np.random.default_rng(1)
    sizes = [1, 2, 7, 12, 5]
    group = np.repeat(np.arange(5), sizes)
    label, score = rng.integers(0, 4, 27).astype(float), np.round(rng.normal(size=27), 1)
    ideal = np.array([3.0, 0.0, 9.5, 20.0, 4.0])[group]
    g, h = B.pair_slopes(group, label, score, ideal, 3)
    for q in range(5):
        at = group == q
        wg, wh = brute_slopes(label[at], score[at], ideal[at][0], 3)
        assert np.allclose(g[at], wg) and np.allclose(h[at], wh)


def simpson(rng, queries):
    """Between queries the feature rises with the grade, within them the lower one is better."""
    level, line = rng.random(queries).repeat(6) * 3, rng.random(queries * 6)
    return pd.DataFrame(
        {"q": np.arange(queries).repeat(6), "id": np.tile(np.arange(6), queries), "x": level + line, "z": rng.random(queries * 6), "labels": np.floor(level) + (line < 0.5)}
    )


def test_a_query_dealt_to_parts_gives_the_same_sums(spark, monkeypatch):
    monkeypatch.setattr(B, "ROWS_PER_QUERY_PART", 5)
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"_query": [1] * 23, "_key": np.arange(23), "_label": rng.integers(0, 4, 23).astype(float), "_score": np.round(rng.normal(size=23), 1), "x": np.arange(23.0)})
    data = vectors(spark, pdf, ["x"]).withColumns({"_parts": F.lit(5), "_part": (F.col("_key") % 5).cast("int"), "_ideal": F.lit(12.0)})
    graded = B.dealt_listwise_loss("_query", "_label", "_key", 4)(data)
    got = graded.groupBy(vector_to_array("features")[0].alias("x")).agg(F.sum(-F.col("_target") * F.col("_weight")).alias("g"), F.sum("_weight").alias("h"))
    found = {int(r.x): (r.g, r.h) for r in got.collect()}
    g, h = brute_slopes(pdf["_label"].to_numpy(), pdf["_score"].to_numpy(), 12.0, 4)
    assert all(found.get(i, (0, 0)) == (pytest.approx(g[i], abs=1e-9), pytest.approx(h[i], abs=1e-9)) for i in range(23))


def test_listwise_beats_pointwise(spark, monkeypatch):
    rng = np.random.default_rng(4)
    data = vectors(spark, simpson(rng, 300), ["x", "z"])
    train, test = data.where("q % 3 > 0"), data.where("q % 3 = 0")
    ranker = B.fit_listwise_ranker(train, "q", "labels", "id", rounds=12, depth=4)
    mine = V.ndcg(ranker.transform(test), "q", "labels", "prediction", "id").first()
    other = V.ndcg(M.fit_ranker(train, "labels", maxIter=12, maxDepth=4).transform(test), "q", "labels", "preds", "id").first()
    assert all(mine[k] > other[k] + 0.05 for k in ("ndcg_at_1", "ndcg_at_3", "ndcg_at_5"))
    # Queries in parts: the same model up to rounding, so the same order.
    monkeypatch.setattr(B, "ROWS_PER_QUERY_PART", 4)
    few = train.where("q < 60")
    apart = B.fit_listwise_ranker(few, "q", "labels", "id", rounds=2, depth=3, min_rows=1)
    monkeypatch.undo()
    whole = B.fit_listwise_ranker(few, "q", "labels", "id", rounds=2, depth=3, min_rows=1)
    pair = [np.array([r[0] for r in m.transform(few).orderBy("q", "id").select("prediction").collect()]) for m in (apart, whole)]
    assert np.corrcoef(*pair)[0, 1] > 0.99


def test_rounds_past_a_fold(spark):
    data = vectors(spark, simpson(np.random.default_rng(6), 60), ["x", "z"])
    ranker = B.fit_listwise_ranker(data, "q", "labels", "id", rounds=B.FOLD_EVERY + 3, depth=2)
    assert len(ranker.trees) == B.FOLD_EVERY + 3
    values = B.leaf_values(ranker)
    scored = ranker.setLeafCol("l").transform(data).select("prediction", vector_to_array("l").alias("l")).collect()
    assert all(r.prediction == pytest.approx(sum(values[t][int(x)] for t, x in enumerate(r.l)), abs=1e-9) for r in scored)


# ---- search -------------------------------------------------------------------


def planted(s):
    return -(((s["maxDepth"] - 6) / 6) ** 2) - ((math.log(s["stepSize"]) + 1) / 3) ** 2 - ((s["gamma"] - 4) / 5) ** 2 - ((math.log(s["alpha"]) + 2) / 4) ** 2


def test_sequence_beats_random_draws():
    drawn = [max(map(planted, U.draw_settings(20, seed, U.PENALISED_SPACE))) for seed in range(10)]
    learned = [max(m for _, m in U.sequence(planted, U.PENALISED_SPACE, 20, seed=seed)) for seed in range(10)]
    assert statistics.mean(learned) > statistics.mean(drawn) and sum(a > b for a, b in zip(learned, drawn)) >= 7


def test_proposals_keep_to_the_space():
    for setting, _ in U.sequence(planted, U.PENALISED_SPACE, 40, seed=3):
        assert 2 <= setting["maxDepth"] <= 8 and 50 <= setting["maxIter"] <= 200 and 0 <= setting["minChildWeight"] <= 20
        assert math.exp(-3) <= setting["stepSize"] <= 1 and 0 <= setting["gamma"] <= 5 and math.exp(-6) <= setting["lambda_"] <= math.exp(-1)
    smaller = U.sequence(lambda s: -planted(s), U.PENALISED_SPACE, 20, seed=1, larger=False)
    assert smaller == [(s, -m) for s, m in U.sequence(planted, U.PENALISED_SPACE, 20, seed=1)]


def test_a_search_goes_on_where_it_stopped(spark):
    log = U.TrialLog(spark, work_path(spark, "trials"))
    whole = U.sequence(planted, U.PENALISED_SPACE, 12, seed=9)
    judged = []

    def stops(setting):
        if len(judged) == 6:
            raise RuntimeError("lost")
        judged.append(setting)
        return planted(setting)

    with pytest.raises(RuntimeError):
        U.sequence(stops, U.PENALISED_SPACE, 12, parallelism=4, seed=9, log=log, search="a")
    done = len(log.read("a"))
    assert 4 <= done <= 6
    later = []
    again = U.sequence(lambda s: later.append(s) or planted(s), U.PENALISED_SPACE, 12, seed=9, log=log, search="a")
    assert again == whole and len(later) == 12 - done and len(log.read("a")) == 12 and log.read("b") == {}


def test_sequential_search_fits_the_best(labelled):
    marked = staged(labelled.withColumn("validation", F.col("c") > 0.4), "marked")
    space = U.PENALISED_SPACE | {"maxIter": U.whole_step(1, 3), "maxDepth": U.whole_step(2, 3)}
    found = U.sequential_search(B.PenalisedTrees(weightCol="weight"), marked, V.AveragePrecision(labelCol="label"), space, evaluations=4, seed=random.Random(1).randrange(99))
    assert found.metric == max(m for _, m in found.trials) and found.best in [s for s, _ in found.trials] and found.metric > 0.6


# ---- trees on packed partitions -------------------------------------------------


def test_partitions_grow_the_trees_of_one(spark, monkeypatch):
    """Dealt to several partitions, with categories and a weight, the same trees up to rounding; and no learner run per round."""
    from touchline.operators import grown as G

    rng = np.random.default_rng(8)
    n = 900
    pdf = pd.DataFrame({"a": rng.normal(size=n).round(2), "kind": rng.choice(list("pqrs"), n), "weight": 1.0 + rng.integers(0, 2, n)})
    pdf["label"] = ((pdf["a"] > 0) ^ pdf["kind"].isin(["q", "s"])).astype(int)
    data = spark.createDataFrame(pdf)
    data = staged(M.featurizer(["kind"], ["a"]).fit(data).transform(data), "kinds")
    assert 4 <= max(G.nominal(data, "features").values()) <= 5
    monkeypatch.setattr(B, "boost", None)
    fit = lambda: B.PenalisedTrees(weightCol="weight", maxIter=12, maxDepth=3, lambda_=1.0).fit(data)
    one = fit()
    monkeypatch.setattr(G, "LEAST_ROWS", 300)
    several = fit()
    assert [pytest.approx(v, abs=1e-9) for v in B.leaf_values(several)] == B.leaf_values(one)
    right = one.transform(data).where("prediction = label").count()
    assert right > 0.95 * n


def test_leaf_quantiles_are_exact():
    from touchline.operators import grown as G

    rng = np.random.default_rng(9)
    parts = [(rng.choice([rng.exponential(), 5.0, -1e6, rng.normal()], k) + rng.normal(size=k).round(3), rng.integers(0, 6, k)) for k in (4000, 700, 0)]
    value, leaf = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    for alpha in (0.01, 0.2, 0.5, 0.99):
        got = G.quantiles(lambda look: [look(*p) for p in parts], 7, alpha)
        want = [np.sort(value[leaf == i])[math.ceil(alpha * (leaf == i).sum()) - 1] for i in range(6)]
        assert got.tolist() == [*want, 0.0]


def test_random_search_over_the_space_grows_on_packed_rows(spark, labelled):
    """All settings of the space without a job for each level; a node has the rows that the setting asks for."""
    marked = staged(labelled.withColumn("validation", F.col("c") > 0.4), "marked")
    settings = [s | {"maxIter": 4} for s in U.draw_settings(3, 7)] + [{"maxDepth": 4, "stepSize": 0.3, "gamma": 0.0, "minInstancesPerNode": 300, "maxIter": 2}]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("packed", "packed")
    trees = B.PenalisedTrees(weightCol="weight")
    params = {trees.getParam(k): v for k, v in settings[-1].items()}
    model = trees.fit(labelled, params)
    few = len(jobs.getJobIdsForGroup("packed"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < few < 10
    held = model.setLeafCol("leaves").transform(labelled).select(vector_to_array("leaves")[0].alias("leaf")).groupBy("leaf").count().collect()
    assert len(held) > 1 and min(r["count"] for r in held) >= 300
    same = lambda m: m.transform(labelled).select("a", "b", vector_to_array("probability")[1].alias("p"), "prediction").orderBy("a", "b").collect()
    for mine, theirs in zip(same(trees.fit_for_trial(labelled, params)), same(model)):
        assert mine.p == pytest.approx(theirs.p, abs=1e-12) and mine.prediction == theirs.prediction
    found = U.random_search(trees, marked, V.AveragePrecision(labelCol="label"), settings)
    assert [s for s, _ in found.trials] == settings and found.metric == max(m for _, m in found.trials) > 0.6


def test_fits_at_the_same_time_keep_caches_of_their_own(spark, labelled, monkeypatch):
    from touchline.operators import grown as G

    kept = []
    grow = G.sampled_edges
    monkeypatch.setattr(G, "sampled_edges", lambda arrays, *more: kept.append(arrays) or grow(arrays, *more))
    one = staged(labelled, "one")
    for _ in range(2):
        B.PenalisedTrees(maxIter=1, maxDepth=1).fit_for_trial(one)
    assert not kept[0].sameSemantics(kept[1])


def test_rows_of_a_cell_grow_the_trees_of_their_rows(spark, monkeypatch):
    """Cells, partitions and the one task of few rows: the same trees for ranks, quantiles and squares; a round asks for no row more than once."""
    from touchline.operators import grown as G

    rng = np.random.default_rng(11)
    n = 1200
    sizes = np.append(rng.integers(1, 9, 400).clip(1), [40, 35])
    q = np.arange(len(sizes)).repeat(sizes)[:n]
    pdf = pd.DataFrame({"q": q, "id": np.arange(len(q)), "x": rng.integers(0, 9, len(q)) / 4.0, "z": rng.integers(0, 5, len(q)) * 1.0})
    pdf["labels"] = np.floor(pdf["x"] + rng.random(len(q)))
    pdf["y"] = pdf["x"] * 3 + pdf["z"] + rng.exponential(size=len(q)).round(2)
    data = vectors(spark, pdf, ["x", "z"])

    def fits():
        ranker = B.fit_listwise_ranker(data, "q", "labels", "id", rounds=4, depth=3, min_rows=5)
        return [B.leaf_values(m) for m in (ranker, B.fit_quantile_trees(data, "y", 0.3, rounds=4, depth=3), B.fit_squared_trees(data, "labels", rounds=4, depth=3))]

    near = lambda models: [[pytest.approx(v, abs=1e-9) for v in m] for m in models]
    one = fits()
    monkeypatch.setattr(G, "LEAST_ROWS", 300)
    levels = []
    histogram = G._rounds
    monkeypatch.setattr(G, "_rounds", lambda *a: levels.append(1) or histogram(*a))
    assert near(fits()) == one and not levels
    monkeypatch.setattr(G, "MOST_CELLS", 3)
    assert near(fits()) == one and len(levels) == 3


def test_squares_are_those_of_sparks_learner(spark):
    from pyspark.ml.regression import GBTRegressor

    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"x": rng.integers(0, 12, 900) * 1.0, "z": rng.integers(0, 7, 900) * 1.0})
    pdf["y"] = np.sin(pdf["x"]) + pdf["z"] ** 2 / 9 + rng.normal(size=900)
    data = vectors(spark, pdf, ["x", "z"])
    wanted = GBTRegressor(labelCol="y", maxIter=7, maxDepth=4, seed=1).fit(data).transform(data)
    found = M.fit_ranker(data, "y", maxIter=7, maxDepth=4).transform(wanted.withColumnRenamed("prediction", "wanted"))
    assert found.agg(F.max(F.abs(F.col("preds") - F.col("wanted")))).first()[0] < 1e-9
    with pytest.raises(Exception, match="null"):
        M.fit_ranker(data.withColumn("y", F.when(F.col("x") > 0, F.col("y"))), "y", maxIter=1)


def test_tables_have_the_slopes_of_all_pairs():
    rng = np.random.default_rng(13)
    label, score = rng.integers(0, 4, (7, 30)).astype(float), np.round(rng.normal(size=(7, 30)), 1)
    query = np.arange(30).repeat(7).astype(float)
    order, columns = B.by_size(3)({"query": query, "label": label.T.ravel()})
    g, h = B.listwise_steps(3)(columns, score.T.ravel()[order])
    assert (order.reshape(7, 30).T.ravel() == np.arange(210)).all()
    for i in range(30):
        first = np.sort(label[:, i])[::-1][:3]
        wg, wh = brute_slopes(label[:, i], score[:, i], sum((2**v - 1) / math.log2(r + 2) for r, v in enumerate(first)), 3)
        assert np.allclose(g.reshape(7, 30)[:, i], wg) and np.allclose(h.reshape(7, 30)[:, i], wh)
