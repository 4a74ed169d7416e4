import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline.operators import boosting
from touchline.operators import evaluate as V
from touchline.operators import features as X
from touchline.operators import models as M
from touchline.operators import neighbours, oversample, tuning
from touchline.plans import training
from touchline.sources.models import ModelStore
from touchline.sources.tables import staged


@pytest.fixture(scope="module")
def people(spark):
    """5 % positives; ``signal`` and ``kind`` carry the label, ``noise`` does not."""
    rng = np.random.default_rng(7)
    n = 1200
    y = (rng.random(n) < 0.05).astype(int)
    pdf = pd.DataFrame(
        {
            "domain_userid": [f"u{i:04d}" for i in range(n)],
            "signal": rng.normal(size=n) + 2.5 * y,
            "noise": rng.normal(size=n),
            "kind": np.where(rng.random(n) < 0.3 + 0.4 * y, "warm", "cold"),
            "converted_user": y,
        }
    )
    pdf.loc[::50, "kind"] = None
    pdf.loc[::70, "signal"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("signal", F.when(~F.isnan("signal"), F.col("signal")))
    return staged(df, "people")


CAT, NUM, Y = ["kind"], ["signal", "noise"], "converted_user"


@pytest.fixture(scope="module")
def fitted(people):
    train, test = X.hash_split(people, "domain_userid", 67)
    train = X.with_class_weight(train, Y)
    trees = M.boosted_trees(Y, weightCol="weight", maxIter=4, maxDepth=3)
    return M.propensity_model(train, Y, CAT, NUM, trees), train, test


def test_scores(fitted):
    model, _, test = fitted
    scored = M.score(model, test, ["domain_userid", Y])
    low, high = scored.agg(F.min("propensity_score"), F.max("propensity_score")).first()
    assert 0 <= low < high <= 1
    assert V.area_under_roc(scored, Y, "propensity_score").first()[0] > 0.8
    assert rows(scored, "domain_userid") == rows(M.score(model, test.repartition(3), ["domain_userid", Y]), "domain_userid")


def test_importances_name_the_signal(fitted):
    model, train, _ = fitted
    table = rows(M.feature_importances(model, train))
    assert table[0][0].startswith("signal") and not any("converted" in name for name, _ in table)
    assert sum(v for _, v in table) == pytest.approx(1.0)
    assert len(rows(M.feature_importances(model, train, top=1))) == 1


def test_label_is_refused_as_feature(people):
    with pytest.raises(ValueError):
        M.propensity_model(people, Y, CAT, [*NUM, Y], M.logistic(Y))


def test_early_stop_uses_fewer_trees(people):
    marked = people.withColumn("held", X.hash_percent(F.col("domain_userid"), "v") < 40)
    trees = M.boosted_trees_with_stop(Y, "held", tolerance=0.05, maxIter=15, maxDepth=2)
    model = M.propensity_model(marked, Y, CAT, NUM, trees)
    assert model.stages[-1].getNumTrees < 15


def test_settings_are_repeatable_and_in_range():
    one, two = tuning.draw_settings(20, 1), tuning.draw_settings(20, 1)
    assert one == two != tuning.draw_settings(20, 2) and len(one) == 20
    for s in one:
        assert 2 <= s["maxDepth"] <= 8 and 50 <= s["maxIter"] <= 200 and np.exp(-3) <= s["stepSize"] <= 1
        assert 0 <= s["gamma"] <= 5 and 1 <= s["minInstancesPerNode"] <= 20


def test_search_picks_the_best_trial(people):
    features = M.featurizer(CAT, NUM).fit(people)
    marked = tuning.with_fold(people, "domain_userid", 2).withColumn("validation", F.col("fold") == 1)
    prepared = X.materialised(features.transform(marked).select(Y, "features", "fold", "validation"))
    settings = [{"maxIter": 1, "maxDepth": 1, "stepSize": 0.1}, {"maxIter": 3, "maxDepth": 3, "stepSize": 0.3}]
    found = tuning.random_search(M.boosted_trees(Y), prepared, V.AveragePrecision(labelCol=Y), settings)
    assert found.metric == max(m for _, m in found.trials) and found.best in settings
    assert found.metric > min(m for _, m in found.trials)
    grid = tuning.grid_search(M.boosted_trees(Y, maxIter=1), prepared, Y, {"maxDepth": [1, 2]}, folds=2)
    assert len(grid.avgMetrics) == 2 and min(grid.avgMetrics) > 0.5


def test_gamma_is_a_sum_over_rows(people):
    """The largest gamma of the space still lets trees split; undivided it would not."""
    assert tuning.as_params({"gamma": 5.0, "maxDepth": 3}, 1000) == {"minInfoGain": 0.005, "maxDepth": 3}
    prepared = M.featurizer(CAT, NUM).fit(people).transform(people)
    params = tuning.as_params({"gamma": 5.0}, people.count())
    assert M.boosted_trees(Y, maxIter=1, maxDepth=3, **params).fit(prepared).trees[0].numNodes > 1
    assert M.boosted_trees(Y, maxIter=1, maxDepth=3, minInfoGain=2.5).fit(prepared).trees[0].numNodes == 1


def test_class_weight_is_learned_on_training_rows(people, spark, tmp_path):
    """Test rows of another ratio do not change the model."""
    store = ModelStore(spark, str(tmp_path / "weights"))
    test_keys = X.hash_split(people, "domain_userid", 67)[1].select("domain_userid")
    other = people.join(test_keys, "domain_userid", "left_semi").withColumn(Y, F.lit(1))
    mixed = people.join(test_keys, "domain_userid", "left_anti").unionByName(other)
    settings = [{"maxIter": 2, "maxDepth": 2, "stepSize": 0.3}]
    for name, table in (("as it is", people), ("changed", mixed)):
        training.train_and_register(staged(table, "table"), store, name, categorical=CAT, continuous=NUM, settings=settings)
    scores = [rows(training.score_users(people, store, name), "domain_userid") for name in ("as it is", "changed")]
    assert scores[0] == scores[1]


def test_the_query_goes_beyond_random_settings(spark, monkeypatch, tmp_path):
    """The search of the query proposes settings from trials before it: as many as the whole search asks for."""
    from workload import modelling

    made = pd.DataFrame({"domain_userid": [f"u{i:03d}" for i in range(300)], "converted_user": [int(i % 7 == 0) for i in range(300)]})
    table = spark.createDataFrame(made)
    for i, c in enumerate(modelling.CATEGORICAL):
        table = table.withColumn(c, F.concat(F.lit("v"), (F.xxhash64("domain_userid", F.lit(i)) % 3).cast("string")))
    for i, c in enumerate(modelling.CONTINUOUS):
        table = table.withColumn(c, (F.xxhash64("domain_userid", F.lit(-i)) % 100).cast("double"))
    monkeypatch.setattr(modelling, "prospects", lambda *_: staged(table, "few"))
    proposed, judged = [], []
    propose, fit = tuning.propose, boosting.PenalisedTrees.fit_for_trial
    monkeypatch.setattr(tuning, "propose", lambda *a, **k: proposed.append(1) or propose(*a, **k))
    short = lambda self, rows, params: judged.append(1) or fit(self.copy(params).copy({self.maxIter: 1}), rows)
    monkeypatch.setattr(boosting.PenalisedTrees, "fit_for_trial", short)
    found = modelling.train_register_and_score(spark, "")
    assert found.where("is_probability AND label_fits").count() == found.count() == 300
    assert (len(judged), len(proposed)) == (20, 12)


def test_store_versions_stages_and_scoring(spark, people, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    settings = [{"maxIter": 2, "maxDepth": 2, "stepSize": 0.3}]
    for expected in (1, 2):
        assert training.train_and_register(people, store, "p", categorical=CAT, continuous=NUM, settings=settings) == expected
    stages = {r["version"]: r["stage"] for r in store.versions("p").collect()}
    assert stages == {1: "Archived", 2: "Production"}
    metrics = store.versions("p").where("version = 2").first()["metrics"]
    assert metrics["f1"] >= 0 and metrics["average_precision"] > 0.1
    assert store.runs().where("key = 'search_f1' AND CAST(value AS DOUBLE) >= 0").count() == 2
    table = training.score_and_label(people, store, "p")
    assert table.count() == people.count()
    assert {r[0] for r in rows(table.select("propensity_label").distinct())} <= {"Low", "Medium", "High"}
    training.save_scores(people, store, "p", "propensity_scores")
    assert spark.table("propensity_scores").columns == ["domain_userid", "propensity_score", "propensity_decile", "propensity_label"]
    training.save_high_propensity(people, store, "p", "high_propensity")
    assert {r[0] for r in rows(spark.table("high_propensity").select("propensity_prediction").distinct())} == {1.0}
    with pytest.raises(ValueError):
        store.transform("p", people.drop("signal"))
    with pytest.raises(ValueError):
        store.load("unknown")
    with pytest.raises(ValueError):
        store.promote("p", 9)


def test_quantile_model_covers_its_share(spark):
    rng = np.random.default_rng(0)
    x = rng.random(6000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": 10 * x + rng.exponential(size=6000)}))
    model = M.fit_quantile(df, "y", ["x"], 0.2)
    got = V.pinball_loss(model.transform(df), "y", "prediction", 0.2).first()
    assert abs(got["coverage"] - 0.2) < 0.02
    assert model.transform(df).count() == 6000


def test_ranker_beats_chance(spark):
    rng = np.random.default_rng(0)
    n = 2000
    good = rng.integers(0, 3, n)
    pdf = pd.DataFrame({"q": np.arange(n) // 10, "id": np.arange(n), "labels": good.astype(float), "x": good + rng.normal(size=n) * 0.5})
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(pdf))
    scored = M.fit_ranker(df, "labels", maxIter=3, maxDepth=3).transform(df)
    learned = V.ndcg(scored, "q", "labels", "preds", "id").first()
    chance = V.ndcg(df.withColumn("r", F.rand(1)), "q", "labels", "r", "id").first()
    assert learned["ndcg_at_3"] > chance["ndcg_at_3"] + 0.2
    best = M.best_per_query(scored, "q", "preds", "id", 2)
    assert best.count() == 400 and "leaf_preds" in best.columns


# ---- nearest neighbours and oversampling ------------------------------------


def cloud(spark, n, seed=1, categories=2):
    rng = np.random.default_rng(seed)
    cont, cat = np.round(rng.normal(size=(n, 2)) * [1, 4], 1), rng.integers(0, 3, (n, categories)).astype(str)
    made = [(f"p{i:05d}", [float(v) for v in cont[i]], list(cat[i]), 1) for i in range(n)]
    schema = "point_id string, cont array<double>, cat array<string>, copies bigint"
    return staged(spark.createDataFrame(made, schema), "points"), cont, cat


def distances(cont, cat, penalty):
    d = sum((cont[:, None, a] - cont[None, :, a]) ** 2 for a in range(2)) + penalty * (cat[:, None] != cat[None]).sum(-1)
    np.fill_diagonal(d, np.inf)
    return d


def test_neighbours_in_one_group_equal_brute_force(spark):
    points, cont, cat = cloud(spark, 500)
    got = neighbours.k_nearest(points, 4, 1.3, group_rows=10_000).toPandas()
    d = distances(cont, cat, 1.3)
    for i in range(500):
        mine = got[got.point_id == f"p{i:05d}"].sort_values(["distance", "near_id"])
        assert sorted(np.round(mine.distance, 9)) == sorted(np.round(np.sort(d[i])[:4], 9))
    assert len(got) == 500 * 4


@pytest.mark.parametrize("categories", [2, 6])
def test_recall_of_neighbours_over_many_groups(spark, categories):
    n, k, penalty = 3000, 5, 1.3
    points, cont, cat = cloud(spark, n, categories=categories)
    got = neighbours.k_nearest(points, k, penalty, group_rows=300).toPandas()
    d = distances(cont, cat, penalty)
    edge = np.sort(d, axis=1)[:, k - 1]
    at = got.point_id.str[1:].astype(int).to_numpy()
    assert len(got) == n * k and (got.distance.to_numpy() <= edge[at] + 1e-9).mean() >= 0.9


def test_groups_beyond_the_cuts_are_counted_off(spark, monkeypatch):
    """Two cuts for ten groups a table."""
    monkeypatch.setattr(neighbours, "MOST_CUTS", 3)
    n, k, penalty = 3000, 5, 1.3
    points, cont, cat = cloud(spark, n)
    got = neighbours.k_nearest(points, k, penalty, group_rows=300).toPandas()
    edge = np.sort(distances(cont, cat, penalty), axis=1)[:, k - 1]
    at = got.point_id.str[1:].astype(int).to_numpy()
    assert len(got) == n * k and (got.distance.to_numpy() <= edge[at] + 1e-9).mean() >= 0.9


def test_work_per_point_does_not_grow(spark):
    """Rows that go into groups, per point, at two sizes."""
    for n in (400, 1600):
        points, _, _ = cloud(spark, n)
        plan = neighbours.k_nearest(points, 3, 1.0, group_rows=100)
        plan.collect()
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in text and text.count("FlatMapGroupsInPandas") == 1
        assert neighbours.TABLES == 12


def test_oversampling(spark, people):
    filled = people.na.fill("N/A", CAT).na.fill(0.0, NUM)
    made = staged(oversample.smote_nc(filled, "domain_userid", Y, NUM, CAT, group_rows=20), "made")
    sizes = dict(rows(made.groupBy(Y).count()))
    assert sizes[0] == sizes[1]
    assert made.join(filled.select("domain_userid"), "domain_userid", "left_semi").count() == people.count()
    real = filled.where(f"{Y} = 1").agg(F.min("signal"), F.max("signal"), F.min("noise"), F.max("noise")).first()
    fake = made.where("domain_userid LIKE '%~%'")
    span = fake.agg(F.min("signal"), F.max("signal"), F.min("noise"), F.max("noise")).first()
    assert real[0] <= span[0] and span[1] <= real[1] and real[2] <= span[2] and span[3] <= real[3]
    kinds = {r[0] for r in rows(fake.select("kind").distinct())}
    assert kinds <= {r[0] for r in rows(filled.where(f"{Y} = 1").select("kind").distinct())}
    again = oversample.smote_nc(filled.repartition(5), "domain_userid", Y, NUM, CAT, group_rows=20)
    assert rows(made, "domain_userid") == rows(again, "domain_userid")


def test_oversampling_of_copies(spark):
    data = [(f"m{i}", 1, 1.0, "a") for i in range(8)] + [("m8", 1, 5.0, "b")] + [(f"n{i}", 0, 0.0, "c") for i in range(40)]
    df = spark.createDataFrame(data, "id string, y int, x double, c string")
    made = oversample.smote_nc(df, "id", "y", ["x"], ["c"], k=3)
    assert dict(rows(made.groupBy("y").count())) == {0: 40, 1: 40}
    # A point with more copies than neighbours wanted is only drawn towards itself.
    copies = made.where("id LIKE 'm%~%' AND id NOT LIKE 'm8~%'")
    assert {tuple(r) for r in copies.select("x", "c").distinct().collect()} == {(1.0, "a")}


def test_nothing_to_oversample(spark):
    df = spark.createDataFrame([("a", 1, 1.0, "x"), ("b", 0, 2.0, "y")], "id string, y int, x double, c string")
    assert oversample.smote_nc(df, "id", "y", ["x"], ["c"]).count() == 2


# ---- two writers --------------------------------------------------------------


def test_a_number_is_claimed_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from touchline.sources.models import claimed

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: claimed(spark, f"{tmp_path}/claims/{i % 5}"), range(60)))
    assert sum(got) == 5


def test_two_writers_get_two_versions_and_one_production(spark, people, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    model = M.propensity_model(people.na.fill(0.0), Y, CAT, NUM, M.logistic(Y))
    stores = [ModelStore(spark, str(tmp_path / "shared")) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda s: s.register("p", model, "contract"), stores))
        assert sorted(versions) == [1, 2, 3, 4]
        list(pool.map(lambda pair: pair[0].promote("p", pair[1]), zip(stores, versions)))
    stages = sorted(r["stage"] for r in stores[0].versions("p").collect())
    assert stages == ["Archived", "Archived", "Archived", "Production"]
    stores[1].promote("p", 2)
    assert {r["version"]: r["stage"] for r in stores[2].versions("p").collect()}[2] == "Production"
    assert [r["stage"] for r in stores[3].versions("p").collect()].count("Production") == 1
