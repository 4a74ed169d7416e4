import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline.operators import audiences as A


def test_change_set(spark):
    before = spark.createDataFrame([("gone", 1, "x"), ("same", 1, None), ("moved", 1, "x"), ("to_null", 1, "x")], "u string, n int, v string")
    after = spark.createDataFrame([("new", 9, "y"), ("same", 1, None), ("moved", 2, "x"), ("to_null", 1, None)], "u string, n int, v string")
    assert rows(A.change_set(before, after, "u", ["n", "v"]), "u") == [
        ("gone", "remove", 1, "x"), ("moved", "update", 2, "x"), ("new", "add", 9, "y"), ("to_null", "update", 1, None),
    ]


def test_strata_are_balanced_even_when_small_or_large(spark):
    df = spark.range(1003).select(
        F.col("id"), F.when(F.col("id") < 2, "tiny").when(F.col("id") < 700, "large").when(F.col("id") < 900, "mid").alias("s")
    )
    split = A.split_stratified(df, "id", ["s"], 4)
    assert split.count() == 1003
    sizes = Counter((r["s"], r["split"]) for r in split.collect())
    for stratum in ("large", "mid", None):
        counts = [sizes[(stratum, g)] for g in range(4)]
        assert max(counts) - min(counts) <= 1
    assert sum(sizes[("tiny", g)] for g in range(4)) == 2
    again = A.split_stratified(df.repartition(7), "id", ["s"], 4)
    assert rows(split, "id") == rows(again, "id")


def test_hash_split_is_stable(spark):
    df = spark.range(3000)
    split = A.split_by_hash(df, "id", 3, "x")
    assert rows(split, "id") == rows(A.split_by_hash(df.repartition(5), "id", 3, "x"), "id")
    assert min(Counter(r["split"] for r in split.collect()).values()) > 900


def test_awareness_audience(spark):
    users = spark.createDataFrame(
        [("yes", 1, None), ("again", 2, None), ("ad", 1, "cpc"), ("low", 1, None), ("unscored", 1, None)],
        "u string, sessions int, mkt_medium string",
    )
    scores = spark.createDataFrame([("yes", "High"), ("again", "High"), ("ad", "High"), ("low", "Low")], "u string, propensity_label string")
    assert [r[0] for r in rows(A.rule_audience(users, scores, "u", A.awareness_rule()))] == ["yes"]


def test_campaign(spark):
    members = spark.createDataFrame([("a", "m"), ("b", "m"), ("c", "r"), ("d", "r"), ("e", "r"), ("f", "r")], "u string, arm string")
    outcomes = spark.createDataFrame([("a",), ("a",), ("c",)], "u string")
    got = rows(A.campaign_performance(members, outcomes, "u", "arm", "r"), "arm")
    assert got == [("m", 2, 1, 0.5, 2.0), ("r", 4, 1, 0.25, 1.0)]


def test_score_table(spark):
    scored = spark.range(100).select(F.col("id").cast("string").alias("domain_userid"), (F.col("id") / 100).alias("propensity_score"))
    counts = dict(rows(A.score_table(scored).groupBy("propensity_label").count()))
    assert counts == {"Low": 80, "Medium": 10, "High": 10}


# ---- intervals ----------------------------------------------------------------


def arms(spark, n, rates, salt):
    """Members of two arms with outcomes drawn at the planted rates."""
    rng = random.Random(salt)
    members = [(f"{arm}{i}", arm) for arm in rates for i in range(n)]
    hits = [(m,) for m, arm in members if rng.random() < rates[arm]]
    return spark.createDataFrame(members, "id string, arm string"), spark.createDataFrame(hits + hits[:3], "id string")


def test_intervals_cover_the_planted_rates(spark):
    covered = {"rate": 0, "lift": 0}
    for salt in range(6):
        members, outcomes = arms(spark, 1500, {"model": 0.12, "rule": 0.08}, salt)
        found = {r.arm: r for r in A.campaign_intervals(members, outcomes, "id", "arm", "rule", replicates=100, salt=str(salt)).collect()}
        model = found["model"]
        covered["rate"] += model.rate_low <= 0.12 <= model.rate_high
        covered["lift"] += model.lift_low <= 1.5 <= model.lift_high
        assert model.rate_low < model.rate < model.rate_high and 0.02 < model.rate_high - model.rate_low < 0.05
        assert found["rule"].lift == found["rule"].lift_low == found["rule"].lift_high == 1.0
    assert covered["rate"] >= 4 and covered["lift"] >= 4


def test_intervals_are_the_same_in_every_run(spark):
    members, outcomes = arms(spark, 300, {"model": 0.2, "rule": 0.1}, 1)
    one = rows(A.campaign_intervals(members, outcomes, "id", "arm", "rule", replicates=50), "arm")
    two = rows(A.campaign_intervals(members.repartition(7), outcomes.repartition(3), "id", "arm", "rule", replicates=50), "arm")
    assert one == two
    plain = {r.arm: r for r in A.campaign_performance(members, outcomes, "id", "arm", "rule").collect()}
    for arm, size, hits, rate, _, _, lift, _, _ in one:
        assert (size, hits, rate) == (plain[arm].members, plain[arm].conversions, plain[arm].rate) and lift == pytest.approx(plain[arm].lift)


def test_replicates_are_drawn_in_tasks_that_follow_the_members(spark, monkeypatch):
    monkeypatch.setattr(A, "_DRAWN", 40)
    members = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, "model").otherwise("rule").alias("arm")).coalesce(1)
    hits = spark.range(0, 400, 3).select("id")
    found = A.campaign_intervals(members, hits, "id", "arm", "rule", replicates=20)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    counts = [tuple(r)[:3] for r in found.orderBy("arm").collect()]
    assert "Repartition 11, true" in plan and counts == [("model", 200, 67), ("rule", 200, 67)]


def test_no_conversions_no_lift(spark):
    members = spark.createDataFrame([("a", "model"), ("b", "rule")], "id string, arm string")
    found = rows(A.campaign_intervals(members, spark.createDataFrame([], "id string"), "id", "arm", "rule", replicates=5), "arm")
    assert [r[3] for r in found] == [0.0, 0.0] and [r[6:] for r in found] == [(None, None, None)] * 2
