import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline.operators import sketches as K
from touchline.operators.ordering import value_summary
from touchline.session import work_path
from touchline.sources.tables import staged


@pytest.fixture(scope="module")
def events(spark):
    """300,000 events of 120,000 users over two weeks from a Monday on; one source has a third of the users."""
    made = spark.range(300_000).select(
        F.expr("date_add(date'2024-01-01', CAST(id % 14 AS INT))").alias("ts"),
        F.concat(F.lit("u"), F.col("id") % 120_000).alias("user"),
        F.when(F.col("id") % 3 == 0, "mail").otherwise("search").alias("source"),
        F.randn(3).alias("value"),
    )
    return staged(made, "events")


def stored(spark, events, by):
    folder = work_path(spark, "sketches")
    K.store_daily(K.daily_user_sketches(events, "ts", "user", by), folder)
    return folder


def test_weeks_from_days(spark, events):
    folder = stored(spark, events, ["source"])
    week = F.date_trunc("week", "day").cast("date")
    got = {(r.span, r.source): r for r in K.merged_users(K.stored_daily(spark, folder), week, ["source"]).collect()}
    exact = events.groupBy(F.date_trunc("week", "ts").cast("date").alias("week"), "source").agg(F.count_distinct("user").alias("n"), F.count("*").alias("events"))
    for r in exact.collect():
        found = got.pop((r.week, r.source))
        assert found.events == r.events
        assert abs(found.users - r.n) <= 0.02 * r.n and abs(found.users_hll - r.n) <= 0.02 * r.n
    assert not got


def test_days_in_pieces_and_spans(spark, events):
    """A day that is written in two pieces merges; a span opens the months that it needs."""
    halves = [events.where("hash(user) % 2 = 0"), events.where("hash(user) % 2 <> 0")]
    folder = work_path(spark, "sketches")
    for half in halves:
        K.store_daily(K.daily_user_sketches(half, "ts", "user"), folder)
    later = events.withColumn("ts", F.expr("add_months(ts, 2)"))
    K.store_daily(K.daily_user_sketches(later, "ts", "user"), folder)
    days = K.stored_daily(spark, folder, "2024-01-02", "2024-01-05")
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1]
    total = K.merged_users(days, F.lit(1)).first()
    exact = events.where("ts BETWEEN '2024-01-02' AND '2024-01-05'").agg(F.count_distinct("user"), F.count("*")).first()
    assert total.events == exact[1] and abs(total.users - exact[0]) <= 0.02 * exact[0]


def test_users_of_one_and_not_of_another(spark):
    data = [(d, f"u{i}", s) for s, low, high in (("a", 0, 60), ("b", 40, 90)) for d in ("2024-01-01", "2024-01-02") for i in range(low, high)]
    events = spark.createDataFrame([*data, ("2024-01-01", None, "a")], "ts string, user string, source string").withColumn("ts", F.to_date("ts"))
    daily = K.daily_user_sketches(events, "ts", "user", ["source"])
    found = K.compared_users(daily, "source", "a", "b").first()
    assert tuple(found) == (60, 50, 20, 90, 40)
    assert tuple(K.compared_users(daily, "source", "a", "nobody").first()) == (60, 0, 0, 60, 60)


def test_edges_keep_to_the_rank_error(spark, events):
    daily = K.daily_value_sketches(events.unionByName(events.limit(5).withColumn("value", F.lit(float("nan")))), "ts", "value")
    edges = staged(K.merged_edges(daily, [0.1, 0.5, 0.9, 0.99]), "edges")
    values = np.sort(events.select("value").toPandas()["value"].to_numpy())
    for r in edges.collect():
        rank = np.searchsorted(values, r.edge) / len(values)
        assert abs(rank - r.share) <= K.rank_error()
    coded = K.with_decile(spark.createDataFrame([(-9.0,), (0.5,), (9.0,), (None,), (float("nan"),)], "value double"), "value", edges)
    assert [r.decile for r in coded.collect()] == [0, 2, 4, None, None]
    assert value_summary(events, "value")[0] == 300_000


def test_no_days(spark):
    none = spark.createDataFrame([], "ts date, value double, user string")
    assert rows(K.merged_edges(K.daily_value_sketches(none, "ts", "value"), [0.5])) == []
    assert rows(K.merged_users(K.daily_user_sketches(none, "ts", "user"), F.lit(1))) == []


def test_size_is_bounded(spark):
    many = pd.DataFrame({"ts": pd.to_datetime(["2024-01-01"] * 100_000).date, "user": [f"u{i}" for i in range(100_000)]})
    daily = K.daily_user_sketches(spark.createDataFrame(many), "ts", "user")
    theta, hll = daily.select(F.octet_length("theta"), F.octet_length("hll")).first()
    assert theta < 2 * 8 * 2**K.THETA_LOG2 + 1000 and hll < 2**K.HLL_LOG2 + 1000
