"""The physical plans that the design relies on, with broadcasts and adaptive re-planning off."""

import pytest
from pyspark.sql import functions as F

from touchline.operators import aggregates as A
from touchline.operators import joins as J
from touchline.operators import sessions as S
from touchline.plans.gold import first_touch, first_views
from touchline.sources.tables import staged
from workload import inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def plain_plans(spark):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_views_are_cut_before_the_shuffle(spark):
    text = plan(first_views(staged(inputs.views(spark, SF))))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "EqualTo(page_view_in_session_index,1)" in text


def test_top_values_are_cut_before_the_shuffle(spark):
    text = plan(A.top_values(inputs.read(spark, SF, "customer"), ["c_mktsegment"], 3))
    assert "WindowGroupLimit" in text


def test_sessionize_moves_full_rows_once(spark):
    events = inputs.read(spark, SF, "events")
    text = plan(S.sessionize(events, "user_id", "ts", "event_id"))
    assert text.count("Exchange hashpartitioning") == 4  # rows, cells, cells by user, cells back
    cells = plan(S.session_bounds(events, "user_id", "ts", 1800))
    assert "FileScan parquet [ts" in cells and "props" not in cells


def test_gold_joins_without_further_shuffles(spark):
    views = staged(inputs.views(spark, SF))
    converted = spark.range(3).select(F.col("id").cast("string").alias("domain_userid"), F.lit(True).alias("converted"))
    text = plan(first_touch(S.users(views), views, staged(converted)))
    # Views to users, first views, conversions; the joins add none.
    assert text.count("Exchange") == 3 and text.count("SortMergeJoin") == 2


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(inputs.read(spark, SF, "events").where("event_type = 'view'").select("user_id"))
    assert "EqualTo(event_type,view)" in text and "ReadSchema: struct<user_id:bigint,event_type:string>" in text


def test_lookup_of_a_very_common_value_is_split(spark):
    """A third of the rows share one address: adaptive execution divides them over several tasks."""
    lowered = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in lowered}
    for k, v in lowered.items():
        spark.conf.set(k, v)
    try:
        spread = F.pmod(F.xxhash64("id"), F.lit(1 << 22)).cast("bigint")
        data = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(77).cast("bigint")).otherwise(spread).alias("ip"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        ranges = spark.range(0, 1 << 22, 1000).select(F.col("id").alias("low"), (F.col("id") + 900).alias("high"), F.col("id").alias("code"))
        found = J.range_lookup(data, ranges, "ip", "low", "high", ["code"])
        summed = found.agg(F.count(F.lit(1)).alias("n"), F.max("payload"), F.max("code"))
        assert summed.collect()[0]["n"] == 300_000
        assert "skew=true" in plan(summed)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
