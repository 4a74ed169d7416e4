"""Users and quantiles over spans of days, from stored sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import sketches as K
from touchline.session import work_path
from touchline.sources.tables import staged
from touchline.streaming import events as E
from touchline.streaming import metrics as R
from workload import ctes, inputs
from workload.registry import query
from workload.streams import event_stream

_SHARES = [i / 10 for i in range(1, 10)]


def _stored(spark, sf):
    """Daily sketches by traffic source, written once and read back; what follows reads no events."""
    folder = work_path(spark, "daily_users")
    sourced = inputs.wide(spark, sf).withColumn("source", F.coalesce("mkt_source", F.lit("direct")))
    K.store_daily(K.daily_user_sketches(sourced, "collector_tstamp", "domain_userid", ["source"]), folder)
    return K.stored_daily(spark, folder)


_SOURCED = f"WITH {ctes.WIDE_CTE}, s AS (SELECT *, coalesce(mkt_source, 'direct') AS source FROM wide)"
_NEAR = "true AS is_near, true AS hll_is_near"


@query(
    f"{_SOURCED} SELECT CAST(date_trunc('week', collector_tstamp) AS DATE) AS week, source, count(*) AS events, "
    f"{_NEAR} FROM s GROUP BY 1, 2"
)
def weekly_users_from_sketches(spark, sf):
    """Users per week and source from daily sketches, against the exact numbers: within 2 % and half a user."""
    merged = K.merged_users(_stored(spark, sf), F.date_trunc("week", "day").cast("date"), ["source"]).withColumnRenamed("span", "week")
    week = F.date_trunc("week", "collector_tstamp").cast("date").alias("week")
    sourced = inputs.wide(spark, sf).withColumn("source", F.coalesce("mkt_source", F.lit("direct")))
    users = sourced.groupBy(week, "source", "domain_userid").agg(F.lit(1).alias("_one")).groupBy("week", "source").agg(F.count("domain_userid").alias("exact"))
    near = {n: F.abs(F.col(c) - F.col("exact")) <= 0.5 + 0.02 * F.col("exact") for n, c in (("is_near", "users"), ("hll_is_near", "users_hll"))}
    return merged.join(users, ["week", "source"]).withColumns(near).select("week", "source", "events", "is_near", "hll_is_near")


@query(
    f"{_SOURCED}, g AS (SELECT DISTINCT domain_userid FROM s WHERE source = 'google'), n AS (SELECT DISTINCT domain_userid FROM s WHERE source = 'newsletter'), "
    "b AS (SELECT (SELECT count(*) FROM g) AS one, (SELECT count(*) FROM n) AS other, (SELECT count(*) FROM g JOIN n USING (domain_userid)) AS both) "
    "SELECT name, true AS is_near FROM b, (VALUES ('one'), ('other'), ('both'), ('either'), ('one_only')) v(name)"
)
def users_of_one_source_and_not_of_another(spark, sf):
    """Sizes of set operations on the users of two sources, against the exact ones: within 2 % of the union and half a user."""
    found = K.compared_users(_stored(spark, sf), "source", "google", "newsletter").first()
    users = inputs.wide(spark, sf).where("mkt_source IN ('google', 'newsletter')").groupBy("domain_userid").agg(
        F.max(F.when(F.col("mkt_source") == "google", 1).otherwise(0)).alias("g"), F.max(F.when(F.col("mkt_source") == "newsletter", 1).otherwise(0)).alias("n")
    )
    exact = users.agg(
        F.sum("g").alias("one"), F.sum("n").alias("other"), F.sum(F.col("g") * F.col("n")).alias("both"),
        F.count(F.lit(1)).alias("either"), F.sum(F.col("g") * (1 - F.col("n"))).alias("one_only"),
    ).first()
    room = 0.5 + 0.02 * (exact["either"] or 0)
    rows = [(n, abs((found[n] or 0) - (exact[n] or 0)) <= room) for n in ("one", "other", "both", "either", "one_only")]
    return spark.createDataFrame(rows, "name string, is_near boolean")


@query(
    "SELECT o_orderkey, true AS edges_are_near, true AS deciles_are_even FROM orders"
)
def score_deciles_from_sketches(spark, sf):
    """Deciles of order values from the edges that daily sketches give, and whether edges and deciles keep to the sketch's rank error."""
    orders = inputs.read(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").cast("double").alias("score"))
    folder = work_path(spark, "daily_values")
    K.store_daily(K.daily_value_sketches(orders, "o_orderdate", "score"), folder)
    edges = staged(K.merged_edges(K.stored_daily(spark, folder), _SHARES), "edges")
    known = edges.orderBy("number").collect()  # nine rows
    below = [F.avg((F.col("score") < e["edge"]).cast("double")).alias(f"_lo{e['number']}") for e in known]
    upto = [F.avg((F.col("score") <= e["edge"]).cast("double")).alias(f"_hi{e['number']}") for e in known]
    ranks = orders.agg(F.count("score").alias("_n"), *below, *upto).first()
    room = K.rank_error() + 1.0 / max(ranks["_n"] or 1, 1)
    near = [ranks[f"_lo{e['number']}"] - room <= e["share"] <= ranks[f"_hi{e['number']}"] + room for e in known]
    coded = staged(K.with_decile(orders, "score", edges), "coded")
    sizes = {r["decile"]: r["count"] for r in coded.groupBy("decile").count().collect()}  # ten rows
    even = all(abs(sizes.get(d, 0) / ranks["_n"] - 0.1) <= 2 * room for d in range(10)) if ranks["_n"] else True
    return coded.select("o_orderkey", F.lit(len(near) == 9 and all(near)).alias("edges_are_near"), F.lit(even).alias("deciles_are_even"))


@query(
    "WITH d AS (SELECT CAST(ts AS DATE) AS day FROM events GROUP BY 1 "
    "HAVING epoch_us(CAST(ts AS DATE) + INTERVAL 1 DAY) <= (SELECT (epoch_us(max(ts)) // 1000 - 3600000) * 1000 FROM events)) "
    "SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS events, true AS is_near FROM events WHERE CAST(ts AS DATE) IN (SELECT day FROM d) GROUP BY 1"
)
def stream_weekly_users_from_sketches(spark, sf):
    """Weekly users from the sketches that a stream left day by day, over its closed days."""
    daily = E.run_to_table(R.stream_user_sketches(event_stream(spark, sf), "user_id"), "daily_sketches")
    week = F.date_trunc("week", "day").cast("date")
    merged = K.merged_users(daily, week).withColumnRenamed("span", "week")
    closed = daily.select("day").distinct()
    events = inputs.read(spark, sf, "events").select(F.to_date("ts").alias("day"), "user_id").join(closed, "day", "left_semi")
    exact = events.groupBy(week.alias("week"), "user_id").agg(F.lit(1).alias("_one")).groupBy("week").agg(F.count("user_id").alias("exact"))
    near = F.abs(F.col("users") - F.col("exact")) <= 0.5 + 0.02 * F.col("exact")
    return merged.join(exact, "week").select("week", "events", near.alias("is_near"))
