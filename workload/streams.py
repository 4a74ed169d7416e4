"""Streaming queries: each runs over the whole events table as a stream and reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.functions.times import epoch_micros
from touchline.operators import models as M
from touchline.operators import sessions as S
from touchline.plans import bindings as B
from touchline.session import work_path
from touchline.sources.tables import staged
from touchline.streaming import closing as K
from touchline.streaming import events as E
from touchline.streaming import metrics as R
from touchline.streaming.upsert import Upsert
from workload import inputs
from workload.ctes import GOLD_CTE, VIEWS_CTE
from workload.modelling import CATEGORICAL, CONTINUOUS, LABEL, prospects
from workload.registry import query


def event_stream(spark, sf):
    schema = inputs.read(spark, sf, "events").schema
    # As a pattern the path may name one file or a folder of files.
    return E.with_event_time(E.read_stream(spark, f"{sf}/events.parque[t]", schema), "ts")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_bronze_load(spark, sf):
    stream = event_stream(spark, sf)
    copies = stream.unionByName(stream.withColumn("value", F.col("value") + 0))
    once = E.deduplicated(copies, "event_id", salts=4)
    return E.run_to_table(once.select("event_id", "user_id", "event_type", "value"), "bronze")


@query(
    "WITH gaps AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) "
    f"< {B.SESSION_GAP_S * 1000000} THEN 0 ELSE 1 END AS opens FROM events), "
    "numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS idx FROM gaps), "
    "closed AS (SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS events FROM numbered GROUP BY user_id, idx) "
    f"SELECT * FROM closed WHERE end_us + {B.SESSION_GAP_S * 1000000 - 1} <= (SELECT (epoch_us(max(ts)) // 1000 - 3600000) * 1000 FROM events)"
)
def stream_closed_sessions(spark, sf):
    closed = R.stream_sessions(event_stream(spark, sf), "user_id", B.SESSION_GAP_S)
    written = E.run_to_table(closed, "sessions")
    return written.select(
        "user_id", F.unix_micros("start_tstamp").alias("start_us"), F.unix_micros("end_tstamp").alias("end_us"), "events"
    )


_WATERMARK = "(SELECT (epoch_us(max(ts)) // 1000 - 3600000) * 1000 FROM events)"


@query(
    "WITH c AS (SELECT user_id, epoch_us(ts) // 1000000 AS cell, min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last, count(*) AS events, "
    f"max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS closes FROM events GROUP BY 1, 2), "
    "g AS (SELECT *, lag(last) OVER w AS before, lag(closes) OVER w AS ended FROM c WINDOW w AS (PARTITION BY user_id ORDER BY cell)), "
    f"n AS (SELECT *, sum(CASE WHEN first - before < {B.SESSION_GAP_S * 1000000} AND ended = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY cell) AS idx FROM g), "
    "s AS (SELECT CAST(user_id AS VARCHAR) AS user, min(first) AS start_us, max(last) AS end_us, CAST(sum(events) AS BIGINT) AS events, "
    "max(closes) = 1 AS closed_by_event, max(cell) AS last_cell FROM n GROUP BY user_id, idx) "
    "SELECT user, start_us, end_us, events, closed_by_event FROM s WHERE CASE WHEN closed_by_event THEN (last_cell + 1) * 1000000 "
    f"ELSE end_us + {B.SESSION_GAP_S * 1000000} END <= {_WATERMARK}"
)
def stream_sessions_closed_by_purchase(spark, sf):
    """Sessions that end with a purchase or with silence, from a stream with state and timers of its own."""
    before = {k: spark.conf.get(k, None) for k in K.STATE_STORE}
    for name, value in K.STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        closed = K.stream_closing_sessions(event_stream(spark, sf), "user_id", B.SESSION_GAP_S, "event_type = 'purchase'")
        return E.run_to_table(closed, "closing")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@query(
    "SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users, count(*) AS events FROM events GROUP BY 1 "
    "HAVING epoch_us(CAST(ts AS DATE) + INTERVAL 1 DAY) <= (SELECT (epoch_us(max(ts)) // 1000 - 3600000) * 1000 FROM events)"
)
def stream_daily_users_and_events(spark, sf):
    return E.run_to_table(R.stream_daily_activity(event_stream(spark, sf), "user_id"), "daily")


_CLOSED_DAYS = (
    "d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1 "
    "HAVING epoch_us(CAST(ts AS DATE) + INTERVAL 1 DAY) <= (SELECT (epoch_us(max(ts)) // 1000 - 3600000) * 1000 FROM events))"
)


@query(f"WITH {_CLOSED_DAYS} SELECT day, events, true AS is_near FROM d")
def stream_estimated_users(spark, sf):
    estimated = E.run_to_table(R.stream_approximate_activity(event_stream(spark, sf), "user_id"), "daily")
    exact = inputs.read(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count_distinct("user_id").alias("exact"))
    near = F.abs(F.col("users") - F.col("exact")) <= 1 + 0.05 * F.col("exact")
    return estimated.join(exact, "day").select("day", "events", near.alias("is_near"))


@query(f"WITH {GOLD_CTE} SELECT domain_userid, true AS same_as_batch FROM gold")
def stream_propensity_scores(spark, sf):
    table = prospects(spark, sf)
    model = M.propensity_model(table, LABEL, CATEGORICAL, CONTINUOUS, M.logistic(LABEL))
    folder = work_path(spark, "arriving")
    table.write.parquet(folder)
    arriving = E.read_stream(spark, folder, table.schema)
    streamed = E.run_to_table(R.stream_scores(arriving, model, ["domain_userid"]), "scores")
    batch = M.score(model, table, ["domain_userid"]).toDF("domain_userid", "_score", "_prediction")
    same = (F.col("_score") == F.col("propensity_score")) & (F.col("_prediction") == F.col("prediction"))
    return streamed.join(batch, "domain_userid").select("domain_userid", same.alias("same_as_batch"))


@query(
    "WITH gaps AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) "
    f"< {B.SESSION_GAP_S * 1000000} THEN 0 ELSE 1 END AS opens FROM events), "
    "numbered AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS domain_sessionidx FROM gaps) "
    "SELECT user_id, domain_sessionidx, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS events "
    "FROM numbered GROUP BY 1, 2"
)
def stream_session_upsert(spark, sf):
    events = inputs.read(spark, sf, "events").select("event_id", "user_id", "ts")
    # Three arrivals, each with events from the whole time span: sessions grow and join.
    folder = work_path(spark, "arrivals")
    events.repartition(3, F.pmod(F.xxhash64("event_id"), F.lit(3))).write.parquet(folder)

    def build(rows):
        return S.session_bounds(rows, "user_id", "ts", B.SESSION_GAP_S).drop("domain_sessionidx")

    upsert = Upsert(spark, work_path(spark, "upsert"), "user_id", "ts", build, gap_s=B.SESSION_GAP_S)
    upsert.run(E.read_stream(spark, folder, events.schema, files_per_batch=1), work_path(spark, "upsert-state"))
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("start_us")).cast("bigint")
    return upsert.current(events.schema).withColumn("domain_sessionidx", number)


@query(
    f"WITH {VIEWS_CTE} SELECT page_view_id, epoch_us(start_tstamp) AS start_us, epoch_us(end_tstamp) AS end_us, "
    "CAST(engaged_time_in_s // 10 AS BIGINT) AS pings FROM views"
)
def stream_page_view_upsert(spark, sf):
    """Page views kept current from three arrivals, in the order of time but for some late events."""
    events = staged(inputs.wide(spark, sf).select("page_view_id", "collector_tstamp", "event_id"), "wide")
    folder = work_path(spark, "arrivals")
    third = F.when(F.col("event_id") % 11 == 0, 2).when(F.dayofmonth("collector_tstamp") <= 15, 0).otherwise(1)
    for number in range(3):
        events.where(third == number).coalesce(1).write.mode("append").parquet(folder)

    def build(rows):
        us = epoch_micros(rows, "collector_tstamp")
        return rows.groupBy("page_view_id").agg(F.min(us).alias("start_us"), F.max(us).alias("end_us"), F.count(F.lit(1)).alias("pings"))

    upsert = Upsert(spark, work_path(spark, "upsert"), "page_view_id", "collector_tstamp", build)
    upsert.run(E.read_stream(spark, folder, events.schema, files_per_batch=1), work_path(spark, "upsert-state"))
    return upsert.current(events.schema)


@query(
    "WITH gaps AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) "
    f"< {B.SESSION_GAP_S * 1000000} THEN 0 ELSE 1 END AS opens FROM events) SELECT user_id, CAST(sum(opens) AS BIGINT) AS sessions, "
    "count(*) AS events, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM gaps GROUP BY 1"
)
def stream_user_upsert(spark, sf):
    """Users as a roll-up of the sessions that a stream keeps current: as cheap as there are sessions."""
    table = stream_session_upsert(spark, sf)
    return table.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("events").alias("events"),
        F.min("start_us").alias("first_us"),
        F.max("end_us").alias("last_us"),
    )
