"""Sessions, daily metrics and scores over streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.times import MICROS
from touchline.operators import sketches
from touchline.operators.models import score


def stream_sessions(stream: DataFrame, user: str, gap_s: int, event_time: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """Closed sessions: emitted once the watermark is past their end plus the gap.

    Rows are merged into sessions inside each task before they are shuffled, so
    that a very busy user moves as a few sessions per task, if the session was
    made with ``session.STREAM_SETTINGS``. Spark's own session
    window still joins events that lie exactly a gap apart; one microsecond less
    makes it agree with the batch sessions, which start a new one there.
    """
    gap = f"{gap_s * MICROS - 1} microseconds"
    grouped = stream.withWatermark(event_time, delay).groupBy(F.session_window(event_time, gap).alias("session"), user)
    counted = grouped.agg(
        F.count(F.lit(1)).alias("events"), F.min(event_time).alias("start_tstamp"), F.max(event_time).alias("end_tstamp")
    )
    return counted.select(user, "start_tstamp", "end_tstamp", "events")


def stream_daily_activity(stream: DataFrame, user: str, event_time: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """Users and events of closed days.

    Exact: first one row per (day, user), then one row per day. Both steps keep
    one running number per group, not the events.
    """
    per_user = (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day").alias("w"), user)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_day = per_user.groupBy(F.window(F.window_time("w"), "1 day").alias("day")).agg(
        F.count(user).alias("users"), F.sum("n").alias("events")
    )
    # Days as numbers since 1970 and back, so that the session time zone plays no part.
    number = F.floor(F.unix_seconds("day.start") / 86400).cast("int")
    return per_day.select(F.date_from_unix_date(number).alias("day"), "users", "events")


def stream_approximate_activity(stream: DataFrame, user: str, event_time: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """As ``stream_daily_activity`` with an estimated user count: a sketch of fixed size per day."""
    counted = (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day").alias("day"))
        .agg(F.approx_count_distinct(user, 0.01).alias("users"), F.count(F.lit(1)).alias("events"))
    )
    number = F.floor(F.unix_seconds("day.start") / 86400).cast("int")
    return counted.select(F.date_from_unix_date(number).alias("day"), "users", "events")


def stream_user_sketches(
    stream: DataFrame, user: str, by: Sequence[str] = (), event_time: str = "event_time", delay: str = "1 hour"
) -> DataFrame:
    """Stored sketches of closed days, as ``sketches.daily_user_sketches`` makes them in batch; the state is one sketch per day and group."""
    grouped = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, "1 day").alias("_day"), *by)
    made = grouped.agg(
        F.count(F.lit(1)).alias("events"),
        F.theta_sketch_agg(F.col(user), F.lit(sketches.THETA_LOG2)).alias("theta"),
        F.hll_sketch_agg(F.col(user), F.lit(sketches.HLL_LOG2)).alias("hll"),
    )
    number = F.floor(F.unix_seconds("_day.start") / 86400).cast("int")
    return made.select(F.date_from_unix_date(number).alias("day"), *by, "events", "theta", "hll")


def stream_scores(stream: DataFrame, model: PipelineModel, keep: list[str]) -> DataFrame:
    """Scores of users as they arrive, from the same fitted pipeline as in batch."""
    return score(model, stream, keep)
