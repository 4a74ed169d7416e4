"""Bring silver tables up to date from new events only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.times import MICROS, at_micros, epoch_micros
from touchline.operators.joins import join_unique
from touchline.operators.sessions import session_bounds, sessionize
from touchline.sources.tables import staged


def after_mark(events: DataFrame, arrival: str, mark) -> DataFrame:
    """Events that arrived after the high-water mark."""
    return events.where(F.col(arrival) > F.lit(mark))


def refresh(
    table: DataFrame,
    events: DataFrame,
    new_events: DataFrame,
    key: str,
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The table with the keys of the new events rebuilt, all other rows kept.

    Adaptive execution splits a key that very many events have.
    """
    touched = new_events.select(key).distinct()
    rebuilt = build(events.join(touched, key, "left_semi"))
    return table.join(touched, key, "left_anti").unionByName(rebuilt)


def refresh_sessions(
    old: DataFrame, events: DataFrame, new_events: DataFrame, user: str, ts: str, gap_s: int
) -> DataFrame:
    """A session table (as from ``session_bounds``) with new, possibly late, events worked in.

    A late event can lengthen a session or join two. Sessions that ended a gap
    or more before a user's earliest new event cannot change: they are kept,
    and only events from the first changeable session on are read again. The
    oldest such time is a plain filter on the events, which skips older files.
    ``old`` is read twice: pass a written table.
    """
    gap_us = gap_s * MICROS
    earliest = new_events.groupBy(user).agg(F.min(epoch_micros(new_events, ts)).alias("_new_us"))
    # A user has few sessions, however many events: joins on the session level need no care.
    marked = old.join(earliest, user, "left")
    closed = F.col("_new_us").isNull() | (F.col("end_us") + gap_us <= F.col("_new_us"))
    kept = marked.where(closed).select(old.columns)
    reopened = (
        marked.where("_new_us IS NOT NULL")
        .groupBy(user)
        .agg(
            F.min(F.when(~closed, F.col("start_us"))).alias("_open_us"),
            F.max(F.when(closed, F.col("domain_sessionidx"))).alias("_kept"),
        )
    )
    start = staged(
        earliest.join(reopened, user, "left").select(
            user, F.least("_new_us", "_open_us").alias("_from_us"), F.coalesce("_kept", F.lit(0)).alias("_kept")
        ),
        "changed_users",
    )
    oldest = start.agg(F.min("_from_us")).first()[0]
    if oldest is None:
        return old
    recent = events.where(F.col(ts) >= at_micros(events, ts, oldest))
    again = join_unique(recent, start, user).where(epoch_micros(events, ts) >= F.col("_from_us")).select(events.columns)
    rebuilt = session_bounds(again, user, ts, gap_s).join(start.select(user, "_kept"), user)
    renumbered = rebuilt.withColumn("domain_sessionidx", F.col("domain_sessionidx") + F.col("_kept")).select(old.columns)
    return kept.unionByName(renumbered)


def refresh_views(
    old: DataFrame,
    events: DataFrame,
    new_events: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    user: str,
    gap_s: int,
    view: str = "page_view_id",
    ts: str = "collector_tstamp",
) -> DataFrame:
    """Sessionized page views with new, possibly late, events worked in.

    ``old`` and what ``build`` makes of events have the view, the user and
    start_tstamp; ``old`` has domain_sessionidx and its position as well. Only
    views with new events are built again, from events since the earliest of
    their starts, which is a plain filter that skips older files. Sessions that
    closed a gap before a user's earliest changed view keep their views and
    numbers; those after it are numbered again. ``old`` is read several times:
    pass a written table.
    """
    arrived = new_events.groupBy(view).agg(F.min(epoch_micros(new_events, ts)).alias("_new_us"))
    started = old.select(view, epoch_micros(old, "start_tstamp").alias("_start_us"))
    touched = staged(
        arrived.join(started, view, "left").select(view, F.least("_new_us", "_start_us").alias("_from_us")), "changed_views"
    )
    oldest = touched.agg(F.min("_from_us")).first()[0]
    if oldest is None:
        return old
    recent = events.where(F.col(ts) >= at_micros(events, ts, oldest))
    rebuilt = staged(build(recent.join(touched.select(view), view, "left_semi")), "rebuilt_views")
    untouched = old.join(touched.select(view), view, "left_anti")

    earliest = rebuilt.groupBy(user).agg(F.min(epoch_micros(rebuilt, "start_tstamp")).alias("_changed_us"))
    ended = old.groupBy(user, "domain_sessionidx").agg(F.max(epoch_micros(old, "start_tstamp")).alias("_last_us"))
    closed = ended.join(earliest, user).where(F.col("_last_us") + gap_s * MICROS <= F.col("_changed_us"))
    users = earliest.join(closed.groupBy(user).agg(F.max("domain_sessionidx").alias("_kept")), user, "left")
    users = users.select(user, F.coalesce("_kept", F.lit(0)).alias("_kept"))
    marked = untouched.join(users, user, "left")
    still = F.col("_kept").isNull() | (F.col("domain_sessionidx") <= F.col("_kept"))
    open_again = marked.where(~still).select(rebuilt.columns).unionByName(rebuilt)
    numbered = sessionize(open_again, user, "start_tstamp", view, gap_s).join(users, user)
    numbered = numbered.withColumn("domain_sessionidx", F.col("domain_sessionidx") + F.col("_kept"))
    name = F.concat(F.col(user).cast("string"), F.lit("-"), F.col("domain_sessionidx").cast("string"))
    numbered = numbered.withColumn("domain_sessionid", name)
    return marked.where(still).select(old.columns).unionByName(numbered.select(old.columns))
