"""Page views, sessions and users from raw events.

Sessions are found without sorting a user's events in one task. Time is cut
into cells no wider than the session gap; two events of one cell are then
always in the same session. Events are counted per (user, cell) before any
shuffle, the gap test runs over cells, and a cell count per user is bounded by
the time span, however many events a user has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.times import MICROS, epoch_micros

PAGE_VIEW_FIRST = [
    "domain_userid", "page_title", "page_urlpath", "refr_urlhost", "refr_medium",
    "mkt_source", "mkt_medium", "mkt_campaign", "mkt_term",
    "geo_country", "geo_region", "geo_city", "br_lang", "device_family", "os_family",
]


def first_of(order: Sequence[str], columns: Sequence[str]) -> Column:
    """Aggregate: the named columns of the row that comes first."""
    return F.min_by(F.struct(*columns), F.struct(*order))


def last_of(order: Sequence[str], columns: Sequence[str]) -> Column:
    """Aggregate: the named columns of the row that comes last."""
    return F.max_by(F.struct(*columns), F.struct(*order))


def page_views(
    events: DataFrame,
    heartbeat_s: int = 10,
    carried: Sequence[str] = tuple(PAGE_VIEW_FIRST),
) -> DataFrame:
    """One row per page view, added up from its pings.

    Engaged time is the number of pings times the heartbeat; absolute time the
    whole seconds between first and last ping; scroll depths are maxima.
    """
    us = epoch_micros(events, "collector_tstamp")
    rolled = (
        events.withColumn("_us", us)
        .groupBy("page_view_id")
        .agg(
            first_of(["collector_tstamp", "event_id"], carried).alias("_first"),
            F.min("collector_tstamp").alias("start_tstamp"),
            F.max("collector_tstamp").alias("end_tstamp"),
            (F.count(F.lit(1)) * heartbeat_s).alias("engaged_time_in_s"),
            F.expr(f"(max(_us) - min(_us)) div {MICROS}").alias("absolute_time_in_s"),
            F.max("vertical_percentage").alias("vertical_percentage_scrolled"),
            F.max("horizontal_percentage").alias("horizontal_percentage_scrolled"),
        )
    )
    return rolled.select("page_view_id", "_first.*", *[c for c in rolled.columns if c not in ("page_view_id", "_first")])


def session_cells(
    rows: DataFrame, user: str, ts: str, gap_s: int, cell_s: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with their time cell, and the cells with session number and offset.

    A new session starts when a user was idle for ``gap_s`` or longer.
    """
    cell_s = cell_s or max(1, gap_s // 30)
    if cell_s > gap_s:
        raise ValueError("a cell must not be wider than the gap")
    width = cell_s * MICROS
    placed = rows.withColumn("_us", epoch_micros(rows, ts))
    placed = placed.withColumn("_cell", F.expr(f"(_us - pmod(_us, {width})) div {width}"))
    by_time = Window.partitionBy("_user").orderBy("_in_cell")
    known = placed.where(F.col(user).isNotNull() & F.col("_us").isNotNull())
    cells = known.groupBy(F.col(user).alias("_user"), F.col("_cell").alias("_in_cell")).agg(
        F.min("_us").alias("_first_us"), F.max("_us").alias("_last_us"), F.count(F.lit(1)).alias("_n")
    )
    idle = F.col("_first_us") - F.lag("_last_us").over(by_time)
    cells = cells.withColumn("_opens", F.when(idle < gap_s * MICROS, 0).otherwise(1))
    cells = cells.withColumn("domain_sessionidx", F.sum("_opens").over(by_time))
    in_session = Window.partitionBy("_user", "domain_sessionidx").orderBy("_in_cell")
    cells = cells.withColumn(
        "_before", F.coalesce(F.sum("_n").over(in_session.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    return placed, cells


def sessionize(
    rows: DataFrame,
    user: str = "domain_userid",
    ts: str = "start_tstamp",
    tie: str = "page_view_id",
    gap_s: int = 1800,
    cell_s: int | None = None,
    index_name: str = "page_view_in_session_index",
) -> DataFrame:
    """Add the session number per user, a session id and the position in the session.

    The rows are shuffled once, by (user, cell). That one partitioning serves
    the position within the cell and the join with the cell table. Rows without
    a user or a time stay in the result, without session.
    """
    placed, cells = session_cells(rows, user, ts, gap_s, cell_s)
    in_cell = Window.partitionBy(user, "_cell").orderBy("_us", tie)
    local = placed.withColumn("_local", F.row_number().over(in_cell))
    slim = cells.select("_user", "_in_cell", "domain_sessionidx", "_before")
    joined = local.join(slim, (F.col(user) == F.col("_user")) & (F.col("_cell") == F.col("_in_cell")), "left")
    return joined.select(
        *rows.columns,
        F.col("domain_sessionidx").cast("bigint").alias("domain_sessionidx"),
        F.concat(F.col(user).cast("string"), F.lit("-"), F.col("domain_sessionidx").cast("string")).alias(
            "domain_sessionid"
        ),
        (F.col("_before") + F.col("_local")).cast("bigint").alias(index_name),
    )


def session_bounds(
    rows: DataFrame, user: str, ts: str, gap_s: int, cell_s: int | None = None
) -> DataFrame:
    """Start, end and size of each session, read off the cells: the rows themselves never move."""
    _, cells = session_cells(rows, user, ts, gap_s, cell_s)
    return cells.groupBy(F.col("_user").alias(user), F.col("domain_sessionidx").cast("bigint").alias("domain_sessionidx")).agg(
        F.min("_first_us").alias("start_us"), F.max("_last_us").alias("end_us"), F.sum("_n").alias("events")
    )


def sessions(views: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """One row per session from sessionized page views."""
    carried = carried or [
        "mkt_source", "mkt_medium", "mkt_campaign", "geo_country", "geo_region", "geo_city", "device_family", "os_family",
    ]
    order = ["start_tstamp", "page_view_id"]
    rolled = views.groupBy("domain_userid", "domain_sessionid", "domain_sessionidx").agg(
        F.min("start_tstamp").alias("start_tstamp"),
        F.max("end_tstamp").alias("end_tstamp"),
        F.sum("engaged_time_in_s").alias("engaged_time_in_s"),
        F.count(F.lit(1)).alias("page_views"),
        first_of(order, ["page_title", *carried]).alias("_first"),
        last_of(order, ["page_title"]).alias("_last"),
    )
    return rolled.select(
        "domain_userid", "domain_sessionid", "domain_sessionidx", "start_tstamp", "end_tstamp",
        "engaged_time_in_s", "page_views",
        F.col("_first.page_title").alias("first_page_title"),
        F.col("_last.page_title").alias("last_page_title"),
        *[F.col(f"_first.{c}").alias(c) for c in carried],
    )


USER_FIRST = ["refr_urlhost", "refr_medium", "mkt_source", "mkt_medium", "mkt_campaign", "mkt_term"]


def users(views: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """One row per user from sessionized page views, with first-touch source columns.

    One aggregate, combined on the map side: of a user with very many views each
    task sends one row. It gives what ``users_of_sessions`` gives for the sessions.
    """
    carried = carried or USER_FIRST
    order = ["start_tstamp", "page_view_id"]
    rolled = views.groupBy("domain_userid").agg(
        F.min("start_tstamp").alias("start_tstamp"),
        F.max("end_tstamp").alias("end_tstamp"),
        F.sum("engaged_time_in_s").alias("engaged_time_in_s"),
        F.count(F.lit(1)).alias("page_views"),
        F.max("domain_sessionidx").alias("sessions"),
        first_of(order, ["page_title", *carried]).alias("_first"),
        last_of(order, ["page_title"]).alias("_last"),
    )
    return rolled.select(
        "domain_userid", "start_tstamp", "end_tstamp", "engaged_time_in_s", "page_views", "sessions",
        F.col("_first.page_title").alias("first_page_title"),
        F.col("_last.page_title").alias("last_page_title"),
        *[F.col(f"_first.{c}").alias(c) for c in carried],
    )


def users_with_opening(
    views: DataFrame, opening: Sequence[str], gap_s: int = 1800, cell_s: int | None = None, carried: Sequence[str] | None = None
) -> DataFrame:
    """What ``users`` gives, from page views that are not in sessions yet, and the ``opening`` columns of the user's first view.

    The first view in time opens the first session, and the number of sessions
    follows from the time cells, so views are not numbered, and move as one row
    per user and task. Rows of users without any dated view have no session and
    are left out, and so is the row of views without a user. ``views`` is read twice.
    """
    carried = carried or USER_FIRST
    order = ["start_tstamp", "page_view_id"]
    dated = F.when(F.col("start_tstamp").isNotNull(), F.struct(*order))
    rolled = views.where(F.col("domain_userid").isNotNull()).groupBy("domain_userid").agg(
        F.sum("engaged_time_in_s").alias("engaged_time_in_s"),
        F.count(F.lit(1)).alias("page_views"),
        first_of(order, ["page_title", *carried]).alias("_first"),
        F.min_by(F.struct(*opening), dated).alias("_opening"),
    )
    _, cells = session_cells(views.select("domain_userid", "start_tstamp"), "domain_userid", "start_tstamp", gap_s, cell_s)
    counted = cells.groupBy(F.col("_user").alias("domain_userid")).agg(F.sum("_opens").alias("sessions"))
    return rolled.join(counted, "domain_userid").select(
        "domain_userid", "engaged_time_in_s", "page_views", "sessions",
        F.col("_first.page_title").alias("first_page_title"),
        *[F.col(f"_first.{c}").alias(c) for c in carried],
        *[F.col(f"_opening.{c}").alias(c) for c in opening],
    )


def users_of_sessions(table: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """One row per user from sessions that carry the given columns: what opened the first one and closed the last one."""
    carried = carried or USER_FIRST
    order = ["domain_sessionidx"]
    rolled = table.groupBy("domain_userid").agg(
        F.min("start_tstamp").alias("start_tstamp"),
        F.max("end_tstamp").alias("end_tstamp"),
        F.sum("engaged_time_in_s").alias("engaged_time_in_s"),
        F.sum("page_views").alias("page_views"),
        F.max("domain_sessionidx").alias("sessions"),
        first_of(order, ["first_page_title", *carried]).alias("_first"),
        last_of(order, ["last_page_title"]).alias("_last"),
    )
    return rolled.select(
        "domain_userid", "start_tstamp", "end_tstamp", "engaged_time_in_s", "page_views", "sessions",
        F.col("_first.first_page_title").alias("first_page_title"),
        F.col("_last.last_page_title").alias("last_page_title"),
        *[F.col(f"_first.{c}").alias(c) for c in carried],
    )


def user_journey(table: DataFrame, user_id: str) -> DataFrame:
    """All rows of one user in time order: the filter reaches the scan."""
    return table.where(F.col("domain_userid") == user_id).orderBy("start_tstamp")
