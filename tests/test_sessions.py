from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline.operators import incremental
from touchline.operators import sessions as S

START = datetime(2024, 1, 1)
SCHEMA = "domain_userid string, start_tstamp timestamp_ntz, page_view_id string"


def views(spark, *entries):
    made = [(u, None if s is None else START + timedelta(seconds=s), v) for u, s, v in entries]
    return spark.createDataFrame(made, SCHEMA)


@pytest.mark.parametrize("cell", [1, 7, 60, 1800])
def test_gap_equal_below_and_above(spark, cell):
    df = views(spark, ("a", 0, "1"), ("a", 1799, "2"), ("a", 3599, "3"), ("a", 5398.9, "4"), ("a", 9000, "5"))
    got = S.sessionize(df, gap_s=1800, cell_s=cell).select(
        "page_view_id", "domain_sessionidx", "page_view_in_session_index"
    )
    # 1799 -> 3599 is idle for exactly the gap: a new session.
    assert rows(got, "page_view_id") == [("1", 1, 1), ("2", 1, 2), ("3", 2, 1), ("4", 2, 2), ("5", 3, 1)]


def test_ties_in_time_are_ordered_by_id(spark):
    df = views(spark, ("a", 5, "z"), ("a", 5, "b"), ("a", 5, "c"))
    got = S.sessionize(df).select("page_view_id", "page_view_in_session_index")
    assert rows(got, "page_view_id") == [("b", 1), ("c", 2), ("z", 3)]


def test_rows_without_user_or_time_stay(spark):
    df = views(spark, ("a", 5, "1"), (None, 5, "2"), ("a", None, "3"))
    got = S.sessionize(df).select("page_view_id", "domain_sessionid", "page_view_in_session_index")
    assert rows(got, "page_view_id") == [("1", "a-1", 1), ("2", None, None), ("3", None, None)]


def test_one_user_with_most_rows(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "busy").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("domain_userid"),
        F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("start_tstamp"),
        F.col("id").cast("string").alias("page_view_id"),
    )
    got = S.sessionize(df, gap_s=600).where("domain_userid = 'busy'")
    busy = got.agg(F.count(F.lit(1)), F.max("domain_sessionidx"), F.max("page_view_in_session_index"), F.countDistinct("page_view_in_session_index")).first()
    assert tuple(busy) == (13_333, 1, 13_333, 13_333)


def test_bounds_match_sessionized_rows(spark):
    df = views(spark, *[(u, (i * 977) % 50_000, f"{u}{i}") for u in "abc" for i in range(60)])
    detailed = S.sessionize(df).groupBy("domain_userid", "domain_sessionidx").agg(F.count(F.lit(1)).alias("events"))
    direct = S.session_bounds(df, "domain_userid", "start_tstamp", 1800).select("domain_userid", "domain_sessionidx", "events")
    assert rows(detailed, "domain_userid", "domain_sessionidx") == rows(direct, "domain_userid", "domain_sessionidx")


def test_cell_wider_than_gap_is_refused(spark):
    with pytest.raises(ValueError):
        S.sessionize(views(spark, ("a", 0, "1")), gap_s=10, cell_s=11)


@pytest.mark.parametrize(
    "late",
    [
        [("a", 3500, "x")],  # joins two sessions
        [("a", 100, "x")],  # inside an old session
        [("a", 99_000, "x"), ("new", 5, "y")],  # after the end, and an unknown user
        [("b", 0, "x")],
    ],
)
def test_late_events_give_the_same_as_a_full_run(spark, late):
    old = [("a", 0, "1"), ("a", 2000, "2"), ("a", 5000, "3"), ("a", 90_000, "4"), ("b", 10, "5"), ("c", 1, "6")]
    everything = views(spark, *old, *late)
    before = S.session_bounds(views(spark, *old), "domain_userid", "start_tstamp", 1800)
    fresh = incremental.refresh_sessions(before, everything, views(spark, *late), "domain_userid", "start_tstamp", 1800)
    full = S.session_bounds(everything, "domain_userid", "start_tstamp", 1800)
    order = ["domain_userid", "domain_sessionidx"]
    assert rows(fresh, *order) == rows(full, *order)


def test_refresh_keeps_untouched_keys(spark):
    table = spark.createDataFrame([("a", 1), ("b", 1)], "user string, n bigint")
    events = spark.createDataFrame([("a", 1), ("a", 2)], "user string, id bigint")
    new = events.where("id = 2")
    got = incremental.refresh(table, events, new, "user", lambda e: e.groupBy("user").agg(F.count(F.lit(1)).alias("n")))
    assert rows(got, "user") == [("a", 2), ("b", 1)]


def test_after_mark(spark):
    events = spark.createDataFrame([(1, 10), (2, 20)], "id int, arrived int")
    assert rows(incremental.after_mark(events, "arrived", 10)) == [(2, 20)]


def test_users_with_opening_equal_users_and_first_views(spark):
    schema = (
        "domain_userid string, page_view_id string, start_tstamp timestamp_ntz, end_tstamp timestamp_ntz, engaged_time_in_s bigint, "
        "page_title string, refr_urlhost string, br_lang string"
    )
    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    given = [
        ("a", "2", at(1), "late"), ("a", "1", at(1), "tie"), ("a", "3", at(1, 20), "same"), ("a", "4", at(5), "second"), ("a", "5", None, "undated"),
        ("b", "6", at(3), "only"), ("c", "7", None, "never dated"), (None, "8", at(2), "nobody"),
    ]
    views = spark.createDataFrame([(u, v, t, t, 10, title, title + ".host", title + "-x") for u, v, t, title in given], schema)
    numbered = S.sessionize(views, gap_s=1800)
    first = numbered.where("page_view_in_session_index = 1 AND domain_sessionidx = 1").select("domain_userid", "br_lang")
    columns = ["domain_userid", "engaged_time_in_s", "page_views", "sessions", "first_page_title", "refr_urlhost", "br_lang"]
    wanted = S.users(numbered, ["refr_urlhost"]).join(first, "domain_userid").select(columns)
    made = S.users_with_opening(views, ["br_lang"], gap_s=1800, carried=["refr_urlhost"])
    assert rows(made.select(columns), "domain_userid") == rows(wanted, "domain_userid")
    assert rows(made.select("domain_userid", "sessions", "br_lang"), "domain_userid") == [("a", 2, "tie-x"), ("b", 1, "only-x")]


def test_gold_moves_no_page_view_after_it_was_rolled_up(spark):
    from workload import inputs

    plan = inputs.gold(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan  # views are not numbered, so they need not meet
