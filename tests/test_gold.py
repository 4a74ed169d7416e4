from datetime import datetime

from conftest import rows

from touchline.plans.gold import GOLD_COLUMNS, build_gold_table, first_touch, first_touch_raw, first_views

VIEW = (
    "domain_userid string, page_view_id string, start_tstamp timestamp_ntz, page_view_in_session_index bigint, "
    "absolute_time_in_s bigint, vertical_percentage_scrolled int, geo_country string, geo_region string, br_lang string, "
    "device_family string, os_family string"
)
USER = (
    "domain_userid string, first_page_title string, refr_urlhost string, refr_medium string, mkt_medium string, mkt_source string, "
    "mkt_term string, mkt_campaign string, engaged_time_in_s bigint, sessions bigint, page_views bigint"
)
T = datetime(2024, 1, 1)


def view(user, view_id, index=1, seconds=5, at=T):
    return (user, view_id, at, index, seconds, None, "X", "Y", "en", "Mac", "macOS")


def user(name, engaged=1, medium="CPC"):
    return (name, "Home", None, "Search", medium, None, None, None, engaged, 1, 1)


def tables(spark):
    users = spark.createDataFrame([user("a"), user("b", None, None), user("no_view"), user("late_only")], USER)
    views = spark.createDataFrame(
        [view("a", "2", seconds=9), view("a", "1", seconds=7), view("a", "0", index=2), view("b", "3"), view("late_only", "4", index=2)],
        VIEW,
    )
    converted = spark.createDataFrame([("a", True), ("a", False), ("a", True), ("b", False)], "domain_userid string, converted boolean")
    return users, views, converted


def test_first_view_ties_go_to_the_smaller_id(spark):
    _, views, _ = tables(spark)
    assert rows(first_views(views).select("domain_userid", "absolute_time_in_s"), "domain_userid") == [("a", 7), ("b", 5)]


def test_gold(spark):
    gold = first_touch(*tables(spark))
    assert gold.columns == GOLD_COLUMNS
    got = rows(gold.select("domain_userid", "refr_medium", "mkt_medium", "engaged_time_in_s", "vertical_percentage_scrolled", "converted_user"), "domain_userid")
    # Repeated conversions do not multiply users; users without an opening view are left out;
    # numeric gaps become 0 while text gaps stay.
    assert got == [("a", "search", "cpc", 1, 0, 1), ("b", "search", None, 0, 0, 0)]


def test_raw_variant(spark):
    raw = first_touch_raw(*tables(spark))
    got = rows(raw.select("domain_userid", "refr_medium", "engaged_time_in_s", "converted_user"), "domain_userid")
    assert got == [("a", "Search", 1, True), ("b", "Search", None, False)]


def test_managed_gold_table_from_named_tables(spark):
    for name, df in zip(("t_users", "t_views", "t_converted"), tables(spark)):
        df.write.mode("overwrite").saveAsTable(name)
    for _ in range(2):
        build_gold_table(spark, "t_users", "t_views", "t_converted", "t_gold")
    assert spark.table("t_gold").count() == 2 and spark.table("gold_view").count() == 2
