"""The first-touch gold table: one row per user with features and label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.functions.scores import flag
from touchline.sources.tables import write_table

# The columns that the gold table takes from the first view.
FIRST_VIEW_COLUMNS = [
    "absolute_time_in_s", "vertical_percentage_scrolled", "geo_country", "geo_region",
    "br_lang", "device_family", "os_family",
]

# The columns of the gold table, in their order.
GOLD_COLUMNS = [
    "domain_userid", "first_page_title", "refr_urlhost", "refr_medium", "mkt_medium", "mkt_source",
    "mkt_term", "mkt_campaign", "engaged_time_in_s", "sessions", "page_views", "absolute_time_in_s",
    "vertical_percentage_scrolled", "geo_country", "geo_region", "br_lang", "device_family",
    "os_family", "converted_user",
]


def first_views(views: DataFrame, tie: str = "page_view_id") -> DataFrame:
    """The first session-opening page view of each user.

    Spark cuts to one row per user on the map side before it shuffles
    (WindowGroupLimit), so a user with very many views costs no more than others.
    """
    by_user = Window.partitionBy("domain_userid").orderBy("start_tstamp", tie)
    opening = views.where(F.col("page_view_in_session_index") == 1)
    ranked = opening.withColumn("rn", F.row_number().over(by_user)).where("rn = 1")
    return ranked.select("domain_userid", *FIRST_VIEW_COLUMNS)


def conversions(converted: DataFrame) -> DataFrame:
    """One flag per user; repeated entries would otherwise multiply users."""
    return converted.groupBy("domain_userid").agg(F.max("converted").alias("converted"))


def first_touch(users: DataFrame, views: DataFrame, converted: DataFrame) -> DataFrame:
    """Users with the features of their first view and a 0/1 conversion label.

    Users without a session-opening view are left out; numeric gaps become 0.
    """
    return first_touch_of_users(users.join(first_views(views), "domain_userid"), converted)


def first_touch_of_users(users: DataFrame, converted: DataFrame) -> DataFrame:
    """The same for users that have the columns of their first view already."""
    joined = (
        users.join(conversions(converted), "domain_userid", "left")
        .withColumn("refr_medium", F.lower("refr_medium"))
        .withColumn("mkt_medium", F.lower("mkt_medium"))
        .withColumn("converted_user", flag(F.col("converted")))
    )
    return joined.select(*GOLD_COLUMNS).na.fill(0)


def first_touch_raw(users: DataFrame, views: DataFrame, converted: DataFrame) -> DataFrame:
    """The variant with names as they came and a boolean label, gaps left as null."""
    columns = [c for c in GOLD_COLUMNS if c not in ("sessions", "page_views")]
    joined = (
        users.join(first_views(views), "domain_userid")
        .join(conversions(converted), "domain_userid", "left")
        .withColumn("converted_user", F.coalesce("converted", F.lit(False)))
    )
    return joined.select(*columns)


def create_gold_view(
    spark: SparkSession, users: str, page_views: str, converted: str, view: str = "gold_view"
) -> DataFrame:
    """The gold table over three catalogue tables, as a temporary view."""
    gold = first_touch(spark.read.table(users), spark.read.table(page_views), spark.read.table(converted))
    gold.createOrReplaceTempView(view)
    return gold


def build_gold_table(spark: SparkSession, users: str, page_views: str, converted: str, target: str) -> None:
    """Build the gold table from catalogue tables and replace the stored one."""
    write_table(create_gold_view(spark, users, page_views, converted), target)
