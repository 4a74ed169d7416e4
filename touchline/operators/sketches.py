"""Distinct users and quantiles over any span, from one small stored row per day.

A day's users become a theta sketch and an HLL sketch, its values a KLL sketch.
Sketches of days merge into those of weeks, months or campaigns, so a longer
span reads its days' rows and no events. Theta sketches also give the users that
two groups share or that only one has.

Sketches are built in parts and merged, so a busy day is no single task. Their
size is bounded by a parameter and does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: log2 of the entries of a theta sketch: a standard error of 1 / sqrt(2 ** n), 0.8 %. Up to that many users it is exact.
THETA_LOG2 = 14
#: log2 of the registers of an HLL sketch: a standard error of 0.8 / sqrt(2 ** n).
HLL_LOG2 = 14
#: Accuracy of a KLL sketch; see ``rank_error``.
KLL_K = 800


def rank_error(k: int = KLL_K) -> float:
    """Share of the values by which the rank of a quantile may be off, at 99 % confidence (Karnin, Lang, Liberty 2016; the published fit for its sketch)."""
    return 2.296 / k**0.9021


# ---- users --------------------------------------------------------------------


def daily_user_sketches(events: DataFrame, ts: str, user: str, by: Sequence[str] = ()) -> DataFrame:
    """(day, *by, events, theta, hll): one row per day and group. A null user counts as an event and as nobody."""
    return events.groupBy(F.to_date(ts).alias("day"), *by).agg(
        F.count(F.lit(1)).alias("events"),
        F.theta_sketch_agg(F.col(user), F.lit(THETA_LOG2)).alias("theta"),
        F.hll_sketch_agg(F.col(user), F.lit(HLL_LOG2)).alias("hll"),
    )


def _month(day: Column) -> Column:
    return F.date_trunc("month", day).cast("date")


def store_daily(sketches: DataFrame, path: str) -> None:
    """Add days to the stored sketches, in one folder per month. A day may be written in several pieces, which merge like days do."""
    sketches.withColumn("month", _month(F.col("day"))).repartition("month").write.mode("append").partitionBy("month").parquet(path)


def stored_daily(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored sketches of the days from ``first`` to ``last``; other months' files are not opened."""
    found = spark.read.parquet(path)
    if first is not None:
        day = F.lit(first).cast("date")
        found = found.where((F.col("month") >= _month(day)) & (F.col("day") >= day))
    if last is not None:
        day = F.lit(last).cast("date")
        found = found.where((F.col("month") <= _month(day)) & (F.col("day") <= day))
    return found.drop("month")


def merged_users(daily: DataFrame, span: Column, by: Sequence[str] = ()) -> DataFrame:
    """(span, *by, events, users, users_hll) per span of days, from their sketches alone."""
    merged = daily.groupBy(span.alias("span"), *by).agg(
        F.sum("events").alias("events"), F.theta_union_agg("theta", F.lit(THETA_LOG2)).alias("_theta"), F.hll_union_agg("hll", F.lit(True)).alias("_hll")
    )
    return merged.select("span", *by, "events", F.theta_sketch_estimate("_theta").alias("users"), F.hll_sketch_estimate("_hll").alias("users_hll"))


def compared_users(daily: DataFrame, by: str, one: str, other: str) -> DataFrame:
    """One row: users of group ``one``, of group ``other``, of both, of either, and of ``one`` only, over all the days given.

    A group without rows has no users.
    """
    each = [F.theta_union_agg(F.when(F.col(by) == name, F.col("theta")), F.lit(THETA_LOG2)).alias(alias) for name, alias in ((one, "_a"), (other, "_b"))]
    both = daily.where(F.col(by).isin(one, other)).agg(*each)
    size = F.theta_sketch_estimate
    return both.select(
        size("_a").alias("one"),
        size("_b").alias("other"),
        size(F.theta_intersection("_a", "_b")).alias("both"),
        size(F.theta_union("_a", "_b", F.lit(THETA_LOG2))).alias("either"),
        size(F.theta_difference("_a", "_b")).alias("one_only"),
    )


# ---- quantiles -----------------------------------------------------------------


def daily_value_sketches(rows: DataFrame, ts: str, value: str, k: int = KLL_K) -> DataFrame:
    """(day, n, kll): one row per day over the values that are neither null nor NaN."""
    number = F.col(value).cast("double")
    real = rows.select(F.to_date(ts).alias("day"), number.alias("_value")).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    return real.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_value", F.lit(k)).alias("kll"))


def merged_edges(daily: DataFrame, shares: Sequence[float], k: int = KLL_K) -> DataFrame:
    """(number, share, edge): quantiles over all the days given, from their sketches alone. No rows without days."""
    merged = daily.agg(F.kll_merge_agg_double("kll", F.lit(k)).alias("_kll"), F.sum("n").alias("_n")).where("_n > 0")
    each = F.array(
        *[
            F.struct(F.lit(i + 1).alias("number"), F.lit(s).alias("share"), F.kll_sketch_get_quantile_double("_kll", F.lit(s)).alias("edge"))
            for i, s in enumerate(shares)
        ]
    )
    return merged.select(F.inline(each))


def with_decile(rows: DataFrame, value: str, edges: DataFrame, name: str = "decile") -> DataFrame:
    """Add the number of edges below the value, 0 to the number of edges; null for null and NaN.

    The edges are a handful of numbers, so they go to the rows as constants.
    """
    known = sorted(r["edge"] for r in edges.select("edge").collect())
    number = F.col(value).cast("double")
    below = F.size(F.filter(F.lit(known).cast("array<double>"), lambda e: e < number))
    return rows.withColumn(name, F.when(number.isNotNull() & ~F.isnan(number), below))
