"""Roll-ups over events and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_activity(events: DataFrame, ts: str, user: str) -> DataFrame:
    """Unique users and events per day.

    Rows are first counted per (day, user), on the map side as far as
    possible, so neither a busy day nor a busy user ends up in one task.
    """
    per_user = events.groupBy(F.to_date(ts).alias("day"), user).agg(F.count(F.lit(1)).alias("_n"))
    return per_user.groupBy("day").agg(F.count(user).alias("users"), F.sum("_n").alias("events"))


def distinct_per_group(df: DataFrame, groups: Sequence[str], counted: str, name: str) -> DataFrame:
    """Distinct values per group, through one row per (group, value)."""
    pairs = df.groupBy(*groups, counted).agg(F.lit(1).alias("_one"))
    return pairs.groupBy(*groups).agg(F.count(counted).alias(name))


def class_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).count()


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, in one scan; null without positives."""
    negatives = F.count_if(F.col(label) == 0)
    positives = F.count_if(F.col(label) == 1)
    return df.agg(F.try_divide(negatives.cast("double"), positives.cast("double")).alias("ratio"))


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def top_values(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The k most frequent values of each column; ties go to the smaller value.

    All columns are counted in one scan. The fan-out happens before a map-side
    count, so what is shuffled is one row per distinct value and task.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    counted = df.select(pairs.alias("_p")).select("_p.*").where("value IS NOT NULL").groupBy("column", "value").count()
    ranked = Window.partitionBy("column").orderBy(F.col("count").desc(), "value")
    return counted.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def histogram(df: DataFrame, value: Column, by: str, low: float | None, high: float | None, bins: int) -> DataFrame:
    """Rows per equal-width bin (from 0) and class; the top edge belongs to the last bin.

    With equal edges all values are in bin 0. Null and NaN, and with them all
    rows if there are no edges, have the bin null.
    """
    real = ~F.isnan(value.cast("double"))
    width = (high - low) / bins if low is not None and high is not None else None
    if width is None:
        number = F.lit(None)
    elif width == 0:
        number = F.when(real, 0)
    else:
        number = F.when(real, F.least(F.floor((value - low) / width), F.lit(bins - 1)))
    return df.groupBy(number.cast("int").alias("bin"), by).agg(F.count(F.lit(1)).alias("rows"))


def value_range(df: DataFrame, value: str) -> tuple[float | None, float | None]:
    """Smallest and largest value, null and NaN left out; nothing without values."""
    real = F.when(~F.isnan(F.col(value).cast("double")), F.col(value))
    row = df.agg(F.min(real).alias("low"), F.max(real).alias("high")).first()
    return row["low"], row["high"]


def largest(df: DataFrame, by: str, n: int, *tie: str) -> DataFrame:
    """The n rows with the largest value: each task keeps n rows, no full sort."""
    return df.orderBy(F.col(by).desc(), *tie).limit(n)
