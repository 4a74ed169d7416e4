"""Minority oversampling on mixed columns (SMOTE-NC, Chawla et al. 2002)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.scores import hash_fraction
from touchline.operators.joins import join_unique
from touchline.operators.neighbours import k_nearest
from touchline.operators.ordering import hash_slice, ordinals
from touchline.sources.tables import staged


def _most_common(values: Column) -> Column:
    """The most frequent entry of an array; ties go to the smaller one."""
    counted = F.transform(
        F.array_distinct(values),
        lambda v: F.struct((-F.size(F.filter(values, lambda x: x == v))).alias("n"), v.alias("value")),
    )
    return F.array_min(counted)["value"]


def _part(pool: str, i: int) -> Column:
    """The i-th category of every row in the pool."""
    return F.transform(pool, lambda p: p["cat"][i])


def smote_nc(
    df: DataFrame,
    key: str,
    label: str,
    continuous: Sequence[str],
    categorical: Sequence[str],
    k: int = 5,
    seed: str = "0",
    group_rows: int = 2000,
) -> DataFrame:
    """The rows plus synthetic positives, so that both classes are equally large.

    Each synthetic row lies between a positive row and one of its k nearest
    positive neighbours; its categories are the most common among the k. All
    choices are drawn from hashes of the key, so a rerun gives the same rows.
    Call it on training rows only, with gaps filled. Synthetic keys read
    ``<key>~<number>``.
    """
    columns = [key, label, *continuous, *categorical]
    rows = df.select(
        F.col(key).cast("string").alias(key), F.col(label).cast("int").alias(label),
        *[F.col(c).cast("double").alias(c) for c in continuous], *[F.col(c).cast("string").alias(c) for c in categorical],
    )
    sizes = rows.agg(F.count_if(F.col(label) == 1).alias("few"), F.count_if(F.col(label) == 0).alias("many")).first()
    few, needed = sizes["few"], sizes["many"] - sizes["few"]
    if few < 2 or needed <= 0:
        return rows

    positives = rows.where(F.col(label) == 1)
    spread = positives.agg(F.array_sort(F.array(*[F.stddev_pop(c) for c in continuous])).alias("s")).first()["s"]
    middle = len(spread) // 2
    median = spread[middle] if len(spread) % 2 else (spread[middle - 1] + spread[middle]) / 2

    shaped = positives.select(
        F.col(key).alias("_key"), F.array(*continuous).alias("cont"), F.array(*categorical).cast("array<string>").alias("cat")
    )
    shaped = staged(shaped.withColumn("point_id", F.sha2(F.to_json(F.struct("cont", "cat")), 256)), "positives")
    points = staged(
        shaped.groupBy("point_id").agg(
            F.any_value("cont").alias("cont"), F.any_value("cat").alias("cat"), F.count(F.lit(1)).alias("copies")
        ),
        "points",
    )
    near = k_nearest(points, k, median * median, group_rows)

    # Per point the k slots to draw from: its own copies first, then its neighbours with theirs.
    found = near.groupBy("point_id").agg(
        F.array_sort(F.collect_list(F.struct("distance", "near_id", "near_cont", "near_cat", "near_copies"))).alias("_near")
    )
    own = F.array_repeat(
        F.struct(F.col("cont"), F.col("cat")), F.least(F.col("copies") - 1, F.lit(k)).cast("int")
    )
    others = F.flatten(
        F.transform(
            F.coalesce("_near", F.array().cast(_near_type(near))),
            lambda p: F.array_repeat(
                F.struct(p["near_cont"].alias("cont"), p["near_cat"].alias("cat")), F.least(p["near_copies"], F.lit(k)).cast("int")
            ),
        )
    )
    pools = points.join(found, "point_id", "left").select(
        "point_id", F.slice(F.concat(own, others), 1, k).alias("_pool")
    )

    # Every positive serves needed // few times; the first by hash serve once more.
    cut = shaped.withColumns({"_hash": F.md5("_key"), "_cut": hash_slice(F.col("_key"), few)})
    dealt = ordinals(cut, [], "_cut", ["_hash", "_key"], "_position")
    times = F.lit(needed // few) + (F.col("_position") <= needed % few).cast("int")
    drawn = (
        join_unique(dealt.where(times > 0), pools, "point_id")
        .withColumn("_no", F.explode(F.sequence(F.lit(1).cast("bigint"), times)))
        .withColumn("_id", F.concat_ws("~", "_key", F.col("_no").cast("string")))
    )
    choice = F.floor(hash_fraction(F.col("_id"), f"pick{seed}") * F.size("_pool")).cast("int")
    drawn = drawn.withColumns({"_other": F.get("_pool", choice), "_gap": hash_fraction(F.col("_id"), f"gap{seed}")})
    made = drawn.select(
        F.col("_id").alias(key),
        F.lit(1).alias(label),
        *[
            (F.col("cont")[i] + F.col("_gap") * (F.col("_other.cont")[i] - F.col("cont")[i])).alias(c)
            for i, c in enumerate(continuous)
        ],
        *[_most_common(_part("_pool", i)).alias(c) for i, c in enumerate(categorical)],
    )
    return rows.select(*columns).unionByName(made)


def _near_type(near: DataFrame) -> str:
    """The array type that ``collect_list`` gives for neighbour rows."""
    fields = ["distance", "near_id", "near_cont", "near_cat", "near_copies"]
    return f"array<struct<{','.join(f'{c}:{near.schema[c].dataType.simpleString()}' for c in fields)}>>"
