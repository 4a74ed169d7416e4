"""Running totals, ordinals and quantiles that do not need one big sort task.

A plain window without a partition key, or with a key that holds a third of
the rows, puts all those rows into one task. Here every ordered group is first
cut into slices along its order. Work inside a slice is an ordinary window
keyed by (group, slice); what the earlier slices contribute is a small table
of one row per (group, slice), added by a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor, isfinite, log

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a slice, and the number of slices from which on a caller's number is refused.
ROWS_PER_SLICE = 2_000_000
MOST_SLICES = 1_000_000


def slices_for(n: int) -> int:
    """So many slices that one holds ROWS_PER_SLICE rows; a few even for little data."""
    return max(64, ceil(n / ROWS_PER_SLICE))


def value_summary(df: DataFrame, name: str, slices: int | None = None) -> tuple[int, list[float]]:
    """Row count, gaps included, and slice bounds of a numeric column.

    The number of slices follows the row count, which is taken first, unless
    the caller gives one. The bounds come back to the driver as ``slices - 1``
    numbers at most. As fixed numbers they give the same slice to a row
    wherever it is recomputed.
    """
    n = df.count()
    slices = slices or slices_for(n)
    if slices > MOST_SLICES:
        raise ValueError(f"{slices} slices are more bounds than a driver should hold; {MOST_SLICES} at most")
    probs = [i / slices for i in range(1, slices)]
    value = F.col(name).cast("double")
    found = df.agg(F.percentile_approx(F.when(~F.isnan(value), value), probs, 20 * slices)).first()[0]
    return n, sorted({b for b in found or [] if isfinite(b)})


def with_slice(df: DataFrame, name: str, bounds: list[float], slice_name: str = "_slice") -> DataFrame:
    """Number the slice of each row; the number rises with the value."""
    if not bounds:
        return df.withColumn(slice_name, F.lit(0))
    bucketizer = Bucketizer(
        splits=[float("-inf"), *bounds, float("inf")], inputCol="_value", outputCol="_bucket"
    )
    cut = bucketizer.transform(df.withColumn("_value", F.col(name).cast("double")))
    return cut.withColumn(slice_name, F.col("_bucket").cast("int")).drop("_value", "_bucket")


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    bounds: list[float],
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<name>`` for each name: the total up to and with the row.

    ``df`` holds one row per value of ``order``, as left by a ``groupBy(order)``.
    """
    sliced = with_slice(df, order, bounds)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    within = Window.partitionBy("_slice").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.select("*", *[F.sum(c).over(within).alias(f"_local_{c}") for c in sums])

    # One row per slice, that is per ROWS_PER_SLICE rows: small enough for one task.
    slice_order = F.col("_slice").desc() if descending else F.col("_slice").asc()
    before = Window.orderBy(slice_order).rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy("_slice").agg(*[F.sum(c).alias(f"_total_{c}") for c in sums])
    offsets = totals.select(
        "_slice", *[F.coalesce(F.sum(f"_total_{c}").over(before), F.lit(0)).alias(f"_offset_{c}") for c in sums]
    )
    joined = local.join(offsets, "_slice")
    return joined.select(
        *df.columns, *[(F.col(f"_local_{c}") + F.col(f"_offset_{c}")).alias(f"cum_{c}") for c in sums]
    )


def ordinals(
    df: DataFrame,
    keys: Sequence[str],
    slice_name: str,
    order: Sequence[Column | str],
    name: str,
) -> DataFrame:
    """Row number within ``keys`` for rows that carry a slice column.

    ``slice_name`` must rise with ``order``. The slice counts are aggregated
    before they are shuffled, so only the rows themselves move, once.
    """
    keys = list(keys)
    within = Window.partitionBy(*keys, slice_name).orderBy(*order)
    local = df.withColumn("_local", F.row_number().over(within))
    counts = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(slice_name).alias("_s")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    by_slice = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]) if keys else Window
    before = by_slice.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    match = F.col(slice_name).eqNullSafe(F.col("_s"))
    for i, key in enumerate(keys):
        match = match & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(offsets, match)
    return joined.select(*df.columns, (F.col("_local") + F.col("_before")).cast("bigint").alias(name))


def exact_quantiles(df: DataFrame, name: str, probs: Sequence[float], slices: int | None = None) -> list[float]:
    """Exact quantiles with linear interpolation, without one task holding the column.

    Values are counted first, then ranked by running totals; only the rows at
    the wanted ranks (two per quantile) reach the driver. Null and NaN are left out.
    """
    values = df.select(F.col(name).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    n, bounds = value_summary(values, "_v", slices)
    if n == 0:
        return []
    positions = [p * (n - 1) for p in probs]
    ranks = sorted({r for p in positions for r in (floor(p), ceil(p))})
    counted = values.groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    running = running_totals(counted, "_v", ["_n"], bounds)
    wanted = F.array(*[F.lit(r).cast("bigint") for r in ranks])
    hits = F.filter(wanted, lambda r: (r >= F.col("cum__n") - F.col("_n")) & (r < F.col("cum__n")))
    found = running.select(F.explode(hits).alias("rank"), "_v").collect()
    at = {row["rank"]: row["_v"] for row in found}
    return [at[floor(p)] + (at[ceil(p)] - at[floor(p)]) * (p - floor(p)) for p in positions]


def decile_edges(df: DataFrame, score: str, bins: int = 10, slices: int | None = None) -> list[float]:
    """The inner edges that cut a score column into equally filled bins."""
    return exact_quantiles(df, score, [i / bins for i in range(1, bins)], slices)


def bin_code(score: Column, edges: Sequence[float]) -> Column:
    """Number of edges below the score: bins closed on the right, from 0. Null and NaN give null."""
    total = F.lit(0)
    for edge in edges:
        total = total + F.when(score > F.lit(float(edge)), 1).otherwise(0)
    return F.when(score.isNotNull() & ~F.isnan(score.cast("double")), total)


def hash_slice(key: Column, n: int) -> Column:
    """Leading hex digits of a key's hash: evenly filled slices of ROWS_PER_SLICE of ``n`` rows at most."""
    digits = max(1, ceil(log(max(n, 1) / ROWS_PER_SLICE, 16)))
    return F.substring(F.md5(key.cast("string")), 1, digits)
