"""Approximate k nearest neighbours over mixed columns, with work in proportion to the points.

Every point takes part in a fixed number of tables. A table orders the points
by a hash of some of their categories, then along a random direction of the
continuous columns, and cuts that order into groups of even size. Points are
compared within groups; the best of all tables are kept. Tables use few to
all of the categories, so near points that differ in one or two of them, or
that a cut parts in one table, meet in others. Groups cannot grow: what is
ordered are distinct points, and ties are broken by a hash. With as many
points as one group holds the result is exact; ``tests/test_models.py`` finds
a recall above 0.9 for many groups.

The distance is that of SMOTE-NC (Chawla et al. 2002): squared differences of
the continuous columns, plus a fixed penalty per category that differs.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The functions below travel to the executors as they are: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLES = 12
#: Cuts of a table that come to the driver; groups beyond that number are counted off within a slice.
MOST_CUTS = 4_096
_PAIR = "point_id string, distance double, near_id string, near_cont array<double>, near_cat array<string>, near_copies bigint"


def nearest(queries: pd.DataFrame, points: pd.DataFrame, k: int, penalty: float) -> pd.DataFrame:
    """The k nearest other points of each query point, within the given points."""
    if len(queries) == 0 or len(points) == 0:
        return pd.DataFrame(columns=["point_id", "distance", "near_id", "near_cont", "near_cat", "near_copies"])
    p_cont, p_cat = np.stack(points["cont"].to_numpy()), _codes(points, queries)
    q_cat = p_cat[len(points) :]
    p_cat = p_cat[: len(points)]
    q_cont = np.stack(queries["cont"].to_numpy())
    p_ids, q_ids = points["point_id"].to_numpy(), queries["point_id"].to_numpy()
    found = []
    step = max(1, 4_000_000 // len(points))
    for start in range(0, len(queries), step):
        stop = min(start + step, len(queries))
        d = np.zeros((stop - start, len(points)))
        for axis in range(p_cont.shape[1]):
            d += (q_cont[start:stop, axis, None] - p_cont[None, :, axis]) ** 2
        for axis in range(p_cat.shape[1]):
            d += penalty * (q_cat[start:stop, axis, None] != p_cat[None, :, axis])
        d[q_ids[start:stop, None] == p_ids[None, :]] = np.inf
        width = min(k, len(points))
        # Equal distances are settled by id, so the choice does not depend on the cells.
        edge = np.partition(d, width - 1, axis=1)[:, width - 1]
        for row in range(stop - start):
            near = np.flatnonzero((d[row] <= edge[row]) & np.isfinite(d[row]))
            near = near[np.lexsort((p_ids[near], d[row, near]))][:k]
            found.append((np.full(len(near), start + row), near, d[row, near]))
    rows = np.concatenate([f[0] for f in found])
    near = np.concatenate([f[1] for f in found])
    picked = points.iloc[near]
    return pd.DataFrame(
        {
            "point_id": q_ids[rows],
            "distance": np.concatenate([f[2] for f in found]),
            "near_id": picked["point_id"].to_numpy(),
            "near_cont": picked["cont"].to_numpy(),
            "near_cat": picked["cat"].to_numpy(),
            "near_copies": picked["copies"].to_numpy(),
        }
    )


def _codes(points: pd.DataFrame, queries: pd.DataFrame) -> np.ndarray:
    """Category texts of both frames as numbers, points first."""
    texts = [list(c) for c in points["cat"]] + [list(c) for c in queries["cat"]]
    table = np.array(texts, dtype=object).reshape(len(texts), -1)
    columns = [pd.factorize(table[:, i], use_na_sentinel=False)[0] for i in range(table.shape[1])]
    return np.stack(columns, axis=1) if columns else np.zeros((len(texts), 0), dtype=int)


def table_key(table: int, spread: list[float], categories: int) -> Column:
    """The order of one table: a hash of some categories, and within it a place between 0 and 1 along a direction."""
    rng = np.random.default_rng(table)
    some = rng.permutation(categories)[: round(categories * (table % TABLES + 1) / TABLES)]
    hashed = F.pmod(F.xxhash64(F.lit(table), *[F.get("cat", F.lit(int(i))) for i in some]), F.lit(1 << 20)).cast("double")
    along = F.lit(0.0)
    for axis, (weight, width) in enumerate(zip(rng.normal(size=len(spread)), spread)):
        along = along + F.get("cont", F.lit(axis)) * float(weight / width)
    tie = F.pmod(F.xxhash64(F.lit(table), "point_id"), F.lit(1 << 20)) / float(1 << 50)
    return hashed + 1 / (1 + F.exp(-along / 4)) + tie


def k_nearest(points: DataFrame, k: int, penalty: float, group_rows: int = 2000, tables: int = TABLES) -> DataFrame:
    """(point_id, distance, near_id, near_cont, near_cat, near_copies): about the k nearest others per point.

    ``points`` holds distinct points: point_id, cont, cat, copies. It is read
    several times, so pass a written table. Distances are squared. Each point
    is shuffled ``tables`` times, whatever the number of points.
    """
    shape = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("cont")).alias("cont"), F.max(F.size("cat")).alias("cat")).first()
    n, groups = shape["n"], max(1, -(-shape["n"] // group_rows))
    if groups == 1:
        tables = 1
    axes = range(shape["cont"] or 0)
    widths = points.agg(*[F.stddev_pop(F.get("cont", F.lit(i))).alias(f"s{i}") for i in axes]).first() if axes else []
    keys = [f"_key{t}" for t in range(tables)]
    spread = [float(w) or 1.0 for w in widths]
    keyed = points.select("point_id", "cont", "cat", "copies", *[table_key(t, spread, shape["cat"] or 0).alias(c) for t, c in enumerate(keys)])
    # Coarse cuts come to the driver, at most MOST_CUTS per table; they steer the work only.
    slices = min(groups, MOST_CUTS)
    probs = [i / slices for i in range(1, slices)]
    cuts = keyed.agg(*[F.percentile_approx(c, probs, 20 * slices).alias(c) for c in keys]).first() if probs else {c: [] for c in keys}
    cutter = Bucketizer(
        inputCols=keys,
        outputCols=[f"_group{t}" for t in range(tables)],
        splitsArray=[[float("-inf"), *(sorted(set(cuts[c])) or [0.0]), float("inf")] for c in keys],
    )
    dealt = cutter.transform(keyed) if probs else keyed.withColumn("_group0", F.lit(0.0))
    seats = [F.struct(F.lit(t).alias("table"), F.col(f"_group{t}").cast("int").alias("slice"), F.col(c).alias("at")) for t, c in enumerate(keys)]
    seated = dealt.select("point_id", "cont", "cat", "copies", F.explode(F.array(*seats)).alias("seat")).select("*", "seat.*").drop("seat")
    if groups > slices:
        # Fine groups follow the order within a slice, which one task can hold: a few thousandths of the points.
        place = F.row_number().over(Window.partitionBy("table", "slice").orderBy("at", "point_id"))
        seated = seated.withColumn("group", F.floor((place - 1) / group_rows).cast("int"))
    else:
        seated = seated.withColumn("group", F.lit(0))
    seated = seated.drop("at")

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        return nearest(pdf, pdf, k, penalty)

    found = seated.groupBy("table", "slice", "group").applyInPandas(inside, _PAIR)
    once = found.dropDuplicates(["point_id", "near_id"])
    order = Window.partitionBy("point_id").orderBy("distance", "near_id")
    return once.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")
