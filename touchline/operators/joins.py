"""Joins: default after left join, event existence, range lookup, very common keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, share: float = 0.001) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows: no more than 1 / share of them.

    One pass with a frequent-items sketch of fixed size: nothing is shuffled by key.
    """
    most = int(1 / share)
    row = (
        df.select(F.col(key).alias("_key"))
        .where("_key IS NOT NULL")
        .agg(F.expr(f"approx_top_k(xxhash64(_key), {most}, {10 * most})").alias("top"), F.count(F.lit(1)).alias("n"))
        .first()
    )
    return [item["item"] for item in row["top"] if item["count"] > share * row["n"]]


def join_unique(rows: DataFrame, unique: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join with a table that holds a key at most once, when some keys may hold very many rows.

    Rows of heavy keys stay where they are and meet a broadcast of those keys
    alone, which the definition of heavy bounds to about a thousand rows. All
    other rows take the usual shuffled join. For inner, left, left_semi and
    left_anti joins. ``rows`` is read once more to find the heavy keys.

    Without adaptive execution, or where the rows come out of an aggregate or
    window by the same key, nothing else splits such a key. Elsewhere the plain
    join does, and reads ``rows`` once.
    """
    heavy = heavy_keys(rows, key)
    if not heavy:
        return rows.join(unique, key, how)
    # The hash depends on the type, so both sides hash the type of ``rows``.
    is_heavy = F.col(key).isNotNull() & F.xxhash64(F.col(key).cast(rows.schema[key].dataType)).isin(heavy)
    hot = rows.where(is_heavy).join(F.broadcast(unique.where(is_heavy)), key, how)
    return hot.unionByName(rows.where(~is_heavy).join(unique.where(~is_heavy), key, how))


def with_related(parent: DataFrame, related: DataFrame, key: str) -> DataFrame:
    """The parent rows with the columns of a related table, null where there is none."""
    return parent.join(related, key, "left")


def with_flag(parent: DataFrame, flags: DataFrame, key: str, name: str) -> DataFrame:
    """A boolean from a list that may hold a key several times or not at all."""
    once = flags.groupBy(key).agg(F.max(name).alias(name))
    return parent.join(once, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def who_did(parent: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Parent rows with at least one event.

    Events are cut to one row per key on the map side, so a key that holds most of
    them is small; the shuffle of that step is the one that the join needs.
    """
    return parent.join(events.select(key).distinct(), key, "left_semi")


def who_never_did(parent: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Parent rows without any event."""
    return parent.join(events.select(key).distinct(), key, "left_anti")


def when_first_did(parent: DataFrame, events: DataFrame, key: str, ts: str, name: str) -> DataFrame:
    """Parent rows with the time of their first event; others are left out.

    Events are cut to one row per key before the join.
    """
    firsts = events.groupBy(key).agg(F.min(ts).alias(name))
    return parent.join(firsts, key)


def disjoint_ranges(ranges: DataFrame, low: str, high: str, carried: Sequence[str], bucket_bits: int) -> DataFrame:
    """(key, from, to, range): the ranges cut into pieces that neither overlap nor leave their bucket.

    Where ranges overlap, the one that starts last has the piece, and of those
    the shortest: for nested ranges the innermost. All ranges of a bucket of
    2 ** bucket_bits numbers meet in one row.
    """
    bucket = F.explode(F.sequence(F.shiftright(F.col(low), bucket_bits), F.shiftright(F.col(high), bucket_bits)))
    first = F.greatest(F.col(low), F.shiftleft(F.col("bucket"), bucket_bits))
    last = F.least(F.col(high), F.shiftleft(F.col("bucket") + 1, bucket_bits) - 1)
    inner = F.struct(F.col(low).alias("start"), (-F.col(high)).alias("end"), F.struct(*carried).alias("range"))
    cut = ranges.where(F.col(low) <= F.col(high)).withColumn("bucket", bucket)
    cut = cut.groupBy("bucket").agg(F.collect_list(F.struct(first.alias("a"), last.alias("b"), inner.alias("inner"))).alias("all"))
    edges = F.array_sort(F.array_distinct(F.concat(F.transform("all", lambda r: r["a"]), F.transform("all", lambda r: r["b"] + 1))))
    parted = cut.withColumn("edges", edges).select("bucket", "all", "edges", F.posexplode("edges").alias("i", "from"))
    holding = F.filter("all", lambda r: (r["a"] <= F.col("from")) & (r["b"] >= F.col("from")))
    best = F.array_max(F.transform(holding, lambda r: r["inner"]))
    pieces = parted.select("bucket", "from", (F.get("edges", F.col("i") + 1) - 1).alias("to"), best.alias("best"))
    return pieces.where("best IS NOT NULL").select(_bucket_key(F.col("bucket")), "from", "to", F.col("best.range").alias("range"))


def _bucket_key(bucket: Column) -> Column:
    """A bucket as a join key. Hashed, so that the pieces are shuffled for the join; only then can Spark split a common one."""
    return F.xxhash64(bucket.cast("bigint")).alias("key")


def range_lookup(
    rows: DataFrame,
    ranges: DataFrame,
    value: str,
    low: str,
    high: str,
    carried: Sequence[str],
    bucket_bits: int = 16,
) -> DataFrame:
    """Left join on ``low <= value <= high``; of several ranges the innermost.

    The ranges are cut into disjoint pieces in buckets of 2 ** bucket_bits
    neighbouring numbers, a lookup table. Rows meet the pieces of their bucket
    by an equality and keep the one that holds them. A table that is small
    enough in bytes is broadcast by Spark, and the rows do not move; otherwise
    adaptive execution splits a bucket that many rows share. Large spans cost
    one piece per bucket, which the width of the value space bounds.
    """
    pieces = disjoint_ranges(ranges, low, high, carried, bucket_bits)
    number = F.col(value).cast("bigint")
    holds = (_bucket_key(F.shiftright(number, bucket_bits)) == F.col("_key")) & (number >= F.col("_from")) & (number <= F.col("_to"))
    named = pieces.select(*[F.col(c).alias(f"_{c}") for c in ("key", "from", "to", "range")])
    return rows.join(named, holds, "left").select(*rows.columns, *[F.col(f"_range.{c}").alias(c) for c in carried])
