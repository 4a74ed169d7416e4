import random

from conftest import rows
from pyspark.sql import functions as F

from touchline.operators import joins as J


def skewed(spark):
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id"
    )


def test_heavy_keys(spark):
    hot = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert J.heavy_keys(skewed(spark), "k", 0.01) == [hot]
    assert J.heavy_keys(skewed(spark).where("false"), "k") == []


def test_join_unique_equals_plain_join(spark):
    big = skewed(spark)
    unique = spark.createDataFrame([("hot", 1), ("k1", 2), ("k5", 3), ("gone", 4)], "k string, x int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got, want = J.join_unique(big, unique, "k", how), big.join(unique, "k", how)
        assert rows(got, "id") == rows(want, "id"), how


def test_join_unique_with_another_integer_type(spark):
    big = spark.range(300).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    unique = spark.createDataFrame([(7, "seven"), (9, "nine")], "k int, x string")
    assert rows(J.join_unique(big, unique, "k"), "id") == rows(big.join(unique, "k"), "id")


def test_heavy_rows_are_not_shuffled(spark):
    unique = spark.range(5).select(F.col("id").cast("string").alias("k"))
    plan = J.join_unique(skewed(spark), unique, "k")._jdf.queryExecution().simpleString()
    assert "BroadcastHashJoin" in plan and "Union" in plan


def test_range_lookup_equals_brute_force(spark):
    rng = random.Random(3)
    edges = sorted(rng.sample(range(2**20), 40))
    spans = [(edges[i], edges[i + 1] - rng.randint(0, 3), f"r{i}") for i in range(0, 40, 2)]
    values = [rng.randrange(2**20) for _ in range(500)] + [s[0] for s in spans] + [s[1] for s in spans] + [None]
    ranges = spark.createDataFrame(spans, "low bigint, high bigint, name string")
    data = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint")
    for bits in (4, 10, 16):
        got = J.range_lookup(data, ranges, "v", "low", "high", ["name"], bucket_bits=bits)
        want = [(i, v, next((n for lo, hi, n in spans if v is not None and lo <= v <= hi), None)) for i, v in enumerate(values)]
        assert rows(got.select("id", "v", "name"), "id") == want


def test_nested_ranges_give_the_innermost(spark):
    spans = [(0, 1000, "wide"), (100, 200, "inner"), (150, 160, "core"), (150, 400, "late"), (70_000, 140_000, "far"), (9, 3, "empty")]
    ranges = spark.createDataFrame(spans, "low bigint, high bigint, name string")
    values = [0, 99, 100, 149, 150, 155, 160, 161, 200, 201, 400, 401, 500, 1000, 1001, 70_000, 131_072, 140_000, 140_001, -5]

    def innermost(v):
        held = [(lo, -hi, n) for lo, hi, n in spans if lo <= v <= hi]
        return max(held)[2] if held else None

    for bits in (6, 16):
        got = J.range_lookup(spark.createDataFrame([(v,) for v in values], "v int"), ranges, "v", "low", "high", ["name"], bits)
        assert rows(got, "v") == sorted((v, innermost(v)) for v in values)


def test_lookup_leaves_the_rows_in_place(spark):
    ranges = spark.createDataFrame([(0, 10, "a")], "low bigint, high bigint, name string")
    got = J.range_lookup(spark.range(100), ranges, "id", "low", "high", ["name"])
    got.collect()
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_event_existence(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("c",)], "u string")
    events = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), ("x", 9)], "u string, t int")
    assert rows(J.who_did(parent, events, "u"), "u") == [("a",), ("b",)]
    assert rows(J.who_never_did(parent, events, "u")) == [("c",)]
    assert rows(J.when_first_did(parent, events, "u", "t", "first"), "u") == [("a", 1), ("b", 2)]
