from conftest import rows
from pyspark.sql import functions as F

from touchline.operators import drift


def payloads(spark, data):
    df = spark.createDataFrame(data, "id int, day string, raw string").withColumn("day", F.to_date("day"))
    return drift.with_variant(df, "raw", "v")


DATA = [
    (1, "2024-01-01", '{"k": 1, "name": "a"}'),
    (2, "2024-01-02", '{"k": 2}'),
    (3, "2024-01-02", '{"k": "3", "extra": {"x": 1.5}}'),
    (4, "2024-01-03", '{"k": "four", "extra": null}'),
    (5, "2024-01-03", "[1, 2]"),
    (6, "2024-01-03", "nonsense"),
    (7, "2024-01-03", None),
    (8, "2024-01-03", '{"k": 5, "name": "b"}'),
]


def test_changes(spark):
    found = drift.changes(drift.field_types(payloads(spark, DATA), "day", "v"))
    got = {(str(r.day), r.field, r.type): (r.rows, r.change) for r in found.collect()}
    assert got == {
        ("2024-01-02", "k", "STRING"): (1, "retyped"),
        ("2024-01-02", "extra", "OBJECT<x: DECIMAL(2,1)>"): (1, "new"),
        ("2024-01-03", "extra", "VOID"): (1, "retyped"),
        ("2024-01-03", drift.NOT_AN_OBJECT, "ARRAY<BIGINT>"): (1, "new"),
        ("2024-01-03", drift.NOT_AN_OBJECT, "VOID"): (2, "new"),
    }


def test_fields_of_old_and_new_rows(spark):
    df = payloads(spark, DATA)
    read = df.select(
        "id",
        drift.read_field("v", "$.k", ["int", "string"]),
        drift.read_field("v", "$.extra.x", ["double"]),
        drift.read_field("v", "$.name", ["string"], F.lit("none")),
    )
    assert rows(read, "id") == [
        (1, 1, None, "a"), (2, 2, None, "none"), (3, 3, 1.5, "none"), (4, None, None, "none"),
        (5, None, None, "none"), (6, None, None, "none"), (7, None, None, "none"), (8, 5, None, "b"),
    ]


def test_schema_of_a_day(spark):
    whole = payloads(spark, [r for r in DATA if r[0] in (1, 2, 3)])
    got = {str(r.day): r.schema for r in drift.daily_schema(whole, "day", "v").collect()}
    assert got["2024-01-01"] == "OBJECT<k: BIGINT, name: STRING>"
    assert "k: VARIANT" in got["2024-01-02"] and "extra: OBJECT<x: DECIMAL(2,1)>" in got["2024-01-02"]


def test_no_rows(spark):
    assert rows(drift.changes(drift.field_types(payloads(spark, []), "day", "v"))) == []
