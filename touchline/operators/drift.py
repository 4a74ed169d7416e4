"""Events whose fields come, go and change their type.

A payload is kept as VARIANT, which holds any JSON value with its own type. Old
and new rows are then read by one expression per field, and what changed is
reported by day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The type reported for a payload that is no JSON object.
NOT_AN_OBJECT = "(payload)"


def with_variant(rows: DataFrame, raw: str, name: str = "payload_variant") -> DataFrame:
    """Add the payload as VARIANT; null where the text is null or no JSON."""
    return rows.withColumn(name, F.try_parse_json(F.col(raw)))


def read_field(variant: str, path: str, types: Sequence[str], default: Column | None = None) -> Column:
    """A field in the first of the types, wherever a row holds it in a form that can be cast to one of them.

    ``types`` says what is tried, in order; the result has the first type. Values
    that fit none, and absent fields, give ``default`` or null.
    """
    tried = [F.try_variant_get(F.col(variant), path, t) for t in types]
    wanted = [tried[0], *[t.try_cast(types[0]) for t in tried[1:]]]
    return F.coalesce(*wanted, *([default] if default is not None else []))


def field_types(rows: DataFrame, day: str, variant: str) -> DataFrame:
    """(day, field, type, rows): the fields of each day's payloads with the types they had.

    Types are counted before they are shuffled. A payload that is null or no JSON counts as the type
    ``VOID`` of the field NOT_AN_OBJECT, one that is no object as its own type of that field.
    """
    whole = F.schema_of_variant(F.col(variant))
    is_object = F.coalesce(whole.startswith("OBJECT"), F.lit(False))
    # A variant's fields as a map of variants.
    fields = F.when(is_object, F.try_variant_get(F.col(variant), "$", "map<string, variant>"))
    each = F.transform(F.map_entries(fields), lambda e: F.struct(e["key"].alias("field"), F.schema_of_variant(e["value"]).alias("type")))
    other = F.array(F.struct(F.lit(NOT_AN_OBJECT).alias("field"), F.coalesce(whole, F.lit("VOID")).alias("type")))
    listed = rows.select(F.col(day).alias("day"), F.explode(F.when(is_object, each).otherwise(other)).alias("_f"))
    return listed.groupBy("day", F.col("_f.field").alias("field"), F.col("_f.type").alias("type")).agg(F.count(F.lit(1)).alias("rows"))


def daily_schema(rows: DataFrame, day: str, variant: str) -> DataFrame:
    """(day, schema): one schema that covers all payloads of the day."""
    return rows.groupBy(F.col(day).alias("day")).agg(F.schema_of_variant_agg(F.col(variant)).alias("schema"))


def changes(types: DataFrame) -> DataFrame:
    """(day, field, type, rows, change): fields that are ``new`` on a day, and types that a known field has for the first time (``retyped``).

    On the first day of all nothing is new. ``types`` is what ``field_types`` gives: as
    many rows as there are days, fields and types, not events.
    """
    by_field = Window.partitionBy("field")
    by_type = Window.partitionBy("field", "type")
    # Days times fields times types are few rows: one small window for the first day of all.
    seen = types.withColumns(
        {"_field_since": F.min("day").over(by_field), "_type_since": F.min("day").over(by_type), "_start": F.min("day").over(Window.partitionBy(F.lit(1)))}
    )
    change = F.when(F.col("day") == F.col("_start"), None).when(F.col("day") == F.col("_field_since"), "new").when(F.col("day") == F.col("_type_since"), "retyped")
    return seen.select("day", "field", "type", "rows", change.alias("change")).where("change IS NOT NULL")
