"""Checks and clean-up between raw events and the bronze table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import web

# The accepted lawful bases for processing.
LAWFUL_BASES = ["consent", "contract", "legalObligation", "vitalInterests", "publicTask", "legitimateInterests"]

_CORRUPT = "_corrupt_record"


def parse_checked(df: DataFrame, raw: str, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """Add ``parsed`` and ``reason``; the reason is null for rows that fit the schema."""
    wide_schema = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(raw, wide_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    checked = df.withColumn("_parsed", parsed)
    reason = F.when(F.col(raw).isNull(), "empty").when(F.col(f"_parsed.{_CORRUPT}").isNotNull(), "does not fit schema")
    for name in required:
        reason = reason.when(F.col(f"_parsed.{name}").isNull(), f"missing {name}")
    fields = F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields])
    return checked.withColumns({"parsed": fields, "reason": reason}).drop("_parsed")


def split_by_schema(
    df: DataFrame, raw: str, schema: T.StructType, required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, with their fields; and rows that do not, with the raw text and a reason."""
    checked = parse_checked(df, raw, schema, required)
    others = [c for c in df.columns if c != raw]
    good = checked.where("reason IS NULL").select(*others, "parsed.*")
    bad = checked.where("reason IS NOT NULL").select(*others, raw, "reason")
    return good, bad


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``, then by its other columns; copies are dropped on the map side first."""
    rest = [c for c in df.columns if c not in keys]
    after = [c for c in rest if c not in order]
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, *after)).alias("_kept"))
    return kept.select(*keys, "_kept.*").select(*df.columns)


def without_bots(df: DataFrame, agent: str, bots: DataFrame | None = None) -> DataFrame:
    """Rows whose agent neither looks like a bot nor is on the list of known bots."""
    people = df.where(~web.is_bot(F.col(agent)))
    return people if bots is None else people.join(bots.select(agent).distinct(), agent, "left_anti")


def classify_referrer(df: DataFrame, host: str, hosts: DataFrame, own_hosts: Sequence[str] = ()) -> DataFrame:
    """Add ``refr_medium``: direct without a host, internal for own hosts, else from the host list."""
    known = hosts.groupBy(F.col("host").alias(host)).agg(F.min("medium").alias("_medium"))
    medium = (
        F.when(F.col(host).isNull(), "direct")
        .when(F.col(host).isin(list(own_hosts)), "internal")
        .otherwise(F.coalesce("_medium", F.lit("unknown")))
    )
    return df.join(known, host, "left").withColumn("refr_medium", medium).drop("_medium")


def latest_consent(consents: DataFrame, user: str, order: Sequence[str]) -> DataFrame:
    """The last consent state of each user."""
    latest = consents.groupBy(user).agg(F.max_by(F.struct("state", "basis"), F.struct(*order)).alias("_last"))
    return latest.select(user, "_last.*")


def with_lawful_basis(events: DataFrame, consents: DataFrame, user: str, order: Sequence[str]) -> DataFrame:
    """Events of users whose last consent state is granted, on an accepted basis."""
    latest = latest_consent(consents, user, order)
    allowed = latest.where((F.col("state") == "granted") & F.col("basis").isin(LAWFUL_BASES))
    return events.join(allowed.select(user), user, "left_semi")


def column_counters(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls and distinct values of each column, in one scan.

    Values are counted per (column, value) before the shuffle, so a value that
    fills a third of a column moves as one row per task.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    counted = df.select(cells.alias("_c")).select("_c.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy("column").agg(
        F.sum("_n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )


def rule_counters(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule; a rule that gives null counts as broken."""
    broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    return df.agg(F.count(F.lit(1)).alias("rows"), *broken)
