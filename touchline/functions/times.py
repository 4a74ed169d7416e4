"""Time expressions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = 1_000_000


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column of either kind.

    Zone-free timestamps are taken apart field by field, so that the result
    does not depend on the session time zone.
    """
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        seconds = F.unix_date(F.to_date(col)) * F.lit(86400).cast("bigint") + F.hour(col) * 3600 + F.minute(col) * 60
        return seconds * MICROS + (F.extract(F.lit("SECOND"), col) * MICROS).cast("bigint")
    return F.unix_micros(col)


def at_micros(df: DataFrame, name: str, micros: int) -> Column:
    """A constant of the column's own kind, which a scan can use to skip files."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        moment = datetime(1970, 1, 1) + timedelta(microseconds=micros)
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.timestamp_micros(F.lit(micros))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """1 is Sunday, 7 is Saturday."""
    return F.dayofweek(ts)
