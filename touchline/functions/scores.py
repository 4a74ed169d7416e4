"""Expressions over scores, labels and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Highest decile code of each label, the rest is "High".
LOW_UP_TO = 7
MEDIUM_UP_TO = 8


def propensity_label(decile: Column) -> Column:
    """Low for the lowest 80 % of scores, Medium for the next 10 %, High on top.

    No decile, no label.
    """
    return (
        F.when(decile.isNull(), F.lit(None).cast("string"))
        .when(decile <= LOW_UP_TO, "Low")
        .when(decile <= MEDIUM_UP_TO, "Medium")
        .otherwise("High")
    )


def above_half(probability: Column, threshold: float = 0.5) -> Column:
    """1 when the probability lies above the threshold, 0 when at or below it."""
    return F.when(probability > threshold, 1).when(probability <= threshold, 0)


def flag(value: Column) -> Column:
    """A boolean as 0/1, with absent meaning false."""
    return F.coalesce(value, F.lit(False)).cast("int")


def hash_number(key: Column, salt: str = "") -> Column:
    """A stable whole number below 16 ** 8 per key: the same in every run, order and cluster."""
    text = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_percent(key: Column, salt: str = "") -> Column:
    """A stable number 0-99 per key."""
    return (hash_number(key, salt) % 100).cast("int")


def hash_fraction(key: Column, salt: str) -> Column:
    """A stable number in [0, 1) per key."""
    return hash_number(key, salt).cast("double") / F.lit(float(16**8))
