"""Expressions that hide or fingerprint personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pseudonym(value: Column, salt: str) -> Column:
    """A keyed one-way hash: equal inputs stay equal, null stays null."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def mask_address(address: Column) -> Column:
    """A dotted address without its last part."""
    return F.regexp_replace(address, r"\.\d+$", ".x")


def fingerprint(*columns: Column) -> Column:
    """One hash over the payload of an event.

    Absent and empty values give different fingerprints, and so do values
    moved from one column to the next: each part carries its own length.
    """
    parts = [
        F.when(c.isNull(), F.lit("-")).otherwise(
            F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))
        )
        for c in columns
    ]
    return F.sha2(F.concat(*parts), 256)
