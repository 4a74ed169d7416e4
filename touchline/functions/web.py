"""Expressions over URLs, referrers, user agents and addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# First match wins, patterns are tried in this order.
DEVICE_PATTERNS = [
    ("iPhone", "iPhone"),
    ("iPad", "iPad"),
    ("Android", "Android"),
    ("Macintosh", "Mac"),
    ("Windows NT", "Windows PC"),
    ("Linux", "Linux PC"),
]
BROWSER_PATTERNS = [
    ("Edg/", "Edge"),
    ("Firefox/", "Firefox"),
    ("Chrome/", "Chrome"),
    ("Safari/", "Safari"),
]
BOT_PATTERN = "(?i)(bot|crawl|spider|slurp|preview)"

# Query-string keys of the campaign columns.
CAMPAIGN_KEYS = {
    "mkt_source": "utm_source",
    "mkt_medium": "utm_medium",
    "mkt_campaign": "utm_campaign",
    "mkt_term": "utm_term",
}


def first_match(text: Column, patterns: list[tuple[str, str]], otherwise: str = "Other") -> Column:
    """Name of the first pattern found in the text; null text gives null."""
    start = F.when(text.isNull(), F.lit(None).cast("string"))
    chain = reduce(lambda c, p: c.when(text.contains(p[0]), p[1]), patterns, start)
    return chain.otherwise(otherwise)


def device_family(agent: Column) -> Column:
    return first_match(agent, DEVICE_PATTERNS)


def browser_family(agent: Column) -> Column:
    return first_match(agent, BROWSER_PATTERNS)


def is_bot(agent: Column) -> Column:
    return F.coalesce(agent.rlike(BOT_PATTERN), F.lit(False))


def url_host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def url_path(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("PATH"))


def campaign_columns(url: Column) -> dict[str, Column]:
    """The campaign columns read from the query string of a landing URL."""
    return {
        name: F.try_parse_url(url, F.lit("QUERY"), F.lit(key)) for name, key in CAMPAIGN_KEYS.items()
    }
