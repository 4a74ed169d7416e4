"""How the given tables stand in for a web-event feed.

``events`` becomes the wide event table, ``customer``/``nation``/``region``
give the geography. The columns are SQL text that, but for ``pick``, reads the
same to Spark and to the checking engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_GAP_S = 6 * 3600
PURCHASES_TO_CONVERT = 16
CITY = "n_name || ' ' || CAST(c_custkey % 7 AS STRING)"

# Sample user agents, picked by k % 6.
AGENTS = [
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) Version/16.0 Safari/604.1",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/110.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 13_2) Version/16.3 Safari/605.1.15",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:109.0) Firefox/110.0",
    "Mozilla/5.0 (Linux; Android 13) Chrome/110.0 Mobile Safari/537.36",
    "Mozilla/5.0 (compatible; Searchbot/2.1; crawler)",
]


def pick(index: str, values: list[str | None], engine: str = "spark") -> str:
    """SQL text that picks a value by ``index % len(values)``.

    In Spark the index is worked out once (``elt``), which matters when the
    optimizer puts the expression into a filter.
    """
    if engine == "spark":
        entries = ", ".join("CAST(NULL AS STRING)" if v is None else f"'{v}'" for v in values)
        return f"elt({index} % {len(values)} + 1, {entries})"
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {index} % {len(values)} {arms} END"


def wide_columns(engine: str = "spark") -> dict[str, str]:
    """Name and SQL text of each column of the wide event table."""
    return {
        "event_id": "event_id",
        "collector_tstamp": "ts",
        "domain_userid": "CAST(user_id AS STRING)",
        "customer_key": "user_id",
        "event_type": "event_type",
        "k": "k",
        "app_id": "CASE WHEN k < 80 THEN 'website' ELSE 'mobile' END",
        "login_id": "CASE WHEN event_type = 'signup' THEN 'u' || CAST(user_id % 97 AS STRING) END",
        "domain_sessionid": (
            "CAST(user_id AS STRING) || '-' || CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING)"
        ),
        "page_view_id": (
            "CAST(user_id AS STRING) || '-' || CAST(year(ts) * 1000000 + month(ts) * 10000 "
            "+ day(ts) * 100 + hour(ts) - hour(ts) % 2 AS STRING)"
        ),
        "page_title": pick("k", ["Home", "Pricing", "Get Started", "Blog", "Docs"], engine),
        "page_urlpath": pick("k", ["/", "/pricing/", "/get-started/", "/blog/", "/docs/"], engine)
        + " || CASE WHEN k % 2 = 0 THEN 'a' ELSE 'b' END",
        "refr_urlhost": pick("k", ["search.example.com", "social.example.com", None], engine),
        "refr_medium": pick("k", ["Search", "Social", None], engine),
        "mkt_medium": pick("k", ["CPC", None, "Email", None], engine),
        "mkt_source": "CASE WHEN k % 2 = 0 THEN " + pick("k", ["google", "newsletter", "partner"], engine) + " END",
        "mkt_campaign": "CASE WHEN k % 2 = 0 THEN 'camp-' || CAST(k % 7 AS STRING) END",
        "mkt_term": "CASE WHEN k % 4 = 0 THEN 'term-' || CAST(k % 6 AS STRING) END",
        "br_lang": pick("k", ["en", "de", "fr", "es"], engine),
        "device_family": pick("k", ["iPhone", "Windows PC", "Mac"], engine),
        "os_family": pick("k", ["iOS", "Windows", "macOS"], engine),
        "useragent": pick("k", AGENTS, engine),
        "vertical_percentage": "k",
        "horizontal_percentage": "(k * 7) % 101",
        "ip": "(user_id * 2654435761 + k * 40503) % 4294967296",
    }


TARGET_URL = "https://console.example.com/"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, without geography."""
    raw = read(spark, sf_dir, "events").selectExpr(
        "*", "CAST(get_json_object(props, '$.k') AS INT) AS k"
    )
    return raw.selectExpr(*[f"{text} AS {name}" for name, text in wide_columns().items()])


def with_geography(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add country, region and a made-up city from the customer's nation; apply it to as few rows as possible."""
    geography = (
        read(spark, sf_dir, "customer")
        .join(read(spark, sf_dir, "nation"), _same("c_nationkey", "n_nationkey"))
        .join(read(spark, sf_dir, "region"), _same("n_regionkey", "r_regionkey"))
        .selectExpr("c_custkey AS customer_key", "n_name AS geo_country", "r_name AS geo_region", f"{CITY} AS geo_city")
    )
    return rows.join(geography, "customer_key", "left")


def _same(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an entity array (absent, empty, one or two entries) and an event struct."""
    wide = wide_events(spark, sf_dir)
    entry = F.struct("device_family", "useragent")
    other = F.struct(F.lit("Other").alias("device_family"), F.lit("none").alias("useragent"))
    no_entry = F.array().cast("array<struct<device_family:string,useragent:string>>")
    context = (
        F.when(F.col("k") % 10 == 0, None)
        .when(F.col("k") % 10 == 1, no_entry)
        .when(F.col("k") % 10 == 2, F.array(entry, other))
        .otherwise(F.array(entry))
    )
    target = F.when(F.col("k") % 3 == 0, TARGET_URL).otherwise("https://docs.example.com/")
    click = F.when(F.col("event_type") == "click", F.struct(target.alias("target_url")))
    return wide.withColumns({"contexts_ua": context, "unstruct_link_click": click})


def converted_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with enough purchases; only converted users are listed."""
    bought = read(spark, sf_dir, "events").where("event_type = 'purchase'")
    return (
        bought.groupBy("user_id")
        .count()
        .where(f"count > {PURCHASES_TO_CONVERT}")
        .selectExpr("CAST(user_id AS STRING) AS domain_userid", "true AS converted")
    )
