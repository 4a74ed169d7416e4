"""Scans, projections, filters, joins, aggregates, windows, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.functions import privacy, scores, times, web
from touchline.operators import aggregates as A
from touchline.operators import features as X
from touchline.operators import joins as J
from touchline.operators import ordering as O
from touchline.operators import sessions as S
from touchline.plans import bindings as B
from touchline.plans.gold import first_views
from touchline.sources.tables import first_rows
from workload import ctes, inputs
from workload.registry import query

# ---- projections and filters ----------------------------------------------


@query("SELECT * FROM events ORDER BY event_id LIMIT 10")
def first_events(spark, sf):
    return first_rows(inputs.read(spark, sf, "events"), 10, "event_id")


@query(
    "SELECT c_custkey AS domain_userid, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer"
)
def project_user_columns(spark, sf):
    return inputs.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("domain_userid"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


@query(f"WITH {ctes.WIDE_CTE} SELECT event_id, collector_tstamp, event_type FROM wide WHERE domain_userid = '7' AND app_id = 'website'")
def filter_by_user_and_app(spark, sf):
    wide = inputs.wide(spark, sf)
    mine = wide.where((F.col("domain_userid") == "7") & (F.col("app_id") == "website"))
    return mine.select("event_id", "collector_tstamp", "event_type")


@query(
    f"WITH {ctes.NESTED_CTE} SELECT event_id, domain_userid FROM nested "
    f"WHERE unstruct_link_click.target_url = '{B.TARGET_URL}' AND app_id = 'website'"
)
def filter_on_nested_field(spark, sf):
    nested = B.nested_events(spark, sf)
    clicked = (F.col("unstruct_link_click.target_url") == B.TARGET_URL) & (F.col("app_id") == "website")
    return nested.where(clicked).select("event_id", "domain_userid")


@query(f"WITH {ctes.WIDE_CTE} SELECT event_id, page_urlpath FROM wide WHERE page_urlpath LIKE '/get-started/%'")
def filter_by_path_prefix(spark, sf):
    wide = inputs.wide(spark, sf)
    return wide.where(F.col("page_urlpath").like("/get-started/%")).select("event_id", "page_urlpath")


@query(
    f"WITH {ctes.NESTED_CTE} SELECT event_id, contexts_ua[1].device_family AS device_family, "
    "contexts_ua[1].useragent AS useragent FROM nested"
)
def first_entity_fields(spark, sf):
    nested = B.nested_events(spark, sf)
    return nested.select(
        "event_id",
        F.get("contexts_ua.device_family", F.lit(0)).alias("device_family"),
        F.get("contexts_ua.useragent", F.lit(0)).alias("useragent"),
    )


@query("SELECT doc_id, CAST(quality AS DOUBLE) AS prediction FROM labels WHERE quality = 1")
def filter_on_prediction(spark, sf):
    scored = inputs.read(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("prediction"))
    return scored.where(F.col("prediction") == 1.0)


@query("SELECT doc_id, quality FROM labels WHERE toxic = 0")
def filter_by_text_condition(spark, sf):
    return inputs.read(spark, sf, "labels").filter("toxic = 0").select("doc_id", "quality")


@query(
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS large_order FROM orders"
)
def add_computed_column(spark, sf):
    orders = inputs.read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.withColumn("large_order", (F.col("o_totalprice") > 250000).cast("int"))


@query("SELECT o_orderstatus, o_orderpriority, o_totalprice FROM orders")
def choose_columns_by_type(spark, sf):
    orders = inputs.read(spark, sf, "orders").drop("o_orderkey", "o_custkey")
    return orders.select(*X.string_columns(orders), *X.other_columns(orders, ["o_orderdate"]))


@query(
    "WITH top AS (SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY count(*) DESC, CAST(c_nationkey AS VARCHAR) LIMIT 5) "
    "SELECT c_custkey, CASE WHEN c_nationkey IN (SELECT c_nationkey FROM top) THEN CAST(c_nationkey AS VARCHAR) "
    "ELSE 'Other' END AS nation FROM customer"
)
def replace_rare_values(spark, sf):
    customer = inputs.read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    kept = [row["value"] for row in A.top_values(customer, ["nation"], 5).select("value").collect()]
    return customer.withColumn("nation", F.when(F.col("nation").isin(kept), F.col("nation")).otherwise("Other"))


# ---- joins -----------------------------------------------------------------

_FIRST_VIEW_SQL = "SELECT * FROM views WHERE page_view_in_session_index = 1 QUALIFY row_number() OVER (PARTITION BY domain_userid ORDER BY start_tstamp, page_view_id) = 1"


@query(
    f"WITH {ctes.VIEWS_CTE} SELECT domain_userid, c_name, absolute_time_in_s, geo_country FROM customer "
    f"JOIN ({_FIRST_VIEW_SQL}) ON domain_userid = CAST(c_custkey AS VARCHAR)"
)
def users_with_first_view(spark, sf):
    users = inputs.read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("domain_userid"), "c_name")
    firsts = first_views(inputs.views(spark, sf))
    return users.join(firsts, "domain_userid").select("domain_userid", "c_name", "absolute_time_in_s", "geo_country")


@query(
    "SELECT c_custkey, coalesce(c.converted, false) AS converted FROM customer LEFT JOIN "
    "(SELECT DISTINCT user_id, true AS converted FROM events WHERE event_type = 'purchase') c ON user_id = c_custkey"
)
def left_join_with_default(spark, sf):
    bought = inputs.read(spark, sf, "events").where("event_type = 'purchase'")
    flags = bought.select(F.col("user_id").alias("c_custkey"), F.lit(True).alias("converted"))
    return J.with_flag(inputs.read(spark, sf, "customer").select("c_custkey"), flags, "c_custkey", "converted")


@query(
    "SELECT c_custkey, c_mktsegment, orders, spent FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS orders, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS spent FROM orders GROUP BY 1) ON o_custkey = c_custkey"
)
def join_related_model(spark, sf):
    orders = inputs.read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    spending = orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("spent"),
    )
    return J.with_related(inputs.read(spark, sf, "customer").select("c_custkey", "c_mktsegment"), spending, "c_custkey")


def _buyers(spark, sf):
    customer = inputs.read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return customer, inputs.read(spark, sf, "events").where("event_type = 'error' AND value > 100")


_ERRORS = "SELECT user_id, ts FROM events WHERE event_type = 'error' AND value > 100"


@query(f"SELECT c_custkey AS user_id, c_mktsegment FROM customer WHERE c_custkey IN (SELECT user_id FROM ({_ERRORS}))")
def users_who_did(spark, sf):
    return J.who_did(*_buyers(spark, sf), "user_id")


@query(f"SELECT c_custkey AS user_id, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM ({_ERRORS}))")
def users_who_never_did(spark, sf):
    return J.who_never_did(*_buyers(spark, sf), "user_id")


@query(
    "SELECT c_custkey AS user_id, c_mktsegment, first_error FROM customer JOIN "
    f"(SELECT user_id, min(ts) AS first_error FROM ({_ERRORS}) GROUP BY 1) ON user_id = c_custkey"
)
def users_when_first_did(spark, sf):
    parent, events = _buyers(spark, sf)
    return J.when_first_did(parent, events, "user_id", "ts", "first_error")


# Width of one nation's address range, and the unassigned tail of it.
_STEP, _GAP = 171798691, 20000000


@query(
    f"WITH {ctes.WIDE_CTE}, ranges AS (SELECT CAST(n_nationkey AS BIGINT) * {_STEP} AS low, "
    f"CAST(n_nationkey AS BIGINT) * {_STEP} + {_STEP - _GAP} AS high, n_name AS country FROM nation) "
    "SELECT event_id, ip, country FROM wide LEFT JOIN ranges ON ip BETWEEN low AND high"
)
def locate_addresses(spark, sf):
    key = F.col("n_nationkey").cast("bigint") * _STEP
    ranges = inputs.read(spark, sf, "nation").select(
        key.alias("low"), (key + (_STEP - _GAP)).alias("high"), F.col("n_name").alias("country")
    )
    events = inputs.wide(spark, sf).select("event_id", "ip")
    return J.range_lookup(events, ranges, "ip", "low", "high", ["country"])


# ---- aggregates ------------------------------------------------------------


@query(
    f"WITH {ctes.WIDE_CTE} SELECT CAST(collector_tstamp AS DATE) AS day, count(DISTINCT domain_userid) AS users, "
    "count(*) AS events FROM wide WHERE app_id = 'website' GROUP BY 1"
)
def daily_users_and_events(spark, sf):
    site = inputs.wide(spark, sf).where("app_id = 'website'")
    return A.daily_activity(site, "collector_tstamp", "domain_userid").orderBy("day")


@query(
    f"WITH {ctes.NESTED_CTE} SELECT contexts_ua[1].device_family AS device_family, "
    "contexts_ua[1].useragent AS browser_family, count(DISTINCT domain_sessionid) AS number_of_sessions "
    f"FROM nested WHERE unstruct_link_click.target_url = '{B.TARGET_URL}' AND app_id = 'website' "
    "GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 10"
)
def top_devices_by_sessions(spark, sf):
    clicked = (F.col("unstruct_link_click.target_url") == B.TARGET_URL) & (F.col("app_id") == "website")
    keyed = B.nested_events(spark, sf).where(clicked).select(
        F.get("contexts_ua.device_family", F.lit(0)).alias("device_family"),
        F.get("contexts_ua.useragent", F.lit(0)).alias("browser_family"),
        "domain_sessionid",
    )
    counted = A.distinct_per_group(keyed, ["device_family", "browser_family"], "domain_sessionid", "number_of_sessions")
    return A.largest(counted, "number_of_sessions", 10, "device_family", "browser_family")


@query("SELECT label, count(*) AS count FROM embeddings GROUP BY 1")
def rows_per_class(spark, sf):
    return A.class_counts(inputs.read(spark, sf, "embeddings"), "label")


@query(
    "SELECT CAST(count(*) FILTER (quality = 0) AS DOUBLE) / CAST(count(*) FILTER (quality = 1) AS DOUBLE) AS ratio FROM labels"
)
def class_imbalance(spark, sf):
    return A.class_ratio(inputs.read(spark, sf, "labels"), "quality")


@query("SELECT round(avg(o_totalprice), 4) AS o_totalprice FROM orders")
def column_mean(spark, sf):
    means = A.column_means(inputs.read(spark, sf, "orders"), ["o_totalprice"])
    return means.select(F.round("o_totalprice", 4).alias("o_totalprice"))


@query(
    f"WITH {ctes.WIDE_CTE}, pairs AS (SELECT unnest([{{'column': 'mkt_campaign', 'value': mkt_campaign}}, "
    "{'column': 'geo_country', 'value': geo_country}], recursive := true) FROM wide), "
    'counted AS (SELECT "column", value, count(*) AS count FROM pairs WHERE value IS NOT NULL GROUP BY ALL) '
    'SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS INTEGER) AS rank '
    "FROM counted QUALIFY rank <= 4"
)
def most_frequent_values(spark, sf):
    return A.top_values(inputs.located(spark, sf), ["mkt_campaign", "geo_country"], 4)


@query(
    "SELECT CAST(unnest(range(1, 10)) AS INTEGER) AS edge, "
    "round(unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])), 9) AS value FROM events"
)
def decile_edges(spark, sf):
    edges = O.decile_edges(inputs.read(spark, sf, "events"), "value")
    return spark.createDataFrame([(i + 1, round(e, 9)) for i, e in enumerate(edges)], "edge int, value double")


@query(
    "WITH r AS (SELECT min(value) AS low, max(value) AS high FROM events) "
    "SELECT CAST(least(floor((value - low) / ((high - low) / 100)), 99) AS INTEGER) AS bin, event_type, count(*) AS rows "
    "FROM events, r GROUP BY 1, 2"
)
def score_histogram(spark, sf):
    events = inputs.read(spark, sf, "events")
    low, high = A.value_range(events, "value")
    return A.histogram(events, F.col("value"), "event_type", low, high, 100)


# ---- windows ---------------------------------------------------------------


@query(f"WITH {ctes.VIEWS_CTE} SELECT domain_userid, page_view_id, start_tstamp FROM ({_FIRST_VIEW_SQL})")
def first_view_per_user(spark, sf):
    views = inputs.views(spark, sf).where("page_view_in_session_index = 1")
    by_user = Window.partitionBy("domain_userid").orderBy("start_tstamp", "page_view_id")
    ranked = views.withColumn("rn", F.row_number().over(by_user)).where("rn = 1")
    return ranked.select("domain_userid", "page_view_id", "start_tstamp")


@query(f"WITH {ctes.VIEWS_CTE} SELECT page_view_id, domain_sessionidx, page_view_in_session_index FROM views")
def view_position_in_session(spark, sf):
    return inputs.views(spark, sf).select("page_view_id", "domain_sessionidx", "page_view_in_session_index")


@query(
    "WITH gaps AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) "
    f"< {B.SESSION_GAP_S * 1000000} THEN 0 ELSE 1 END AS opens FROM events), "
    "numbered AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS domain_sessionidx FROM gaps) "
    "SELECT user_id, domain_sessionidx, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS events "
    "FROM numbered GROUP BY 1, 2"
)
def event_sessions(spark, sf):
    return S.session_bounds(inputs.read(spark, sf, "events"), "user_id", "ts", B.SESSION_GAP_S)


@query(
    f"WITH {ctes.WIDE_CTE} SELECT domain_userid, arg_min(page_title, collector_tstamp) AS first_page_title, "
    "arg_max(page_title, collector_tstamp) AS last_page_title, arg_min(event_type, collector_tstamp) AS first_event_type "
    "FROM wide GROUP BY 1"
)
def first_and_last_values(spark, sf):
    order = ["collector_tstamp", "event_id"]
    rolled = inputs.wide(spark, sf).groupBy("domain_userid").agg(
        S.first_of(order, ["page_title", "event_type"]).alias("first"), S.last_of(order, ["page_title"]).alias("last")
    )
    return rolled.select(
        "domain_userid",
        F.col("first.page_title").alias("first_page_title"),
        F.col("last.page_title").alias("last_page_title"),
        F.col("first.event_type").alias("first_event_type"),
    )


@query(
    "WITH e AS (SELECT quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM events) "
    "SELECT event_id, CAST(len(list_filter(edges, lambda x: x < value)) AS INTEGER) AS decile FROM events, e"
)
def score_deciles(spark, sf):
    events = inputs.read(spark, sf, "events").select("event_id", "value")
    edges = O.decile_edges(events, "value")
    return events.select("event_id", O.bin_code(F.col("value"), edges).alias("decile"))


# ---- sorts and set operations ---------------------------------------------


@query("SELECT event_id, ts, event_type FROM events WHERE user_id = 3 ORDER BY ts")
def journey_in_time_order(spark, sf):
    events = inputs.read(spark, sf, "events")
    return events.where("user_id = 3").select("event_id", "ts", "event_type").orderBy("ts")


@query(
    "SELECT p_brand, p_type, count(*) AS parts FROM part GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"
)
def sort_by_count_and_limit(spark, sf):
    counted = inputs.read(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("parts"))
    return A.largest(counted, "parts", 10, "p_brand", "p_type")


@query(
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 10"
)
def top_rows_of_segment(spark, sf):
    building = inputs.read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return A.largest(building.select("c_custkey", "c_acctbal"), "c_acctbal", 10, "c_custkey")


@query(
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' UNION ALL "
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 300000"
)
def union_all_rows(spark, sf):
    orders = inputs.read(spark, sf, "orders")
    left = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    right = orders.where("o_totalprice > 300000").select("o_custkey", "o_orderkey")
    return left.unionByName(right)


# ---- scalar functions ------------------------------------------------------


@query(
    f"WITH {ctes.WIDE_CTE} SELECT event_id, lower(refr_medium) AS refr_medium, lower(mkt_medium) AS mkt_medium, "
    "coalesce(k > 50, false) AS high, CAST(k > 50 AS INTEGER) AS high_int, CAST(collector_tstamp AS DATE) AS day, "
    "CAST(k AS DOUBLE) AS k_number FROM wide"
)
def text_flag_and_date_functions(spark, sf):
    wide = inputs.wide(spark, sf)
    high = F.col("k") > 50
    return wide.select(
        "event_id",
        F.lower("refr_medium").alias("refr_medium"),
        F.lower("mkt_medium").alias("mkt_medium"),
        F.ifnull(high, F.lit(False)).alias("high"),
        scores.flag(high).alias("high_int"),
        F.to_date("collector_tstamp").alias("day"),
        F.col("k").cast("double").alias("k_number"),
    )


@query(
    f"WITH {ctes.WIDE_CTE} SELECT event_id, mkt_term, coalesce(CASE WHEN k > 20 THEN k END, 0) AS k, "
    "CASE WHEN k > 30 THEN k > 40 END AS seen FROM wide"
)
def fill_numeric_gaps(spark, sf):
    wide = inputs.wide(spark, sf).select(
        "event_id", "mkt_term", F.when(F.col("k") > 20, F.col("k")).alias("k"),
        F.when(F.col("k") > 30, F.col("k") > 40).alias("seen"),
    )
    return wide.na.fill(0)


@query(
    f"WITH {ctes.RAW}, d AS (SELECT event_id, CASE WHEN k % 11 < 10 THEN k % 11 END AS decile, k / 100.0 AS p FROM raw) "
    "SELECT event_id, CASE WHEN decile IS NULL THEN NULL WHEN decile <= 7 THEN 'Low' WHEN decile <= 8 THEN 'Medium' "
    "ELSE 'High' END AS label, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS predicted FROM d"
)
def label_and_threshold(spark, sf):
    wide = inputs.wide(spark, sf)
    code = F.col("k") % 11
    return wide.select(
        "event_id",
        scores.propensity_label(F.when(code < 10, code)).alias("label"),
        scores.above_half(F.col("k") / 100).alias("predicted"),
    )


@query(
    "SELECT user_id, CAST(hour(min(ts)) AS INTEGER) AS first_hour, CAST(dayofweek(min(ts)) + 1 AS INTEGER) AS first_weekday "
    "FROM events GROUP BY 1"
)
def temporal_features(spark, sf):
    firsts = inputs.read(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("first"))
    return firsts.select(
        "user_id",
        times.hour_of_day(F.col("first")).alias("first_hour"),
        times.day_of_week(F.col("first")).alias("first_weekday"),
    )


@query(
    "SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, "
    "regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, "
    + "".join(f"nullif(regexp_extract(url, '[?&]utm_{c}=([^&#]*)', 1), '') AS mkt_{c}, " for c in ("source", "medium", "campaign", "term"))
    + "nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages"
)
def url_parts(spark, sf):
    url = F.col("url")
    return inputs.read(spark, sf, "pages").select(
        "page_id",
        web.url_host(url).alias("host"),
        web.url_path(url).alias("path"),
        *[c.alias(name) for name, c in web.campaign_columns(url).items()],
        F.try_parse_url(url, F.lit("QUERY"), F.lit("ref")).alias("ref"),
    )


@query(
    "SELECT c_custkey, sha256('pepper' || CAST(c_custkey AS VARCHAR)) AS pseudonym FROM customer"
)
def pseudonymise_ids(spark, sf):
    customer = inputs.read(spark, sf, "customer")
    return customer.select("c_custkey", privacy.pseudonym(F.col("c_custkey"), "pepper").alias("pseudonym"))


@query(
    "SELECT event_id, sha256(length(event_type) || ':' || event_type || length(CAST(user_id AS VARCHAR)) || ':' || "
    "CAST(user_id AS VARCHAR) || length(props) || ':' || props) AS fingerprint FROM events"
)
def event_fingerprints(spark, sf):
    events = inputs.read(spark, sf, "events")
    hashed = privacy.fingerprint(F.col("event_type"), F.col("user_id"), F.col("props"))
    return events.select("event_id", hashed.alias("fingerprint"))


# Made-up yearly exchange rates to one currency, for all years that orders have.
RATES = [
    ("EUR", 1995, 1.31), ("EUR", 1996, 1.27), ("EUR", 1997, 1.13), ("EUR", 1998, 1.11),
    ("EUR", 1999, 1.07), ("EUR", 2000, 0.92), ("EUR", 2001, 0.90),
    ("GBP", 1995, 1.58), ("GBP", 1996, 1.56), ("GBP", 1997, 1.64), ("GBP", 1998, 1.66),
    ("GBP", 1999, 1.62), ("GBP", 2000, 1.52), ("GBP", 2001, 1.44),
]
_RATES_SQL = ", ".join(f"('{c}', {y}, CAST({r} AS DOUBLE))" for c, y, r in RATES)


@query(
    f"WITH rates(currency, year, rate) AS (VALUES {_RATES_SQL}), "
    "priced AS (SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year, "
    "CASE o_custkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'USD' END AS currency FROM orders) "
    "SELECT o_orderkey, currency, round(CASE WHEN currency = 'USD' THEN o_totalprice ELSE o_totalprice * rate END, 4) AS usd "
    "FROM priced LEFT JOIN rates USING (currency, year)"
)
def convert_currency(spark, sf):
    rates = spark.createDataFrame(RATES, "currency string, year int, rate double")
    code = F.col("o_custkey") % 3
    priced = inputs.read(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
        F.when(code == 0, "EUR").when(code == 1, "GBP").otherwise("USD").alias("currency"),
    )
    usd = F.when(F.col("currency") == "USD", F.col("o_totalprice")).otherwise(F.col("o_totalprice") * F.col("rate"))
    joined = priced.join(rates, ["currency", "year"], "left")
    return joined.select("o_orderkey", "currency", F.round(usd, 4).alias("usd"))
