"""Event quality, privacy, identity and incremental refresh."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import privacy, web
from touchline.operators import drift, identity, incremental, quality
from touchline.operators import sessions as S
from touchline.plans import bindings as B
from touchline.sources.tables import staged
from workload import ctes, inputs
from workload.registry import query

# Every seventh payload is broken: not JSON, or of the wrong type.
_RAW_SQL = (
    "SELECT event_id, CASE WHEN k % 14 = 0 THEN 'not json' WHEN k % 14 = 7 THEN '{\"k\": \"seven\"}' "
    "WHEN k % 14 = 3 THEN '{\"other\": 1}' ELSE props END AS payload, k FROM raw"
)


def _payloads(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    payload = (
        F.when(k % 14 == 0, "not json")
        .when(k % 14 == 7, '{"k": "seven"}')
        .when(k % 14 == 3, '{"other": 1}')
        .otherwise(F.col("props"))
    )
    return inputs.read(spark, sf, "events").select("event_id", payload.alias("payload"))


_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


@query(f"WITH {ctes.RAW}, p AS ({_RAW_SQL}) SELECT event_id, k FROM p WHERE k % 14 NOT IN (0, 3, 7)")
def events_that_fit_schema(spark, sf):
    return quality.split_by_schema(_payloads(spark, sf), "payload", _SCHEMA, ["k"])[0]


@query(
    f"WITH {ctes.RAW}, p AS ({_RAW_SQL}) SELECT event_id, payload, "
    "CASE WHEN k % 14 = 3 THEN 'missing k' ELSE 'does not fit schema' END AS reason FROM p WHERE k % 14 IN (0, 3, 7)"
)
def events_that_do_not_fit(spark, sf):
    return quality.split_by_schema(_payloads(spark, sf), "payload", _SCHEMA, ["k"])[1]


# From one day on k is a text, from another there is a new field, and some payloads are no objects.
_DRIFT_SQL = (
    "d AS (SELECT event_id, CAST(ts AS DATE) AS day, k, CASE WHEN k % 50 = 49 THEN '[1]' WHEN k % 50 = 48 THEN 'not json' "
    "WHEN ts >= TIMESTAMP '2024-01-20' THEN '{\"k\": \"' || k || '\", \"source\": {\"app\": ' || (k % 3) || '}}' "
    "WHEN ts >= TIMESTAMP '2024-01-10' THEN '{\"k\": ' || k || ', \"share\": 0.5}' ELSE props END AS payload FROM raw)"
)


def _drifting(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    text = k.cast("string")
    payload = (
        F.when(k % 50 == 49, "[1]")
        .when(k % 50 == 48, "not json")
        .when(F.col("ts") >= F.expr("timestamp_ntz'2024-01-20'"), F.concat(F.lit('{"k": "'), text, F.lit('", "source": {"app": '), (k % 3).cast("string"), F.lit("}}")))
        .when(F.col("ts") >= F.expr("timestamp_ntz'2024-01-10'"), F.concat(F.lit('{"k": '), text, F.lit(', "share": 0.5}')))
        .otherwise(F.col("props"))
    )
    rows = inputs.read(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"), payload.alias("payload"))
    return drift.with_variant(rows, "payload", "v")


@query(
    f"WITH {ctes.RAW}, {_DRIFT_SQL}, o AS (SELECT day, payload FROM d WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'), "
    "t AS (SELECT day, field, CASE json_type(payload, '$.' || field) WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' "
    "WHEN 'DOUBLE' THEN 'DECIMAL(1,1)' ELSE 'OBJECT<app: BIGINT>' END AS type FROM (SELECT day, payload, unnest(json_keys(payload)) AS field FROM o) "
    "UNION ALL SELECT day, '(payload)', CASE WHEN json_valid(payload) THEN 'ARRAY<BIGINT>' ELSE 'VOID' END FROM d "
    "WHERE NOT json_valid(payload) OR json_type(payload) <> 'OBJECT'), "
    "c AS (SELECT day, field, type, count(*) AS rows FROM t GROUP BY 1, 2, 3), "
    "f AS (SELECT *, min(day) OVER (PARTITION BY field) AS fs, min(day) OVER (PARTITION BY field, type) AS ts, min(day) OVER () AS start FROM c) "
    "SELECT day, field, type, rows, CASE WHEN day = fs THEN 'new' ELSE 'retyped' END AS change FROM f WHERE day > start AND day IN (fs, ts)"
)
def payload_fields_that_changed(spark, sf):
    """Fields that are new on a day, and known ones that have a type for the first time."""
    return drift.changes(drift.field_types(_drifting(spark, sf), "day", "v"))


@query(
    f"WITH {ctes.RAW}, {_DRIFT_SQL} SELECT event_id, CASE WHEN k % 50 < 48 THEN k END AS k, "
    "CASE WHEN k % 50 < 48 AND day >= DATE '2024-01-20' THEN k % 3 END AS app FROM d"
)
def read_fields_of_any_shape(spark, sf):
    """One expression per field reads rows of all days."""
    rows = _drifting(spark, sf)
    return rows.select("event_id", drift.read_field("v", "$.k", ["int", "string"]).alias("k"), drift.read_field("v", "$.source.app", ["int"]).alias("app"))


@query(f"WITH {ctes.RAW}, {_DRIFT_SQL} SELECT DISTINCT day, true AS covers FROM d")
def daily_payload_schema(spark, sf):
    """One schema per day that covers its payloads: where a field has several types or payloads are no objects, it is VARIANT."""
    rows = _drifting(spark, sf).where("v IS NOT NULL AND schema_of_variant(v) LIKE 'OBJECT%'")
    schemas = drift.daily_schema(rows, "day", "v")
    wanted = F.when(F.col("day") >= F.lit("2024-01-20").cast("date"), "OBJECT<k: STRING, source: OBJECT<app: BIGINT>>").when(
        F.col("day") >= F.lit("2024-01-10").cast("date"), "OBJECT<k: BIGINT, share: DECIMAL(1,1)>"
    ).otherwise("OBJECT<k: BIGINT>")
    return schemas.select("day", (F.col("schema") == wanted).alias("covers"))


@query("SELECT event_id, ts, user_id, event_type FROM events")
def deduplicate_events(spark, sf):
    events = inputs.read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    later = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 5 SECONDS"))
    return quality.deduplicate(events.unionByName(later), ["event_id"], ["ts"])


@query(f"WITH {ctes.WIDE_CTE} SELECT event_id, useragent FROM wide WHERE k % 6 NOT IN (4, 5)")
def remove_bots(spark, sf):
    wide = inputs.wide(spark, sf).select("event_id", "useragent")
    listed = wide.where(F.col("useragent").contains("Android")).select("useragent").distinct()
    return quality.without_bots(wide, "useragent", listed)


@query(
    f"WITH {ctes.WIDE_CTE}, a AS (SELECT event_id, CAST(floor(ip / 16777216) AS INTEGER) AS p1, "
    "CAST(floor(ip / 65536) AS BIGINT) % 256 AS p2, CAST(floor(ip / 256) AS BIGINT) % 256 AS p3, ip % 256 AS p4, "
    "domain_userid FROM wide) SELECT event_id, concat_ws('.', p1, p2, p3, 'x') AS masked_address, "
    "sha256('pepper' || concat_ws('.', p1, p2, p3, p4)) AS address_key, sha256('pepper' || domain_userid) AS user_key FROM a"
)
def pseudonymise_events(spark, sf):
    ip = F.col("ip")
    parts = [F.shiftright(ip, 24), F.shiftright(ip, 16) % 256, F.shiftright(ip, 8) % 256, ip % 256]
    wide = inputs.wide(spark, sf).withColumn("address", F.concat_ws(".", *[p.cast("string") for p in parts]))
    return wide.select(
        "event_id",
        privacy.mask_address(F.col("address")).alias("masked_address"),
        privacy.pseudonym(F.col("address"), "pepper").alias("address_key"),
        privacy.pseudonym(F.col("domain_userid"), "pepper").alias("user_key"),
    )


_HOST_SQL = "regexp_extract(url, '^https?://([^/?#]+)', 1)"


@query(
    f"WITH p AS (SELECT page_id, {_HOST_SQL} AS refr_urlhost"
    + "".join(f", nullif(regexp_extract(url, '[?&]utm_{c}=([^&#]*)', 1), '') AS mkt_{c}" for c in ("source", "medium", "campaign", "term"))
    + " FROM pages), hosts AS (SELECT refr_urlhost AS host, CASE WHEN refr_urlhost LIKE 'm.%' THEN 'social' ELSE 'search' END AS medium "
    "FROM p WHERE refr_urlhost LIKE 'm.%' OR refr_urlhost LIKE 'www.%' GROUP BY 1) "
    "SELECT page_id, refr_urlhost, mkt_source, mkt_medium, mkt_campaign, mkt_term, CASE WHEN refr_urlhost = 'spam-farm.example.org' THEN 'internal' "
    "ELSE coalesce(medium, 'unknown') END AS refr_medium FROM p LEFT JOIN hosts ON host = refr_urlhost"
)
def attribute_campaign_and_referrer(spark, sf):
    url = F.col("url")
    pages = inputs.read(spark, sf, "pages").select(
        "page_id", web.url_host(url).alias("refr_urlhost"), *[c.alias(name) for name, c in web.campaign_columns(url).items()]
    )
    host = F.col("refr_urlhost")
    listed = pages.where(host.startswith("m.") | host.startswith("www.")).select(host.alias("host")).distinct()
    hosts = listed.withColumn("medium", F.when(F.col("host").startswith("m."), "social").otherwise("search"))
    return quality.classify_referrer(pages, "refr_urlhost", hosts, ["spam-farm.example.org"])


@query(
    f"WITH {ctes.WIDE_CTE} SELECT event_id, "
    "CASE k % 6 WHEN 0 THEN 'iPhone' WHEN 1 THEN 'Windows PC' WHEN 2 THEN 'Mac' WHEN 3 THEN 'Windows PC' "
    "WHEN 4 THEN 'Android' ELSE 'Other' END AS device, CASE k % 6 WHEN 0 THEN 'Safari' WHEN 1 THEN 'Chrome' "
    "WHEN 2 THEN 'Safari' WHEN 3 THEN 'Firefox' WHEN 4 THEN 'Chrome' ELSE 'Other' END AS browser FROM wide"
)
def device_and_browser_families(spark, sf):
    agent = F.col("useragent")
    return inputs.wide(spark, sf).select(
        "event_id", web.device_family(agent).alias("device"), web.browser_family(agent).alias("browser")
    )


_BASES = [*quality.LAWFUL_BASES, "curiosity", "other"]


@query(
    f"WITH {ctes.RAW}, c AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'signup' THEN 'granted' ELSE 'withdrawn' END AS state, "
    f"{B.pick('k', _BASES, 'duckdb')} AS basis FROM raw WHERE event_type IN ('signup', 'error')), "
    "latest AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) "
    "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM latest WHERE state = 'granted' "
    "AND basis IN ('consent', 'contract', 'legalObligation', 'vitalInterests', 'publicTask', 'legitimateInterests'))"
)
def events_with_lawful_basis(spark, sf):
    events = inputs.read(spark, sf, "events")
    with_k = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    consents = with_k.where("event_type IN ('signup', 'error')").selectExpr(
        "user_id", "ts", "event_id",
        "CASE event_type WHEN 'signup' THEN 'granted' ELSE 'withdrawn' END AS state",
        f"{B.pick('k', _BASES)} AS basis",
    )
    return quality.with_lawful_basis(events.select("event_id", "user_id"), consents, "user_id", ["ts", "event_id"])


_COUNTED = ["domain_userid", "login_id", "mkt_medium", "refr_urlhost", "geo_country"]


@query(
    f"WITH {ctes.WIDE_CTE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values FROM wide"
        for c in _COUNTED
    )
)
def column_quality_counters(spark, sf):
    return quality.column_counters(inputs.located(spark, sf), _COUNTED)


@query(
    f"WITH {ctes.WIDE_CTE} SELECT count(*) AS rows, count(*) - count(login_id) AS no_login, "
    "count(*) FILTER (k > 95) AS deep_scroll FROM wide"
)
def rule_quality_counters(spark, sf):
    rules = {"no_login": F.col("login_id").isNotNull(), "deep_scroll": F.col("vertical_percentage") <= 95}
    return quality.rule_counters(inputs.wide(spark, sf), rules)


# ---- identity --------------------------------------------------------------


@query(
    f"WITH {ctes.WIDE_CTE} SELECT domain_userid, arg_max(login_id, collector_tstamp) AS stitched_user_id FROM wide "
    "WHERE login_id IS NOT NULL GROUP BY 1"
)
def identifier_mapping(spark, sf):
    return identity.latest_login(inputs.wide(spark, sf), "domain_userid", "login_id", ["collector_tstamp", "event_id"])


@query(
    f"WITH {ctes.SESSIONS_CTE}, m AS (SELECT domain_userid, arg_max(login_id, collector_tstamp) AS login FROM wide "
    "WHERE login_id IS NOT NULL GROUP BY 1) SELECT domain_sessionid, page_views, coalesce(login, domain_userid) AS stitched_user_id "
    "FROM session_table LEFT JOIN m USING (domain_userid)"
)
def stitched_sessions(spark, sf):
    wide = inputs.wide(spark, sf)
    mapping = identity.latest_login(wide, "domain_userid", "login_id", ["collector_tstamp", "event_id"])
    table = staged(S.sessions(inputs.views(spark, sf)), "sessions")
    return identity.stitch(table, mapping, "domain_userid").select("domain_sessionid", "page_views", "stitched_user_id")


@query(
    f"WITH RECURSIVE {ctes.WIDE_CTE}, e AS (SELECT DISTINCT domain_userid AS a, login_id AS b FROM wide WHERE login_id IS NOT NULL), "
    "both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e), "
    "reach(id, seen) AS (SELECT a, a FROM both_ways UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.seen) "
    "SELECT id, min(seen) AS canonical_id FROM reach GROUP BY id"
)
def customer_groups(spark, sf):
    return identity.connected(inputs.wide(spark, sf), "domain_userid", "login_id")


# ---- flattening, drill-down, incremental refresh ----------------------------


@query(
    f"WITH {ctes.NESTED_CTE} SELECT event_id, domain_userid, unstruct_link_click.target_url AS link_click_target_url, "
    "u.e.device_family AS ua_device_family FROM nested LEFT JOIN LATERAL (SELECT unnest(contexts_ua) AS e) u ON true"
)
def flatten_entities(spark, sf):
    nested = B.nested_events(spark, sf)
    return nested.select(
        "event_id",
        "domain_userid",
        F.col("unstruct_link_click.target_url").alias("link_click_target_url"),
        F.explode_outer("contexts_ua").alias("ua"),
    ).select("event_id", "domain_userid", "link_click_target_url", F.col("ua.device_family").alias("ua_device_family"))


@query(
    f"WITH {ctes.SESSIONS_CTE} SELECT 'session' AS level, domain_sessionid AS id, start_tstamp, first_page_title AS title FROM session_table "
    "WHERE domain_userid = '5' UNION ALL SELECT 'view', page_view_id, start_tstamp, page_title FROM views WHERE domain_userid = '5' "
    "UNION ALL SELECT 'user', '5', min(start_tstamp), arg_min(page_title, start_tstamp) FROM views WHERE domain_userid = '5'"
)
def user_drill_down(spark, sf):
    # Sessions never cross users, so the user's events are enough, and the filter reaches the scan.
    events = inputs.wide(spark, sf).where("customer_key = 5")
    mine = S.user_journey(inputs.views(spark, sf, events), "5")
    per_view = mine.select(F.lit("view").alias("level"), F.col("page_view_id").alias("id"), "start_tstamp", F.col("page_title").alias("title"))
    per_session = S.sessions(mine).select(F.lit("session"), "domain_sessionid", "start_tstamp", "first_page_title")
    per_user = S.users(mine).select(F.lit("user"), "domain_userid", "start_tstamp", "first_page_title")
    return per_view.union(per_session).union(per_user)


_SESSIONS_SQL = (
    "WITH gaps AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) "
    f"< {B.SESSION_GAP_S * 1000000} THEN 0 ELSE 1 END AS opens FROM events), "
    "numbered AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS domain_sessionidx FROM gaps) "
    "SELECT user_id, domain_sessionidx, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS events "
    "FROM numbered GROUP BY 1, 2"
)


@query(_SESSIONS_SQL)
def refresh_sessions(spark, sf):
    events = inputs.read(spark, sf, "events").select("event_id", "user_id", "ts", "props")
    # Arrived later: everything after the mark, and some older events that were held back.
    late = (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")) | F.col("props").contains('7}')
    old = staged(S.session_bounds(events.where(~late), "user_id", "ts", B.SESSION_GAP_S), "sessions")
    return incremental.refresh_sessions(old, events, events.where(late), "user_id", "ts", B.SESSION_GAP_S)


@query(f"WITH {ctes.VIEWS_CTE} SELECT page_view_id, domain_sessionidx, page_view_in_session_index, engaged_time_in_s FROM views")
def refresh_page_views(spark, sf):
    wide = inputs.wide(spark, sf)
    # Arrived later: everything after the mark, and some older pings that were held back.
    late = (F.col("collector_tstamp") >= F.lit("2024-01-28").cast("timestamp_ntz")) | (F.col("event_id") % 501 == 0)

    def build(events):
        return inputs.page_views(events, spark, sf)

    old = staged(S.sessionize(staged(build(wide.where(~late)), "page_views"), gap_s=B.SESSION_GAP_S), "sessionized")
    fresh = incremental.refresh_views(old, wide, wide.where(late), build, "domain_userid", B.SESSION_GAP_S)
    return fresh.select("page_view_id", "domain_sessionidx", "page_view_in_session_index", "engaged_time_in_s")
