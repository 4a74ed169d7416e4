"""Checking SQL shared by several queries, as WITH clauses for DuckDB."""

from touchline.plans.bindings import CITY, PURCHASES_TO_CONVERT, SESSION_GAP_S, TARGET_URL, wide_columns

_WIDE_COLUMNS = ",\n    ".join(f"{text} AS {name}" for name, text in wide_columns("duckdb").items())

RAW = """raw AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""

WIDE_CTE = f"""{RAW},
wide0 AS (SELECT {_WIDE_COLUMNS} FROM raw),
wide AS (
  SELECT w.*, n_name AS geo_country, r_name AS geo_region, {CITY} AS geo_city
  FROM wide0 w LEFT JOIN customer ON customer_key = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

NESTED_CTE = f"""{WIDE_CTE},
nested AS (
  SELECT *,
    CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN []
      WHEN 2 THEN [{{'device_family': device_family, 'useragent': useragent}},
                   {{'device_family': 'Other', 'useragent': 'none'}}]
      ELSE [{{'device_family': device_family, 'useragent': useragent}}] END AS contexts_ua,
    CASE WHEN event_type = 'click' THEN {{'target_url':
      CASE WHEN k % 3 = 0 THEN '{TARGET_URL}' ELSE 'https://docs.example.com/' END}} END AS unstruct_link_click
  FROM wide)"""

_FIRST = [
    "domain_userid", "page_title", "page_urlpath", "refr_urlhost", "refr_medium", "mkt_source", "mkt_medium",
    "mkt_campaign", "mkt_term", "geo_country", "geo_region", "geo_city", "br_lang", "device_family", "os_family",
]

VIEWS_CTE = f"""{WIDE_CTE},
opened AS (
  SELECT page_view_id, {", ".join(_FIRST)} FROM wide
  QUALIFY row_number() OVER (PARTITION BY page_view_id ORDER BY collector_tstamp, event_id) = 1),
pinged AS (
  SELECT page_view_id, min(collector_tstamp) AS start_tstamp, max(collector_tstamp) AS end_tstamp,
    count(*) * 10 AS engaged_time_in_s,
    CAST(floor((epoch_us(max(collector_tstamp)) - epoch_us(min(collector_tstamp))) / 1000000) AS BIGINT)
      AS absolute_time_in_s,
    max(vertical_percentage) AS vertical_percentage_scrolled,
    max(horizontal_percentage) AS horizontal_percentage_scrolled
  FROM wide GROUP BY page_view_id),
pv0 AS (SELECT * FROM opened JOIN pinged USING (page_view_id)),
pv1 AS (
  SELECT *, CASE WHEN epoch_us(start_tstamp) - lag(epoch_us(start_tstamp)) OVER
      (PARTITION BY domain_userid ORDER BY start_tstamp, page_view_id) < {SESSION_GAP_S * 1000000} THEN 0 ELSE 1 END AS opens
  FROM pv0),
pv2 AS (
  SELECT *, CAST(sum(opens) OVER (PARTITION BY domain_userid ORDER BY start_tstamp, page_view_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS domain_sessionidx FROM pv1),
views AS (
  SELECT * EXCLUDE (opens), domain_userid || '-' || CAST(domain_sessionidx AS VARCHAR) AS domain_sessionid,
    row_number() OVER (PARTITION BY domain_userid, domain_sessionidx ORDER BY start_tstamp, page_view_id)
      AS page_view_in_session_index
  FROM pv2)"""

SESSIONS_CTE = f"""{VIEWS_CTE},
sess AS (
  SELECT domain_userid, domain_sessionid, domain_sessionidx, min(start_tstamp) AS start_tstamp,
    max(end_tstamp) AS end_tstamp, CAST(sum(engaged_time_in_s) AS BIGINT) AS engaged_time_in_s,
    count(*) AS page_views,
    arg_min(page_title, start_tstamp) AS first_page_title, arg_max(page_title, start_tstamp) AS last_page_title
  FROM views GROUP BY ALL),
sess_first AS (
  SELECT domain_sessionid, mkt_source, mkt_medium, mkt_campaign, geo_country, geo_region, geo_city, device_family, os_family
  FROM views WHERE page_view_in_session_index = 1),
session_table AS (SELECT * FROM sess JOIN sess_first USING (domain_sessionid))"""

USERS_CTE = f"""{VIEWS_CTE},
user_sum AS (
  SELECT domain_userid, min(start_tstamp) AS start_tstamp, max(end_tstamp) AS end_tstamp,
    CAST(sum(engaged_time_in_s) AS BIGINT) AS engaged_time_in_s, count(*) AS page_views,
    max(domain_sessionidx) AS sessions, arg_max(page_title, start_tstamp) AS last_page_title
  FROM views GROUP BY domain_userid),
user_first AS (
  SELECT domain_userid, page_title AS first_page_title, refr_urlhost, refr_medium, mkt_source, mkt_medium,
    mkt_campaign, mkt_term
  FROM views QUALIFY row_number() OVER (PARTITION BY domain_userid ORDER BY start_tstamp, page_view_id) = 1),
user_table AS (SELECT * FROM user_sum JOIN user_first USING (domain_userid))"""

# The columns of the gold table and of its raw variant, written out so that they do not depend on the code under test.
_GOLD_LIST = """
  domain_userid AS domain_userid,
  visitor.first_page_title AS first_page_title,
  visitor.refr_urlhost AS refr_urlhost,
  lower(visitor.refr_medium) AS refr_medium,
  lower(visitor.mkt_medium) AS mkt_medium,
  visitor.mkt_source AS mkt_source,
  visitor.mkt_term AS mkt_term,
  visitor.mkt_campaign AS mkt_campaign,
  coalesce(visitor.engaged_time_in_s, 0) AS engaged_time_in_s,
  coalesce(visitor.sessions, 0) AS sessions,
  coalesce(visitor.page_views, 0) AS page_views,
  coalesce(opening.absolute_time_in_s, 0) AS absolute_time_in_s,
  coalesce(opening.vertical_percentage_scrolled, 0) AS vertical_percentage_scrolled,
  opening.geo_country AS geo_country,
  opening.geo_region AS geo_region,
  opening.br_lang AS br_lang,
  opening.device_family AS device_family,
  opening.os_family AS os_family,
  CAST(domain_userid IN (SELECT domain_userid FROM buyers) AS INTEGER) AS converted_user"""

_RAW_GOLD_LIST = """
  domain_userid AS domain_userid,
  visitor.first_page_title AS first_page_title,
  visitor.refr_urlhost AS refr_urlhost,
  visitor.refr_medium AS refr_medium,
  visitor.mkt_medium AS mkt_medium,
  visitor.mkt_source AS mkt_source,
  visitor.mkt_term AS mkt_term,
  visitor.mkt_campaign AS mkt_campaign,
  visitor.engaged_time_in_s AS engaged_time_in_s,
  opening.absolute_time_in_s AS absolute_time_in_s,
  opening.vertical_percentage_scrolled AS vertical_percentage_scrolled,
  opening.geo_country AS geo_country,
  opening.geo_region AS geo_region,
  opening.br_lang AS br_lang,
  opening.device_family AS device_family,
  opening.os_family AS os_family,
  domain_userid IN (SELECT domain_userid FROM buyers) AS converted_user"""


# The first view is the one that no other opening view of the user precedes.
_GOLD_PARTS = f"""{USERS_CTE},
buyers AS (
  SELECT CAST(user_id AS VARCHAR) AS domain_userid FROM events
  GROUP BY user_id HAVING count(*) FILTER (event_type = 'purchase') > {PURCHASES_TO_CONVERT}),
openings AS (SELECT * FROM views WHERE page_view_in_session_index = 1),
opening AS (
  SELECT * FROM openings o WHERE NOT EXISTS (SELECT 1 FROM openings p WHERE p.domain_userid = o.domain_userid
    AND (p.start_tstamp < o.start_tstamp OR p.start_tstamp = o.start_tstamp AND p.page_view_id < o.page_view_id))),
visitor AS (SELECT * FROM user_table)"""

GOLD_CTE = f"""{_GOLD_PARTS},
gold AS (SELECT {_GOLD_LIST} FROM visitor JOIN opening USING (domain_userid))"""

RAW_GOLD_CTE = f"""{_GOLD_PARTS},
gold AS (SELECT {_RAW_GOLD_LIST} FROM visitor JOIN opening USING (domain_userid))"""

HASH_PERCENT = "CAST(('0x' || substr(md5(CAST({0} AS VARCHAR)), 1, 8)) AS BIGINT) % 100"
