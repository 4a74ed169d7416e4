"""Score tables, audiences, splits, change sets and campaigns."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import audiences as A
from touchline.operators import joins as J
from touchline.operators import sessions as S
from touchline.sources.tables import staged
from workload import ctes, inputs
from workload.registry import query

#: A visit to the site ends for campaigns when the user stayed away for ten days.
CAMPAIGN_GAP_S = 10 * 86_400

# A stand-in for a model score that SQL can compute too: mean spend, squashed to (0, 1).
_SCORES_SQL = (
    "spend AS (SELECT CAST(o_custkey AS VARCHAR) AS domain_userid, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 654321 AS propensity_score FROM orders GROUP BY o_custkey)"
)
_LABELLED_SQL = (
    f"{_SCORES_SQL}, edges AS (SELECT quantile_cont(propensity_score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM spend), "
    "coded AS (SELECT domain_userid, propensity_score, CAST(len(list_filter(e, lambda x: x < propensity_score)) AS INTEGER) AS propensity_decile "
    "FROM spend, edges), scores AS (SELECT *, CASE WHEN propensity_decile <= 7 THEN 'Low' WHEN propensity_decile <= 8 THEN 'Medium' "
    "ELSE 'High' END AS propensity_label FROM coded)"
)


def _scored(spark, sf):
    orders = inputs.read(spark, sf, "orders")
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    mean = (total / F.count(F.lit(1)) / 654321).alias("propensity_score")
    return orders.groupBy(F.col("o_custkey").cast("string").alias("domain_userid")).agg(mean)


def _labelled(spark, sf):
    return A.score_table(staged(_scored(spark, sf), "scores"))


@query(f"WITH {_LABELLED_SQL} SELECT domain_userid, round(propensity_score, 9) AS propensity_score, propensity_decile, propensity_label FROM scores")
def propensity_score_table(spark, sf):
    return _labelled(spark, sf).withColumn("propensity_score", F.round("propensity_score", 9))


@query(f"WITH {_SCORES_SQL} SELECT domain_userid, CAST(1 AS DOUBLE) AS propensity_prediction FROM spend WHERE propensity_score > 0.5")
def high_propensity_users(spark, sf):
    predicted = _scored(spark, sf).withColumn("prediction", (F.col("propensity_score") > 0.5).cast("double"))
    return A.high_propensity(predicted, "domain_userid", "prediction")


@query(
    f"WITH {_LABELLED_SQL} SELECT domain_userid, propensity_score FROM (SELECT domain_userid, round(propensity_score, 9) AS propensity_score, "
    "propensity_label FROM scores) WHERE propensity_label = 'High' ORDER BY propensity_score DESC, domain_userid LIMIT 10"
)
def best_prospects(spark, sf):
    high = _labelled(spark, sf).where("propensity_label = 'High'").withColumn("propensity_score", F.round("propensity_score", 9))
    return high.select("domain_userid", "propensity_score").orderBy(F.col("propensity_score").desc(), "domain_userid").limit(10)


@query(
    f"WITH {ctes.USERS_CTE}, {_LABELLED_SQL} SELECT domain_userid, sessions, mkt_medium, propensity_label FROM user_table "
    "LEFT JOIN scores USING (domain_userid) WHERE sessions <= 40 AND mkt_medium IS NULL AND propensity_label = 'High'"
)
def rule_based_audience(spark, sf):
    users = S.users(inputs.views(spark, sf)).select("domain_userid", "sessions", "mkt_medium")
    scores = _labelled(spark, sf).select("domain_userid", "propensity_label")
    rule = (F.col("sessions") <= 40) & F.col("mkt_medium").isNull() & (F.col("propensity_label") == "High")
    return A.rule_audience(users, scores, "domain_userid", rule)


@query(
    f"WITH {ctes.USERS_CTE}, {_LABELLED_SQL}, starts AS (SELECT domain_userid, CASE WHEN epoch_us(start_tstamp) - lag(epoch_us(start_tstamp)) "
    f"OVER (PARTITION BY domain_userid ORDER BY start_tstamp, page_view_id) < {CAMPAIGN_GAP_S * 1000000} THEN 0 ELSE 1 END AS opens FROM pv0), "
    "visits AS (SELECT domain_userid, CAST(sum(opens) AS BIGINT) AS sessions FROM starts GROUP BY 1), "
    "src AS (SELECT domain_userid, mkt_medium FROM user_table) SELECT domain_userid, sessions, mkt_medium, propensity_label "
    "FROM visits JOIN src USING (domain_userid) JOIN scores USING (domain_userid) WHERE sessions = 1 AND mkt_medium IS NULL AND propensity_label = 'High'"
)
def first_time_high_propensity_audience(spark, sf):
    rolled = staged(inputs.page_views(inputs.wide(spark, sf), spark, sf), "page_views")
    visits = S.sessionize(rolled, gap_s=CAMPAIGN_GAP_S)
    parent = S.users(visits).select("domain_userid", "sessions", "mkt_medium")
    scores = _labelled(spark, sf).select("domain_userid", "propensity_label")
    return A.rule_audience(parent, scores, "domain_userid", A.awareness_rule())


@query(
    f"WITH {ctes.USERS_CTE} SELECT domain_userid, sessions FROM user_table WHERE domain_userid IN "
    "(SELECT domain_userid FROM views WHERE page_urlpath LIKE '/get-started/%')"
)
def event_based_audience(spark, sf):
    views = staged(inputs.views(spark, sf), "page_views")
    visits = A.event_audience(views, "/get-started/%")
    return J.who_did(S.users(views).select("domain_userid", "sessions"), visits, "domain_userid")


@query(
    "WITH prev AS (SELECT o_custkey AS key, count(*) AS orders, max(o_orderpriority) AS priority FROM orders "
    "WHERE o_orderdate < TIMESTAMP '1998-06-01' GROUP BY 1), "
    "cur AS (SELECT o_custkey AS key, count(*) AS orders, max(o_orderpriority) AS priority FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1) "
    "SELECT coalesce(c.key, p.key) AS key, CASE WHEN p.key IS NULL THEN 'add' WHEN c.key IS NULL THEN 'remove' ELSE 'update' END AS change, "
    "coalesce(c.orders, p.orders) AS orders, coalesce(c.priority, p.priority) AS priority FROM prev p FULL JOIN cur c ON p.key = c.key "
    "WHERE p.key IS NULL OR c.key IS NULL OR p.orders <> c.orders OR p.priority <> c.priority"
)
def audience_change_set(spark, sf):
    orders = inputs.read(spark, sf, "orders")

    def snapshot(rows):
        return rows.groupBy(F.col("o_custkey").alias("key")).agg(
            F.count(F.lit(1)).alias("orders"), F.max("o_orderpriority").alias("priority")
        )

    previous = snapshot(orders.where("o_orderdate < timestamp_ntz'1998-06-01'"))
    current = snapshot(orders.where("o_orderdate >= timestamp_ntz'1996-01-01'"))
    return A.change_set(previous, current, "key", ["orders", "priority"])


@query(
    "SELECT c_custkey, CAST(CAST(('0x' || substr(md5('may' || CAST(c_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % 3 AS INTEGER) AS split FROM customer"
)
def random_split(spark, sf):
    return A.split_by_hash(inputs.read(spark, sf, "customer").select("c_custkey"), "c_custkey", 3, "may")


@query(
    "SELECT c_custkey, c_mktsegment, CAST((row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) - 1) "
    "% 4 AS INTEGER) AS split FROM customer"
)
def stratified_split(spark, sf):
    customer = inputs.read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return A.split_stratified(customer, "c_custkey", ["c_mktsegment"], 4)


@query(
    "WITH m AS (SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 5000 THEN 'model' ELSE 'rule' END AS arm FROM customer), "
    "hit AS (SELECT DISTINCT o_custkey AS user_id FROM orders WHERE o_totalprice > 470000), "
    "s AS (SELECT arm, count(*) AS members, count(hit.user_id) AS conversions FROM m LEFT JOIN hit USING (user_id) GROUP BY arm), "
    "r AS (SELECT *, CAST(conversions AS DOUBLE) / CAST(members AS DOUBLE) AS rate FROM s) "
    "SELECT arm, members, conversions, round(rate, 9) AS rate, round(rate / (SELECT rate FROM r WHERE arm = 'rule'), 9) AS lift FROM r"
)
def campaign_performance(spark, sf):
    members = inputs.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.when(F.col("c_acctbal") > 5000, "model").otherwise("rule").alias("arm")
    )
    outcomes = inputs.read(spark, sf, "orders").where("o_totalprice > 470000").select(F.col("o_custkey").alias("user_id"))
    compared = A.campaign_performance(members, outcomes, "user_id", "arm", "rule")
    return compared.withColumns({"rate": F.round("rate", 9), "lift": F.round("lift", 9)})


_POISSON_SQL = "CASE " + " ".join(f"WHEN u < {c!r} THEN {i}" for i, c in enumerate(A._POISSON)) + f" ELSE {len(A._POISSON)} END"


@query(
    "WITH m AS (SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 5000 THEN 'model' ELSE 'rule' END AS arm FROM customer), "
    "hit AS (SELECT DISTINCT o_custkey AS user_id, 1 AS hit FROM orders WHERE o_totalprice > 400000), "
    "d AS (SELECT arm, coalesce(hit, 0) AS hit, r, CAST(CAST(('0x' || substr(md5('lift' || CAST(user_id AS VARCHAR) || ':' || CAST(r AS VARCHAR)), 1, 8)) AS BIGINT) AS DOUBLE) "
    "/ 4294967296.0 AS u FROM m LEFT JOIN hit USING (user_id), unnest(generate_series(0, 200)) t(r)), "
    f"w AS (SELECT arm, r, hit, CASE WHEN r = 0 THEN 1 ELSE {_POISSON_SQL} END AS copies FROM d), "
    "c AS (SELECT arm, r, sum(copies)::BIGINT AS members, sum(copies * hit)::BIGINT AS conversions FROM w GROUP BY 1, 2), "
    "q AS (SELECT *, CASE WHEN members > 0 THEN conversions::DOUBLE / members::DOUBLE END AS rate FROM c), "
    "l AS (SELECT q.*, CASE WHEN b.rate > 0 THEN q.rate / b.rate END AS lift FROM q LEFT JOIN q b ON b.r = q.r AND b.arm = 'rule') "
    "SELECT arm, max(members) FILTER (r = 0) AS members, max(conversions) FILTER (r = 0) AS conversions, "
    + ", ".join(
        f"round(max({n}) FILTER (r = 0), 9) AS {n}, round(quantile_cont({n}, 0.025) FILTER (r > 0), 9) AS {n}_low, "
        f"round(quantile_cont({n}, 0.975) FILTER (r > 0), 9) AS {n}_high"
        for n in ("rate", "lift")
    )
    + " FROM l GROUP BY arm"
)
def campaign_intervals(spark, sf):
    """Whether one arm's rate is above the other's by more than chance."""
    members = inputs.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.when(F.col("c_acctbal") > 5000, "model").otherwise("rule").alias("arm")
    )
    outcomes = inputs.read(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("user_id"))
    found = A.campaign_intervals(members, outcomes, "user_id", "arm", "rule", salt="lift")
    return found.withColumns({c: F.round(c, 9) for c in found.columns if c.startswith(("rate", "lift"))})


@query(
    f"WITH {ctes.WIDE_CTE} SELECT CAST(collector_tstamp AS DATE) AS day, coalesce(mkt_source, 'direct') AS source, "
    "count(DISTINCT domain_userid) AS users, count(*) AS events FROM wide GROUP BY 1, 2"
)
def website_insights(spark, sf):
    return A.site_insights(inputs.wide(spark, sf), "collector_tstamp", "domain_userid", "mkt_source")
