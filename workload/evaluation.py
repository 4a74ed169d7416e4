"""Feature preparation and metrics that SQL can compute too."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, StringIndexer
from pyspark.sql import functions as F

from touchline.operators import evaluate as V
from touchline.operators import features as X
from workload import ctes, inputs
from workload.registry import query

# ---- features --------------------------------------------------------------


@query(
    f"WITH {ctes.WIDE_CTE} SELECT event_id, coalesce(mkt_medium, 'N/A') AS mkt_medium, coalesce(mkt_term, 'N/A') AS mkt_term, "
    "refr_urlhost FROM wide"
)
def fill_missing_categories(spark, sf):
    wide = inputs.wide(spark, sf).select("event_id", "mkt_medium", "mkt_term", "refr_urlhost")
    return X.FillCategories(columns=["mkt_medium", "mkt_term"]).transform(wide)


@query(
    "WITH g AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders) "
    "SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM g)), 4) AS price FROM g"
)
def impute_mean(spark, sf):
    gaps = inputs.read(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price")
    )
    filled = Imputer(strategy="mean", inputCols=["price"], outputCols=["price"]).fit(gaps).transform(gaps)
    return filled.withColumn("price", F.round("price", 4))


@query(
    "SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS \"c_mktsegment_AUTOMOBILE\", "
    "CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS \"c_mktsegment_BUILDING\", CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS \"c_mktsegment_FURNITURE\", "
    "CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS \"c_mktsegment_HOUSEHOLD\", CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS \"c_mktsegment_MACHINERY\" FROM customer"
)
def dummy_columns(spark, sf):
    customer = inputs.read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return X.DummyColumns(columns=["c_mktsegment"]).fit(customer).transform(customer)


@query(
    f"WITH {ctes.WIDE_CTE}, train AS (SELECT * FROM wide WHERE {ctes.HASH_PERCENT.format('event_id')} < 80), "
    "top AS (SELECT geo_country FROM train WHERE geo_country IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6) "
    "SELECT event_id, CASE WHEN geo_country IN (SELECT geo_country FROM top) THEN geo_country ELSE 'Other' END AS geo_country FROM wide"
)
def keep_top_categories(spark, sf):
    wide = inputs.located(spark, sf).select("event_id", "geo_country")
    train, _ = X.hash_split(wide, "event_id", 80)
    return X.TopKCategories(columns=["geo_country"], k=6).fit(train).transform(wide)


@query(
    "SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS c_mktsegment_ix FROM customer"
)
def index_strings(spark, sf):
    customer = inputs.read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    names = [c for c in X.string_columns(customer)]
    indexer = StringIndexer(
        inputCols=names, outputCols=[f"{c}_ix" for c in names], stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return indexer.fit(customer).transform(customer).select("c_custkey", "c_mktsegment_ix")


@query(
    f"SELECT c_custkey, CASE WHEN {ctes.HASH_PERCENT.format('c_custkey')} < 67 THEN 'train' ELSE 'test' END AS part FROM customer"
)
def train_test_by_hash(spark, sf):
    train, test = X.hash_split(inputs.read(spark, sf, "customer").select("c_custkey"), "c_custkey", 67)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query()
def train_test_at_random(spark, sf):
    train, test = X.random_split(inputs.read(spark, sf, "customer").select("c_custkey"), [0.85, 0.15], seed=1)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_totalprice, md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) <= count(*) OVER () // 10 * 8 "
    "THEN 'train' ELSE 'test' END AS part FROM orders"
)
def train_test_by_position(spark, sf):
    orders = inputs.read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    train, test = X.ordered_split(orders, "o_totalprice", "o_orderkey")
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.select("o_orderkey", "part")


@query(
    "SELECT doc_id, CASE WHEN quality = 1 THEN (SELECT CAST(count(*) FILTER (quality = 0) AS DOUBLE) / "
    "CAST(count(*) FILTER (quality = 1) AS DOUBLE) FROM labels) ELSE 1.0 END AS weight FROM labels"
)
def class_weights(spark, sf):
    return X.with_class_weight(inputs.read(spark, sf, "labels"), "quality").select("doc_id", "weight")


# ---- metrics over a score that SQL can compute ------------------------------

# Label: returned goods. Score and prediction come from price and discount.
_SCORED_SQL = (
    "s AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, "
    "round(l_discount * 5 + l_quantity / 100, 6) AS score, "
    "CASE WHEN round(l_discount * 5 + l_quantity / 100, 6) > 0.5 THEN 1 ELSE 0 END AS prediction FROM lineitem)"
)
_COUNTS_SQL = (
    f"{_SCORED_SQL}, m AS (SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp, "
    "CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp, CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn, "
    "CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM s)"
)
_CURVE_SQL = (
    f"{_SCORED_SQL}, c AS (SELECT score, sum(label) AS pos, count(*) AS n FROM s GROUP BY score), "
    "r AS (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS cum_pos, CAST(sum(n) OVER w AS DOUBLE) AS cum_n FROM c WINDOW w AS (ORDER BY score DESC))"
)
_AUC_SQL = "sum((n - pos) * (cum_pos - pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos))"


def _scored(spark, sf):
    score = F.round(F.col("l_discount") * 5 + F.col("l_quantity") / 100, 6)
    return inputs.read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        score.alias("score"),
        (score > 0.5).cast("int").alias("prediction"),
    )


@query(f"WITH {_CURVE_SQL} SELECT round(sum(cum_pos / cum_n * pos) / sum(pos), 9) AS average_precision FROM r")
def average_precision(spark, sf):
    result = V.average_precision(_scored(spark, sf), "label", "score")
    return result.select(F.round("average_precision", 9).alias("average_precision"))


@query(f"WITH {_CURVE_SQL} SELECT round({_AUC_SQL}, 9) AS area_under_roc FROM r")
def area_under_roc(spark, sf):
    result = V.area_under_roc(_scored(spark, sf), "label", "score")
    return result.select(F.round("area_under_roc", 9).alias("area_under_roc"))


@query(f"WITH {_COUNTS_SQL} SELECT round(2 * tp / (2 * tp + fp + fn), 9) AS f_beta FROM m")
def f_one(spark, sf):
    return V.f_beta(_scored(spark, sf), "label", "prediction").select(F.round("f_beta", 9).alias("f_beta"))


@query(f"WITH {_COUNTS_SQL} SELECT round(5 * tp / (5 * tp + fp + 4 * fn), 9) AS f_beta FROM m")
def f_two(spark, sf):
    return V.f_beta(_scored(spark, sf), "label", "prediction", 2.0).select(F.round("f_beta", 9).alias("f_beta"))


@query(
    f"WITH {_SCORED_SQL}, cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(label, prediction)) "
    "SELECT cells.label, cells.prediction, count(s.label) AS count FROM cells LEFT JOIN s "
    "ON s.label = cells.label AND s.prediction = cells.prediction GROUP BY 1, 2"
)
def confusion_matrix(spark, sf):
    return V.confusion(_scored(spark, sf), "label", "prediction")


@query(
    f"WITH {_COUNTS_SQL}, p AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0, tn + fp AS s0, "
    "tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS s1, tp + fp + fn + tn AS total FROM m), "
    "lines AS (SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, s0 AS s FROM p UNION ALL SELECT '1', p1, r1, f1, s1 FROM p "
    "UNION ALL SELECT 'accuracy', (tp + tn) / total, (tp + tn) / total, (tp + tn) / total, total FROM p "
    "UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total FROM p "
    "UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / total, (r0 * s0 + r1 * s1) / total, (f0 * s0 + f1 * s1) / total, total FROM p) "
    "SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, CAST(s AS BIGINT) AS support FROM lines"
)
def classification_report(spark, sf):
    report = V.classification_report(_scored(spark, sf), "label", "prediction")
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(
    f"WITH {_CURVE_SQL}, m AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp, "
    "count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) AS n FROM s) "
    "SELECT round((n - fp - fn) / CAST(n AS DOUBLE), 9) AS accuracy, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision, "
    f"round(tp / CAST(tp + fn AS DOUBLE), 9) AS recall, round((SELECT {_AUC_SQL} FROM r), 9) AS area_under_roc FROM m"
)
def classification_statistics(spark, sf):
    result = V.classification_statistics(_scored(spark, sf), "label", "prediction", "score")
    return result.select(*[F.round(c, 9).alias(c) for c in result.columns])


@query(
    "WITH e AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem), "
    "m AS (SELECT avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae, var_pop(y) AS v FROM e) "
    "SELECT round(mse / 1e6, 6) AS mse, round(sqrt(mse), 6) AS rmse, round(mae, 6) AS mae, round(1 - mse / v, 9) AS r2 FROM m"
)
def regression_statistics(spark, sf):
    lines = inputs.read(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p")
    )
    result = V.regression_statistics(lines, "y", "p")
    return result.select(
        F.round(F.col("mse") / 1e6, 6).alias("mse"), F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"),
        F.round("r2", 9).alias("r2"),
    )


@query(
    "WITH e AS (SELECT l_extendedprice - l_quantity * 1200 AS e FROM lineitem) "
    "SELECT round(avg(greatest(0.2 * e, (0.2 - 1) * e)), 6) AS pinball_loss, round(avg(CASE WHEN e <= 0 THEN 1.0 ELSE 0.0 END), 9) AS coverage FROM e"
)
def pinball_loss(spark, sf):
    lines = inputs.read(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1200).alias("p")
    )
    result = V.pinball_loss(lines, "y", "p", 0.2)
    return result.select(F.round("pinball_loss", 6).alias("pinball_loss"), F.round("coverage", 9).alias("coverage"))


def _ndcg_sql() -> str:
    parts = []
    for k in (1, 3, 5):
        dcg = f"sum(CASE WHEN rs <= {k} THEN (pow(2.0, rel) - 1) / log2(rs + 1) END)"
        ideal = f"sum(CASE WHEN ri <= {k} THEN (pow(2.0, rel) - 1) / log2(ri + 1) END)"
        parts.append(f"CASE WHEN {ideal} > 0 THEN {dcg} / {ideal} ELSE 1.0 END AS n{k}")
    return (
        "WITH d AS (SELECT l_orderkey, l_partkey * 10 + l_linenumber AS tie, CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END AS rel, "
        "l_extendedprice AS score FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, tie) AS rs, "
        "row_number() OVER (PARTITION BY l_orderkey ORDER BY rel DESC, tie) AS ri FROM d), "
        f"q AS (SELECT l_orderkey, {', '.join(parts)} FROM r GROUP BY 1) "
        "SELECT round(avg(n1), 8) AS ndcg_at_1, round(avg(n3), 8) AS ndcg_at_3, round(avg(n5), 8) AS ndcg_at_5 FROM q"
    )


@query(_ndcg_sql())
def ndcg_at_cutoffs(spark, sf):
    grade = F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "A", 1).otherwise(0)
    lines = inputs.read(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("tie"), grade.alias("rel"),
        F.col("l_extendedprice").alias("score"),
    )
    result = V.ndcg(lines, "l_orderkey", "rel", "score", "tie")
    return result.select(*[F.round(c, 8).alias(c) for c in result.columns])


@query(f"WITH {_SCORED_SQL} SELECT prediction, count(*) AS count FROM s GROUP BY 1")
def prediction_counts(spark, sf):
    return V.prediction_counts(_scored(spark, sf), "prediction")
