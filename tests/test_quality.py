from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import privacy, web
from touchline.operators import quality as Q


def test_schema_split_loses_nothing(spark):
    raw = spark.createDataFrame(
        [(1, '{"k": 5, "n": "x"}'), (2, '{"k": "five"}'), (3, "not json"), (4, None), (5, '{"n": "y"}'), (6, '{"k": null}')],
        "id int, raw string",
    )
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("n", T.StringType())])
    good, bad = Q.split_by_schema(raw, "raw", schema, ["k"])
    assert rows(good) == [(1, 5, "x")]
    assert rows(bad.select("id", "reason"), "id") == [
        (2, "does not fit schema"), (3, "does not fit schema"), (4, "empty"), (5, "missing k"), (6, "missing k"),
    ]


def test_deduplicate_keeps_the_first(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 1, "only")], "id string, t int, v string")
    assert rows(Q.deduplicate(df, ["id"], ["t"]), "id") == [("a", 1, "first"), ("b", 1, "only")]


def test_consent(spark):
    order = ["t"]
    consents = spark.createDataFrame(
        [("a", 1, "granted", "consent"), ("a", 2, "withdrawn", "consent"), ("b", 1, "withdrawn", "consent"),
         ("b", 2, "granted", "contract"), ("c", 1, "granted", "because")],
        "u string, t int, state string, basis string",
    )
    events = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("d",)], "u string")
    assert rows(Q.with_lawful_basis(events, consents, "u", order)) == [("b",), ("b",)]


def test_bots_by_pattern_and_list(spark):
    df = spark.createDataFrame([("Googlebot/2.1",), ("Mozilla/5.0 iPhone",), ("listed",), (None,)], "agent string")
    bots = spark.createDataFrame([("listed",)], "agent string")
    assert set(rows(Q.without_bots(df, "agent", bots))) == {("Mozilla/5.0 iPhone",), (None,)}


def test_referrer_class(spark):
    df = spark.createDataFrame([("s.com",), ("me.com",), ("x.com",), (None,)], "host_name string")
    hosts = spark.createDataFrame([("s.com", "search"), ("s.com", "search")], "host string, medium string")
    got = Q.classify_referrer(df, "host_name", hosts, ["me.com"])
    assert set(rows(got.select("host_name", "refr_medium"))) == {("s.com", "search"), ("me.com", "internal"), ("x.com", "unknown"), (None, "direct")}


def test_counters(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "s string, n int")
    assert rows(Q.column_counters(df, ["s", "n"]), "column") == [("n", 3, 1, 2), ("s", 3, 1, 1)]
    assert rows(Q.rule_counters(df, {"positive": F.col("n") > 1})) == [(3, 2)]


def test_fingerprint_sees_nulls_and_boundaries(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("abc", None), ("abc", ""), ("ab", "c")], "x string, y string")
    marks = [r[0] for r in rows(df.select(privacy.fingerprint(F.col("x"), F.col("y"))))]
    assert len(set(marks)) == 4 and marks[0] == marks[4]


def test_privacy(spark):
    df = spark.createDataFrame([("10.0.0.1",), (None,)], "ip string")
    got = rows(df.select(privacy.mask_address(F.col("ip")), privacy.pseudonym(F.col("ip"), "s")))
    assert got[0][0] == "10.0.0.x" and len(got[0][1]) == 64 and got[1] == (None, None)


def test_url_functions(spark):
    df = spark.createDataFrame([("https://a.b/c/d?utm_source=x&utm_term=y#z",), ("::bad",), (None,)], "u string")
    campaign = web.campaign_columns(F.col("u"))
    got = rows(df.select(web.url_host(F.col("u")), web.url_path(F.col("u")), campaign["mkt_source"], campaign["mkt_term"], campaign["mkt_medium"]))
    assert got[0] == ("a.b", "/c/d", "x", "y", None)
    assert got[2] == (None,) * 5


def test_latest_consent_by_time(spark):
    consents = spark.createDataFrame([("a", datetime(2024, 1, 2), "x", "y"), ("a", datetime(2024, 1, 1), "z", "w")], "u string, t timestamp, state string, basis string")
    assert rows(Q.latest_consent(consents, "u", ["t"])) == [("a", "x", "y")]
