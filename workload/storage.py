"""Sources and sinks: catalogue tables, views, files, local rows, inspection."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from touchline.plans import bindings as B
from touchline.plans.gold import create_gold_view
from touchline.session import work_path
from touchline.operators import sessions as S
from touchline.sources import tables as T
from workload import ctes, inputs
from workload.registry import query


# The names of the regions by their key.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query("SELECT * FROM nation")
def scan_catalogue_table(spark, sf):
    name = _name("nation")
    T.for_this_run(spark, name)
    T.write_table(inputs.read(spark, sf, "nation"), name, path=work_path(spark, "nation"))
    return T.read_table(spark, f"spark_catalog.default.{name}")


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, sf):
    path = work_path(spark, "csv")
    customer = inputs.read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    customer.write.csv(path, header=True)
    return T.read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string")


@query("SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_acctbal FROM supplier")
def scan_csv_with_inferred_types(spark, sf):
    path = work_path(spark, "csv")
    inputs.read(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.csv(path, header=True)
    return T.read_csv(spark, path)


@query(
    "SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS label, round(l_quantity, 6) AS quantity, round(l_discount, 6) AS discount, "
    "round(l_tax, 6) AS tax FROM lineitem"
)
def scan_libsvm(spark, sf):
    path = work_path(spark, "libsvm")
    lines = inputs.read(spark, sf, "lineitem")
    numbers = ["l_quantity", "l_discount", "l_tax"]
    pairs = [F.concat(F.lit(f"{i}:"), F.col(c).cast("string")) for i, c in enumerate(numbers, start=1)]
    label = F.when(F.col("l_returnflag") == "R", "1").otherwise("0")
    lines.select(F.concat_ws(" ", label, *pairs).alias("value")).write.text(path)
    rows = T.read_libsvm(spark, path, len(numbers)).withColumn("x", vector_to_array("features"))
    return rows.select(
        "label", F.round(F.col("x")[0], 6).alias("quantity"), F.round(F.col("x")[1], 6).alias("discount"), F.round(F.col("x")[2], 6).alias("tax")
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def scan_parquet(spark, sf):
    orders = T.read_parquet(spark, f"{sf}/orders.parquet")
    return orders.where("o_totalprice > 400000").select("o_orderkey", "o_totalprice")


@query("SELECT n_regionkey, r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def local_rows(spark, sf):
    # A hand-made lookup table: rows written down here, not data that passes the driver.
    lookup = spark.createDataFrame(list(enumerate(REGIONS)), "n_regionkey int, r_name string")
    joined = inputs.read(spark, sf, "nation").join(lookup, "n_regionkey")
    return joined.groupBy("n_regionkey", "r_name").agg(F.count(F.lit(1)).alias("nations"))


@query("SELECT c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1")
def replace_table_and_schema(spark, sf):
    name, path = _name("segments"), work_path(spark, "segments")
    T.for_this_run(spark, name)
    customer = inputs.read(spark, sf, "customer")
    T.write_table(customer.select("c_custkey"), name, path=path)
    counted = customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
    T.write_table(counted, name, path=path)
    return T.read_table(spark, name)


@query(f"WITH {ctes.GOLD_CTE} SELECT converted_user, count(*) AS users, CAST(sum(page_views) AS BIGINT) AS page_views FROM gold GROUP BY 1")
def gold_as_temporary_view(spark, sf):
    tables = {n: _name(n) for n in ("users", "page_views", "converted")}
    views = T.staged(inputs.views(spark, sf), "page_views")
    T.make_view(views, tables["page_views"])
    T.make_view(S.users(views), tables["users"])
    T.make_view(B.converted_users(spark, sf), tables["converted"])
    gold = _name("gold_view")
    T.for_this_run(spark, *tables.values(), gold)
    create_gold_view(spark, tables["users"], tables["page_views"], tables["converted"], gold)
    return spark.sql(f"SELECT converted_user, count(*) AS users, sum(page_views) AS page_views FROM {gold} GROUP BY 1")


@query(
    "SELECT (SELECT count(*) FROM customer) AS rows, * FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), "
    "('c_nationkey', 'int'), ('c_acctbal', 'double'), ('c_mktsegment', 'string')) v(\"column\", type)"
)
def inspect_table(spark, sf):
    return T.describe(inputs.read(spark, sf, "customer"))
