"""Catalogue tables, views, files and staged intermediate tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.session import on_release, work_path


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table by its one-, two- or three-part name."""
    return spark.read.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A CSV file with a header. Without a schema Spark reads the file twice to infer one."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=schema)


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """(label, features) rows. Giving the feature count saves a pass over the file."""
    return spark.read.format("libsvm").option("numFeatures", str(features)).load(path)


def write_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> None:
    """Replace a catalogue table, its schema included."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def make_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def for_this_run(spark: SparkSession, *names: str) -> None:
    """Drop these tables or views when the run is over (``session.releasing``)."""

    def drop(name: str) -> None:
        if not spark.catalog.dropTempView(name):
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    for name in names:
        on_release(partial(drop, name))


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write an intermediate result once and read it back.

    For results with several consumers: each of them then reads only the
    columns it needs, and nothing upstream runs twice or again after a loss.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def describe(df: DataFrame) -> DataFrame:
    """Row count and the schema, one row per column."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    columns = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema]
    return counted.select("rows", F.inline(F.array(*columns)))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n) if order else df.limit(n)
