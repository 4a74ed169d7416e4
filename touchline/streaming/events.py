"""Event streams in and bronze tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from touchline.functions.times import epoch_micros
from touchline.session import work_path


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder (or path pattern) as a stream; a bounded number of files per batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(path)


def with_event_time(stream: DataFrame, ts: str, name: str = "event_time") -> DataFrame:
    """A zone-aware event time, which watermarks need; zone-free input is taken as UTC."""
    return stream.withColumn(name, F.timestamp_micros(epoch_micros(stream, ts)))


def deduplicated(stream: DataFrame, key: str, event_time: str = "event_time", delay: str = "1 hour", salts: int = 0) -> DataFrame:
    """The first copy of each event that arrives, forgotten after the watermark has passed.

    With ``salts``, copies are thinned out in that many places first, by reading task, so that
    an event sent very many times does not fill one task. It costs a second
    state store.
    """
    marked = stream.withWatermark(event_time, delay)
    if salts:
        spread = marked.withColumn("_salt", F.spark_partition_id() % salts)
        marked = spread.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([key])


def start_stream(
    stream: DataFrame, target: str, checkpoint: str, every: str = "1 minute", partition_by: list[str] | None = None
) -> StreamingQuery:
    """Keep appending to a Parquet folder, one batch per interval; the query is returned running."""
    return _writer(stream, checkpoint, partition_by).trigger(processingTime=every).start(target)


def write_stream(stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Append what is there now to a Parquet folder, then stop. Run it again for what came since."""
    _writer(stream, checkpoint, partition_by).trigger(availableNow=True).start(target).awaitTermination()


def _writer(stream: DataFrame, checkpoint: str, partition_by: list[str] | None) -> DataStreamWriter:
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is there now and read back what it wrote."""
    spark = stream.sparkSession
    target = work_path(spark, label)
    write_stream(stream, target, work_path(spark, f"{label}-state"))
    return spark.read.schema(stream.schema).parquet(target)
