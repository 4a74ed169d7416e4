"""Keep a derived table current from micro-batches, at a cost that does not grow with the history.

Raw events are stored by batch and day. A derived row (a session, a page view)
belongs to the day on which it starts. New events can change the rows of their
keys that are still open for them; the oldest such start gives the first day
that can change. Only events and rows from that day on are read. The batch
writes these days anew, as a version of its own; a reader takes each day from
the last batch that wrote it. Versions that no day is taken from any more are
removed. A batch that is run again after a failure replaces its own folders.

In the order of time a batch touches the last days alone. A late event costs
as many days as it is late.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.times import MICROS, at_micros, epoch_micros
from touchline.session import remove
from touchline.sources.tables import staged

_DAY = 86_400 * MICROS


def _day(micros: Column) -> Column:
    return F.floor(micros / _DAY).cast("int")


@dataclass
class Upsert:
    """``build`` makes rows with the key, start_us and end_us from the events of some keys.

    With ``gap_s`` a row is open for events up to that long after its end (a
    session); without, a row takes all events of its key (a page view).
    """

    spark: SparkSession
    root: str
    key: str
    ts: str
    build: Callable[[DataFrame], DataFrame]
    gap_s: int | None = None

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Store the batch, then write the days anew that it can change."""
        spark, key = batch.sparkSession, self.key
        raw = f"{self.root}/raw/batch={batch_id}"
        batch.withColumn("day", _day(epoch_micros(batch, self.ts))).write.mode("overwrite").partitionBy("day").parquet(raw)
        schema = T.StructType([*batch.schema.fields, T.StructField("day", T.IntegerType())])
        arrived = spark.read.schema(schema).parquet(raw).where(F.col(key).isNotNull() & F.col(self.ts).isNotNull())
        us = epoch_micros(arrived, self.ts)
        earliest = arrived.groupBy(key).agg(F.min(us).alias("_new_us"))
        oldest = arrived.agg(F.min(us)).first()[0]
        if oldest is None:
            return
        before = self._rows(batch.schema, batch_id)
        if self.gap_s is not None:
            # Rows that ended earlier are closed for all new events: files that hold only such rows are skipped.
            before = before.where(F.col("end_us") + self.gap_s * MICROS > oldest)
        opened = before.join(earliest, key)
        if self.gap_s is not None:
            opened = opened.where(F.col("end_us") + self.gap_s * MICROS > F.col("_new_us"))
        reopened = opened.groupBy(key).agg(F.min("start_us").alias("_open_us"))
        start = earliest.join(reopened, key, "left").select(key, F.least("_new_us", "_open_us").alias("_from_us"))
        start = staged(start, "changed_keys")
        first = start.agg(F.min("_from_us")).first()[0]
        first_day = first // _DAY

        stored = spark.read.schema(_with(batch.schema, "batch", "day")).parquet(f"{self.root}/raw")
        recent = stored.where((F.col("batch") <= batch_id) & (F.col("day") >= first_day) & (F.col(self.ts) >= at_micros(stored, self.ts, first)))
        again = recent.join(start, key).where(epoch_micros(stored, self.ts) >= F.col("_from_us")).select(batch.columns)
        rebuilt = self.build(again)
        kept = self._rows(batch.schema, batch_id, first_day).join(start, key, "left")
        kept = kept.where("_from_us IS NULL OR start_us < _from_us").select(rebuilt.columns)
        version = kept.unionByName(rebuilt).withColumn("day", _day(F.col("start_us")))
        version.write.mode("overwrite").partitionBy("day").parquet(f"{self.root}/derived/batch={batch_id}")
        mark = spark.createDataFrame([(int(first_day),)], "first_day int").coalesce(1)
        mark.write.mode("overwrite").parquet(f"{self.root}/marks/batch={batch_id}")
        self._remove_unused(batch_id)

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Work through what is there now, then stop."""
        writer = stream.writeStream.foreachBatch(self.on_batch).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    def current(self, events_schema: T.StructType) -> DataFrame:
        """The derived table as of the last batch."""
        return self._rows(events_schema, None)

    def _versions(self, before: int | None) -> list[tuple[int, int, int | None]]:
        """(batch, first day, day after the last) of the versions in use, newest first: no more than there are days."""
        try:
            marks = self.spark.read.schema("first_day int, batch bigint").parquet(f"{self.root}/marks")
            written = sorted(((r["batch"], r["first_day"]) for r in marks.collect() if before is None or r["batch"] < before), reverse=True)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            written = []
        used: list[tuple[int, int, int | None]] = []
        for number, first_day in written:
            if not used or first_day < used[-1][1]:
                used.append((number, first_day, used[-1][1] if used else None))
        return used

    def _rows(self, events_schema: T.StructType, before: int | None, from_day: int | None = None) -> DataFrame:
        """Rows of the last versions, from a day on. Folders of other versions and days are not opened."""
        shape = self.build(self.spark.createDataFrame([], events_schema)).schema
        taken = F.lit(False)
        for number, first_day, end in self._versions(before):
            days = F.col("day") >= first_day if end is None else (F.col("day") >= first_day) & (F.col("day") < end)
            taken = taken | ((F.col("batch") == number) & days)
        try:
            rows = self.spark.read.schema(_with(shape, "batch", "day")).parquet(f"{self.root}/derived").where(taken)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], shape)
        return (rows if from_day is None else rows.where(F.col("day") >= int(from_day))).select(shape.names)

    def _remove_unused(self, batch_id: int) -> None:
        """Versions that the next batch and its replay read nothing from."""
        used = {number for number, _, _ in self._versions(None)} | {number for number, _, _ in self._versions(batch_id)}
        marks = self.spark.read.schema("first_day int, batch bigint").parquet(f"{self.root}/marks")
        for row in marks.select("batch").distinct().collect():
            if row["batch"] not in used:
                remove(self.spark, f"{self.root}/derived/batch={row['batch']}")
                remove(self.spark, f"{self.root}/marks/batch={row['batch']}")


def _with(schema: T.StructType, *folders: str) -> T.StructType:
    kinds = {"batch": T.LongType(), "day": T.IntegerType()}
    return T.StructType([*schema.fields, *[T.StructField(f, kinds[f]) for f in folders]])
