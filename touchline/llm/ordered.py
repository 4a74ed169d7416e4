"""Documents in the order of their ids, in parts of even length."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shipping import ship

LAST = (1 << 63) - 1


def in_order(docs: DataFrame, doc_id: str, text: str, part_mb: float = 8.0, most: int = 10_000) -> tuple[DataFrame, int]:
    """(part, id, text) rows, not yet moved: parts hold about as many documents each and follow the order of the ids.

    The cuts between parts are approximate quantiles, so at most ``most``
    numbers reach the driver; from 80 GB on, parts grow. A null id counts as
    larger than all others, and a null text as empty.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, min(most, int(size / (part_mb * 1e6)) + 1))
    cuts: list[float] = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        found = rows.agg(F.percentile_approx("id", shares, 10 * parts + 10_000)).first()[0] or []
        cuts = sorted({float(c) for c in found})
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) < 3:
        return rows.select(F.lit(0).alias("part"), "id", "text"), 1
    placed = Bucketizer(splits=splits, inputCol="_at", outputCol="_part").transform(rows.withColumn("_at", F.col("id").cast("double")))
    return placed.select(F.col("_part").cast("int").alias("part"), "id", "text"), len(splits) - 1
