"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def labelled_sample(docs: DataFrame, label: str, per_label: int, max_chars: int) -> list[tuple[str, object]]:
    """(text, label) of at most ``per_label`` documents of each label, of at most ``max_chars`` characters each.

    Documents are drawn by a hash of their text and equal texts once, so the
    sample does not depend on order or partitioning. Only hashes are ranked;
    texts are fetched for the drawn ones.
    """
    usable = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull() & (F.length("text") <= max_chars))
    hashed = usable.select(F.xxhash64("text").alias("draw"), F.col(label).alias("label"), "text")
    order = Window.partitionBy("label").orderBy("draw")
    # The ranking keeps per_label rows of each label in every task before it shuffles.
    drawn = hashed.select("label", "draw").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label)
    chosen = hashed.join(F.broadcast(drawn.select("label", "draw")), ["label", "draw"])
    once = chosen.groupBy("label", "draw").agg(F.first("text").alias("text"))
    return [(r["text"], r["label"]) for r in once.orderBy("label", "draw").collect()]
