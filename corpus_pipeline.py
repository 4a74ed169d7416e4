"""From raw documents to training sequences: one stage after the other, each on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.decontaminate import find_leaks
from touchline.llm.langid import UNKNOWN, identify, language_model
from touchline.llm.near_dedup import near_dedup
from touchline.llm.packing import pack
from touchline.llm.queries import tokenizer_path
from touchline.llm.substring_dedup import substring_dedup
from touchline.sources.tables import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document stays if one language explains this share of its letters.
LEAST_LANGUAGE_SHARE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, most of them in one known language.

    Null and empty texts go, and so do texts without letters. An empty table
    stays empty. If no language could be learned, all documents with letters stay.
    """
    model = language_model(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, model, carried=docs.columns)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE)).select("row.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest id, and of equal ids the smallest hash of the text.

    Of equal rows one stays. Rows are told apart by id and text, so ids may
    repeat and be null; a null id counts as larger than all others. All texts
    without words stay.
    """
    key = [F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), F.xxhash64("text").alias("_text")]
    found = near_dedup(docs.withColumn("_text", F.xxhash64("text")), carried=["_text"], groups=True)
    order = F.struct(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), "row._text")
    chosen = found.where("n_shingles > 0").groupBy("component").agg(F.min(order).alias("least")).select("least.*")
    names = ["_id", "_none", "_text"]
    keyed = docs.select("*", *key)
    # The window deals rows as the join does, so texts move once.
    once = Window.partitionBy(*names).orderBy("_text")
    kept = keyed.join(chosen, names).withColumn("_place", F.row_number().over(once)).where("_place = 1").select(*docs.columns)
    without_words = F.coalesce(F.regexp_replace("text", r"[ \t-\r]+", ""), F.lit("")) == ""
    return kept.unionByName(docs.where(without_words))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words that an earlier document holds; as they were where there is none.

    A document of which nothing is left goes, as does nothing else.
    """
    found = substring_dedup(docs, carried=docs.columns).where("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    size = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    return found.select(F.col("row").withField("text", text).withField("n_chars", size).alias("row")).select("row.*")


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no test item, told apart by id and text, so ids may repeat and be null."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    leaks = find_leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="_key").select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(leaks, "_key", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 2048 tokens, as pieces of documents with their token ids."""
    # The workers live on from stage to stage: they get less memory for words than for packing alone, and none after their task.
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), narrow=True, cached_words=1_000_000, lasting=False)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_dedup", one_of_near_copies),
    ("substring_dedup", without_repeats),
    ("decontamination", without_test_items),
    ("packing", packed),
]

#: Fitted models, near copies by reachability and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
