"""Fingerprints of documents by one-permutation MinHash.

Every shingle is hashed once. The hash names a bin and a value; a bin keeps
its smallest value. A bin that stays empty takes the value of another one,
chosen by a hash of its own number and the attempt alone (optimal
densification, Shrivastava 2017), so two documents with the same bins filled
choose alike. Only the low bits of the values are kept, packed; the share of
bins that agree by chance is taken off when two fingerprints are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.ordered import LAST, in_order
from touchline.llm.text import mix, pieces, shingles, words_of

BINS = 256
BITS = 4


def fingerprints(column: pa.Array, size: int = 5, bins: int = BINS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(low bits of each bin, whether there is any shingle) of each text; A-Z count as lower case.

    ``bins`` must be a power of two.
    """
    document, hashes = shingles(words_of(column, lower=True), size)
    shift = np.uint64(64 - (bins.bit_length() - 1))
    values = np.full(len(column) * bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    place = document * bins + (hashes >> shift).astype(np.int64)
    np.minimum.at(values, place, hashes & ((np.uint64(1) << shift) - np.uint64(1)))
    values = values.reshape(-1, bins)
    filled = values != np.iinfo(np.uint64).max
    some = filled.any(axis=1)
    row, empty = np.nonzero(~filled & some[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        lender = (mix(empty.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        found = filled[row, lender]
        values[row[found], empty[found]] = values[row[found], lender[found]]
        row, empty = row[~found], empty[~found]
    # Mixed with the bin's number, so that bins that borrowed one value agree by chance one by one.
    values = mix(values + np.arange(bins, dtype=np.uint64)[None, :])
    return np.where(some[:, None], values & np.uint64((1 << bits) - 1), 0).astype(np.uint8), some


def packed(low: np.ndarray, some: np.ndarray, bits: int = BITS) -> list[str]:
    """The low bits of all bins end to end, in hexadecimal; "" for a text without words."""
    unpacked = (low[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    raw = np.packbits(unpacked.reshape(len(low), -1), axis=1)
    return [r.tobytes().hex() if s else "" for r, s in zip(raw, some)]


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity: agreement of the bins, without what agrees by chance.

    Two texts without words are alike, one without and one with words are not.
    """
    chance = 0.5**bits
    agree = (a == b).mean(axis=1)
    both = np.clip((agree - chance) / (1 - chance), 0.0, 1.0)
    return np.where(some_a & some_b, both, (some_a == some_b).astype(float))


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """Per document: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents follow one another by id, then text, and the first follows the
    last. The edited text has its last ``floor(n_chars / 2)`` characters
    replaced by the first as many (or all) of the next document.

    Documents move once, to parts in id order. A part also gets the first
    document of the next part, so neighbours always meet, and rows are read as
    a stream.

    Null texts count as empty; texts without words have the fingerprint "",
    are alike to each other (1.0) and unlike all others (0.0). Rows with equal
    ids are told apart by their texts; equal rows follow one another. A null
    id comes last. A single document is its own next. An empty table gives an
    empty result.
    """
    rows, _ = in_order(docs, doc_id, text)
    heads = sorted(tuple(r) for r in rows.groupBy("part").agg(F.min("id")).collect())
    before = [(heads[i - 1][0], head[1]) for i, head in enumerate(heads)]
    spark = docs.sparkSession
    # One row per part: at most 10,000.
    ends = F.broadcast(spark.createDataFrame(before, "end_of int, id long"))
    firsts = rows.join(ends, "id").groupBy("end_of", "id").agg(F.min("text").alias("text"))
    both = rows.select("part", F.lit(False).alias("end"), "id", "text").unionByName(
        firsts.select(F.col("end_of").alias("part"), F.lit(True).alias("end"), "id", "text")
    )
    laid = both.repartition("part").sortWithinPartitions("part", "end", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in pieces(batches, "text"):
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held else table
            held = table.slice(table.num_rows - 1)
            if table.num_rows < 2:
                continue
            column = table.column("text").combine_chunks()
            texts = column.to_pylist()
            low, some = fingerprints(column, size)
            edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, texts[1:])]
            new_low, new_some = fingerprints(pa.array(edited, pa.string()), size)
            code, new_code = packed(low, some), packed(new_low, new_some)
            ids = np.array(table.column("id"))[:-1]
            found = pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64(), mask=ids == LAST),
                    "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
                    "edited_text": pa.array(edited, pa.string()),
                    "fingerprint": pa.array(code[:-1], pa.string()),
                    "edited_fingerprint": pa.array(new_code, pa.string()),
                    "near_edited": pa.array(likeness(low[:-1], new_low, some[:-1], new_some)),
                    "near_next": pa.array(likeness(low[:-1], low[1:], some[:-1], some[1:])),
                }
            )
            yield found.filter(pa.array(~np.array(table.column("end"))[:-1]))

    return laid.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
