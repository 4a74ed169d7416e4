"""Substring deduplication by words: seed and extend.

Seeds are anchors chosen by winnowing; matching seeds are extended both ways
to runs of windows, and runs that meet or overlap join into maximal repeats
(see ``repeats``). A repeat goes from every document but the smallest id that
holds it.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from touchline.llm.blocks import in_blocks
from touchline.llm.repeats import Block, remove_repeats
from touchline.llm.text import words_of

_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


def spans_of(covered: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal covered stretches that do not cross documents: (document, first unit, unit after the last), by place in the document."""
    before = np.append(False, covered[:-1])
    after = np.append(covered[1:], False)
    edges = offsets[(offsets > 0) & (offsets < len(covered))]
    before[edges] = False
    after[edges - 1] = False
    lo, hi = np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after) + 1
    document = np.searchsorted(offsets, lo, side="right") - 1
    return document, lo - offsets[document], hi - offsets[document]


def span_lists(covered: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The spans of each document as a list column."""
    document, lo, hi = spans_of(covered, offsets)
    ends = np.searchsorted(document, np.arange(len(offsets)))
    items = pa.StructArray.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)


def removed_per_document(covered: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(covered))[offsets])


def substring_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 50,
    seed: int = 15,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Per document: its id, n_words, n_removed, removed word spans, kept_text (kept words joined by one space), and ``row``.

    A word goes if a window of ``length`` words that covers it also starts in
    a document with a smaller id. Windows are judged on the input.

    Null and empty texts have no words and keep the text "". Rows with equal
    ids do not remove each other's words. A null id counts as larger than all
    others. An empty table gives an empty result. Columns other than the two
    named are only looked at if ``carried`` names them; they come back in the
    struct ``row``, so their names cannot clash.
    """
    blocks, layout = in_blocks(docs, doc_id, text, carried)
    fields = [
        StructField("doc_id", LongType()),
        StructField("n_words", LongType()),
        StructField("n_removed", LongType()),
        StructField("spans", ArrayType(_SPAN)),
        StructField("kept_text", StringType()),
    ]
    schema = StructType([*fields, *[f for f in blocks.schema.fields if f.name == "row"]])

    def units(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(table.column("text"))
        return words.hashes, words.offsets

    def result(table: pa.Table, block: Block, covered: np.ndarray) -> pa.Table:
        offsets = block.offsets
        removed = removed_per_document(covered, offsets)
        kept = []
        for i, value in enumerate(table.column("text")):
            words = (value.as_py() or "").encode().split()
            if removed[i]:
                words = compress(words, ~covered[offsets[i] : offsets[i + 1]])
            kept.append(b" ".join(words).decode())
        columns = {
            "doc_id": table.column("id"),
            "n_words": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "spans": span_lists(covered, offsets),
            "kept_text": pa.array(kept, pa.string()),
        }
        if "row" in table.column_names:
            columns["row"] = table.column("row")
        return pa.table(columns)

    return remove_repeats(blocks, layout, length, seed, units, result, schema)
