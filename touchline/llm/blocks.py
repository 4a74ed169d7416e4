"""Documents in blocks, and messages between blocks and shards.

Some operators must look up something for every few words of every document.
As one row per lookup that would be many times the corpus. Here documents are
dealt into blocks of a few MB by a hash. A block sends each shard one packed
message, a shard answers each block with one packed message, and all of that
is two shuffles by key. Block and shard numbers follow from the size of the
corpus alone. Blocks grow with the square root of the corpus, so that messages
stay long enough to be worth a row. A shard gets at most one entry per key
from a block, so a key that is everywhere adds no more than one entry for each
block.

The shuffle that deals the texts is the same in every pass over them, so
Spark runs it once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from touchline.llm.shipping import ship
from touchline.llm.text import carried_columns, with_text

MAIL = StructType(
    [
        StructField("shard", IntegerType()),
        StructField("block", LongType()),
        StructField("kind", IntegerType()),
        StructField("payload", BinaryType()),
    ]
)
_MAIL_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])

Mail = tuple[int, int, int, bytes]


@dataclass(frozen=True)
class Layout:
    blocks: int
    shards: int

    @classmethod
    def of(cls, text_bytes: int, block_mb: float = 4.0) -> Layout:
        """Blocks of ``block_mb``, growing with the root of what exceeds 4 GB, up to 16 times that."""
        size = block_mb * 1e6 * min(16.0, max(1.0, math.sqrt(text_bytes / 4e9)))
        blocks = max(1, math.ceil(text_bytes / size))
        return cls(blocks, min(16_384, max(1, math.ceil(blocks / 2))))


def in_blocks(
    docs: DataFrame, doc_id: str, text: str, carried: Sequence[str] = (), block_mb: float = 4.0
) -> tuple[DataFrame, Layout]:
    """(block, id, text, row) with the carried columns in the struct ``row`` (see ``carried_columns``). Reads the text's size first."""
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    layout = Layout.of(size, block_mb)
    block = F.pmod(F.xxhash64(doc_id, text), F.lit(layout.blocks)).cast("long")
    return docs.select(block.alias("block"), F.col(doc_id).cast("long").alias("id"), *carried_columns(text, carried)), layout


def _table(rows: list[Mail]) -> pa.Table:
    """Messages as rows, payloads compressed: counts and codes are small numbers for the most part."""
    pack = zstd.ZstdCompressor(level=1).compress
    columns = list(zip(*[(s, b, k, pack(p)) for s, b, k, p in rows])) if rows else [[], [], [], []]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _MAIL_ARROW)], schema=_MAIL_ARROW)


def _mail(table: pa.Table) -> list[Mail]:
    unpack = zstd.ZstdDecompressor().decompress
    columns = [table.column(n).to_pylist() for n in ("shard", "block", "kind", "payload")]
    return [(s, b, k, unpack(p)) for s, b, k, p in zip(*columns)]


def _ordered(table: pa.Table) -> pa.Table:
    """The block's rows in one order, whichever way the shuffle delivered them, so that all passes agree."""
    table = with_text(table)
    return table.take(pc.sort_indices(table, [("id", "ascending"), ("text", "ascending")]))


def send(blocks: DataFrame, work: Callable[[int, pa.Table], list[Mail]]) -> DataFrame:
    """Messages of each block."""

    def run(table: pa.Table) -> pa.Table:
        return _table(work(table.column("block")[0].as_py(), _ordered(table)))

    return blocks.groupBy("block").applyInArrow(run, MAIL)


def answer(mail: DataFrame, work: Callable[[int, list[Mail]], list[Mail]]) -> DataFrame:
    """Answers of each shard to the blocks that wrote to it."""

    def run(table: pa.Table) -> pa.Table:
        return _table(work(table.column("shard")[0].as_py(), _mail(table)))

    return mail.groupBy("shard").applyInArrow(run, MAIL)


def reply(blocks: DataFrame, mail: DataFrame, work: Callable[[int, pa.Table, list[Mail]], list[Mail]]) -> DataFrame:
    """Messages of each block, given its answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _table(work(left.column("block")[0].as_py(), _ordered(left), _mail(right)) if left.num_rows else [])

    return blocks.groupBy("block").cogroup(mail.groupBy("block")).applyInArrow(run, MAIL)


def finish(
    blocks: DataFrame, mail: DataFrame, work: Callable[[pa.Table, list[Mail]], pa.Table], schema: StructType
) -> DataFrame:
    """The result rows of each block, given its answers."""
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(schema).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(_ordered(left), _mail(right)) if left.num_rows else empty

    return blocks.groupBy("block").cogroup(mail.groupBy("block")).applyInArrow(run, schema)


def by_shard(shard: np.ndarray, shards: int) -> np.ndarray:
    """Bounds of each shard in an ascending array of shard numbers."""
    return np.searchsorted(shard, np.arange(shards + 1))
