"""Words and hashes of text columns, as numpy arrays over Arrow buffers.

A word is a longest run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return. Words and stretches of units (words or
bytes) are named by 64-bit hashes. The hash of a stretch is the difference of
two prefix sums, so every stretch of a document costs the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_SEGMENT = 1 << 18
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2 ** 64."""
    global _powers
    if len(_powers[0]) < n:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(max(n, 2 * len(_powers[0])), base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        _powers = (tables[0], tables[1])
    return _powers


def prefix(units: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``stretch`` takes the hash of any stretch of the units."""
    up, _ = _power_tables(len(units) + 1)
    sums = np.zeros(len(units) + 1, dtype=np.uint64)
    np.cumsum(units * up[: len(units)], out=sums[1:])
    return sums


def stretch(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of each stretch lo..hi-1; equal for equal units wherever they stand."""
    _, down = _power_tables(len(sums))
    size = (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix((sums[hi] - sums[lo]) * down[lo] + size)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values end to end, and n + 1 offsets. Null counts as empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts, offsets, base = [], [np.zeros(1, dtype=np.int64)], 0
    for chunk in chunks:
        if not len(chunk):
            continue
        chunk = chunk.cast(pa.large_string()).fill_null("")
        _, ends, data = chunk.buffers()
        at = np.frombuffer(ends, dtype=np.int64, count=len(chunk) + 1, offset=8 * chunk.offset)
        raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
        parts.append(raw)
        offsets.append(at[1:] - at[0] + base)
        base += len(raw)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint8)), np.concatenate(offsets)


class Words:
    """The words of a text column: byte positions, hashes, and each document's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR):
        solid = ~separator[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        edge = edge[1 : len(data)]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1] | edge
        last[:-1] &= ~solid[1:] | edge
        self.data = data
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.offsets = np.searchsorted(self.starts, offsets)
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            base = self.starts[i]
            j = max(int(np.searchsorted(self.starts, base + _SEGMENT)), i + 1)
            sums = prefix(BYTE_HASH[self.data[base : self.ends[j - 1]]])
            out[i:j] = stretch(sums, self.starts[i:j] - base, self.ends[i:j] - base)
            i = j
        return out


def words_of(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    data, offsets = text_bytes(column)
    return Words(LOWER[data] if lower else data, offsets)


def carried_columns(text: str, carried: Sequence[str]) -> list[Column]:
    """The text, and the carried columns in the struct ``row``; a text among these is not sent twice."""
    if not carried:
        return [F.col(text).alias("text")]
    row = F.struct(*[F.col(c) for c in carried]).alias("row")
    if text in carried:
        return [row, F.lit(list(carried).index(text)).alias("text_at")]
    return [F.col(text).alias("text"), row]


def with_text(data: pa.RecordBatch | pa.Table) -> pa.RecordBatch | pa.Table:
    """The rows with the column ``text``, taken out of ``row`` if it is only there."""
    if "text" in data.schema.names or not data.num_rows:
        return data
    return data.append_column("text", pc.struct_field(data.column("row"), [data.column("text_at")[0].as_py()]))


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text and no more than 8192 rows, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = with_text(batch) if column == "text" else batch
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part, number = np.cumsum(lengths) // size, np.arange(len(lengths)) // 8192
        new = (part[1:] != part[:-1]) | (number[1:] != number[:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield batch.slice(a, b - a)


def owners(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The document that each unit position belongs to."""
    return np.searchsorted(offsets, at, side="right") - 1


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each shingle of ``size`` words, in order.

    A document with fewer words has one shingle of all its words; one without
    words has none.
    """
    counts = np.diff(words.offsets)
    number = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    document = np.repeat(np.arange(len(counts)), number)
    shift = words.offsets[:-1] - (np.cumsum(number) - number)
    lo = np.arange(len(document)) + shift[document]
    out = np.empty(len(document), dtype=np.uint64)
    step = 1 << 18
    for a in range(0, len(lo), step):
        part = lo[a : a + step]
        hi = np.minimum(part + size, words.offsets[document[a : a + step] + 1])
        base, top = int(part[0]), int(hi.max())
        out[a : a + step] = stretch(prefix(words.hashes[base:top]), part - base, hi - base)
    return document, out
