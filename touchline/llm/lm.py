"""Log probabilities of documents under an n-gram model held in Elias-Fano tries.

The model counts words, pairs and triples of words in training documents. A
context h that was seen c(h) times with t(h) different successors gives

    p(w | h) = (c(h w) + t(h) * p(w | shorter h)) / (c(h) + t(h))

(Witten and Bell). Pairs are kept for contexts seen ``least_seen`` times or
more, triples for contexts seen ``least_context`` times or more; other contexts
fall back. With 1 and 1 every context that was seen has its own counts.

A trie level has its contexts in ascending order, a monotone pointer from each
context to its successors, and the successors numbered context by context, so
that they ascend over the whole level. All three are Elias-Fano sequences;
relative frequencies are kept as one byte each on a logarithmic scale. A
level lies in one memory-mapped file, and a successor is searched between the
two pointers of its context.

Levels are dealt to shards by context; a context with a large share of all
words is dealt to several shards by its successors. Blocks of documents send
each shard the contexts and successors they hold, with their counts. The shard
builds its level from all of them and answers each block (see ``blocks``). So
neither counts nor model pass through one task or the driver. A pair of words
that only one block holds has all its successors there; the answer about the
pair says so, and the block counts them itself.
"""

from __future__ import annotations

import os
import tempfile
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from touchline.llm.blocks import Mail, answer, by_shard, finish, in_blocks, reply, send
from touchline.llm.text import mix, words_of

END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
_WORD_BYTES, _CONTEXT_BYTES, _NEXT_BYTES = 6, 5, 3
_NEXT_BITS = 8 * _NEXT_BYTES
#: Codes 1 to 255 stand for relative frequencies from 1 down to 10 ** -9; 0 stands for none.
_DECADES = 9.0
WORDS, PAIRS, TRIPLES, STATE = range(4)


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of whole numbers, all first bytes first; high bytes that are zero then shrink well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def squeezed(values: np.ndarray, width: int) -> bytes:
    """As ``planes``, each plane compressed by itself: beside planes of random bytes in one frame those of small numbers hardly shrink."""
    pack, whole = zstd.ZstdCompressor(level=1).compress, planes(values, width)
    parts = []
    for k in range(width):
        plane = whole[k * len(values) : (k + 1) * len(values)]
        small = pack(plane) if any(plane) else b""
        parts.append(small if len(small) < len(plane) else plane)
    return np.array([len(p) for p in parts], dtype="<u4").tobytes() + b"".join(parts)


def steps(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Numbers that ascend in stretches, which start at ``begin``, as the first of each stretch and the steps from there."""
    out = values.copy()
    out[1:] -= values[:-1]
    out[begin] = values[begin]
    return out


def climbed(out: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The numbers that ``steps`` was given."""
    sums = np.cumsum(out, dtype=np.uint64)
    before = sums[begin] - out[begin]
    return sums - np.repeat(before, np.diff(np.append(begin, len(out))))


class _Reader:
    """Reads what ``planes`` and ``squeezed`` wrote, one after the other."""

    def __init__(self, payload: bytes):
        self.payload, self.at = payload, 0

    def numbers(self, n: int) -> np.ndarray:
        out = np.frombuffer(self.payload, np.int64, n, self.at)
        self.at += 8 * n
        return out

    def planes(self, n: int, width: int) -> np.ndarray:
        raw = np.frombuffer(self.payload, np.uint8, n * width, self.at).reshape(width, n)
        self.at += n * width
        out = np.zeros((n, 8), dtype=np.uint8)
        out[:, :width] = raw.T
        return out.reshape(-1).view("<u8").astype(np.uint64)

    def squeezed(self, n: int, width: int) -> np.ndarray:
        sizes = np.frombuffer(self.payload, "<u4", width, self.at)
        self.at += 4 * width
        out = np.zeros((n, 8), dtype=np.uint8)
        unpack = zstd.ZstdDecompressor().decompress
        for k, size in enumerate(sizes.tolist()):
            if size:
                plane = self.payload[self.at : self.at + size]
                out[:, k] = np.frombuffer(plane if size == n else unpack(plane), np.uint8)
                self.at += size
        return out.reshape(-1).view("<u8").astype(np.uint64)


def code_of(share: np.ndarray) -> np.ndarray:
    """One byte for each relative frequency above 0."""
    return (1 + np.clip(np.round(-np.log10(share) * 254 / _DECADES), 0, 254)).astype(np.uint8)


_SHARES = np.append(0.0, 10 ** (-np.arange(255) * _DECADES / 254))


def _nth_bit(words: np.ndarray, before: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The place of each set bit with the given number; ``before`` counts those before each word."""
    word = np.searchsorted(before, index, side="right") - 1
    left = (index - before[word]).astype(np.uint8)
    rest = words[word]
    place = word * 64
    for width in (32, 16, 8, 4, 2, 1):
        part = np.bitwise_count(rest & np.uint64((1 << width) - 1))
        past = left >= part
        left -= part * past
        shift = past * np.uint8(width)
        place += shift
        rest >>= shift
    return place


class EliasFano:
    """An ascending sequence of whole numbers: low bits packed, high bits as a bit for each number and each step."""

    def __init__(self, low: np.ndarray, high: np.ndarray, ranks: np.ndarray, bits: int, size: int):
        self.low, self.high, self.ranks, self.bits, self.size = low, high, ranks, bits, size

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        steps = (values >> np.uint64(bits)).astype(np.int64)
        flags = np.zeros(((n + (top >> bits) + 1 + 63) // 64) * 64, dtype=bool)
        flags[steps + np.arange(n)] = True
        high = np.packbits(flags, bitorder="little").view("<u8")
        ranks = np.append(0, np.cumsum(np.bitwise_count(high), dtype=np.int64)).astype("<u4")
        each = np.empty((n, bits), dtype=bool)
        for b in range(bits):
            each[:, b] = (values >> np.uint64(b)) & np.uint64(1)
        low = np.append(np.packbits(each.ravel(), bitorder="little"), np.zeros(8, np.uint8))
        return cls(low, high, ranks, bits, n)

    def at(self, index: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        steps = _nth_bit(self.high, self.ranks.astype(np.int64), index) - index
        return (steps.astype(np.uint64) << np.uint64(self.bits)) | self.low_bits(index)

    def alike(self, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the numbers with these high bits start and end."""
        # The bit that is the step from some high bits to the next comes after all numbers that have these or less.
        gaps, others = 64 * np.arange(len(self.ranks)) - self.ranks, ~self.high

        def upto(last: np.ndarray) -> np.ndarray:
            there = (last >= 0) & (last < gaps[-1])
            found = _nth_bit(others, gaps, np.where(there, last, 0)) - last
            return np.where(there, found, np.where(last < 0, 0, self.size))

        return upto(steps - 1), upto(steps)

    def low_bits(self, index: np.ndarray) -> np.ndarray:
        offset = index * self.bits
        byte = offset >> 3
        raw = np.zeros(len(index), dtype=np.uint64)
        for k in range((self.bits + 14) // 8):
            raw |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        return (raw >> (offset & 7).astype(np.uint64)) & np.uint64((1 << self.bits) - 1)


class Level:
    """One trie level in a memory-mapped file, deleted when it is closed."""

    def __init__(self, contexts: np.ndarray, number: np.ndarray, successors: np.ndarray, codes: np.ndarray):
        """Ascending contexts, successors of each, (context number << 24 | successor) ascending, and codes."""
        sequences = [EliasFano.of(contexts), EliasFano.of(np.append(0, np.cumsum(number)).astype(np.uint64)), EliasFano.of(successors)]
        parts = [a for s in sequences for a in (s.low, s.high, s.ranks)] + [codes]
        handle, self.path = tempfile.mkstemp(prefix="level-")
        self.bytes = 0
        with os.fdopen(handle, "wb") as out:
            places = []
            for part in parts:
                pad = -out.tell() % 8
                out.write(b"\0" * pad)
                places.append(out.tell())
                out.write(np.ascontiguousarray(part).tobytes())
            self.bytes = out.tell()
        mapped = [
            np.asarray(np.memmap(self.path, dtype=p.dtype, mode="r", offset=at, shape=p.shape)) if p.size else p
            for p, at in zip(parts, places)
        ]
        self.contexts, self.pointers, self.successors = (
            EliasFano(*mapped[3 * i : 3 * i + 3], s.bits, s.size) for i, s in enumerate(sequences)
        )
        self.codes = mapped[9]

    def __enter__(self) -> Level:
        return self

    def __exit__(self, *_: object) -> None:
        os.unlink(self.path)

    def search(self, context: np.ndarray, following: np.ndarray) -> np.ndarray:
        """The code of each (context number, successor), 0 where it is not in the level."""
        bounds = self.pointers.at(np.arange(self.pointers.size)).astype(np.int64)
        wanted = (context.astype(np.uint64) << np.uint64(_NEXT_BITS)) | following
        # Between the pointers, only successors with the same high bits are looked at, by their low bits.
        bits = np.uint64(self.successors.bits)
        lo, end = self.successors.alike((wanted >> bits).astype(np.int64))
        lo, end = np.maximum(lo, bounds[context]), np.minimum(end, bounds[context + 1])
        hi, wanted = end.copy(), wanted & ((np.uint64(1) << bits) - np.uint64(1))
        active = np.flatnonzero(lo < hi)
        while len(active):
            middle = (lo[active] + hi[active]) >> 1
            less = self.successors.low_bits(middle) < wanted[active]
            lo[active[less]] = middle[less] + 1
            hi[active[~less]] = middle[~less]
            active = active[lo[active] < hi[active]]
        out = np.zeros(len(context), dtype=np.uint8)
        there = np.flatnonzero(lo < end)
        there = there[self.successors.low_bits(lo[there]) == wanted[there]]
        out[there] = self.codes[lo[there]]
        return out


def _sorted_sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, the sum of counts of each, and each item's key number."""
    unique, back = np.unique(keys, return_inverse=True)
    return unique, np.bincount(back, weights=counts, minlength=len(unique)).astype(np.int64), back


def _numbered(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers without gaps for keys below ``size``, in their order, and an item of each."""
    one = np.full(size, -1)
    one[keys] = np.arange(len(keys))
    used = one >= 0
    return (np.cumsum(used) - 1)[keys], one[used]


@dataclass
class Grams:
    """Different (context, successor) pairs of one block, in shard order, and how to read the answers."""

    item: np.ndarray  # the entry of each item
    following: np.ndarray
    counts: np.ndarray
    bounds: np.ndarray
    context_bounds: np.ndarray  # entries of each context row
    row_bounds: np.ndarray  # context rows of each shard
    row_key: np.ndarray  # number of each row's context
    row_count: np.ndarray  # how often the context was seen
    number: np.ndarray  # of each item's pair, those with equal hashes told apart
    pairs: int  # how many numbers there are

    @classmethod
    def of(
        cls,
        context: np.ndarray,
        context_hash: np.ndarray,
        seen: np.ndarray,
        following: np.ndarray,
        word_hash: np.ndarray,
        train: np.ndarray,
        total: int,
        shards: int,
    ) -> Grams:
        """``context`` and ``following`` number the context and word of each item, ``train`` says whether it counts.

        Hashes and counts (``seen``) are given once per context, hashes once per word.
        """
        key = context.astype(np.int64) * len(word_hash) + following
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
        item = np.empty(len(order), dtype=np.int64)
        item[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        stands, number, pairs = order[first], item, len(first)
        of_entry, after = context[stands], word_hash[following[stands]]
        heads, seen_entry = context_hash[of_entry], seen[of_entry]
        # A context with a large share of all words is dealt to several shards by its successors.
        spread = np.minimum(shards, 1 + (2.0 * shards * seen / max(1, total)).astype(np.int64))
        shard = ((heads >> np.uint64(44)) + (after >> np.uint64(44)) % spread[of_entry].astype(np.uint64)) % np.uint64(shards)
        shard = shard.astype(np.uint16)
        short = heads & np.uint64((1 << 8 * _CONTEXT_BYTES) - 1)
        code = (short << np.uint64(_NEXT_BITS)) | (after & np.uint64((1 << _NEXT_BITS) - 1))
        order = np.argsort(code)
        order = order[np.argsort(shard[order], kind="stable")]
        s, c = shard[order], code[order]
        first = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (c[1:] != c[:-1]))) if len(order) else order
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        item = place[item]
        counts = np.bincount(item, weights=train, minlength=len(first)).astype(np.int64)
        stands = order[first]
        entry_shard, short, seen_entry = shard[stands].astype(np.int64), short[stands], seen_entry[stands]

        # Entries lie context by context; a context that is dealt to several shards
        # has a row in each of them, so that all its successors can be counted.
        bits = np.uint64(8 * _CONTEXT_BYTES)
        row = (entry_shard.astype(np.uint64) << bits) | short
        begin = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else stands
        sizes, row_count, row = np.diff(np.append(begin, len(row))), seen_entry[begin], row[begin]
        used = np.zeros(len(seen), dtype=bool)
        used[context] = True
        hot = np.flatnonzero(used & (spread > 1))
        parts = spread[hot]
        lead = np.repeat(hot, parts)
        step = np.arange(len(lead)) - np.repeat(np.cumsum(parts) - parts, parts)
        extra = ((context_hash[lead] >> np.uint64(44)) + step.astype(np.uint64)) % np.uint64(shards)
        extra = (extra << bits) | (context_hash[lead] & np.uint64((1 << 8 * _CONTEXT_BYTES) - 1))
        extra, at = np.unique(extra, return_index=True)
        where = np.searchsorted(row, extra)
        missing = (where == len(row)) | (row[np.minimum(where, len(row) - 1)] != extra) if len(row) else np.ones(len(extra), dtype=bool)
        where = where[missing]
        row = np.insert(row, where, extra[missing])
        row_count = np.insert(row_count, where, seen[lead[at[missing]]])
        sizes = np.insert(sizes, where, 0)
        return cls(
            item,
            (c[first] & np.uint64((1 << _NEXT_BITS) - 1)) if len(order) else c,
            counts,
            by_shard(entry_shard, shards),
            np.append(0, np.cumsum(sizes)),
            by_shard((row >> bits).astype(np.int64), shards),
            row & ((np.uint64(1) << bits) - np.uint64(1)),
            row_count,
            number,
            pairs,
        )

    def mail(self, block: int, kind: int) -> list[Mail]:
        out = []
        for k in range(len(self.bounds) - 1):
            a, b, x, y = self.bounds[k], self.bounds[k + 1], self.row_bounds[k], self.row_bounds[k + 1]
            if x < y:
                head = np.array([y - x, b - a], dtype=np.int64).tobytes()
                sizes = np.diff(self.context_bounds[x : y + 1])
                keys = steps(self.row_key[x:y], np.zeros(1, dtype=np.int64))
                body = squeezed(keys, _CONTEXT_BYTES) + squeezed(self.row_count[x:y], 8) + squeezed(sizes, 4)
                following = steps(self.following[a:b], self.context_bounds[x:y][sizes > 0] - a)
                out.append((k, block, kind, head + body + squeezed(following, _NEXT_BYTES) + squeezed(self.counts[a:b], 4)))
        return out

    def read(self, mail: list[Mail], kind: int) -> tuple[np.ndarray, np.ndarray]:
        """(relative frequency, number of different successors of its context) of each item."""
        share = np.zeros(self.bounds[-1])
        kinds = np.zeros(self.row_bounds[-1], dtype=np.int64)
        for k, _, what, payload in mail:
            if what == kind:
                a, b, x, y = self.bounds[k], self.bounds[k + 1], self.row_bounds[k], self.row_bounds[k + 1]
                reader = _Reader(payload)
                kinds[x:y] = reader.squeezed(y - x, 4)
                share[a:b] = _SHARES[reader.squeezed(b - a, 1)]
        # Shards hold different successors of a context, so their numbers add up.
        _, summed, back = _sorted_sums(self.row_key, kinds)
        row = np.repeat(np.arange(len(self.row_key)), np.diff(self.context_bounds))
        return share[self.item], summed[back][row][self.item]

    def alone(self, mail: list[Mail], kind: int) -> np.ndarray:
        """Whether no other block holds the pair of each item."""
        out = np.zeros(self.bounds[-1], dtype=bool)
        for k, _, what, payload in mail:
            if what == kind:
                a, b, x, y = self.bounds[k], self.bounds[k + 1], self.row_bounds[k], self.row_bounds[k + 1]
                flags = np.frombuffer(payload, np.uint8, offset=len(payload) - (b - a + 7) // 8)
                out[a:b] = np.unpackbits(flags, count=b - a).astype(bool)
        return out[self.item]


def _level_answers(mail: list[Mail], kind: int) -> list[Mail]:
    """Build this shard's level from all blocks' messages, and search it for each of them."""
    mail = [m for m in mail if m[2] == kind]
    if not mail:
        return []
    read = []
    for m in mail:
        reader = _Reader(m[3])
        rows, entries = (int(v) for v in reader.numbers(2))
        keys, seen, sizes = reader.squeezed(rows, _CONTEXT_BYTES), reader.squeezed(rows, 8), reader.squeezed(rows, 4).astype(np.int64)
        following = climbed(reader.squeezed(entries, _NEXT_BYTES), (np.cumsum(sizes) - sizes)[sizes > 0])
        read.append((np.cumsum(keys, dtype=np.uint64), seen, sizes, following, reader.squeezed(entries, 4)))
    keys, seen = np.concatenate([r[0] for r in read]), np.concatenate([r[1] for r in read])
    unique, back = np.unique(keys, return_inverse=True)
    first = np.empty(len(unique), dtype=np.int64)
    first[back[::-1]] = np.arange(len(back))[::-1]
    seen = seen[first]
    context = np.repeat(back, np.concatenate([r[2] for r in read]))
    following = np.concatenate([r[3] for r in read])
    value = (context.astype(np.uint64) << np.uint64(_NEXT_BITS)) | following
    grams, counts, gram = _sorted_sums(value, np.concatenate([r[4] for r in read]).astype(np.int64))
    # A block names each pair once, so this is the number of blocks that hold it.
    alone = (np.bincount(gram, minlength=len(grams)) == 1)[gram]
    asked, grams, counts = grams, grams[counts > 0], counts[counts > 0]
    owner = (grams >> np.uint64(_NEXT_BITS)).astype(np.int64)
    number = np.bincount(owner, minlength=len(unique))
    codes = code_of(np.minimum(1.0, counts / np.maximum(1, seen[owner].astype(np.int64))))
    out, row, entry = [], 0, 0
    # Many blocks ask for the same; each pair is searched once, in order.
    with Level(unique, number, grams, codes) as level:
        found = level.search((asked >> np.uint64(_NEXT_BITS)).astype(np.int64), asked & np.uint64((1 << _NEXT_BITS) - 1))[gram]
    for m, r in zip(mail, read):
        rows, mine = back[row : row + len(r[0])], slice(entry, entry + len(r[3]))
        flags = np.packbits(alone[mine]).tobytes() if kind == PAIRS else b""
        out.append((m[0], m[1], kind, squeezed(number[rows], 4) + squeezed(found[mine], 1) + flags))
        row, entry = row + len(r[0]), entry + len(r[3])
    return out


def _word_answers(shard: int, mail: list[Mail]) -> list[Mail]:
    """Each word's count, and the number of words and of different words in this shard."""
    read = []
    for m in mail:
        reader = _Reader(m[3])
        n = int(reader.numbers(1)[0])
        read.append((np.cumsum(reader.squeezed(n, _WORD_BYTES), dtype=np.uint64), reader.squeezed(n, 8)))
    keys = np.concatenate([r[0] for r in read])
    words, counts, back = _sorted_sums(keys, np.concatenate([r[1] for r in read]).astype(np.int64))
    real = words != (START & np.uint64((1 << 8 * _WORD_BYTES) - 1))
    totals = np.array([counts[real].sum(), (counts[real] > 0).sum()], dtype=np.int64).tobytes()
    cuts = np.cumsum([len(r[0]) for r in read])[:-1]
    return [(m[0], m[1], WORDS, totals + squeezed(c, 8)) for m, c in zip(mail, np.split(counts[back], cuts))]


class Tokens:
    """The tokens of one block: the words of each document and its end."""

    def __init__(self, table: pa.Table, held_out: int, modulus: int, shards: int):
        words = words_of(table.column("text"), lower=True)
        size = np.diff(words.offsets) + 1
        self.ids, self.shards, self.size = table.column("id"), shards, size
        self.ends = np.cumsum(size)
        is_end = np.zeros(self.ends[-1], dtype=bool)
        is_end[self.ends - 1] = True
        self.tokens = np.empty(len(is_end), dtype=np.uint64)
        self.tokens[is_end], self.tokens[~is_end] = END, words.hashes
        names = ["" if i is None else str(i) for i in self.ids.to_pylist()]
        self.held_out = np.array([zlib.crc32(n.encode()) % modulus == held_out for n in names], dtype=bool)
        self.train = np.repeat(~self.held_out, size)
        self.place = np.arange(len(is_end)) - np.repeat(self.ends - size, size)
        self.words, back = np.unique(np.append(self.tokens, START), return_inverse=True)
        self.word = back[:-1]
        counts = np.bincount(self.word, weights=self.train, minlength=len(self.words)).astype(np.int64)
        counts[back[-1]] = (~self.held_out).sum()
        self.start = back[-1]
        shard = ((self.words >> np.uint64(50)) % np.uint64(shards)).astype(np.uint16)
        # Within a shard in the order of what is sent of a word, so that steps are small.
        self.sent = self.words & np.uint64((1 << 8 * _WORD_BYTES) - 1)
        order = np.argsort(self.sent)
        self.order = order[np.argsort(shard[order], kind="stable")]
        self.bounds = by_shard(shard[self.order].astype(np.int64), shards)
        self.counts = counts

    def ask_words(self, block: int) -> list[Mail]:
        words, counts = self.sent[self.order], self.counts[self.order]
        out = []
        # Every shard is asked, if only for its totals.
        for k, a, b in zip(range(self.shards), self.bounds, self.bounds[1:]):
            keys = steps(words[a:b], np.zeros(min(1, b - a), dtype=np.int64))
            head = np.array([b - a], dtype=np.int64).tobytes()
            out.append((k, block, WORDS, head + squeezed(keys, _WORD_BYTES) + squeezed(counts[a:b], 8)))
        return out

    def read_words(self, mail: list[Mail]) -> None:
        self.seen = np.zeros(len(self.words), dtype=np.int64)
        self.total = self.different = 0
        for k, _, kind, payload in mail:
            if kind == WORDS:
                a, b = self.bounds[k], self.bounds[k + 1]
                reader = _Reader(payload)
                total, different = reader.numbers(2)
                self.total, self.different = self.total + int(total), self.different + int(different)
                self.seen[self.order[a:b]] = reader.squeezed(b - a, 8)

    def pairs(self, least_seen: int) -> None:
        """The previous word of each token, and the pairs to ask for."""
        self.before = np.where(self.place > 0, np.append(0, self.word[:-1]), self.start)
        self.asked = np.flatnonzero(self.seen[self.before] >= least_seen)
        self.pair = Grams.of(
            self.before[self.asked],
            mix(self.words ^ np.uint64(2)),
            self.seen,
            self.word[self.asked],
            mix(self.words ^ np.uint64(3)),
            self.train[self.asked],
            self.total,
            self.shards,
        )

    def read_pairs(self, mail: list[Mail]) -> None:
        self.pair_share, self.pair_kinds = np.zeros(len(self.tokens)), np.zeros(len(self.tokens))
        self.pair_alone = np.zeros(len(self.tokens), dtype=bool)
        self.pair_number = np.zeros(len(self.tokens), dtype=np.int64)
        self.pair_number[self.asked] = self.pair.number
        if len(self.asked):
            self.pair_share[self.asked], self.pair_kinds[self.asked] = self.pair.read(mail, PAIRS)
            self.pair_alone[self.asked] = self.pair.alone(mail, PAIRS)

    def triples(self, least_context: int) -> None:
        """The count of each token's two previous words as a pair, and the triples to ask for."""
        count = np.round(self.pair_share * self.seen[self.before]).astype(np.int64)
        self.context_count = np.where(self.place > 0, np.append(0, count[:-1]), 0)
        enough = self.context_count >= least_context
        alone = np.append(False, self.pair_alone[:-1])
        self.own3, self.asked3 = np.flatnonzero(enough & alone), np.flatnonzero(enough & ~alone)
        at = self.asked3
        context, lead = _numbered(self.pair_number[at - 1], self.pair.pairs)
        first, second = self.words[self.before[at[lead] - 1]], self.words[self.before[at[lead]]]
        self.triple = Grams.of(
            context,
            mix(mix(first ^ np.uint64(5)) + second),
            self.context_count[at[lead]],
            self.word[at],
            mix(self.words ^ np.uint64(7)),
            self.train[at],
            self.total,
            self.shards,
        )

    def own_triples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, successors and count of its context) of each triple whose context only this block holds."""
        at = self.own3
        context, _ = _numbered(self.pair_number[at - 1], self.pair.pairs)
        grams, counts, item = _sorted_sums(context * len(self.words) + self.word[at], self.train[at])
        owner = grams // len(self.words)
        kinds, seen = np.bincount(owner, weights=counts > 0), np.bincount(owner, weights=counts)
        return counts[item], kinds[context], seen[context]

    def score(self, mail: list[Mail]) -> dict[str, pa.Array]:
        known = self.seen[self.word]
        base = (known + 0.5) / (self.total + 0.5 * (self.different + 1))
        seen = self.seen[self.before].astype(float)
        pair = np.zeros(len(seen), dtype=bool)
        pair[self.asked] = True
        chance = np.where(pair, (self.pair_share * seen + self.pair_kinds * base) / np.maximum(seen + self.pair_kinds, 1), base)
        if len(self.asked3):
            share, kinds3 = self.triple.read(mail, TRIPLES)
            # A pair that was never seen may share the hash of one that was; as a context it has no successors, and falls back.
            there = kinds3 > 0
            at, share, kinds3 = self.asked3[there], share[there], kinds3[there]
            seen = self.context_count[at].astype(float)
            chance[at] = (share * seen + kinds3 * chance[at]) / (seen + kinds3)
        if len(self.own3):
            count, kinds3, seen = self.own_triples()
            there = kinds3 > 0
            at, count, kinds3, seen = self.own3[there], count[there], kinds3[there], seen[there]
            chance[at] = (count + kinds3 * chance[at]) / (seen + kinds3)
        begin = self.ends - self.size
        total = lambda x: np.add.reduceat(x, begin)
        return {
            "doc_id": self.ids,
            "held_out": pa.array(self.held_out),
            "n_tokens": pa.array(self.size, pa.int64()),
            "n_known": pa.array(total((known > 0).astype(np.int64)), pa.int64()),
            "train_tokens": pa.array(np.full(len(self.size), self.total), pa.int64()),
            "base_score": pa.array(total(np.log10(base))),
            "score": pa.array(total(np.log10(chance))),
        }


def score_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    held_out: int = 1,
    modulus: int = 5,
    least_context: int = 1,
    least_seen: int = 1,
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    The model learns from documents whose ``crc32(doc_id) mod modulus`` is not
    ``held_out`` and scores all. Tokens are the words with A-Z in lower case,
    and an end for each document. ``base_score`` is that of single words with
    half a count added to each and to one unknown word. ``least_seen`` and
    ``least_context`` (1 or more) leave rarer contexts to lower orders; as it
    is, every context that was seen counts. Words are told apart by hashes, of 24 bits
    among the successors of one context: two of n successors that collide
    share a count, which happens to one of them in 2 ** 24 / n. A context that
    only seems to be seen by such a collision falls back to the lower order.

    Null and empty texts are one end. Equal rows count as often as they occur
    and get equal scores. A null id counts as the empty text. Without training
    documents every known share is 0 and both scores are log10 of 1. An empty
    table gives an empty result.
    """
    blocks, layout = in_blocks(docs, doc_id, text, block_mb=7.0)
    shards = layout.shards

    def load(table: pa.Table) -> Tokens:
        return Tokens(table, held_out, modulus, shards)

    def state(block: int, t: Tokens) -> Mail:
        head = np.array([t.total, t.different], dtype=np.int64).tobytes()
        return (block % shards, block, STATE, head + squeezed(t.seen, 8))

    def restore(t: Tokens, mail: list[Mail]) -> None:
        reader = _Reader(next(m[3] for m in mail if m[2] == STATE))
        t.total, t.different = (int(v) for v in reader.numbers(2))
        t.seen = reader.squeezed(len(t.words), 8).astype(np.int64)

    def first(block: int, table: pa.Table) -> list[Mail]:
        return load(table).ask_words(block)

    def second(block: int, table: pa.Table, mail: list[Mail]) -> list[Mail]:
        t = load(table)
        t.read_words(mail)
        t.pairs(least_seen)
        return [*t.pair.mail(block, PAIRS), state(block, t)]

    def pair_answers(shard: int, mail: list[Mail]) -> list[Mail]:
        return [*_level_answers(mail, PAIRS), *[m for m in mail if m[2] == STATE]]

    def third(block: int, table: pa.Table, mail: list[Mail]) -> list[Mail]:
        t = load(table)
        restore(t, mail)
        t.pairs(least_seen)
        t.read_pairs(mail)
        t.triples(least_context)
        return t.triple.mail(block, TRIPLES)

    def triple_answers(shard: int, mail: list[Mail]) -> list[Mail]:
        return _level_answers(mail, TRIPLES)

    def last(table: pa.Table, mail: list[Mail]) -> pa.Table:
        t = load(table)
        restore(t, mail)
        t.pairs(least_seen)
        t.read_pairs(mail)
        t.triples(least_context)
        return pa.table(t.score(mail))

    counts = [StructField(n, LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
    scores = [StructField(n, DoubleType()) for n in ("base_score", "score")]
    schema = StructType([StructField("doc_id", LongType()), StructField("held_out", BooleanType()), *counts, *scores])
    asked = reply(blocks, answer(send(blocks, first), _word_answers), second)
    # Answers about pairs serve two passes. They are dealt to blocks once, and wait there for those about triples.
    pairs = answer(asked, pair_answers).repartition("block")
    triples = answer(reply(blocks, pairs, third), triple_answers).repartition("block")
    return finish(blocks, pairs.unionByName(triples), last, schema)
