"""Stretches of text that other documents hold too: seeds, and their extension in both directions.

Units are words or bytes. A window is ``length`` consecutive units of one
document. The question for each window is whether the same window starts in a
document with a smaller id.

Seeds. Of the ``length - seed + 1`` stretches of ``seed`` units in a window,
the one with the least hash is the window's anchor (winnowing). Equal windows
have equal anchors, and neighbouring windows mostly share theirs, so there is
about one anchor for every ``(length - seed) / 2`` units.

Extension. The windows that share one anchor form a run: the anchor extended
left and right as far as it stays the anchor. Runs are compared instead of
pairs of documents, so a passage that a third of all documents hold costs one
entry for each document, not one for each pair.

1. Blocks send a short fingerprint of each anchor; shards tell which ones
   occur in two documents or more.
2. For those, blocks send each different run with its smallest document.
   Shards tell which block holds the smallest document of all: the run is
   removed everywhere else. They also tell which anchors have several different
   runs, because then part of a run may match part of another.
3. Only those runs are taken apart, by a method that each operator chooses.
   Anchors with very many different runs (``hot``) are always taken apart into
   windows by hash, which deals them to all shards.
4. Blocks mark what was found and give the result.

Fingerprints only narrow the search. What is removed rests on 64-bit hashes of
whole runs and windows, or on the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from touchline.llm.blocks import Layout, Mail, answer, by_shard, finish, reply, send
from touchline.llm.text import owners, prefix, stretch

_FINGERPRINT = np.uint64((1 << 31) - 1)
_SEGMENT = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
HOT_RUNS = 4096

ANCHORS, RUNS, CONTEXTS, WINDOWS, PIECES, STATE = range(6)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring keys."""
    size, out = 1, keys
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < width:
        out = np.minimum(out[: len(out) - (width - size)], out[width - size :])
    return out


def find_runs(units: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor hash, content hash) of each run, in order.

    Long texts are taken in pieces. A run ends at a piece's border, which adds
    a run and changes no window.
    """
    width = length - seed + 1
    found = []
    for a in range(0, len(units) - length + 1, _SEGMENT):
        part = units[a : a + _SEGMENT + length - 1]
        sums = prefix(part)
        windows = len(part) - length + 1
        at = np.arange(windows + width - 1)
        grams = stretch(sums, at, at + seed)
        # Among equal hashes the last place wins, so equal windows choose alike.
        keys = (grams & ~_PLACE) | (_PLACE - at.astype(np.uint64))
        chosen = (_PLACE - (_least(keys, width) & _PLACE)).astype(np.int64)
        valid = np.ones(windows, dtype=bool)
        ends = offsets[np.searchsorted(offsets, a, side="right") : np.searchsorted(offsets, a + len(part) - 1, side="right")]
        across = (ends[:, None] - np.arange(1, length)[None, :] - a).ravel()
        valid[across[(across >= 0) & (across < windows)]] = False
        border = np.ones(windows, dtype=bool)
        border[1:] = (chosen[1:] != chosen[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(border)
        count = np.diff(np.append(first, windows))
        keep = valid[first]
        first, count = first[keep], count[keep]
        found.append((first + a, count, grams[chosen[first]], stretch(sums, first, first + count - 1 + length)))
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found))


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the keys (the first is the most important), the groups of the first key, and each item's group."""
    order = np.lexsort(keys[::-1])
    key = keys[0][order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    group = np.empty(len(key), dtype=np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
    return order, first, group


def _bits(mail: list[Mail], kind: int, bounds: np.ndarray, part: int = 0, parts: int = 1) -> np.ndarray:
    """Answers of one kind put together in shard order."""
    out = np.zeros(bounds[-1], dtype=bool)
    for shard, _, k, payload in mail:
        if k == kind:
            lo, hi = bounds[shard], bounds[shard + 1]
            raw = np.frombuffer(payload, dtype=np.uint8)
            raw = raw[part * (len(raw) // parts) : (part + 1) * (len(raw) // parts)]
            out[lo:hi] = np.unpackbits(raw, count=hi - lo).astype(bool)
    return out


@dataclass
class Holders:
    """Hashes with the smallest document of this block that holds each; one entry per hash, in shard order."""

    item: np.ndarray  # entry of each item
    hashes: np.ndarray
    ids: np.ndarray
    first: np.ndarray  # the item that stands for the entry
    bounds: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, ids: np.ndarray, shards: int) -> Holders:
        order, first, group = _groups(hashes, ids)
        stands = order[first]
        shard = (hashes[stands] >> np.uint64(33)) % np.uint64(shards)
        dealt = np.argsort(shard, kind="stable")
        place = np.empty(len(dealt), dtype=np.int64)
        place[dealt] = np.arange(len(dealt))
        stands = stands[dealt]
        return cls(place[group], hashes[stands], ids[stands], stands, by_shard(shard[dealt].astype(np.int64), shards))

    def mail(self, block: int, kind: int) -> list[Mail]:
        spans = [(k, self.bounds[k], self.bounds[k + 1]) for k in range(len(self.bounds) - 1)]
        return [(k, block, kind, self.hashes[a:b].tobytes() + self.ids[a:b].tobytes()) for k, a, b in spans if a < b]


def holding(mail: list[Mail], kind: int) -> list[Mail]:
    """For each entry of each block, whether that block holds the smallest document of all."""
    mail = [m for m in mail if m[2] == kind]
    if not mail:
        return []
    parts = [np.frombuffer(m[3], dtype=np.uint64).reshape(2, -1) for m in mail]
    hashes, ids = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).view(np.int64)
    order, first, group = _groups(hashes, ids)
    holds = ids == ids[order[first]][group]
    cuts = np.cumsum([p.shape[1] for p in parts])[:-1]
    return [(m[0], m[1], kind, np.packbits(h).tobytes()) for m, h in zip(mail, np.split(holds, cuts))]


class Block:
    """One block's runs, and what its answers say about them."""

    def __init__(self, table: pa.Table, units: np.ndarray, offsets: np.ndarray, length: int, seed: int, shards: int):
        self.ids = np.array(table.column("id").fill_null(np.iinfo(np.int64).max), dtype=np.int64)
        self.units, self.offsets, self.length, self.shards = units, offsets, length, shards
        self.start, self.count, anchor, self.content = find_runs(units, offsets, length, seed)
        self.run_id = self.ids[owners(offsets, self.start)]
        shard = (anchor >> np.uint64(33)) % np.uint64(shards)
        self.code = (shard << np.uint64(31)) | (anchor & _FINGERPRINT)
        self.order, self.first, self.group = _groups(self.code)
        self.keys = self.code[self.order[self.first]]
        self.bounds = by_shard((self.keys >> np.uint64(31)).astype(np.int64), shards)

    def anchors(self, block: int) -> list[Mail]:
        if not len(self.first):
            return []
        ids = self.run_id[self.order]
        several = np.minimum.reduceat(ids, self.first) < np.maximum.reduceat(ids, self.first)
        packed = (((self.keys & _FINGERPRINT) << np.uint64(1)) | several).astype("<u4")
        spans = [(k, self.bounds[k], self.bounds[k + 1]) for k in range(self.shards)]
        return [(k, block, ANCHORS, packed[a:b].tobytes()) for k, a, b in spans if a < b]

    def narrow(self, shared: np.ndarray) -> None:
        """Keep the runs whose anchors occur in several documents."""
        self.shared = shared
        live = shared[self.group] if len(self.group) else np.zeros(0, dtype=bool)
        self.live = np.flatnonzero(live)
        self.runs = Holders.of(self.content[self.live], self.run_id[self.live], self.shards)
        self.stands = self.live[self.runs.first]
        #: The entry of each kept anchor that an entry of ``runs`` belongs to.
        number = np.cumsum(shared) - 1
        self.entry_anchor = number[self.group[self.stands]]
        self.anchor_bounds = np.append(0, np.cumsum(shared))[self.bounds]

    def contexts(self, block: int) -> list[Mail]:
        """For each shared anchor a check sum of its run and the number of different runs."""
        n = int(self.shared.sum())
        number = np.bincount(self.entry_anchor, minlength=n)
        check = np.zeros(n, dtype="<u4")
        check[self.entry_anchor] = (self.runs.hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        key = (self.keys[self.shared] & _FINGERPRINT).astype("<u4")
        number = np.minimum(number, 65_535).astype("<u2")
        spans = [(k, self.anchor_bounds[k], self.anchor_bounds[k + 1]) for k in range(self.shards)]
        return [
            (k, block, CONTEXTS, key[a:b].tobytes() + check[a:b].tobytes() + number[a:b].tobytes())
            for k, a, b in spans
            if a < b
        ]

    def decide(self, holds: np.ndarray, several: np.ndarray, hot: np.ndarray) -> None:
        self.holds, self.several, self.hot = holds, several, hot
        #: Entries whose windows must be compared one by one.
        part = holds & several[self.entry_anchor] if len(holds) else holds
        split = part & hot[self.entry_anchor] if len(holds) else part
        self.partial, self.split = np.flatnonzero(part & ~split), np.flatnonzero(split)

    def windows(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, Holders]:
        """(entry, place in its run) of each window of the entries, and the windows' holders."""
        entries = entries[np.argsort(self.start[self.stands[entries]])]
        count = self.count[self.stands[entries]]
        entry = np.repeat(entries, count)
        place = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
        lo = self.start[self.stands[entry]] + place
        hashes = np.empty(len(lo), dtype=np.uint64)
        step = 1 << 17
        for a in range(0, len(lo), step):
            part = lo[a : a + step]
            base = int(part[0])
            hashes[a : a + step] = stretch(prefix(self.units[base : int(part[-1]) + self.length]), part - base, part - base + self.length)
        return entry, place, Holders.of(hashes, self.runs.ids[entry], self.shards)

    def taken(self, entry: np.ndarray, place: np.ndarray, holders: Holders, holds: np.ndarray) -> np.ndarray:
        """Which windows start in a document with a smaller id."""
        if not len(entry):
            return np.zeros(0, dtype=bool)
        return ~holds[holders.item] | (self.runs.ids[entry] > holders.ids[holders.item])

    def covered(self, entry: np.ndarray, place: np.ndarray) -> np.ndarray:
        """A flag for each unit: covered by a window to remove, which are whole runs and the given windows of entries."""
        ids, item = self.run_id[self.live], self.runs.item
        other = (~self.holds[item] | (ids > self.runs.ids[item])) if len(item) else np.zeros(0, dtype=bool)
        whole = self.live[other]
        lo, hi = [self.start[whole]], [self.start[whole] + self.count[whole] - 1 + self.length]
        if len(entry):
            # The windows of an entry go in every run of that content in the same document.
            order = np.argsort(entry, kind="stable")
            entry, place = entry[order], place[order]
            begin = np.searchsorted(entry, np.arange(len(self.holds) + 1))
            own = np.flatnonzero(~other)
            size = (begin[1:] - begin[:-1])[item[own]]
            run = np.repeat(own, size)
            at = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[item[own]], size)
            start = self.start[self.live[run]] + place[at]
            lo.append(start)
            hi.append(start + self.length)
        n = len(self.units)
        delta = np.bincount(np.concatenate(lo), minlength=n + 1) - np.bincount(np.concatenate(hi), minlength=n + 1)
        return np.cumsum(delta)[:n] > 0


def _shared_anchors(shard: int, mail: list[Mail]) -> list[Mail]:
    parts = [np.frombuffer(m[3], dtype="<u4") for m in mail]
    both = np.concatenate(parts)
    order, first, group = _groups(both >> 1)
    size = np.diff(np.append(first, len(both)))
    shared = (size > 1) | (np.maximum.reduceat((both & 1)[order], first) > 0)
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return [(shard, m[1], ANCHORS, np.packbits(s).tobytes()) for m, s in zip(mail, np.split(shared[group], cuts))]


def _contexts(mail: list[Mail]) -> list[Mail]:
    mail = [m for m in mail if m[2] == CONTEXTS]
    if not mail:
        return []
    sizes = [len(m[3]) // 10 for m in mail]
    key = np.concatenate([np.frombuffer(m[3], "<u4", n) for m, n in zip(mail, sizes)])
    check = np.concatenate([np.frombuffer(m[3], "<u4", n, 4 * n) for m, n in zip(mail, sizes)])
    number = np.concatenate([np.frombuffer(m[3], "<u2", n, 8 * n) for m, n in zip(mail, sizes)]).astype(np.int64)
    order, first, group = _groups(key)
    check, number = check[order], number[order]
    several = (np.maximum.reduceat(number, first) > 1) | (np.minimum.reduceat(check, first) < np.maximum.reduceat(check, first))
    hot = np.add.reduceat(number, first) > HOT_RUNS
    cuts = np.cumsum(sizes)[:-1]
    both = zip(mail, np.split(several[group], cuts), np.split(hot[group], cuts))
    return [(m[0], m[1], CONTEXTS, np.packbits(s).tobytes() + np.packbits(h).tobytes()) for m, s, h in both]


def _state(block: int, shards: int, *flags: np.ndarray) -> Mail:
    """What a block tells itself for the next pass."""
    packed = [np.packbits(f).tobytes() for f in flags]
    sizes = np.array([len(flags), *[len(f) for f in flags]], dtype=np.int64).tobytes()
    return (block % shards, block, STATE, sizes + b"".join(packed))


def _restored(mail: list[Mail]) -> list[np.ndarray]:
    payload = next((m[3] for m in mail if m[2] == STATE), None)
    if payload is None:
        return []
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    sizes = np.frombuffer(payload, np.int64, n, 8)
    out, at = [], 8 * (n + 1)
    for size in sizes:
        raw = np.frombuffer(payload, np.uint8, (size + 7) // 8, at)
        out.append(np.unpackbits(raw, count=size).astype(bool))
        at += len(raw)
    return out


#: Messages for runs that need comparing, their answers, and the (entry, place) pairs to remove.
Ask = Callable[[Block, int, np.ndarray], list[Mail]]
Solve = Callable[[list[Mail]], list[Mail]]
Read = Callable[[Block, np.ndarray, list[Mail]], tuple[np.ndarray, np.ndarray]]


def remove_repeats(
    blocks: DataFrame,
    layout: Layout,
    length: int,
    seed: int,
    units: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
    result: Callable[[pa.Table, Block, np.ndarray], pa.Table],
    schema: StructType,
    compare: tuple[Ask, Solve, Read] | None = None,
) -> DataFrame:
    """The result rows of ``result(table, block, covered units)`` for each block.

    ``compare`` takes the partly matching runs apart; without it they go the way of the hot ones, by window hashes.
    """
    shards = layout.shards

    def load(table: pa.Table) -> Block:
        return Block(table, *units(table), length, seed, shards)

    def first(block: int, table: pa.Table) -> list[Mail]:
        return load(table).anchors(block)

    def second(block: int, table: pa.Table, mail: list[Mail]) -> list[Mail]:
        b = load(table)
        b.narrow(_bits(mail, ANCHORS, b.bounds))
        return [*b.runs.mail(block, RUNS), *b.contexts(block), _state(block, shards, b.shared)]

    def judged(shard: int, mail: list[Mail]) -> list[Mail]:
        return [*holding(mail, RUNS), *_contexts(mail), *[m for m in mail if m[2] == STATE]]

    def split(b: Block) -> np.ndarray:
        return b.split if compare else np.union1d(b.split, b.partial)

    def third(block: int, table: pa.Table, mail: list[Mail]) -> list[Mail]:
        b = load(table)
        b.narrow(_restored(mail)[0])
        several, hot = (_bits(mail, CONTEXTS, b.anchor_bounds, i, 2) for i in (0, 1))
        b.decide(_bits(mail, RUNS, b.runs.bounds), several, hot)
        asked = compare[0](b, block, b.partial) if compare else []
        return [*b.windows(split(b))[2].mail(block, WINDOWS), *asked, _state(block, shards, b.shared, b.holds, several, hot)]

    def compared(shard: int, mail: list[Mail]) -> list[Mail]:
        return [*holding(mail, WINDOWS), *(compare[1](mail) if compare else []), *[m for m in mail if m[2] == STATE]]

    def last(table: pa.Table, mail: list[Mail]) -> pa.Table:
        b = load(table)
        state = _restored(mail)
        b.narrow(state[0])
        b.decide(*state[1:])
        entry, place, holders = b.windows(split(b))
        taken = b.taken(entry, place, holders, _bits(mail, WINDOWS, holders.bounds))
        entry, place = entry[taken], place[taken]
        if compare:
            more = compare[2](b, b.partial, mail)
            entry, place = np.concatenate([entry, more[0]]), np.concatenate([place, more[1]])
        return result(table, b, b.covered(entry, place))

    asked = reply(blocks, answer(send(blocks, first), _shared_anchors), second)
    asked = reply(blocks, answer(asked, judged), third)
    return finish(blocks, answer(asked, compared), last, schema)
