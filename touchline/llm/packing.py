"""Packing of documents into training sequences, in their order.

The documents' tokens form one stream. It is cut into windows of at most
``limit`` tokens. A cut costs nothing between documents, little after a
sentence, and more inside one; a window costs the padding that fills it up to
``limit``, unless its length is a power of two. The cheapest set of cuts comes
from dynamic programming over the places where a cut may lie:

    best[j] = price(j) + min over i of best[i] + padding(place[j] - place[i])

Padding falls by one for each token, so the minimum over all i within reach is
that of ``best[i] + place[i]`` over a sliding window, which a monotone queue
gives at once. Windows of a power of two are tried beside it.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.ordered import LAST, in_order
from touchline.llm.text import BYTE_HASH, pieces, prefix, stretch, text_bytes

END = 1
SENTENCE_PRICE = 2.0
INSIDE_PRICE = 24.0
_TOGETHER = 400


class Encoder:
    """Token ids of texts by a byte-level BPE file, each different word encoded once.

    Byte-level BPE never joins characters across the border before a space
    that follows a non-space, so texts are split there and the ids of the
    parts put end to end. Parts are told apart by 64-bit hashes, and looked up
    and put together as arrays.

    Strings of the file's added tokens in a text become these tokens, as the
    library has it; such a text is encoded as a whole.
    """

    def __init__(self, path: str, cached: int = 100_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        #: The first ``cached`` different parts: hashes in order, and where their ids lie. Others are encoded again in each call.
        self.cached = cached
        self.forget()
        size = self.model.get_vocab_size()
        last = [(self.model.id_to_token(i) or " ")[-1] for i in range(size)]
        #: Tokens that end a sentence; the byte-level alphabet writes a line feed as Ċ.
        self.sentence = np.array([c in ".!?Ċ" for c in last])
        #: Tokens that start with a space, which that alphabet writes as Ġ.
        self.spaced = np.array([(self.model.id_to_token(i) or "").startswith("Ġ") for i in range(size)])

    def forget(self) -> None:
        """Drops the ids of all words."""
        self.hashes, self.starts, self.ends = (np.zeros(0, dtype) for dtype in (np.uint64, np.int64, np.int64))
        self.ids = np.zeros(0, dtype="<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = {i: t for i, t in enumerate(texts) if any(a in t for a in self.added)}
        data, offsets = text_bytes(pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.large_string()))
        ids, cuts = self._ids(data, offsets)
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        for i, found in zip(whole, self.model.encode_batch_fast(list(whole.values()), add_special_tokens=False)):
            out[i] = np.array(found.ids, dtype="<u4")
        return out

    def _ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and n + 1 offsets."""
        starts = part_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = np.empty(len(starts), dtype=np.uint64)
        for a in range(0, len(starts), 1 << 16):
            lo, hi = starts[a : a + (1 << 16)], ends[a : a + (1 << 16)]
            hashes[a : a + len(lo)] = stretch(prefix(BYTE_HASH[data[lo[0] : hi[-1]]]), lo - lo[0], hi - lo[0])
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, unique)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == unique[known]
        lo, hi = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        lo[known], hi[known] = self.starts[at[known]], self.ends[at[known]]
        fresh = np.flatnonzero(~known)
        text = data.tobytes()
        made = self._encoded([text[a:b].decode() for a, b in zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist())])
        sizes = np.array([len(m) // 4 for m in made], dtype=np.int64)
        table = np.concatenate([self.ids, np.frombuffer(b"".join(made), dtype="<u4")])
        hi[fresh] = len(self.ids) + np.cumsum(sizes)
        lo[fresh] = hi[fresh] - sizes
        if len(self.hashes) < self.cached:
            place = at[fresh]
            self.hashes = np.insert(self.hashes, place, unique[fresh])
            self.starts, self.ends = np.insert(self.starts, place, lo[fresh]), np.insert(self.ends, place, hi[fresh])
            self.ids = table
        counts = (hi - lo)[back]
        ids = table[np.arange(counts.sum()) + np.repeat(lo[back] - (np.cumsum(counts) - counts), counts)]
        return ids, np.append(0, np.cumsum(counts))[np.searchsorted(starts, offsets)]

    def _encoded(self, words: list[str]) -> list[bytes]:
        """The ids of each part. Words after one space are encoded many at a time: each starts at a token that starts with a space."""
        plain = [i for i, w in enumerate(words) if w[0] == " " and w.split() == [w[1:]]]
        out: list[bytes | None] = [None] * len(words)
        groups = [plain[i : i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        for group, found in zip(groups, self.model.encode_batch_fast(["".join(words[i] for i in g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            cuts = np.flatnonzero(self.spaced[ids])
            if len(cuts) == len(group):
                raw, at = ids.tobytes(), (4 * np.append(cuts, len(ids))).tolist()
                for i, a, b in zip(group, at, at[1:]):
                    out[i] = raw[a:b]
        rest = [i for i, found in enumerate(out) if found is None]
        for i, found in zip(rest, self.model.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(found.ids, dtype="<u4").tobytes()
        return out


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the parts of texts start that may be encoded on their own: at their first byte, and at spaces after what is no space.

    A byte of a longer character counts as white space if the character may be
    such; a place that is left out only makes a part longer.
    """
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    before = data[at - 1]
    wide = before >= 128
    third, second = data[np.maximum(at - 3, 0)], data[np.maximum(at - 2, 0)]
    blank = wide & (((second == 0xC2) & ((before == 0x85) | (before == 0xA0))) | ((third >= 0xE1) & (third <= 0xE3) & np.isin(second, (0x9A, 0x80, 0x81))))
    solid = ~blank & (before != 32) & ~((before >= 9) & (before <= 13)) & ~((before >= 28) & (before <= 31))
    first = offsets[:-1][np.diff(offsets) > 0]
    return np.union1d(at[solid], first)


@lru_cache(maxsize=2)
def encoder(path: str, cached: int) -> Encoder:
    """The worker's encoder for a file; its words last from task to task unless the task drops them."""
    return Encoder(path, cached)


def cut_places(ids: np.ndarray, ends: np.ndarray, sentence: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut may lie, and their prices.

    These are the ends of documents and sentences, every 64th token in long
    stretches without either, and all places in the last ``limit`` tokens,
    which let the stream end in windows of a power of two.
    """
    n = len(ids)
    price = np.full(n + 1, np.inf)
    price[max(0, n - limit) :] = INSIDE_PRICE
    price[np.flatnonzero(sentence[ids]) + 1] = SENTENCE_PRICE
    price[0] = 0.0
    price[ends] = 0.0
    at = np.flatnonzero(price < np.inf)
    for i in np.flatnonzero(np.diff(at) > 256):
        price[at[i] + 64 : at[i + 1] : 64] = INSIDE_PRICE
    at = np.flatnonzero(price < np.inf)
    return at, price[at]


def best_cuts(place: np.ndarray, price: np.ndarray, limit: int) -> np.ndarray:
    """The places of the cheapest cuts, first and last place included. Neighbouring places are at most ``limit`` apart."""
    m = len(place)
    exact: dict[int, list[int]] = {}
    size = limit
    while size:
        if size & (size - 1) == 0:
            at = np.searchsorted(place, place - size)
            for j in np.flatnonzero((place[np.minimum(at, m - 1)] == place - size) & (place >= size)):
                exact.setdefault(int(j), []).append(int(at[j]))
            size //= 2
        else:
            size &= size - 1
    where, cost = place.tolist(), price.tolist()
    best, came = [0.0] * m, [0] * m
    # The monotone queue as arrays: places with rising keys (best + place), of which those before ``head`` are too far back.
    keys, queue = [0.0] * m, [0] * m
    keys[0] = float(where[0])
    head, tail = 0, 1
    near = exact.get
    for j in range(1, m):
        here = where[j]
        oldest = here - limit
        while where[queue[head]] < oldest:
            head += 1
        i = queue[head]
        value = keys[head] - oldest
        same = near(j)
        if same is not None:
            for k in same:
                if best[k] < value:
                    value, i = best[k], k
        value += cost[j]
        best[j], came[j] = value, i
        value += here
        while tail > head and keys[tail - 1] >= value:
            tail -= 1
        keys[tail], queue[tail] = value, j
        tail += 1
    cuts = [m - 1]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return place[np.array(cuts[::-1])]


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 2048,
    stretch_tokens: int = 1_000_000,
    with_ids: bool = True,
    narrow: bool = False,
    cached_words: int = 3_000_000,
    lasting: bool = True,
) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, doc_tokens, sequence_id, offset, and ids or ids_crc32.

    ``ids`` holds the piece's tokens as little-endian numbers of four bytes, or
    of two with ``narrow``, which takes a vocabulary of 65,536 at most. With
    ``with_ids=False`` their checksum ``ids_crc32`` is given instead.

    A document is its token ids and the end mark 1; ``start`` counts its ids
    before the piece, ``offset`` the ids before it in its sequence. Documents
    are laid in id order, in parts of even length that are packed on their own;
    a part is packed in stretches of about ``stretch_tokens``, which bounds
    memory. ``tokenizer`` is a path that every executor can read. A worker keeps
    the ids of ``cached_words`` words, about 40 bytes each, from task to task;
    with ``lasting=False`` until its task ends, so that workers that live on have
    their memory for other steps.

    Null and empty texts are the end mark alone. Very long documents run over
    several sequences. Rows with equal ids, or equal rows, are packed as
    documents of their own, in the order of their texts. A null id comes last.
    An empty table gives an empty result.
    """
    rows, _ = in_order(docs, doc_id, text)
    laid = rows.repartition("part").sortWithinPartitions("part", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer, cached_words)
        part, number = -1, 0
        held: list[tuple[int, np.ndarray]] = []
        tokens = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal held, tokens, number
            if not held:
                return
            ids = np.concatenate([t for _, t in held])
            ends = np.cumsum([len(t) for _, t in held])
            cuts = best_cuts(*cut_places(ids, ends, bpe.sentence, limit), limit)
            # A piece ends wherever a document or a sequence does.
            edges = np.union1d(cuts, ends)
            lo, hi = np.append(0, edges[edges > 0][:-1]), edges[edges > 0]
            document = np.searchsorted(ends, lo, side="right")
            begin = ends - [len(t) for _, t in held]
            sequence = np.searchsorted(cuts, lo, side="right") - 1
            owner = np.array([d for d, _ in held], dtype=np.int64)[document]
            columns = {
                "doc_id": pa.array(owner, pa.int64(), mask=owner == LAST),
                "start": pa.array(lo - begin[document], pa.int64()),
                "length": pa.array(hi - lo, pa.int64()),
                "doc_tokens": pa.array((ends - begin)[document], pa.int64()),
                "sequence_id": pa.array((part << 40) + number + sequence, pa.int64()),
                "offset": pa.array(lo - cuts[sequence], pa.int64()),
            }
            if with_ids:
                # The pieces follow each other, so the bytes of all of them are one buffer.
                raw = (ids.astype("<u2") if narrow else ids).tobytes()
                bounds = np.append(lo, hi[-1:]).astype(np.int64) * (2 if narrow else 4)
                columns["ids"] = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lo), [None, pa.py_buffer(bounds), pa.py_buffer(raw)]).cast(pa.binary())
            else:
                columns["ids_crc32"] = pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(lo.tolist(), hi.tolist())], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)
            number += len(cuts) - 1
            held, tokens = [], 0

        for batch in pieces(batches, "text"):
            found = bpe.encode(batch.column("text").to_pylist())
            for p, d, t in zip(batch.column("part").to_pylist(), batch.column("id").to_pylist(), found):
                if p != part or tokens > stretch_tokens:
                    yield from packed()
                if p != part:
                    part, number = p, 0
                held.append((d, np.append(t, np.uint32(END)).astype("<u4")))
                tokens += len(t) + 1
        yield from packed()
        if not lasting:
            bpe.forget()

    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    return laid.mapInArrow(run, schema + ("ids binary" if with_ids else "ids_crc32 long"))
