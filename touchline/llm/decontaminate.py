"""Benchmark decontamination by greedy string tiling.

Seeds are stretches of ``least`` words that a document shares with a test
item. Only where seeds lie, tiles are laid: the longest stretches of words
that match and are not covered yet, found with running Karp-Rabin hashes,
are marked first, then shorter ones down to ``least`` words (Wise 1993). Tiles
may lie in any order, so a passage with its sentences moved around is covered
as well. A document that covers enough of a test item holds it.

Documents stay where they are: the test items go to them, in slices of a
bounded number of words.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shipping import ship
from touchline.llm.text import pieces, prefix, stretch, words_of

_SCHEMA = "doc_id long, item_id long, item_words long, n_tiles long, covered_words long, coverage double"
_FILTER_BITS = 20


def tiles(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word sequences: (place in a, place in b, length), longest tiles first.

    Each round looks for matches of ``s`` words or more between uncovered
    stretches. A match far longer than s raises s and starts the round again;
    otherwise the matches are marked from the longest to the shortest and s is
    halved.
    """
    marked_a, marked_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    sums_a, sums_b = prefix(a), prefix(b)
    found: list[tuple[int, int, int]] = []
    s = max(least, min(len(a), len(b)) // 2)

    def free(marked: np.ndarray, s: int) -> np.ndarray:
        covered = np.append(0, np.cumsum(marked))
        return np.flatnonzero(covered[s:] == covered[: len(covered) - s])

    while True:
        at_a, at_b = free(marked_a, s), free(marked_b, s)
        known: dict[int, list[int]] = defaultdict(list)
        for h, j in zip(stretch(sums_b, at_b, at_b + s).tolist(), at_b.tolist()):
            known[h].append(j)
        matches, longest, past = [], 0, {}
        for h, i in zip(stretch(sums_a, at_a, at_a + s).tolist(), at_a.tolist()):
            for j in known.get(h, ()):
                if past.get(i - j, -1) > i:  # inside a match that was found already
                    continue
                n = s
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not marked_a[i + n] and not marked_b[j + n]:
                    n += 1
                past[i - j] = i + n - s + 1
                matches.append((n, i, j))
                longest = max(longest, n)
        if longest > 2 * s:
            s = longest
            continue
        matches.sort(key=lambda m: (-m[0], m[1], m[2]))
        again = False
        for n, i, j in matches:
            if not (marked_a[i : i + n].any() or marked_b[j : j + n].any()):
                marked_a[i : i + n] = marked_b[j : j + n] = True
                found.append((i, j, n))
            else:
                again = True
        if again:  # what is left beside a longer tile may still match
            continue
        if s == least:
            return found
        s = max(least, s // 2)


class Items:
    """Test items as word hashes, and where each seed occurs in them."""

    def __init__(self, ids: list[int], texts: list[str | None], least: int):
        words = words_of(pa.array(texts, pa.string()), lower=True)
        self.ids, self.least = ids, least
        self.words = [words.hashes[a:b] for a, b in zip(words.offsets, words.offsets[1:])]
        # Items with fewer words than a seed are one seed of their own length.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for k, w in enumerate(self.words):
            if len(w):
                size = min(least, len(w))
                at = np.arange(len(w) - size + 1)
                by_size[size].append((stretch(prefix(w), at, at + size), k))
        for size, found in by_size.items():
            hashes = np.concatenate([h for h, _ in found])
            owner = np.concatenate([np.full(len(h), k) for h, k in found])
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            keep = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
            maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
            maybe[hashes & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.seeds[size] = (hashes[keep], owner[keep], maybe)

    def hits(self, hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(document, item, seed size, places of shared seeds) for the documents' word hashes."""
        for size, (seeds, owner, maybe) in self.seeds.items():
            step = 1 << 18
            at_parts = []
            for a in range(0, len(hashes) - size + 1, step):
                part = hashes[a : a + step + size - 1]
                at = np.arange(len(part) - size + 1)
                grams = stretch(prefix(part), at, at + size)
                near = np.flatnonzero(maybe[grams & np.uint64((1 << _FILTER_BITS) - 1)])
                place = np.searchsorted(seeds, grams[near])
                real = seeds[np.minimum(place, len(seeds) - 1)] == grams[near]
                at_parts.append((near[real] + a, grams[near[real]]))
            if not at_parts:
                continue
            at = np.concatenate([p[0] for p in at_parts])
            grams = np.concatenate([p[1] for p in at_parts])
            document = np.searchsorted(offsets, at, side="right") - 1
            inside = at + size <= offsets[document + 1]
            at, grams, document = at[inside], grams[inside], document[inside]
            lo, hi = np.searchsorted(seeds, grams), np.searchsorted(seeds, grams, side="right")
            number = hi - lo
            each = np.repeat(np.arange(len(at)), number)
            item = owner[np.arange(len(each)) - np.repeat(np.cumsum(number) - number, number) + lo[each]]
            key = np.lexsort((at[each], item, document[each]))
            d, i, p = document[each][key], item[key], at[each][key]
            first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (i[1:] != i[:-1]))) if len(d) else []
            for x, y in zip(first, [*first[1:], len(d)]):
                yield int(d[x]), int(i[x]), size, p[x:y]


def _covered(words: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """The stretches of a document that seeds cover, with a different unknown word between any two of them."""
    cover = np.unique((places[:, None] + np.arange(size)).ravel())
    gaps = np.flatnonzero(np.diff(cover) > 1) + 1
    return np.insert(words[cover], gaps, np.arange(len(gaps), dtype=np.uint64))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: int = 5,
    threshold: float = 0.5,
    slice_words: int = 200_000,
) -> DataFrame:
    """(doc_id, item_id, item_words, n_tiles, covered_words, coverage) for each document that holds a test item.

    ``coverage`` is the share of the item's words that lie in tiles of
    ``least`` words or more; rows have ``threshold`` or more. A-Z count as
    lower case. Items are handed to the tasks in slices of about
    ``slice_words`` words, and the documents are read once for each slice.

    An item with fewer words than ``least`` must occur whole. Null and empty
    texts, of documents and items, hold and give nothing; so do empty tables.
    Repeated documents give a row each, as do repeated items. A null id is
    returned as null.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    tests = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    words = tests.agg(F.sum(F.size(F.split(F.trim("text"), r"[ \t-\r]+")))).first()[0] or 0
    slices = max(1, math.ceil(words / slice_words))
    number = F.pmod(F.xxhash64("id", "text"), F.lit(slices))

    def scan(part: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text"):
                words = words_of(batch.column("text"), lower=True)
                ids = batch.column("id").to_pylist()
                out = []
                for d, i, size, places in part.hits(words.hashes, words.offsets):
                    laid = tiles(_covered(words.hashes, places, size), part.words[i], size)
                    total, covered = len(part.words[i]), sum(n for _, _, n in laid)
                    if covered >= threshold * total:
                        out.append((ids[d], part.ids[i], total, len(laid), covered, covered / total))
                if out:
                    names = ("doc_id", "item_id", "item_words", "n_tiles", "covered_words", "coverage")
                    yield pa.RecordBatch.from_pydict(dict(zip(names, (pa.array(c) for c in zip(*out)))), schema=_ARROW)

        return rows.mapInArrow(run, _SCHEMA)

    found = []
    for k in range(slices):
        part = tests.where(number == k).collect()  # about slice_words words
        found.append(scan(Items([r[0] for r in part], [r[1] for r in part], least)))
    return reduce(DataFrame.unionByName, found)


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("item_words", pa.int64()),
        ("n_tiles", pa.int64()),
        ("covered_words", pa.int64()),
        ("coverage", pa.float64()),
    ]
)
