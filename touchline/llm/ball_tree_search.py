"""Ranked lexical search: exact inner products of sparse document vectors, found through ball trees.

A document is a sparse vector of integer term values, an item a sparse vector
of integer term weights, and a score is their inner product. Within a task,
documents form ball trees: a node has a centroid and a radius, so no document
below it scores more than ``q . c + |q'| * r``, where q' is the part of the item's
vector on terms that occur below the node. An item visits subtrees best first
and stops when no bound reaches its worst kept score. Leaves are scored in
integers, and bounds are rounded up by more than what sums of doubles can lose,
so the result is that of scoring every document.

Documents stay where they are: a task builds one tree after the other over
bounded chunks of its documents and keeps the best of each item, so what leaves
it are ``top`` rows per item. Items go to all tasks in slices of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.shipping import ship
from touchline.llm.text import LOWER, Words, pieces, text_bytes
from touchline.sources.tables import staged

#: Bytes that separate terms: all of ASCII but digits and letters.
SEPARATES = np.ones(256, dtype=bool)
SEPARATES[128:] = False
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    SEPARATES[_first : _last + 1] = False

#: Terms of the items that go to the tasks at once; an item with more goes alone.
SLICE_TERMS = 400_000
#: Documents and entries of a tree, and documents of a leaf.
TREE_DOCS, TREE_ENTRIES, LEAF_DOCS = 8192, 2_000_000, 32
#: Doubles are sums of fewer than 2 ** 22 products without sign, each rounded by 2 ** -53 of itself at most.
_SAFE = 1e-9


def term_weight(n: int, df: int) -> int:
    """The weight of a term that ``df`` of ``n`` documents hold."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def term_values(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """The value of a term with ``tf`` occurrences in a document of ``length`` of the ``total`` terms."""
    m = 100 - 90 + (90 * length * n) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _terms(column: pa.Array | pa.ChunkedArray) -> Words:
    data, offsets = text_bytes(column)
    return Words(LOWER[data], offsets, SEPARATES)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        words = _terms(batch.column("text"))
        cuts = words.offsets
        lists = [np.unique(words.hashes[a:b]).view(np.int64) for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(lists, pa.list_(pa.int64()))], ["item_id", "terms"])


@dataclass
class Items:
    """A slice of items: sorted hashes of their terms, and each item's terms as numbers of these."""

    ids: list[int | None]
    vocabulary: np.ndarray
    terms: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # by term

    @staticmethod
    def of(rows) -> Items:
        lists = [np.array(r.terms, dtype=np.int64).view(np.uint64) for r in rows]
        flat = np.concatenate(lists)
        vocabulary, numbers = np.unique(flat, return_inverse=True)
        return Items([r.item_id for r in rows], vocabulary, numbers, np.append(0, np.cumsum([len(x) for x in lists])))


def _postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's length and how often it has which terms of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = _terms(batch.column("text"))
            counts = np.diff(words.offsets)
            owner = np.repeat(np.arange(len(counts)), counts)
            number = np.minimum(np.searchsorted(vocabulary, words.hashes), len(vocabulary) - 1)
            known = vocabulary[number] == words.hashes
            keys, tfs = np.unique(owner[known] * len(vocabulary) + number[known], return_counts=True)
            owner, number = np.divmod(keys, len(vocabulary))
            offsets = pa.array(np.searchsorted(owner, np.arange(len(counts) + 1)), pa.int32())
            columns = [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(number, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _document_counts(postings: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term: counted where the postings lie, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, dtype=np.int64)
        for batch in batches:
            found += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        term = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(found[term], pa.int64())], ["term", "df"])

    out = np.zeros(size, dtype=np.int64)
    for r in postings.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df  # one row per term of the slice
    return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All positions of ranges, one after the other."""
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


class Tree:
    """A ball tree over documents, with the bound of every node for every item."""

    def __init__(self, terms: np.ndarray, values: np.ndarray, offsets: np.ndarray, items: Items):
        self.items = items
        self.scratch = np.zeros(len(items.vocabulary))
        self.weights = items.weights[items.terms].astype(np.float64)
        self.children: list[tuple[int, int] | None] = []
        self.leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None] = []
        self.bounds: list[np.ndarray] = []
        self._grow(terms, values, offsets, np.arange(len(offsets) - 1), None)

    def _products(self, terms: np.ndarray, values: np.ndarray, starts: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Inner product of every document with one vector."""
        self.scratch[at] = to
        found = np.add.reduceat(self.scratch[terms] * values, starts)
        self.scratch[at] = 0
        return found

    def _bound(self, terms, values, offsets, squares) -> np.ndarray:
        n = len(offsets) - 1
        centroid = np.bincount(terms, weights=values, minlength=len(self.scratch)) / n
        around = centroid @ centroid
        distance = squares + around - 2 * np.add.reduceat(centroid[terms] * values, offsets[:-1])
        # No distance is lost to rounding: the error is a share of what was added and taken away.
        radius = np.sqrt(np.max(np.maximum(distance, 0) + 4 * _SAFE * (squares + around)))
        own = self.items.terms
        inner = np.add.reduceat(self.weights * centroid[own], self.items.offsets[:-1])
        norm = np.sqrt(np.add.reduceat(self.weights**2 * (centroid[own] > 0), self.items.offsets[:-1]))
        return (inner + norm * radius) * (1 + 4 * _SAFE) + 1

    def _grow(self, terms, values, offsets, members, above) -> int:
        wide = values.astype(np.float64)
        squares = np.add.reduceat(wide * wide, offsets[:-1])
        bound = self._bound(terms, wide, offsets, squares)
        node = len(self.bounds)
        self.bounds.append(bound if above is None else np.minimum(bound, above))
        self.children.append(None)
        self.leaves.append(None)
        n = len(members)
        if n <= LEAF_DOCS:
            self.leaves[node] = (terms, values, offsets[:-1], members)
            return node
        # Two documents far from each other; the halves are those nearer to either.
        away = [0]
        sides = []
        for _ in range(3):
            a = slice(offsets[away[-1]], offsets[away[-1] + 1])
            sides.append(squares + squares[away[-1]] - 2 * self._products(terms, wide, offsets[:-1], terms[a], wide[a]))
            away.append(int(np.argmax(sides[-1])))
        side = np.argpartition(sides[2] - sides[1], n // 2)
        pair = []
        for part in (np.sort(side[: n // 2]), np.sort(side[n // 2 :])):
            counts = offsets[part + 1] - offsets[part]
            at = _ranges(offsets[part], counts)
            pair.append(self._grow(terms[at], values[at], np.append(0, np.cumsum(counts)), members[part], self.bounds[node]))
        self.children[node] = (pair[0], pair[1])
        return node

    def search(self, item: int, least: int, kept) -> tuple[int, int]:
        """Score leaves best first while a bound reaches ``least``; ``kept`` takes (scores, members) and gives the new least.

        Returns the numbers of leaves that were scored, and of all.
        """
        own = slice(self.items.offsets[item], self.items.offsets[item + 1])
        weights = np.zeros(len(self.scratch), dtype=np.int64)
        weights[self.items.terms[own]] = self.items.weights[self.items.terms[own]]
        queue = [(-self.bounds[0][item], 0)]
        scored = 0
        while queue and -queue[0][0] >= least:
            node = heapq.heappop(queue)[1]
            if self.children[node]:
                for child in self.children[node]:
                    if self.bounds[child][item] >= least:
                        heapq.heappush(queue, (-self.bounds[child][item], child))
                continue
            terms, values, starts, members = self.leaves[node]
            least = kept(np.add.reduceat(weights[terms] * values, starts), members)
            scored += 1
        return scored, sum(x is not None for x in self.leaves)


class Best:
    """The best documents of one item so far: by score, then by id, null last."""

    def __init__(self, top: int):
        self.top = top
        self.rows: list[tuple[int, bool, int]] = []

    @property
    def least(self) -> int:
        return -self.rows[-1][0] if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> int:
        good = np.flatnonzero(scores >= self.least)
        if len(good):
            more = zip((-scores[good]).tolist(), nulls[good].tolist(), ids[good].tolist())
            self.rows = sorted([*self.rows, *more])[: self.top]
        return self.least


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Documents that hold any term of the items, in tables of bounded size."""
    held, docs, entries = [], 0, 0
    for batch in batches:
        lengths = np.diff(batch.column("terms").offsets.to_numpy())
        batch = batch.filter(pa.array(lengths > 0))
        lengths = lengths[lengths > 0]
        a = 0
        while a < batch.num_rows:
            room = np.searchsorted(np.cumsum(lengths[a:]), TREE_ENTRIES - entries, side="right")
            take = int(min(max(room, 1), TREE_DOCS - docs, batch.num_rows - a))
            held.append(batch.slice(a, take))
            docs, entries, a = docs + take, entries + int(lengths[a : a + take].sum()), a + take
            if docs >= TREE_DOCS or entries >= TREE_ENTRIES:
                yield pa.Table.from_batches(held).combine_chunks()
                held, docs, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _ranked(postings: DataFrame, items: Items, n: int, total: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items.ids]
        for table in _trees(batches):
            column = table.column("terms").chunk(0)
            offsets = column.offsets.to_numpy().astype(np.int64)
            terms = column.flatten().to_numpy()
            tfs = table.column("tfs").chunk(0).flatten().to_numpy().astype(np.int64)
            length = np.repeat(table.column("n").to_numpy(), np.diff(offsets))
            ids, nulls = table.column("doc_id").fill_null(0).to_numpy(), table.column("doc_id").is_null().to_numpy()
            tree = Tree(terms, term_values(tfs, length, n, total), offsets - offsets[0], items)
            for item, own in enumerate(best):
                tree.search(item, own.least, lambda scores, members: own.add(scores, ids[members], nulls[members]))
        rows = [(items.ids[i], None if null else doc, -score) for i, own in enumerate(best) for score, null, doc in own.rows]
        for a in range(0, len(rows), 8192):
            columns = [pa.array(c, pa.int64()) for c in zip(*rows[a : a + 8192])]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    return postings.mapInArrow(run, "item_id long, doc_id long, score long")


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents with the highest scores above 0 for each item.

    Terms are runs of ASCII digits and letters and of other characters beyond
    ASCII, with A to Z in lower case; they are told apart by 64-bit hashes.
    Equal scores stand by ascending id, null last. Each row of ``docs`` is a
    document, equal rows and equal ids too; a null or empty text has no terms
    and counts nowhere. Of items with equal ids the one with the least text
    counts, null first; a null id is an item like others. An item without terms, or whose terms
    no document holds, has no rows. Empty tables give an empty table; other
    columns are ignored.

    The documents are read once for each slice of SLICE_TERMS item terms.
    """
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    once = items.groupBy(F.col(item_id).cast("long").alias("item_id")).agg(F.min(F.struct(item_text))[item_text].alias("text"))
    listed = staged(once.mapInArrow(_item_terms, "item_id long, terms array<long>").where(F.size("terms") > 0), "items")
    terms = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    slices = math.ceil(terms / SLICE_TERMS)
    found = []
    for k in range(slices):
        rows = listed.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k).collect()  # about SLICE_TERMS terms
        if not rows:
            continue
        own = Items.of(rows)
        postings = staged(_postings(given, own.vocabulary), "postings")
        n, total = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n:
            break
        counts = _document_counts(postings, len(own.vocabulary))
        own.weights = np.array([term_weight(n, int(df)) for df in counts], dtype=np.int64)
        found.append(staged(_ranked(postings, own, n, total, top), "ranked"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
