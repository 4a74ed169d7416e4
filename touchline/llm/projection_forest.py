"""Approximate nearest neighbours by a forest of random-projection trees.

A tree halves the vectors at the median of their projections on the line
through two random vectors of the node. The forest is fitted on a bounded
sample; every vector is then routed down every tree, and the vectors of a leaf
are counted. A query goes down all trees at once: one priority queue holds the
nodes of all trees, by the squared distance that the query would have to cross
to reach them, and leaves are taken until they hold a share of all vectors.
Queries and vectors meet by leaf, and leaf candidates are ranked by the exact
cosine of the given vectors.

Equal vectors are one node with its smallest ids, so many copies of a vector
cost no more than one. Leaves are put together to cells of even size, and a cell
that is still too large, in vectors or in queries, is dealt to several tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.shipping import ship
from touchline.sources.tables import staged

#: Vectors and queries that meet in one task.
CELL_ROWS = 16_384
CELL_QUERIES = 4_096
#: Sums of rounded products may differ by this much from the exact measure.
_SLACK = 1e-9


@dataclass
class Forest:
    """Complete trees in heap order: node i has the children 2 i + 1 and 2 i + 2."""

    directions: np.ndarray  # trees x nodes x dimension
    cuts: np.ndarray  # trees x nodes
    depth: int

    def leaves(self, unit: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector in each tree."""
        found = np.empty((len(unit), len(self.cuts)), dtype=np.int32)
        for t in range(len(self.cuts)):
            at = np.zeros(len(unit), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", unit, self.directions[t][at]) > self.cuts[t][at]
                at = 2 * at + 1 + side
            found[:, t] = at - (2**self.depth - 1)
        return found

    def probe(self, unit: np.ndarray, sizes: np.ndarray, wanted: int) -> list[tuple[int, int]]:
        """(tree, leaf) of the nearest leaves of one unit vector, until they hold ``wanted`` vectors."""
        inner = 2**self.depth - 1
        margins = np.einsum("tnd,d->tn", self.directions, unit) - self.cuts
        queue = [(0.0, t, 0) for t in range(len(self.cuts))]
        found, held = [], 0
        while queue and held < wanted:
            crossed, t, node = heapq.heappop(queue)
            if node >= inner:
                n = int(sizes[t, node - inner])
                if n:
                    found.append((t, node - inner))
                    held += n
                continue
            margin = float(margins[t, node])
            near = 2 * node + 1 + (margin > 0)
            heapq.heappush(queue, (crossed, t, near))
            heapq.heappush(queue, (crossed + margin * margin, t, 4 * node + 3 - near))
        return found


def fit_forest(sample: np.ndarray, trees: int, depth: int, leaf: int = 16, seed: int = 1) -> Forest:
    """Trees of unit vectors, no deeper than that a leaf holds ``leaf`` of the sample."""
    rng = np.random.default_rng(seed)
    depth = max(0, min(depth, int(np.log2(max(len(sample), 1) / leaf)) if len(sample) > leaf else 0))
    directions = np.zeros((trees, 2**depth - 1, sample.shape[1]), dtype=np.float32)
    cuts = np.zeros((trees, 2**depth - 1), dtype=np.float32)
    for t in range(trees):
        members = {0: np.arange(len(sample))}
        for node in range(2**depth - 1):
            own = members.pop(node)
            line = np.zeros(sample.shape[1])
            if len(own) > 1:
                a, b = sample[rng.choice(own, 2, replace=False)]
                line = a - b
            if not line.any():
                line = rng.normal(size=sample.shape[1])
            line = (line / np.linalg.norm(line)).astype(np.float32)
            at = sample[own] @ line.astype(np.float64)
            cut = np.float32(np.median(at)) if len(own) else np.float32(0)
            directions[t, node], cuts[t, node] = line, cut
            members[2 * node + 1], members[2 * node + 2] = own[at <= cut], own[at > cut]
    return Forest(directions, cuts, depth)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the vectors in equal rows of two arrays, in double precision."""
    a, b = _scaled(a), _scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors times powers of two, which changes no cosine, so that squares stay within the range of doubles."""
    wide = vectors.astype(np.float64)
    return np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1, keepdims=True))[1])


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = _scaled(vectors)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def _usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector): ids with the least of their vectors; no nulls, no zero vectors, one length: the commonest, of equals the larger."""
    element = df.schema[vector].dataType.elementType.simpleString()
    kind = element if element in ("float", "double") else "double"
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    # At most one row per length in use reaches the driver.
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0].n if sizes else 0)).groupBy("id").agg(F.min("vector").alias("vector"))


def _routed(nodes: DataFrame, forest: Forest, kind: str) -> DataFrame:
    """(tree, leaf, least, ids, vector): every node once for each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = forest.leaves(_unit(_matrix(batch.column("vector"))).astype(np.float32))
            for t in range(leaves.shape[1]):
                tree = pa.array(np.full(len(leaves), t, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [tree, pa.array(leaves[:, t]), *[batch.column(n) for n in ("least", "ids", "vector")]], ["tree", "leaf", "least", "ids", "vector"]
                )

    return nodes.mapInArrow(run, f"tree int, leaf int, least long, ids array<long>, vector {kind}")


def _probed(queries: DataFrame, forest: Forest, sizes: np.ndarray, cells: np.ndarray, wanted: int, kind: str) -> DataFrame:
    """(tree, cell, leaves, query, vector): a query once for each cell in which it has leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _unit(_matrix(batch.column("vector"))).astype(np.float32) if batch.num_rows else []
            rows, trees, places, lists = [], [], [], []
            for i, unit in enumerate(units):
                by_cell: dict[tuple[int, int], list[int]] = {}
                for t, leaf in forest.probe(unit, sizes, wanted):
                    by_cell.setdefault((t, int(cells[t, leaf])), []).append(leaf)
                for (t, cell), leaves in by_cell.items():
                    rows.append(i)
                    trees.append(t)
                    places.append(cell)
                    lists.append(leaves)
            for a in range(0, len(rows), 4096):
                part = batch.take(pa.array(rows[a : a + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(trees[a : a + 4096], pa.int32()),
                        pa.array(places[a : a + 4096], pa.int32()),
                        pa.array(lists[a : a + 4096], pa.list_(pa.int32())),
                        part.column("least"),
                        part.column("vector"),
                    ],
                    ["tree", "cell", "leaves", "query", "vector"],
                )

    return queries.mapInArrow(run, f"tree int, cell int, leaves array<int>, query long, vector {kind}")


def _meet(k: int):
    """Exact ranking of the vectors in a cell for the queries with leaves there: k nodes a query at most."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"query": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        vectors, wishes = _matrix(left.column("vector")), _matrix(right.column("vector"))
        units, aims = _unit(vectors), _unit(wishes)
        leaf_of = left.column("leaf").to_numpy()
        order = np.argsort(leaf_of, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(leaf_of[order]) != 0))
        members = {int(leaf_of[order[a]]): order[a:b] for a, b in zip(starts, np.append(starts[1:], len(order)))}
        askers: dict[int, list[int]] = {}
        for i, leaves in enumerate(right.column("leaves").to_pylist()):
            for leaf in leaves:
                askers.setdefault(leaf, []).append(i)
        best = np.full((len(aims), k), -2.0)  # the k best cosines of each query so far
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for leaf, rows in members.items():
            asked = np.array(askers.get(leaf, []), dtype=np.int64)
            for a in range(0, len(asked), 512):
                some = asked[a : a + 512]
                near = aims[some] @ units[rows].T
                both = np.concatenate([best[some], near], axis=1)
                best[some] = -np.partition(-both, k - 1, axis=1)[:, :k]
                q, r = np.nonzero(near >= best[some].min(axis=1)[:, None] - _SLACK)
                found.append((some[q], rows[r]))
        if not found:
            return pa.table(empty)
        q, r = (np.concatenate(x) for x in zip(*found))
        score = np.concatenate([cosine(wishes[q[a : a + 65536]], vectors[r[a : a + 65536]]) for a in range(0, len(q), 65536)])
        least = left.column("least").to_numpy()
        by = np.lexsort((least[r], -score, q))
        q, r, score = q[by], r[by], score[by]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        kept = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) < k
        q, r, score = q[kept], r[kept], score[kept]
        return pa.table({"query": right.column("query").take(pa.array(q)), "ids": left.column("ids").take(pa.array(r)), "score": pa.array(score)})

    return run


def nearest(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    trees: int = 4,
    depth: int = 10,
    share: float = 1.0,
    least: int = 4096,
    sample: int = 16_384,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose id is divisible by ``every``.

    Nearness is the cosine in double precision, equal ones by smaller id; a
    query's own row is no candidate. The forest of ``trees`` trees is fitted on
    ``sample`` different vectors, chosen by a hash, and has at most ``2 ** depth``
    leaves a tree. A query takes leaves until they hold ``share`` of the vectors,
    all trees counted together, and ``least`` at any rate: vectors without any structure need
    about half of all as candidates for a recall of 0.95.

    Left out: null ids, vectors that are null, empty, zero, or hold a null or a
    value that is not finite, and vectors whose length is not the commonest (of
    equally common ones the largest). Of rows with equal ids the one with the
    least vector counts. With fewer candidates than k all are given. An empty
    table gives an empty table; other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    usable = staged(_usable(vectors, vec_id, vector), "vectors")
    kind = usable.schema["vector"].dataType.simpleString()
    # One node for equal vectors: of its ids no more than k + 1 can be wanted, the query's own included.
    first = Window.partitionBy("vector").orderBy("id")
    few = usable.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= k + 1)
    nodes = staged(few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("least", F.col("ids")[0]), "nodes")
    total = nodes.count()
    chosen = nodes.orderBy(F.xxhash64("least"), "least").limit(sample).select("vector").toArrow()  # bounded by ``sample``
    fitted = _matrix(chosen.column("vector"))
    forest = fit_forest(_unit(fitted) if len(fitted) else fitted.astype(np.float64), trees, depth)
    routed = _routed(nodes, forest, kind)

    # Leaves are as many as the forest's parameters say, whatever the number of rows.
    sizes = np.zeros((trees, 2**forest.depth), dtype=np.int64)
    for r in routed.groupBy("tree", "leaf").count().collect():
        sizes[r.tree, r.leaf] = r["count"]
    before = np.cumsum(sizes, axis=1) - sizes
    cells = (before // CELL_ROWS).astype(np.int32)
    in_cell = [(t, int(c), int(sizes[t][cells[t] == c].sum())) for t in range(trees) for c in np.unique(cells[t])]

    asked = usable.where(F.col("id") % every == 0)
    names = asked.select(F.col("id").alias("query_id"), "vector").join(nodes.select("vector", "least"), "vector").select("query_id", "least")
    names = staged(names, "queries")
    queries = nodes.join(names.select("least").distinct(), "least", "left_semi")
    probes = staged(_probed(queries, forest, sizes, cells, max(least, int(np.ceil(share * total))), kind), "probes")

    places = spark.createDataFrame(in_cell or [(0, 0, 0)], "tree int, cell int, rows long")
    per_cell = probes.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("asked")).join(F.broadcast(places), ["tree", "cell"])
    parts = F.broadcast(  # one row per cell: bounded by the leaves of the forest
        per_cell.select(
            "tree",
            "cell",
            F.ceil(F.col("rows") / CELL_ROWS).cast("int").alias("row_parts"),
            F.ceil(F.col("asked") / CELL_QUERIES).cast("int").alias("query_parts"),
        )
    )
    cell_of = F.broadcast(spark.createDataFrame([(t, i, int(cells[t, i])) for t in range(trees) for i in range(2**forest.depth)], "tree int, leaf int, cell int"))
    rows = routed.join(cell_of, ["tree", "leaf"]).join(parts, ["tree", "cell"])
    rows = rows.withColumns(
        {"i": F.pmod(F.xxhash64("least"), F.col("row_parts")).cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))}
    ).select("tree", "cell", "i", "j", "leaf", "least", "ids", "vector")
    wishes = probes.join(parts, ["tree", "cell"])
    wishes = wishes.withColumns(
        {"j": F.pmod(F.xxhash64("query"), F.col("query_parts")).cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("row_parts") - 1))}
    ).select("tree", "cell", "i", "j", "leaves", "query", "vector")
    keys = ["tree", "cell", "i", "j"]
    met = rows.groupBy(*keys).cogroup(wishes.groupBy(*keys)).applyInArrow(_meet(k + 1), "query long, ids array<long>, score double")

    # A node can be met in every tree; ids of equal vectors follow each other.
    found = met.groupBy("query", F.col("ids")[0].alias("_first")).agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    single = found.select("query", "score", F.explode("ids").alias("vec_id")).withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= k + 1)
    own = names.join(single, F.col("least") == F.col("query")).where(F.col("vec_id") != F.col("query_id"))
    ranked = own.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
