"""Near-duplicate documents by MinHash with tensored banding.

Plain banding needs ``tables * rows`` minhashes. Here two small collections of
half keys, of ``rows`` minhashes each, are computed, and a table key is a pair
of one half key from either collection: ``m * m`` tables from ``2 * m * rows``
minhashes. A pair of documents with similarity s meets in some table with
probability ``(1 - (1 - s ** rows) ** m) ** 2``; m is chosen so that a pair at
the threshold is missed with probability ``miss`` at most.

A half key that no other text has cannot meet anything, so table keys are only
formed from shared half keys. Rows are keyed by the half keys of the first
collection alone, ``m`` a node, and carry those of the second: the pairs that are
table keys are formed in the task that holds a first half key. Only where a
first half key is very common do its rows go by table key.

Equal shingle sets are one node. For each first half key a node is compared
with the smallest node that it shares a table key with there, its leader. Nodes that resemble a leader at all (CLUSTER) join the
cluster of the leader that most nodes resemble, and a cluster is compared
within tasks, which give no more links than it has members. A large group of
near copies, many of which are too unlike each other to be linked, so costs
rows in proportion to its size. Nodes of different clusters that share a
bucket are compared by sizes and minhashes first, and what may be similar by
full sets, in a cluster of its own. Every link is confirmed on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.graph import components
from touchline.llm.shipping import ship
from touchline.llm.text import carried_columns, mix, pieces, shingles, words_of
from touchline.sources.tables import staged

#: Members of a table bucket or cluster that are compared in one task; larger ones are dealt to several.
GROUP = 2000
#: Nodes with one first half key that meet in one task; with more of them they meet by table key.
FIRST_GROUP = 16_384
#: Similarity to a leader, in percent, from which a node may join its cluster. It decides where nodes are compared, not whether.
CLUSTER = 40


def collections_needed(threshold: float, rows: int, miss: float) -> int:
    """Half keys per collection so that a pair at the threshold is missed with probability ``miss`` at most."""
    return max(1, math.ceil(math.log(miss / 2) / math.log(1 - threshold**rows)))


def least_matches(threshold: float, hashes: int, miss: float = 1e-8) -> int:
    """The largest number of equal minhashes that a pair at the threshold falls short of with probability ``miss`` at most."""
    below = 0.0
    for k in range(hashes + 1):
        below += math.comb(hashes, k) * threshold**k * (1 - threshold) ** (hashes - k)
        if below > miss:
            return k
    return hashes


def _sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, end to end, their offsets, and each set's number."""
    document, hashes = shingles(words_of(batch.column("text"), lower=True), size)
    cuts = np.searchsorted(document, np.arange(batch.num_rows + 1))
    parts = [np.unique(hashes[a:b]) for a, b in zip(cuts, cuts[1:])]
    offsets = np.append(0, np.cumsum([len(p) for p in parts]))
    items = np.concatenate(parts) if parts else hashes
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(mix(items + np.uint64(1))))
    counts = np.diff(offsets)
    number = mix((sums[offsets[1:]] - sums[offsets[:-1]]) ^ mix(counts.astype(np.uint64)))
    return items, offsets, number.view(np.int64)


def signatures(docs: DataFrame, size: int, m: int, rows: int, seed: int = 1) -> DataFrame:
    """(id, n, node, halves, mins, row) per document: set size, the set's number, half keys and minhashes; null for an empty set."""
    number = 2 * m * rows
    salts = mix(np.arange(1, 2 * number + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * seed))
    flips, factors = salts[:number], salts[number:] | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            items, offsets, node = _sets(batch, size)
            counts = np.diff(offsets)
            full = np.flatnonzero(counts)
            least = np.zeros((len(counts), number), dtype=np.uint64)
            if len(full):
                for k in range(number):
                    values = (items ^ flips[k]) * factors[k]
                    values ^= values >> np.uint64(32)
                    least[full, k] = np.minimum.reduceat(values, offsets[full])
            halves = np.zeros((len(counts), 2 * m), dtype=np.uint64)
            for j in range(rows):
                halves = mix(halves ^ least[:, j::rows])
            empty = counts == 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(counts) + 1) * 2 * m, pa.int32()), pa.array(halves.view(np.int64).ravel(), pa.int64())
            )
            columns = {
                "id": batch.column("id"),
                "n": pa.array(counts, pa.int64()),
                "node": pa.array(node, pa.int64(), mask=empty),
                "halves": lists,
                "mins": pa.array([row.tobytes() for row in least.astype("<u4")], pa.binary()),
            }
            if "row" in batch.schema.names:
                columns["row"] = batch.column("row")
            yield pa.RecordBatch.from_pydict(columns)

    row = ", row " + docs.schema["row"].dataType.simpleString() if "row" in docs.columns else ""
    return docs.mapInArrow(run, f"id long, n long, node long, halves array<long>, mins binary{row}")


def _fetched(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, items): the sets of the wanted nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            items, offsets, node = _sets(batch, size)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(items.view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_pydict({"found": pa.array(node, pa.int64()), "node": batch.column("node"), "items": lists})

    named = nodes.join(wanted, "node").select("node", F.col("min_id").alias("id"))
    sets = texts.join(named, "id").mapInArrow(run, "found long, node long, items array<long>")
    # Rows that share an id may hold different texts; the set's number tells which one is meant.
    return sets.where("found = node").groupBy("node").agg(F.first("items").alias("items"))


def _measured(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes with the sizes of the intersection and the union of their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("_b"))
    common = F.size(F.array_intersect("_a", "_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("common"), (F.size("_a") + F.size("_b")).alias("sizes"))
    return both.select("a", "b", "common", (F.col("sizes") - F.col("common")).alias("united"))


def _cluster_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all similar nodes (cluster, node, items) of a cluster, fewer than it has members in each task.

    A cluster of more than GROUP members is dealt into parts, and each two
    parts meet in a task of their own.
    """
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts")).where("parts > 0")
    dealt = members.join(sizes, "cluster").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    spread = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    spread = spread.withColumn("p", F.least("part", "with")).withColumn("q", F.greatest("part", "with"))

    def run(table: pa.Table) -> pa.Table:
        node = np.array(table.column("node"), dtype=np.int64)
        lists = table.column("items").combine_chunks()
        counts = np.diff(np.array(lists.offsets))
        _, item, often = np.unique(np.array(lists.flatten()), return_inverse=True, return_counts=True)
        # Only shingles of two members or more can be common.
        shared = often[item] > 1
        rank = (np.cumsum(often > 1) - 1)[item]
        owner = np.repeat(np.arange(len(node)), counts)[shared]
        rank = rank[shared]
        width = max(1, int((often > 1).sum()))
        begin = np.searchsorted(owner, np.arange(len(node) + 1))
        block = max(8, min(512, 8_000_000 // width))
        top = list(range(len(node)))

        def root(i: int) -> int:
            while top[i] != i:
                top[i] = top[top[i]]
                i = top[i]
            return i

        def dense(lo: int, hi: int) -> np.ndarray:
            out = np.zeros((hi - lo, width), dtype=np.float32)
            out[owner[begin[lo] : begin[hi]] - lo, rank[begin[lo] : begin[hi]]] = 1
            return out

        found = []
        for lo in range(0, len(node), block):
            hi = min(len(node), lo + block)
            rows = dense(lo, hi)
            for lo2 in range(0, lo + 1, block):
                hi2 = min(len(node), lo2 + block)
                common = rows @ (rows if lo2 == lo else dense(lo2, hi2)).T
                united = counts[lo:hi, None] + counts[None, lo2:hi2] - common
                for i, j in zip(*np.nonzero(100 * common >= percent * united)):
                    x, y = root(lo + int(i)), root(lo2 + int(j))
                    if x != y:
                        top[max(x, y)] = min(x, y)
                        found.append((lo + int(i), lo2 + int(j)))
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(node[pairs[:, 0]]), "b": pa.array(node[pairs[:, 1]])})

    return spread.select("cluster", "p", "q", "node", "items").groupBy("cluster", "p", "q").applyInArrow(run, "a long, b long")


def _leads(table: pa.Table) -> pa.Table:
    """Nodes with one first half key: each that shares a table key with another, and the smallest node that it shares one with."""
    node = np.array(table.column("node"), dtype=np.int64)
    lists = table.column("seconds").combine_chunks()
    owner = np.repeat(np.arange(len(node)), np.diff(np.array(lists.offsets)))
    _, key, often = np.unique(np.array(lists.flatten()), return_inverse=True, return_counts=True)
    owner, key = owner[often[key] > 1], key[often[key] > 1]
    top = np.iinfo(np.int64).max
    smallest = np.full(len(often), top)
    np.minimum.at(smallest, key, node[owner])
    lead = np.full(len(node), top)
    np.minimum.at(lead, owner, smallest[key])
    met = lead < top
    fixed = {n: pa.array(np.array(table.column(n))[met]) for n in ("tk", "first")}
    second = pa.array(np.full(int(met.sum()), -1, dtype=np.int32))
    return pa.table(fixed | {"second": second, "node": pa.array(node[met]), "lead": pa.array(lead[met])})


def _buckets(own: DataFrame, m: int) -> DataFrame:
    """(tk, first, second, node, lead): the nodes that share table keys, by first half key (``second`` is -1), or by table key where that is very common."""
    first = F.filter("own", lambda x: x["slot"] < m)
    second = F.transform(F.filter("own", lambda x: x["slot"] >= m), lambda x: F.xxhash64(x["slot"], x["half"]))
    slots = F.transform(F.filter("own", lambda x: x["slot"] >= m), lambda x: x["slot"])
    rows = own.select("node", F.explode(first).alias("i"), second.alias("seconds"), slots.alias("slots")).where(F.size("seconds") > 0)
    keyed = rows.select(F.xxhash64("i.slot", "i.half").alias("tk"), F.col("i.slot").alias("first"), "node", "seconds", "slots")
    sizes = keyed.groupBy("tk").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    sized = staged(keyed.join(sizes, "tk"), "first_keys")
    usual = sized.where(F.col("members") <= FIRST_GROUP).select("tk", "first", "node", "seconds")
    usual = usual.groupBy("tk").applyInArrow(_leads, "tk long, first int, second int, node long, lead long")
    common = sized.where(F.col("members") > FIRST_GROUP)
    common = common.select("tk", "first", "node", F.explode(F.arrays_zip("seconds", "slots")).alias("j"))
    tables = common.select(F.xxhash64("tk", "j.seconds").alias("tk"), "first", F.col("j.slots").alias("second"), "node")
    leaders = tables.groupBy("tk").agg(F.min("node").alias("lead"), F.max("node").alias("hi")).where("lead < hi")
    return usual.unionByName(tables.join(leaders.select("tk", "lead"), "tk"))


def _bucket_candidates(members: DataFrame, mins: DataFrame, percent: int, m: int, rows: int) -> DataFrame:
    """(cluster, node): the nodes of a bucket with a node of another cluster there, such that sizes and minhashes allow the threshold.

    Members of the bucket's largest cluster do not meet each other. A table
    bucket with more than GROUP members is dealt into parts; each two parts meet
    in a task of their own. A pair counts in one place: at the first half key, and
    table key, that both share first. What leaves a task is at most one row for each
    node in it, under a cluster of their own, in which full sets are compared.
    """
    need = least_matches(percent / 100, 2 * m * rows)
    sizes = members.groupBy("tk").agg(
        F.when(F.max("second") < 0, 1).otherwise(F.ceil(F.count(F.lit(1)) / GROUP)).cast("long").alias("parts"),
        F.min("cluster").alias("lo"),
        F.max("cluster").alias("hi"),
    )
    meeting = members.join(sizes.where("lo < hi").select("tk", "parts"), "tk")
    dealt = meeting.join(mins, "node").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    spread = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    spread = spread.withColumn("p", F.least("part", "with")).withColumn("q", F.greatest("part", "with"))

    def run(table: pa.Table) -> pa.Table:
        node, n, cluster, part = (np.array(table.column(c), dtype=np.int64) for c in ("node", "n", "cluster", "part"))
        mins = np.frombuffer(b"".join(table.column("mins").to_pylist()), dtype="<u4").reshape(len(node), -1)
        first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py() - m
        apart = len(set(part.tolist())) > 1
        # The largest cluster last: its members have nobody after them to meet.
        _, number, often = np.unique(cluster, return_inverse=True, return_counts=True)
        largest = number == int(np.argmax(often))
        order = np.argsort(largest, kind="stable")
        node, n, cluster, part, mins = node[order], n[order], cluster[order], part[order], mins[order]
        met = np.zeros(len(node), dtype=bool)
        for i in range(len(node) - int(largest.sum())):
            rest = slice(i + 1, None)
            near = cluster[rest] != cluster[i]
            near &= 100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])
            if apart:
                near &= part[rest] != part[i]
            at = np.flatnonzero(near) + i + 1
            equal = mins[at] == mins[i]
            enough = equal.sum(axis=1) >= need
            at, equal = at[enough], equal[enough]
            shared = equal.reshape(len(at), 2 * m, rows).all(axis=2)
            here = (shared[:, :m].argmax(axis=1) == first) & shared[:, m:].any(axis=1)
            if second >= 0:
                here &= shared[:, m:].argmax(axis=1) == second
            met[at[here]] = True
            met[i] |= bool(here.any())
        place = (table.column("place")[0].as_py(),) * int(met.sum())
        return pa.table({"cluster": pa.array(place, pa.int64()), "node": pa.array(node[met])})

    columns = ["tk", "first", "second", "p", "q", "place", "node", "n", "cluster", "mins", "part"]
    placed = spread.withColumn("place", F.xxhash64("tk", "p", "q")).select(*columns)
    return placed.groupBy("tk", "p", "q").applyInArrow(run, "cluster long, node long")


def near_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = 80,
    size: int = 5,
    rows: int = 2,
    miss: float = 1e-4,
    carried: Sequence[str] = (),
    groups: bool = False,
) -> DataFrame:
    """Per document: its id, n_shingles, component_id, kept, and ``row``.

    A document's set holds its distinct shingles of ``size`` words with A-Z in
    lower case; a document with fewer words has one shingle of them all.
    Documents whose sets have ``100 * intersection >= percent * union`` are
    linked; component_id is the smallest id that can be reached, and kept says
    that it is the document's own.

    Null texts and texts without words have an empty set and are linked with
    nothing. Equal rows are one node and share their component. A null id
    counts as larger than all others. An empty table gives an empty result.
    ``carried`` columns come back in the struct ``row``. With ``groups``,
    ``component`` tells groups apart also where ids repeat or are null; it is
    null for an empty set.
    """
    ship(docs.sparkSession)
    m = collections_needed(percent / 100, rows, miss)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), *carried_columns(text, carried))
    signed = staged(signatures(texts, size, m, rows), "signatures")
    last = F.lit((1 << 63) - 1)
    nodes = staged(
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min(F.coalesce("id", last)).alias("min_id"),
            F.first("n").alias("n"),
            F.first("halves").alias("halves"),
            F.first("mins").alias("mins"),
        ),
        "nodes",
    )
    halves = nodes.select("node", F.posexplode("halves").alias("slot", "half"))
    shared = halves.groupBy("slot", "half").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    own = halves.join(shared.select("slot", "half"), ["slot", "half"]).groupBy("node")
    own = own.agg(F.collect_list(F.struct("slot", "half")).alias("own"))
    buckets = staged(_buckets(own, m), "buckets")

    sources = docs.select(F.coalesce(F.col(doc_id).cast("long"), last).alias("id"), F.col(text).alias("text"))
    sets = staged(_fetched(sources, nodes, buckets.select("node").distinct(), size), "sets")

    stars = buckets.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    count = nodes.select("node", "n")
    stars = stars.join(count.toDF("a", "na"), "a").join(count.toDF("b", "nb"), "b")
    stars = stars.where(100 * F.least("na", "nb") >= CLUSTER * F.greatest("na", "nb")).select("a", "b")
    near = staged(_measured(sets, stars).where(100 * F.col("common") >= CLUSTER * F.col("united")), "near")
    links = near.where(100 * F.col("common") >= percent * F.col("united")).select("a", "b")

    resembled = near.select("b", "a").union(near.select("b", "b")).distinct().toDF("lead", "node")
    followers = resembled.groupBy("lead").agg(F.count(F.lit(1)).alias("followers"))
    best = F.max(F.struct("followers", "lead"))["lead"].alias("cluster")
    clusters = staged(resembled.join(followers, "lead").groupBy("node").agg(best), "clusters")
    shared = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    within = _cluster_links(clusters.join(shared, "cluster").join(sets, "node").select("cluster", "node", "items"), percent)

    placed = buckets.drop("lead").join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    mixed = placed.groupBy("tk").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi")).where("lo < hi")
    members = placed.join(mixed.select("tk"), "tk").join(nodes.select("node", "n"), "node")
    candidates = _bucket_candidates(members, nodes.select("node", "mins"), percent, m, rows)
    across = _cluster_links(staged(candidates, "candidates").join(sets, "node").select("cluster", "node", "items"), percent)

    joined = components(links.unionByName(within).unionByName(across))
    named = nodes.select("node", "min_id").join(joined, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("min_id").alias("component_id"))
    ids = named.join(smallest, "component").select("node", "component_id", "component")
    whole = signed.select("id", "n", "node", *(["row"] if carried else [])).join(ids, "node", "left")
    component = F.coalesce("component_id", "id")
    return whole.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(component < last, component).alias("component_id"),
        F.coalesce("id", last).eqNullSafe(F.coalesce(component, last)).alias("kept"),
        *(["row"] if carried else []),
        *(["component"] if groups else []),
    )

