"""Which identifiers belong to one customer, for all links at once and as links arrive."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.joins import join_unique
from touchline.session import cut_lineage, remove
from touchline.sources.tables import staged


def latest_login(events: DataFrame, device: str, login: str, order: Sequence[str]) -> DataFrame:
    """The last known login of each device that ever had one."""
    known = events.where(F.col(login).isNotNull())
    return known.groupBy(device).agg(F.max_by(login, F.struct(*order)).alias("stitched_user_id"))


def stitch(rows: DataFrame, mapping: DataFrame, device: str) -> DataFrame:
    """Rows with their customer id: the mapped login, else the device itself.

    ``rows`` is read twice: pass a written table.
    """
    return join_unique(rows, mapping, device, "left").withColumn(
        "stitched_user_id", F.coalesce("stitched_user_id", F.col(device))
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("b", "a")).toDF("node", "other")


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect the larger neighbours of each node to the smallest of its neighbourhood."""
    both = _both_ways(edges)
    smallest = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("low"))
    linked = join_unique(both.where("other > node"), smallest, "node")
    return linked.select(F.col("other").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).where("node <> other")
    smallest = down.groupBy("node").agg(F.min("other").alias("low"))
    others = join_unique(down, smallest, "node").where("other <> low").select(F.col("other").alias("a"), F.col("low").alias("b"))
    own = smallest.select(F.col("node").alias("a"), F.col("low").alias("b"))
    return others.union(own).distinct()


def connected(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(id, canonical_id) for every id in the edges; the canonical id is the smallest of its group.

    Alternates the large-star and small-star steps of Kiveris et al. (2014),
    so a chain of n ids needs a number of rounds in the order of log(n)^2, not
    n. A hub's edges are reduced on the map side and joined with one row per
    node, so adaptive execution can split them. Lineage is cut each round.
    """
    ids = edges.select(F.col(left).cast("string").alias("a"), F.col(right).cast("string").alias("b")).where(
        "a IS NOT NULL AND b IS NOT NULL"
    )
    nodes = ids.select(F.col("a").alias("id")).union(ids.select("b")).distinct()
    current = cut_lineage(ids.where("a <> b").distinct())
    seen = None
    while True:
        current = cut_lineage(_small_star(_large_star(current)))
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("a").alias("id"), F.col("b").alias("_root"))
    return nodes.join(roots, "id", "left").select("id", F.coalesce("_root", "id").alias("canonical_id"))


# ---- groups that grow ----------------------------------------------------------

_GROUP_MEMBERS = "id string, canonical_id string"
_GROUP_VERSIONS = "side string, bucket int, number int, folder string"


@dataclass
class GroupStore:
    """Stored groups that new links extend; only the groups they touch are read and written.

    Members lie twice below ``root``: by a hash of their id, to find the groups of a
    link's ends, and by a hash of their group, to find a group's members. A batch of
    links reads the buckets that its ends and the groups it merges fall into, and
    replaces those that change. ``buckets`` bounds what one id costs to
    look up: choose it so that a bucket holds some ten thousand members, and call
    ``deal_anew`` when it holds many more.

    A batch is written as a new version of its buckets, and becomes visible with the
    list of versions in force, which is written last: a batch that was cut off leaves
    nothing that is read. One writer at a time.
    """

    spark: SparkSession
    root: str
    buckets: int = 256

    _SIDES = {"by_id": "id", "by_group": "canonical_id"}

    def _versions(self) -> dict[tuple[str, int], str]:
        """The folder in force of each bucket: one row per bucket and side."""
        last = self._listed().groupBy("side", "bucket").agg(F.max_by("folder", "number").alias("folder")).collect()
        return {(r["side"], r["bucket"]): r["folder"] for r in last}

    def _listed(self) -> DataFrame:
        try:
            return self.spark.read.schema(_GROUP_VERSIONS).parquet(f"{self.root}/versions")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _GROUP_VERSIONS)

    def _bucket(self, name: str):
        return F.pmod(F.xxhash64(name), F.lit(self.buckets)).cast("int")

    def _read(self, side: str, numbers: Sequence[int] | None, versions: dict[tuple[str, int], str]) -> DataFrame:
        """Members in some buckets, or all; the folders of others are not opened."""
        paths = [f"{self.root}/{f}/bucket={b}" for (s, b), f in sorted(versions.items()) if s == side and (numbers is None or b in numbers)]
        if not paths:
            return self.spark.createDataFrame([], _GROUP_MEMBERS)
        return self.spark.read.schema(_GROUP_MEMBERS).parquet(*paths)

    def members(self) -> DataFrame:
        """(id, canonical_id) of everybody."""
        return self._read("by_id", None, self._versions())

    def extend(self, links: DataFrame, left: str, right: str) -> DataFrame:
        """Add links and give the members whose group is new: (id, canonical_id, before), ``before`` null for new ids.

        A group's id is the smallest id in it, as ``connected`` gives it. A null end makes a link void.
        """
        versions = self._versions()
        ends = staged(
            links.select(F.col(left).cast("string").alias("a"), F.col(right).cast("string").alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct(), "links"
        )
        ids = ends.select(F.col("a").alias("id")).union(ends.select("b")).distinct()
        touched = self._numbers(ids, "id")
        known = ids.join(self._read("by_id", touched, versions), "id", "left")
        known = staged(known.select("id", F.coalesce("canonical_id", "id").alias("root"), F.col("canonical_id").isNull().alias("is_new")), "ends")
        # Links between groups: each end stands for the group that it is in already.
        at = known.select("id", "root")
        between = ends.join(at.toDF("a", "ra"), "a").join(at.toDF("b", "rb"), "b").select("ra", "rb").distinct()
        merged = staged(connected(between, "ra", "rb").toDF("root", "canonical_id"), "merged")
        moved = merged.where("root <> canonical_id")
        old = self._read("by_group", self._numbers(moved, "root"), versions)
        relabelled = old.withColumnRenamed("canonical_id", "before").join(moved.withColumnRenamed("root", "before"), "before")
        added = known.where("is_new").join(merged, "root").select("id", "canonical_id", F.lit(None).cast("string").alias("before"))
        changed = staged(relabelled.select("id", "canonical_id", "before").unionByName(added), "changed")
        self._write(changed, versions)
        return changed

    def _numbers(self, rows: DataFrame, name: str) -> set[int]:
        """The buckets of the values in a column: no more numbers than there are buckets."""
        return {r["n"] for r in rows.select(self._bucket(name).alias("n")).distinct().collect()}

    def _write(self, changed: DataFrame, versions: dict[tuple[str, int], str]) -> None:
        number = (self._listed().agg(F.max("number")).first()[0] or 0) + 1
        rows = []
        for side, key in self._SIDES.items():
            # A folder of its own for each attempt: what one that was cut off left behind is never read.
            folder = f"{side}/{uuid.uuid4().hex}"
            gone = changed.where("before IS NOT NULL").select("id", F.col("before" if side == "by_group" else "canonical_id").alias("canonical_id"))
            hit = self._numbers(changed, key) | self._numbers(gone, key)
            stay = self._read(side, hit, versions).join(changed.select("id"), "id", "left_anti")
            after = staged(stay.unionByName(changed.select("id", "canonical_id")).withColumn("bucket", self._bucket(key)), "after")
            full = {r["bucket"] for r in after.select("bucket").distinct().collect()}
            after.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
            for bucket in sorted(hit):
                if bucket not in full:  # it lost its last member
                    self.spark.createDataFrame([], _GROUP_MEMBERS).write.parquet(f"{self.root}/{folder}/bucket={bucket}")
                rows.append((side, bucket, number, folder))
        if rows:
            self.spark.createDataFrame(rows, _GROUP_VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.root}/versions")

    def deal_anew(self, root: str, buckets: int) -> GroupStore:
        """The same groups in another folder with another number of buckets."""
        fresh = GroupStore(self.spark, root, buckets)
        fresh._write(self.members().withColumn("before", F.lit(None).cast("string")), {})
        return fresh

    def forget_old_versions(self) -> None:
        """Remove the buckets that a later version replaced; not while somebody reads them."""
        versions = self._versions()
        for r in self._listed().select("side", "bucket", "folder").distinct().collect():  # one row per bucket written
            if versions[r["side"], r["bucket"]] != r["folder"]:
                remove(self.spark, f"{self.root}/{r['folder']}/bucket={r['bucket']}")
