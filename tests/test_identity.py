import random

from conftest import rows

from touchline.operators import identity as I
from touchline.session import work_path


def test_chain_star_and_loner(spark):
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("hub", f"leaf{i}") for i in range(300)] + [("self", "self"), ("x", None)]
    got = dict(rows(I.connected(spark.createDataFrame(edges, "a string, b string"), "a", "b")))
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"}
    assert {got[f"leaf{i}"] for i in range(300)} | {got["hub"]} == {"hub"}
    assert got["self"] == "self" and len(got) == 61 + 301 + 1


def test_random_graph_equals_union_find(spark):
    rng = random.Random(4)
    edges = [(f"v{rng.randrange(200)}", f"v{rng.randrange(200)}") for _ in range(150)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = dict(rows(I.connected(spark.createDataFrame(edges, "a string, b string"), "a", "b")))
    assert got == {v: find(v) for v in list(parent)}


def test_device_shared_by_two_logins(spark):
    events = spark.createDataFrame(
        [("d1", "ann", 1), ("d1", "bob", 2), ("d2", None, 3), ("d1", None, 4)], "device string, login string, t int"
    )
    mapping = I.latest_login(events, "device", "login", ["t"])
    assert rows(mapping) == [("d1", "bob")]
    assert set(rows(I.stitch(events.select("device").distinct(), mapping, "device"))) == {("d1", "bob"), ("d2", "d2")}


# ---- groups that grow ---------------------------------------------------------


def _links(spark, pairs):
    return spark.createDataFrame(pairs, "a string, b string")


def _groups(pairs):
    """The smallest id of everybody's group, by merging sets."""
    group = {}
    for a, b in pairs:
        if a is not None and b is not None:
            both = group.get(a, {a}) | group.get(b, {b})
            group.update(dict.fromkeys(both, both))
    return {i: min(g) for i, g in group.items()}


def test_ten_batches_equal_all_links_at_once(spark):
    rng = random.Random(4)
    store = I.GroupStore(spark, work_path(spark, "groups"), buckets=7)
    every, known = [], {}
    for batch in range(10):
        pairs = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(5)] + [("n00", None), ("n07", "n07")]
        every += pairs
        changed = store.extend(_links(spark, pairs), "a", "b")
        want = _groups(every)
        moved = {r.id: (r.canonical_id, r.before) for r in changed.collect()}
        assert moved == {i: (c, known.get(i)) for i, c in want.items() if known.get(i) != c}
        known = dict(rows(store.members()))
        assert known == want
    assert dict(rows(I.connected(_links(spark, every), "a", "b"))) == known
    store.forget_old_versions()
    assert dict(rows(store.members())) == known
    other = store.deal_anew(work_path(spark, "groups"), 3)
    assert dict(rows(other.members())) == known
    assert dict(rows(other.extend(_links(spark, [("n00", "zz")]), "a", "b").select("id", "canonical_id"))) == {"zz": known["n00"]}
    assert rows(store.extend(_links(spark, []), "a", "b")) == []


def test_a_batch_that_was_cut_off_is_not_read(spark):
    from unittest import mock

    store = I.GroupStore(spark, work_path(spark, "groups"), buckets=3)
    store.extend(_links(spark, [("a", "b"), ("c", "d")]), "a", "b")
    before = rows(store.members(), "id")
    real = I.GroupStore._numbers
    calls = []

    def stops(self, df, name):
        calls.append(name)
        if len(calls) == 5:  # one side is written, the other is not
            raise RuntimeError("lost")
        return real(self, df, name)

    with mock.patch.object(I.GroupStore, "_numbers", stops):
        try:
            store.extend(_links(spark, [("b", "c")]), "a", "b")
        except RuntimeError:
            pass
    assert len(calls) == 5 and rows(store.members(), "id") == before
    store.extend(_links(spark, [("b", "c")]), "a", "b")
    assert {c for _, c in rows(store.members())} == {"a"}


def test_rows_read_do_not_grow_with_untouched_groups(spark):
    """Members in the folders that a batch opens, with four times as many groups in four times as many buckets."""
    read = {}
    for groups, buckets in ((400, 16), (1600, 64)):
        store = I.GroupStore(spark, work_path(spark, "groups"), buckets)
        store.extend(_links(spark, [(f"{i:05d}a", f"{i:05d}b") for i in range(groups)]), "a", "b")
        opened = []
        real = store._read

        def counted(side, numbers, versions, real=real, opened=opened):
            found = real(side, numbers, versions)
            opened.append(found.count())
            return found

        store._read = counted
        store.extend(_links(spark, [("00003a", "00009a"), ("x", "00011b")]), "a", "b")
        read[groups] = sum(opened)
    assert read[1600] < 1.7 * read[400] and read[1600] < 1600
