"""Groups of near copies against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from corpus import SCHEMA, frame, planted, prose, shingle_set

from touchline.llm import near_dedup as module
from touchline.llm.graph import components
from touchline.llm.near_dedup import collections_needed, least_matches, near_dedup


def brute(rows, percent):
    sets = {i: shingle_set(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            top[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def family(seed, n):
    """Near copies with very different numbers of edits: chains of links and many that are linked with nothing."""
    rng = random.Random(seed)
    base = prose(rng, 150)
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(12)):
            w[rng.randrange(len(w))] = f"y{rng.randrange(100_000)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_like_brute_force(spark, percent):
    rows = planted(7) + [(2000 + i, t) for i, t in family(3, 120)]
    assert found(near_dedup(frame(spark, rows), percent=percent)) == brute(rows, percent)


def test_large_clusters_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(module, "GROUP", 10)
    rows = family(5, 60)
    assert found(near_dedup(frame(spark, rows), percent=85)) == brute(rows, 85)


def test_edges(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (4, text), (4, text), (5, None), (6, ""), (7, " "), (8, "A b C"), (9, "a B c")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup(frame(spark, rows)).collect()), key=str)
    assert got == sorted(
        [(None, 4, 4, False), (4, 4, 4, True), (4, 4, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 8, True), (9, 1, 8, False)],
        key=str,
    )
    assert near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_carried_columns(spark):
    df = spark.createDataFrame([(1, "a b", 2, "k")], "doc_id long, text string, node long, halves string")
    assert near_dedup(df, carried=df.columns).first().row.asDict() == {"doc_id": 1, "text": "a b", "node": 2, "halves": "k"}


def test_bands():
    for s in (0.8, 0.85, 0.95):
        m = collections_needed(s, 2, 1e-4)
        assert 1 - (1 - (1 - s**2) ** m) ** 2 <= 1e-4
    assert least_matches(0.85, 32) in range(10, 20)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(20)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_per_node_do_not_grow_with_a_family(spark, monkeypatch):
    """Rows in buckets, for families of 300 and 1200 near copies."""
    sizes = {}
    real = module._buckets

    def counted(own, m):
        found = real(own, m)
        sizes[len(sizes)] = (found.count(), m, found)
        return found

    monkeypatch.setattr(module, "_buckets", counted)
    for n in (300, 1200):
        near_dedup(frame(spark, family(9, n)), percent=85).collect()
    (few, m, _), (many, _, _) = sizes[0], sizes[1]
    assert many <= 4.4 * few and many <= m * 1200


def test_a_common_first_half_key(spark, monkeypatch):
    monkeypatch.setattr(module, "FIRST_GROUP", 8)
    monkeypatch.setattr(module, "GROUP", 6)
    rows = family(6, 70) + [(500 + i, t) for i, t in family(8, 30)]
    assert found(near_dedup(frame(spark, rows), percent=80)) == brute(rows, 80)


def test_rows_across_clusters_do_not_grow_with_pairs(spark, monkeypatch):
    """Rows of every intermediate table, for families of 100 and 400 near copies of which each is its own cluster."""
    monkeypatch.setattr(module, "CLUSTER", 100)
    real, links, sizes = module.staged, module._cluster_links, []

    def counted(df, label):
        found = real(df, label)
        sizes[-1][label] = found.count()
        return found

    monkeypatch.setattr(module, "staged", counted)
    monkeypatch.setattr(module, "_cluster_links", lambda members, percent: counted(links(members, percent), f"links{len(sizes[-1])}"))
    for n in (100, 400):
        sizes.append({})
        rows = family(9, n)
        assert found(near_dedup(frame(spark, rows), percent=80)) == brute(rows, 80)
    for table in sizes:  # the links across clusters come last: fewer than there are nodes in the places where they are found
        label = list(table)[-1]
        assert label.startswith("links") and table.pop(label) < table["candidates"]
    assert not {label: few for label, few in sizes[0].items() if sizes[1][label] > 5 * max(few, 20)}
