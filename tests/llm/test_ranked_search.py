"""Ranked search against scoring every document in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import ball_tree_search as B

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    chosen = {}
    for i, t in items:
        key = (t is not None, t or "")
        chosen[i] = min(chosen.get(i, key), key)
    out = []
    for i, (_, text) in chosen.items():
        scores = []
        for doc, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in set(terms(text)) if bag[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(i, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"W{int(rng.paretovariate(0.7)) % 900}" for _ in range(4000)]
    text = lambda k: rng.choice([" ", "-", "_\x00"]).join(rng.choice(words) for _ in range(k))
    docs = [(i, text(rng.choice([1, 8, 40, 120]))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(40)]  # copies: equal scores by id
    docs += [(7, docs[9][1]), (None, docs[5][1]), (None, None), (900, None), (901, ""), (902, "--- ..."), (903, "ÉA" * 30_000 + " w1 " * 20_000)]
    docs += [(904 + i, f"é{i} naïve Naïve ǅ w{i} 1_2") for i in range(3)]
    items = [(i, text(25)) for i in range(12)] + [(20, docs[5][1]), (21, None), (22, ""), (23, "unseen zzz"), (None, "w1 w2"), (24, "É1 naïve 2 1"), (25, "ÉA" * 30_000)]
    return docs, items + [(20, None), (3, "w1")]


def test_against_every_score(spark, monkeypatch):
    docs, items = corpus(1)
    want = brute(docs, items)
    given = spark.createDataFrame(docs, DOCS).withColumns({"n": F.lit(1), "score": F.lit("x"), "rank": F.lit(0)}).repartition(5)
    asked = spark.createDataFrame(items, ITEMS).withColumn("terms", F.lit(3))
    df = B.ranked_search(given, asked)
    assert [f"{n} {t}" for n, t in df.dtypes] == ["item_id bigint", "rank int", "doc_id bigint", "score bigint"]
    assert found(df) == want
    assert found(B.ranked_search(given, asked, top=3)) == brute(docs, items, 3)
    # Slices of items change nothing.
    monkeypatch.setattr(B, "SLICE_TERMS", 60)
    assert found(B.ranked_search(given, asked)) == want


@pytest.mark.parametrize("empty", ["docs", "items", "texts"])
def test_nothing_to_find(spark, empty):
    docs, items = [(1, "a b")], [(1, "a")]
    docs = {"docs": [], "texts": [(1, None), (2, "..")]}.get(empty, docs)
    items = [] if empty == "items" else items
    assert B.ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect() == []


def sparse(rng, n, vocabulary):
    """Documents in groups of like ones, and items made of their terms."""
    rows = []
    for i in range(n):
        base = np.random.default_rng(i % 12).choice(vocabulary, 40, replace=False)
        own = np.unique(np.append(base[: rng.integers(20, 40)], rng.integers(0, vocabulary, 3)))
        rows.append((own, rng.integers(1, 900_000, len(own))))
    offsets = np.append(0, np.cumsum([len(t) for t, _ in rows]))
    lists = [np.unique(rows[i][0][:12]) for i in range(0, n, n // 15)]
    items = B.Items(list(range(len(lists))), np.arange(vocabulary).astype(np.uint64), np.concatenate(lists), np.append(0, np.cumsum([len(x) for x in lists])))
    items.weights = rng.integers(0, 12_000, vocabulary)
    return np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]), offsets, items


def test_bounds_hold_and_prune(monkeypatch):
    monkeypatch.setattr(B, "LEAF_DOCS", 4)
    terms_, values, offsets, items = sparse(np.random.default_rng(1), 600, 500)
    tree = B.Tree(terms_, values, offsets, items)
    scores = np.zeros((len(items.ids), 600), dtype=np.int64)
    for item in range(len(items.ids)):
        weights = np.zeros(500, dtype=np.int64)
        own = items.terms[items.offsets[item] : items.offsets[item + 1]]
        weights[own] = items.weights[own]
        scores[item] = np.add.reduceat(weights[terms_] * values, offsets[:-1])

    def below(node):
        if tree.leaves[node]:
            return tree.leaves[node][3].tolist()
        return [x for child in tree.children[node] for x in below(child)]

    for node in range(len(tree.bounds)):
        assert (tree.bounds[node] >= scores[:, below(node)].max(axis=1)).all()
    assert sorted(below(0)) == list(range(600))
    shares = []
    for item in range(len(items.ids)):
        best = B.Best(10)
        ids, nulls = np.arange(600), np.zeros(600, dtype=bool)
        shares.append(np.divide(*tree.search(item, best.least, lambda s, m: best.add(s, ids[m], nulls[m]))))
        order = np.lexsort((ids, -scores[item]))[:10]
        assert [(-s, i) for s, _, i in best.rows] == [(int(scores[item][i]), int(i)) for i in order if scores[item][i] > 0]
    assert np.mean(shares) < 0.7


def test_copies_have_no_radius(monkeypatch):
    monkeypatch.setattr(B, "LEAF_DOCS", 2)
    terms_, values, _, items = sparse(np.random.default_rng(2), 30, 200)
    own, amount = terms_[:20], values[:20]
    own, at = np.unique(own, return_index=True)
    tree = B.Tree(np.tile(own, 50), np.tile(amount[at], 50), np.arange(51) * len(own), items)
    exact = [int((items.weights[own] * amount[at])[np.isin(own, items.terms[a:b])].sum()) for a, b in zip(items.offsets, items.offsets[1:])]
    assert all(x <= bound <= x * 1.01 + 1e8 for x, bound in zip(exact, tree.bounds[0]))
