"""Neighbours from the forest against all cosines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import projection_forest as P
from touchline.llm import queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, every):
    """(query, rank) to (id, score) by every cosine; of equal ids the least vector."""
    by_id = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = [float(np.float32(x)) for x in v]
        by_id[i] = min(by_id.get(i, v), v)
    lengths = [len(v) for v in by_id.values()]
    usual = max(set(lengths), key=lambda n: (lengths.count(n), n), default=0)
    ids = sorted(i for i, v in by_id.items() if len(v) == usual)
    out = {}
    if not ids:
        return out
    x = np.array([by_id[i] for i in ids])
    norm = np.sqrt((x * x).sum(axis=1))
    for i in ids:
        if i % every == 0:
            v = np.array(by_id[i])
            score = (x * v).sum(axis=1) / (norm * np.sqrt((v * v).sum()))
            order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-score[j], ids[j]))
            for rank, j in enumerate(order[:k], 1):
                out[i, rank] = (ids[j], score[j])
    return out


def found(df):
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in df.collect()}


def same(got, want):
    assert set(got) == set(want)
    assert all(got[x][0] == want[x][0] and got[x][1] == pytest.approx(want[x][1], abs=1e-12) for x in want)


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(150)]
    copy = rng.normal(size=8).tolist()
    rows += [(1000 + i, copy) for i in range(120)] + [(2000 + i, [2 * x for x in copy]) for i in range(3)]
    rows += [(3000, None), (3050, []), (3100, [0.0] * 8), (3150, [None, *[1.0] * 7]), (3200, [float("nan")] * 8), (3250, [float("inf")] * 8)]
    rows += [(None, copy), (50, copy), (50, rows[50][1]), (4000, [1.0, 2.0]), (4050, [1.0] * 9), (5000, [1e-30] * 8), (5050, [3e38] * 8), (-50, copy)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"least": F.lit(1), "tree": F.lit("x"), "query_id": F.lit(0)})
    got = P.nearest(df, k=5, every=50)
    assert [f"{n} {t}" for n, t in got.dtypes] == ["query_id bigint", "rank int", "vec_id bigint", "score double"]
    same(found(got), brute(rows, 5, 50))


def test_few_and_no_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    same(found(P.nearest(spark.createDataFrame(rows, SCHEMA))), brute(rows, 5, 50))
    for rows in ([], [(0, [1.0])], [(0, [0.0]), (None, [1.0])]):
        assert P.nearest(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_recall_and_hot_cells(spark, monkeypatch):
    monkeypatch.setattr(P, "CELL_ROWS", 700)
    monkeypatch.setattr(P, "CELL_QUERIES", 16)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(4000)]
    base = rng.normal(size=32)
    rows += [(10_000 + i, (base + 1e-4 * rng.normal(size=32)).tolist()) for i in range(2000)]  # one leaf holds a third
    rows += [(20_000 + i, base.tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = brute(rows, 5, 50)
    got = found(P.nearest(df))
    assert set(got) == set(want)
    hits = sum(got[x][0] in {want[x[0], r][0] for r in range(1, 6)} for x in got)
    assert hits >= 0.9 * len(want)
    copies = [x for x in want if x[0] >= 20_000]
    assert copies and all(got[x][0] == want[x][0] for x in copies)
    for (q, rank), (_, score) in got.items():
        assert rank == 1 or score <= got[q, rank - 1][1]


def test_leaves_by_distance_to_cross():
    rng = np.random.default_rng(4)
    unit = rng.normal(size=(3000, 6))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    forest = P.fit_forest(unit, trees=3, depth=5)
    leaves = forest.leaves(unit.astype(np.float32))
    sizes = np.stack([np.bincount(leaves[:, t], minlength=32) for t in range(3)])
    assert forest.depth == 5 and sizes.sum() == 9000 and sizes.min() > 50
    for i in range(0, 3000, 500):
        probes = forest.probe(unit[i].astype(np.float32), sizes, 10**9)
        assert len(probes) == 96 == len(set(probes))
        assert {(t, int(leaves[i, t])) for t in range(3)} == set(probes[:3])  # its own leaves come first


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding) for r in table], 5, 50)
    got = found(queries.op12_nearest_neighbours(spark, sf))
    assert set(got) == set(want)
    assert sum(got[x][0] in {want[x[0], r][0] for r in range(1, 6)} for x in got) >= 0.9 * len(want)
