"""The registered queries: their columns, rows and classes of results, and the pipeline stage by stage."""

import random

import pytest
from corpus import frame, planted, prose
from pyspark.sql import functions as F
from test_near_dedup import brute

import __spark_entry__ as entry
import corpus_pipeline
from touchline.llm import queries

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_": "doc_id bigint, kept_sha256 string, n_removed bigint, n_words bigint",
    "op2_": "containment double, doc_id bigint, first_shingle bigint, license_id string",
    "op3_": "base_score double, doc_id bigint, held_out boolean, n_known bigint, n_tokens bigint, score double, train_tokens bigint",
    "op4_": "doc_id bigint, edited_fingerprint string, edited_sha256 string, fingerprint string, n_chars bigint, near_edited double, near_next double",
    "op5_": "doc_id bigint, held_out boolean, predicted int, score double",
    "op6_": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7_": "doc_id bigint, doc_tokens bigint, ids_crc32 bigint, length bigint, offset bigint, sequence_id bigint, start bigint",
    "op8_": "doc_id bigint, kept_sha256 string, n_bytes bigint, n_removed bigint, n_spans bigint",
    "op9_": "component_id bigint, doc_id bigint, kept boolean, n_shingles bigint",
    "op10_": "coverage double, covered_words bigint, doc_id bigint, item_id bigint, item_words bigint, n_tiles bigint",
    "op11_": "audit string, blank bigint, conv_id bigint, cost bigint, duplicate bigint, gaps bigint, illegal bigint, repaired_sha256 string, truncated bigint",
    "op12_": "query_id bigint, rank int, score double, vec_id bigint",
    "op13_": "doc_id bigint, item_id bigint, rank int, score bigint",
}


def test_registered():
    assert {n for n in entry.queries() if n.startswith("op")} == set(queries.QUERIES) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_and_rows(spark, name):
    df = queries.QUERIES[name](spark, SF)
    want = next(v for k, v in COLUMNS.items() if name.startswith(k))
    assert ", ".join(f"{n} {t}" for n, t in sorted(df.dtypes)) == want
    rows = df.collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    if name.startswith("op11_"):
        docs = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    if name.startswith(("op2_", "op10_")):
        assert 0 < len(rows) < docs
    elif name.startswith("op12_"):
        asked = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 50 = 0").count()
        assert len(rows) == 5 * asked
    elif name.startswith("op13_"):
        assert len(rows) == 10 * spark.read.parquet(f"{SF}/benchmark.parquet").count()
    elif not name.startswith("op7_"):
        assert len(rows) == docs


def test_stages(spark, tmp_path):
    rng = random.Random(3)
    rows = [r for r in planted(11) if r[0] < 1000]
    tests = [(1, " ".join(prose(rng, 40)))]
    rows += [(2000, "12 34"), (2001, None), (2002, " ".join(prose(rng, 50)) + " " + tests[0][1])]
    spark.createDataFrame(tests, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = frame(spark, rows)
    names, functions = zip(*corpus_pipeline.STAGES)
    sf = str(tmp_path)

    kept = functions[0](spark, docs, sf)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if i not in (2000, 2001))
    kept2 = functions[1](spark, kept, sf)
    groups = brute([(i, t) for i, t in rows if i not in (2000, 2001)], 80)
    assert kept2.columns == docs.columns and sorted(r.doc_id for r in kept2.collect()) == sorted(i for i, g in groups.items() if g[2])
    kept3 = functions[2](spark, kept2, sf)
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (kept2, kept3))
    assert kept3.columns == docs.columns and any(before[i] != t for i, t in after.items()) and any(before[i] == t for i, t in after.items())
    assert all(r.n_chars == len(r.text) for r in kept3.collect())
    kept4 = functions[3](spark, kept3, sf)
    assert kept4.columns == docs.columns and {r.doc_id for r in kept3.collect()} - {r.doc_id for r in kept4.collect()} == {2002}
    pieces = functions[4](spark, kept4, sf)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in kept4.collect()}


def test_stages_tell_rows_apart_by_text(spark, tmp_path):
    rng = random.Random(8)
    a, b, c, d, item = (" ".join(prose(rng, 60)) for _ in range(5))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, a), (None, a), (None, b), (None, b), (2, c), (2, a), (3, d), (3, d), (4, ""), (4, "")]
    kept = corpus_pipeline.one_of_near_copies(spark, frame(spark, rows), str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, a), (0, b), (2, c), (3, d), (4, ""), (4, "")])
    rows = [(None, a), (None, b + " " + item), (5, c), (5, item), (6, d)]
    clean = corpus_pipeline.without_test_items(spark, frame(spark, rows), str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in clean) == sorted([(0, a), (5, c), (6, d)])


def test_no_language_learned(spark, tmp_path):
    rows = [(1, "some words"), (2, "12 34"), (3, None), (4, "")]
    docs = frame(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    assert [r.doc_id for r in corpus_pipeline.known_language(spark, docs, str(tmp_path)).collect()] == [1]


def test_packing_query_derives_its_digest_from_the_ids(spark, monkeypatch):
    pack = queries.pack
    plain = pack(queries.documents(spark, SF), queries.tokenizer_path("byte_bpe_50k.json"), limit=2048, with_ids=False)
    key = ["sequence_id", "offset", "doc_id", "ids_crc32"]
    assert sorted(map(tuple, queries.QUERIES["op7_packing"](spark, SF).select(key).collect())) == sorted(map(tuple, plain.select(key).collect()))
    monkeypatch.setattr(queries, "pack", lambda *a, **k: pack(*a, **k).withColumn("ids", F.lit(b"")))
    assert {r.ids_crc32 for r in queries.QUERIES["op7_packing"](spark, SF).collect()} == {0}
