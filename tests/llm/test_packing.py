"""Packing: an exact round trip, optimal cuts, and the encoder against the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from corpus import SCHEMA, frame, planted

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from touchline.llm.packing import Encoder, best_cuts, cut_places, pack  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(text):
    model = tokenizers.Tokenizer.from_file(PATH)
    return [*model.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, got, limit):
    of, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in rows:
        ids, at = np.array(plain_ids(text), dtype="<u4"), 0
        for r in sorted(of[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert bytes(r.ids) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    padding = tokens = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limit
        tokens += at
        padding += 0 if at & (at - 1) == 0 else limit - at
    # Documents follow one another in id order.
    order = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    ids = [r.doc_id for r in order]
    assert ids == sorted(ids)
    return padding / tokens


def test_round_trip(spark):
    rows = planted(6)
    assert check(rows, pack(frame(spark, rows), PATH).collect(), 2048) < 0.02


def test_round_trip_with_a_limit_that_is_no_power_of_two(spark):
    rows = planted(8, 30)
    assert check(rows, pack(frame(spark, rows), PATH, limit=300, stretch_tokens=5000).collect(), 300) < 0.05


def test_edges(spark):
    rows = [(None, "b a"), (2, None), (2, ""), (3, "a b c"), (3, "a b c")]
    got = pack(frame(spark, rows), PATH).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.sequence_id, r.offset))][-1] is None
    assert sorted((r.doc_id is None, r.doc_tokens) for r in got if r.start == 0) == sorted((i is None, len(plain_ids(t))) for i, t in rows)
    assert pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_added_tokens_and_forms_of_ids(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "x" * 50 + "<|endoftext|><|endoftext|> y " * 400), (4, "plain")]
    check(rows, pack(frame(spark, rows), PATH).collect(), 2048)
    assert plain_ids(rows[0][1]) == [64, 220, 50256, 275, 1]
    wide, short, sums = (sorted(pack(frame(spark, rows), PATH, **k).collect()) for k in ({}, {"narrow": True}, {"with_ids": False}))
    for a, b, c in zip(wide, short, sums, strict=True):
        assert a[:6] == b[:6] == c[:6] and np.frombuffer(a.ids, "<u4").tolist() == np.frombuffer(b.ids, "<u2").tolist()
        assert c.ids_crc32 == zlib.crc32(a.ids)


def test_parts_beyond_the_cache_and_between_unusual_spaces():
    rng = random.Random(5)
    spaces = [" ", "  ", "\n ", "\u00a0", "\u00a0 ", "\u3000 ", "\u2009 ", "\x1c ", "\x85 ", " \t", "\u2019 ", "é "]
    texts = ["".join(f"{rng.choice(['ab', 'Cé', '中', '1', '’'])}{rng.choice(spaces)}" for _ in range(rng.randrange(40))) for _ in range(300)]
    few = Encoder(PATH, cached=20)
    model = tokenizers.Tokenizer.from_file(PATH)
    want = [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
    for a in range(0, 300, 50):
        assert [g.tolist() for g in few.encode(texts[a : a + 50])] == want[a : a + 50]
    assert few.encode([]) == [] and [len(g) for g in few.encode(["", "", "a"])] == [0, 0, 1]


def test_cuts_are_optimal():
    rng = np.random.default_rng(1)
    for limit in (8, 6):
        for _ in range(150):
            n = int(rng.integers(1, 40))
            ids, ends = rng.integers(0, 4, n), np.unique(np.append(rng.integers(1, n + 1, 3), n))
            place, price = cut_places(ids, ends, np.array([1, 0, 0, 0], dtype=bool), limit)
            if (np.diff(place) > limit).any():
                continue
            padding = [0 if k & (k - 1) == 0 else limit - k for k in range(limit + 1)]
            best = [0.0]
            for j in range(1, len(place)):
                near = [i for i in range(j) if place[j] - place[i] <= limit]
                best.append(min(best[i] + padding[place[j] - place[i]] + price[j] for i in near))
            cuts = best_cuts(place, price, limit)
            cost = sum(padding[b - a] for a, b in zip(cuts, cuts[1:])) + price[np.searchsorted(place, cuts[1:])].sum()
            assert cost == pytest.approx(best[-1]) and cuts[0] == 0 and cuts[-1] == n


def test_long_stretches_without_a_sentence_can_be_cut():
    place, _ = cut_places(np.zeros(10_000, dtype=np.int64), np.array([10_000]), np.zeros(1, dtype=bool), 2048)
    assert np.diff(place).max() <= 256


def test_encoder_like_the_library():
    rng = random.Random(3)
    alphabet = ["a", "B", "é", " ", "  ", "\n", "\t", "1", ".", "'s", "<|endoftext|>", "ü", "中", "🙂", " "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(600)]
    got = Encoder(PATH).encode(texts)
    for text, ids in zip(texts, got):
        assert [*ids.tolist(), 1] == plain_ids(text) if len(text) < 4 else True
    model = tokenizers.Tokenizer.from_file(PATH)
    assert [g.tolist() for g in got] == [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]


def test_a_task_of_the_pipeline_leaves_no_words_in_its_worker(spark, monkeypatch):
    """Workers live on into other steps, whose memory the words would take; packed rows are the same."""
    import corpus_pipeline
    from touchline.llm.packing import encoder

    docs = spark.createDataFrame([(i, f"some words {i} in a row") for i in range(40)], "doc_id long, text string")
    asked = []
    monkeypatch.setattr(corpus_pipeline, "pack", lambda docs, path, **how: asked.append(how) or docs)
    corpus_pipeline.packed(spark, docs, "")
    how = asked[0] | {"cached_words": 777_777}  # an encoder that no other test has filled

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(encoder(PATH, 777_777).hashes)], pa.int64())})

    rows = pack(docs, PATH, **how).collect()
    assert max(r.n for r in spark.range(64).repartition(64).mapInArrow(held, "n long").collect()) == 0
    assert {tuple(r) for r in rows} == {tuple(r) for r in pack(docs, PATH, narrow=True).collect()}
