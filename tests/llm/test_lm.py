"""Scores against plain counts, and the trie against a dictionary."""

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus import SCHEMA, frame, lower, prose, words

from touchline.llm import blocks
from touchline.llm.lm import _SHARES, EliasFano, Level, code_of, planes, score_documents
from touchline.llm.lm import _Reader as Reader
from touchline.llm.queries import QUERIES
from touchline.llm.text import mix, words_of


def tokens(text):
    return [*words(lower(text)), "</s>"]


def brute(rows, least_context=16):
    """Scores with exact instead of quantised frequencies."""
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    one = Counter(w for t in train for w in tokens(t))
    total, different = sum(one.values()), len(one)
    chains = [["<s>", *tokens(t)] for t in train]
    two = Counter(p for c in chains for p in zip(c, c[1:]))
    three = Counter(p for c in chains for p in zip(c, c[1:], c[2:]))
    after, after2 = Counter(p[0] for p in two), Counter(p[:2] for p in three)
    seen = one + Counter({"<s>": len(train)})
    out = []
    for i, t in rows:
        c = ["<s>", *tokens(t)]
        base = score = 0.0
        for k in range(1, len(c)):
            p = (one[c[k]] + 0.5) / (total + 0.5 * (different + 1))
            base += math.log10(p)
            if seen[c[k - 1]] >= 2:
                n, kinds = seen[c[k - 1]], after[c[k - 1]]
                p = (two[c[k - 1], c[k]] + kinds * p) / (n + kinds)
            if k > 1 and two[c[k - 2], c[k - 1]] >= least_context:
                n, kinds = two[c[k - 2], c[k - 1]], after2[c[k - 2], c[k - 1]]
                p = (three[c[k - 2], c[k - 1], c[k]] + kinds * p) / (n + kinds)
            score += math.log10(p)
        known = sum(one[w] > 0 for w in c[1:])
        out.append((i, len(c) - 1, known, total, base, score))
    return out


def exact(rows):
    """Scores with the counts of every context that was seen."""
    chains = {i: ["<s>", *tokens(t)] for i, t in rows}
    train = [c for i, c in chains.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    grams = [Counter(g for c in train for g in zip(*(c[k:] for k in range(n)))) for n in (1, 2, 3)]
    follow = [Counter(g[:-1] for g in level) for level in grams]
    total, different = sum(len(c) - 1 for c in train), len(grams[0]) - 1
    out = []
    for i, c in chains.items():
        score = 0.0
        for k in range(1, len(c)):
            p = (grams[0][c[k],] + 0.5) / (total + 0.5 * (different + 1))
            for n in (1, 2):
                context = tuple(c[max(0, k - n) : k])
                if len(context) == n and (seen := grams[n - 1][context]):
                    kinds = follow[n][context]
                    p = (grams[n][(*context, c[k])] + kinds * p) / (seen + kinds)
            score += math.log10(p)
        out.append((i, len(c) - 1, sum(grams[0][w,] > 0 for w in c[1:]), total, score))
    return out


@pytest.mark.parametrize("block_mb", [12.0, 0.01])
def test_like_plain_counts(spark, monkeypatch, block_mb):
    of = blocks.Layout.of.__func__
    monkeypatch.setattr(blocks.Layout, "of", classmethod(lambda cls, size, mb=4.0: of(cls, size, block_mb)))
    rng = random.Random(2)
    rows = [(i, " ".join(prose(rng, rng.randrange(5, 120), 60)).replace("w1", "W1")) for i in range(80)]
    rows += [(500, None), (501, ""), (502, "zz zz zz"), (None, "w1 w2 w3"), (503, "w1 w2 w3"), (503, "w1 w2 w3")]
    got = sorted(score_documents(frame(spark, rows), least_context=16, least_seen=2).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    want = sorted(brute(rows), key=lambda r: (r[0] is None, r[0]))
    for g, w in zip(got, want, strict=True):
        assert (g.doc_id, g.n_tokens, g.n_known, g.train_tokens) == w[:4]
        assert g.base_score == pytest.approx(w[4], abs=1e-7)
        # Frequencies are kept to about four hundredths.
        assert abs(g.score - w[5]) <= 0.03 * g.n_tokens
        assert g.held_out == (zlib.crc32(("" if g.doc_id is None else str(g.doc_id)).encode()) % 5 == 1)


@pytest.mark.parametrize("block_mb", [12.0, 0.01])
def test_query_counts_rare_contexts(spark, monkeypatch, tmp_path, block_mb):
    """Phrases seen only once to three times have pairs and triples, in one block or in several."""
    of = blocks.Layout.of.__func__
    monkeypatch.setattr(blocks.Layout, "of", classmethod(lambda cls, size, mb=4.0: of(cls, size, block_mb)))
    rng = random.Random(5)
    rare = [[f"r{k}x{j}" for j in range(6)] for k in range(30)]
    rows = [(i, " ".join(prose(rng, 30, 60) + rare[i % 30] + prose(rng, 5, 60) + rare[i % 7])) for i in range(60)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(QUERIES["op3_language_model"](spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    for g, w in zip(got, exact(rows), strict=True):
        assert (g.doc_id, g.n_tokens, g.n_known, g.train_tokens) == w[:4]
        # Frequencies are kept to about four hundredths.
        assert abs(g.score - w[4]) <= 0.02 * g.n_tokens


@pytest.mark.parametrize("block_mb", [12.0, 0.01])
def test_a_pair_that_only_seems_seen_falls_back(spark, monkeypatch, block_mb):
    """Two words with the same 24 bits as successors: one is seen after "a", the other only in a held-out document."""
    of = blocks.Layout.of.__func__
    monkeypatch.setattr(blocks.Layout, "of", classmethod(lambda cls, size, mb=4.0: of(cls, size, block_mb)))
    names = [f"n{i}" for i in range(20_000)]
    hashes = words_of(pa.chunked_array([pa.array([" ".join(names)])]), lower=True).hashes
    bits = (mix(hashes ^ np.uint64(3)) & np.uint64((1 << 24) - 1)).tolist()
    first = {}
    one, other = next((names[first[b]], n) for n, b in zip(names, bits) if first.setdefault(b, names.index(n)) != names.index(n))
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1}
    rng = random.Random(7)
    rows = [(i, " ".join(prose(rng, 40, 60) + ["a", other if i in held else one, "b"])) for i in range(400)]
    got = sorted(score_documents(frame(spark, rows)).collect(), key=lambda r: r.doc_id)
    # Taking the pair for one that was seen raises a score; frequencies are kept to about four hundredths.
    assert all(math.isfinite(g.score) and g.score >= w[4] - 0.02 * g.n_tokens for g, w in zip(got, exact(rows), strict=True))


def test_learns_from_repeats(spark):
    rng = random.Random(4)
    common = prose(rng, 60)
    rows = [(i, " ".join(prose(rng, 10) + common)) for i in range(60)]
    got = [r for r in score_documents(frame(spark, rows)).collect() if r.held_out]
    assert got and all(r.score > r.base_score + 20 for r in got)


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = score_documents(frame(spark, [(held, "a b")])).first()
    assert (row.n_known, row.train_tokens, row.base_score, row.score) == (0, 0, 0.0, 0.0)
    assert score_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_elias_fano_and_level():
    rng = np.random.default_rng(0)
    for n, top in ((1, 5), (10, 3), (1000, 100), (5000, 1 << 40), (64, 64)):
        values = np.sort(rng.integers(0, top, n).astype(np.uint64))
        assert (EliasFano.of(values).at(np.arange(n)) == values).all()
    contexts = np.unique(rng.integers(0, 1 << 40, 300).astype(np.uint64))
    number = rng.integers(0, 20, len(contexts))
    grams = np.concatenate(
        [(np.uint64(i) << np.uint64(24)) | np.sort(rng.choice(1 << 12, k, replace=False)).astype(np.uint64) for i, k in enumerate(number)]
    )
    codes = rng.integers(1, 256, len(grams)).astype(np.uint8)
    known = dict(zip(grams.tolist(), codes.tolist()))
    with Level(contexts, number, grams, codes) as level:
        at, following = rng.integers(0, len(contexts), 3000), rng.integers(0, 1 << 12, 3000).astype(np.uint64)
        assert level.search(at, following).tolist() == [known.get(int(a) << 24 | int(f), 0) for a, f in zip(at, following)]
        assert os.path.exists(level.path) and level.bytes < 8 * len(grams)
    assert not os.path.exists(level.path)


def test_codes_and_planes():
    share = 10 ** -np.linspace(0, 8.9, 500)
    assert np.abs(np.log10(_SHARES[code_of(share)]) - np.log10(share)).max() <= 9 / 254 / 2 + 1e-9
    values = np.array([0, 1, 255, 256, 1 << 39], dtype=np.uint64)
    assert (Reader(planes(values, 5)).planes(5, 5) == values).all()


def test_answers_about_pairs_are_dealt_once(spark, monkeypatch):
    """They wait at their blocks for the last pass: no shuffle by block lies above the union of both kinds of answers."""
    from touchline.llm import blocks, lm

    layout = blocks.Layout.of
    monkeypatch.setattr(blocks.Layout, "of", classmethod(lambda cls, size, mb: layout(max(size, int(40e6)), mb)))
    docs = spark.createDataFrame([(i, f"a b c {i % 7} d e {i % 3}") for i in range(60)], "doc_id long, text string")
    plan = lm.score_documents(docs)._jdf.queryExecution().executedPlan().toString()
    union = next(i for i, line in enumerate(plan.splitlines()) if "Union" in line)
    above = "\n".join(plan.splitlines()[:union])
    assert above.count("Exchange") == 1  # that of the texts
    scores = {r["doc_id"] % 21: r["score"] for r in lm.score_documents(docs).collect()}
    assert len(scores) == 21 and all(s < 0 for s in scores.values())


def test_a_pair_that_many_blocks_ask_for_is_searched_once(monkeypatch):
    """And what blocks send of ascending keys is below its bytes: steps are smaller, and each plane is compressed by itself."""
    from touchline.llm import lm

    rng = np.random.default_rng(1)
    names = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    context, following = (a.ravel() for a in np.meshgrid(np.arange(2000), np.arange(3), indexing="ij"))
    seen = np.full(len(names), 3)
    grams = lm.Grams.of(context, mix(names), seen, following, mix(names + np.uint64(1)), np.ones(len(context)), 10**9, 1)
    mail = [m for block in range(5) for m in grams.mail(block, lm.PAIRS)]
    assert all(len(m[3]) < 2000 * 4 + 6000 * 3.1 for m in mail)
    searched, search = [], Level.search
    monkeypatch.setattr(Level, "search", lambda self, at, after: searched.append(len(at)) or search(self, at, after))
    answers = lm._level_answers(mail, lm.PAIRS)
    assert sum(searched) == len(context) and len(answers) == 5
    for m in answers:
        share, kinds = grams.read([m], lm.PAIRS)
        # Each of the five blocks saw each pair once, and each context three times.
        assert np.abs(share - _SHARES[code_of(np.array([1.0]))]).max() == 0 and (kinds == 3).all()
        assert not grams.alone([m], lm.PAIRS).any()


def test_squeezed_steps():
    rng = np.random.default_rng(2)
    begin = np.array([0, 1, 700])
    parts = [np.sort(rng.integers(0, 1 << 40, n).astype(np.uint64)) for n in (1, 699, 300)]
    values = np.concatenate(parts)
    from touchline.llm.lm import climbed, squeezed, steps

    packed = squeezed(steps(values, begin), 5)
    assert len(packed) < 4.5 * len(values)
    assert (climbed(Reader(packed).squeezed(len(values), 5), begin) == values).all()
    nothing = np.zeros(0, dtype=np.uint64)
    assert len(Reader(squeezed(nothing, 5)).squeezed(0, 5)) == 0
    assert len(climbed(steps(nothing, begin[:0]), begin[:0])) == 0


def test_numbers_with_the_same_high_bits():
    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 5), (10, 3), (1000, 100), (5000, 1 << 40), (300, 1 << 20)):
        values = np.sort(rng.integers(0, top, n).astype(np.uint64))
        sequence = EliasFano.of(values)
        high = (values >> np.uint64(sequence.bits)).astype(np.int64)
        asked = rng.integers(0, (int(high.max()) if n else 0) + 100, 400)
        start, end = sequence.alike(asked)
        there = np.isin(asked, high)
        assert (start[there] == np.searchsorted(high, asked[there])).all() and (end[there] == np.searchsorted(high, asked[there], side="right")).all()
        assert (start[~there] == end[~there]).all()
