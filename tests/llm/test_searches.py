"""Fingerprints, licence notices and leaks of test items, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
import regex
from corpus import SCHEMA, frame, lower, planted, prose, shingle_set, words

from touchline.llm.decontaminate import find_leaks, tiles
from touchline.llm.fingerprint import document_fingerprints, fingerprints, likeness
from touchline.llm.license_scan import NAMES, NOTICES, _length_class, bands_needed, gate_words, license_scan, license_texts
from touchline.llm.queries import QUERIES


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_neighbours(spark):
    rows = planted(9)
    got = {r.doc_id: r for r in document_fingerprints(frame(spark, rows)).collect()}
    ids = sorted(got)
    texts = {i: t or "" for i, t in rows}
    errors = []
    for i, j in zip(ids, ids[1:] + ids[:1]):
        text, half = texts[i], len(texts[i]) // 2
        edited = text[: len(text) - half] + texts[j][:half]
        assert (got[i].n_chars, got[i].edited_text) == (len(text), edited)
        errors += [got[i].near_edited - jaccard(text, edited), got[i].near_next - jaccard(text, texts[j])]
    assert np.sqrt(np.mean(np.square(errors))) < 0.05
    by_text = {}
    for i in ids:
        assert by_text.setdefault(texts[i], got[i].fingerprint) == got[i].fingerprint
    assert got[1001].fingerprint == got[1002].fingerprint == ""


def test_fingerprints_over_many_parts(spark, monkeypatch):
    from touchline.llm import fingerprint, ordered

    monkeypatch.setattr(fingerprint, "in_order", lambda d, i, t: ordered.in_order(d, i, t, part_mb=0.005))
    rows = planted(9)
    whole = sorted(document_fingerprints(frame(spark, rows)).collect())
    monkeypatch.undo()
    assert whole == sorted(document_fingerprints(frame(spark, rows)).collect())


def test_fingerprint_edges(spark):
    one = document_fingerprints(frame(spark, [(5, "a b c d e f")])).first()
    assert one.edited_text == "a b c a b c"[: len("a b c d e f")][:6] + "a b c"[:5]
    rows = [(None, "z"), (1, "a"), (1, "a"), (1, "b"), (2, None)]
    got = document_fingerprints(frame(spark, rows)).collect()
    assert len(got) == 5 and sum(r.doc_id is None for r in got) == 1
    assert document_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_is_not_biased():
    rng = random.Random(0)
    errors = []
    for _ in range(300):
        a, n = prose(rng, 100), rng.randrange(100)
        b = a[:n] + prose(rng, 100 - n)
        low, some = fingerprints(pa.array([" ".join(a), " ".join(b)]))
        errors.append(likeness(low[:1], low[1:], some[:1], some[1:])[0] - jaccard(" ".join(a), " ".join(b)))
    assert abs(np.mean(errors)) < 0.01


def alnum(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def fives(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def test_licence_notices(spark):
    rng = random.Random(1)
    rows = []
    for i in range(80):
        w = prose(rng, rng.randrange(0, 80))
        if i % 4 == 0:
            notice = rng.choice(NOTICES)[1]
            at = rng.randrange(len(w) + 1)
            w = w[:at] + [notice.upper() if i % 8 else notice] + w[at:]
        if i % 10 == 1:  # one word of a long notice changed: still enough, or not
            notice = NOTICES[5][1].split()
            notice[rng.randrange(len(notice))] = "zzz"
            w += notice
        rows.append((i, " ".join(w)))
    rows += [(500, None), (501, ""), (502, "license"), (503, " ".join(prose(rng, 9000)) + " " + NOTICES[0][1])]
    want = set()
    for i, t in rows:
        found = fives(alnum(t))
        for name, notice in NOTICES:
            own = set(fives(alnum(notice)))
            n = _length_class(len(own))
            if any(len(own & set(found[k : k + n])) >= 0.8 * len(own) for k in range(max(1, len(found) - n + 1))):
                want.add((i, name))
    got = license_scan(frame(spark, rows)).collect()
    assert {(r.doc_id, r.license_id) for r in got} == want and len(got) == len(want) > 15
    at = {(r.doc_id, r.license_id): r for r in got}[503, "Apache-2.0"]
    assert at.containment == 1.0 and 8990 <= at.first_shingle <= 9000


def test_licence_edges(spark):
    df = frame(spark, [(1, "use it freely for all"), (1, "use it freely for all"), (None, "use it freely for all")])
    got = license_scan(df, [("A", "Use it freely, for all!"), ("B", ""), ("C", None)]).collect()
    assert sorted((r.doc_id or 0, r.license_id, r.containment, r.first_shingle) for r in got) == [(0, "A", 1.0, 0), (1, "A", 1.0, 0), (1, "A", 1.0, 0)]
    assert license_scan(df, []).count() == 0
    assert license_scan(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = df.withColumnRenamed("lang", "row").withColumnRenamed("source", "h")
    assert license_scan(clash, [("A", "use it freely for all")]).count() == 3


def test_licence_texts_and_edited_notices(spark, tmp_path):
    rng = random.Random(6)
    rows, want = [], set()
    for name, body, _ in license_texts():
        at = len(rows)
        rows.append((at, " ".join([*prose(rng, 40), *body.split(), *prose(rng, 40)])))
        want.add((at, name))
    for name, notice in NOTICES:
        words = alnum(notice)
        fixed = {w for w in NAMES[name][0].split()} | set(NAMES[name][1])
        for k, w in enumerate(words):
            at = len(rows)
            rows.append((at, " ".join([*prose(rng, 20), *words[:k], "zzz", *words[k + 1 :], *prose(rng, 20)])))
            if w not in fixed:
                want.add((at, name))
    bsd2 = license_texts()[6][1].split()
    third = bsd2.index("3."), bsd2.index("THIS")
    others = ["licensed under the apache license version 1 1", "released under the bsd license", "licensed under cc by nc sa 4 0"]
    others += ["this work is licensed under the gnu lesser general public license version 3", " ".join(bsd2[: third[0]] + bsd2[third[1] :])]
    rows += [(1000 + i, t) for i, t in enumerate(others)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.license_id) for r in QUERIES["op2_license_scan"](spark, str(tmp_path)).collect()}
    assert want <= got and not any(i >= 1000 for i, _ in got)


def test_no_python_in_the_licence_plan(spark):
    plan = license_scan(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_gate_words_and_bands():
    notices = [alnum(t) for _, t in NOTICES]
    gate = gate_words(notices, 0.8)
    for w in notices:
        free = [s for s in fives(w) if not any(g in x for g in gate for x in s)]
        assert len(free) < 0.8 * len(fives(w))
    assert bands_needed(1, 0.8, 1e-4) == 1 and bands_needed(10, 0.8, 1e-4) > 5


def leaks(df):
    return {(r.doc_id, r.item_id): r for r in df.collect()}


def test_leaks(spark):
    rng = random.Random(3)
    items = [(k, " ".join(prose(rng, 40))) for k in range(20)] + [(30, None), (31, ""), (32, "tiny test"), (33, items_text := "Q " * 3)]
    rows, want = [], set()
    for i in range(60):
        w = prose(rng, 60)
        if i % 5 == 0:  # whole
            k = rng.randrange(20)
            w = w[:20] + items[k][1].upper().split() + w[20:]
            want.add((i, k))
        elif i % 5 == 1:  # its quarters in another order
            k = rng.randrange(20)
            t = items[k][1].split()
            w = w[:9] + t[30:] + w[9:12] + t[10:20] + w[12:30] + t[:10] + t[20:30] + w[30:]
            want.add((i, k))
        elif i % 5 == 2:  # less than half
            w = w + items[rng.randrange(20)][1].split()[:18]
        rows.append((i, " ".join(w)))
    rows += [(100, None), (101, ""), (102, "a tiny TEST it was"), (103, "tiny and test")]
    want.add((102, 32))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = leaks(find_leaks(frame(spark, rows), bench))
    assert set(got) == want
    for (i, k), r in got.items():
        if i % 5 == 1 and i < 100:
            assert r.n_tiles >= 3 and r.coverage > 0.9
    again = leaks(find_leaks(frame(spark, rows), bench, slice_words=100))
    assert again == got
    assert items_text


def test_leak_edges(spark):
    bench = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f")], "item_id long, text string")
    df = frame(spark, [(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")])
    assert find_leaks(df, bench).count() == 6
    assert find_leaks(df.limit(0), bench).count() == 0 and find_leaks(df, bench.limit(0)).count() == 0


def test_tiles_take_the_longest_first():
    a = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 50, 1, 2, 3, 4, 5], dtype=np.uint64)
    b = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9], dtype=np.uint64)
    assert tiles(a, b, 3) == [(0, 0, 9)]
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 4, 30).astype(np.uint64), rng.integers(0, 4, 20).astype(np.uint64)
        got = tiles(a, b, 3)
        used_a, used_b = [], []
        for i, j, n in got:
            assert n >= 3 and (a[i : i + n] == b[j : j + n]).all()
            used_a += range(i, i + n)
            used_b += range(j, j + n)
        assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
        free_a, free_b = set(range(30)) - set(used_a), set(range(20)) - set(used_b)
        rest = [(i, j) for i in range(28) for j in range(18) if {i, i + 1, i + 2} <= free_a and {j, j + 1, j + 2} <= free_b]
        assert not any((a[i : i + 3] == b[j : j + 3]).all() for i, j in rest)


def test_words_are_the_contract_s():
    assert words("a\x0bb\x0cc\x1cd e") == ["a", "b", "c\x1cd e"] and lower("ÀB") == "Àb"
