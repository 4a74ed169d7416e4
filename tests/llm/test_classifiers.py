"""Toxicity and language ID: held-out accuracy, forward-backward against enumeration, and edges."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus import SCHEMA, frame, prose

from touchline.llm import langid
from touchline.llm import toxicity as toxicity_module
from touchline.llm.langid import forward_backward, identify, language_model
from touchline.llm.toxicity import toxicity, typical, unlike, windows

SYLLABLES = {"en": ["the", "ing", "tion", "er", "st"], "de": ["ung", "sch", "ich", "ä", "ver"], "es": ["ción", "os", "ar", "ñ", "que"]}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(1)
    rows = [(i, text_of(rng, lang := rng.choice(list(SYLLABLES)), rng.randrange(8, 80)), lang) for i in range(240)]
    rows += [(900, None, "en"), (901, "", "de"), (902, " 12 — 3 ", "es"), (903, "the ting", None), (None, "ung sch", "de")]
    rows.append((904, text_of(rng, "en", 6000), "en"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(spoken):
    return language_model(spoken)


def test_languages_of_held_out_documents(spoken, model):
    truth = {r.doc_id: r.lang for r in spoken.collect()}
    got = {r.doc_id: r for r in identify(spoken, model).collect()}
    assert len(got) == spoken.count()
    assert all(0 <= r.score <= 1 for r in got.values())
    held = [i for i, r in got.items() if r.held_out and i is not None and i < 900]
    assert len(held) > 20 and sum(got[i].lang_pred == truth[i] for i in held) >= 0.97 * len(held)
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[904].lang_pred == "en"


def test_code_switched_text_is_labelled_in_stretches(model):
    rng = random.Random(5)
    column = pa.array([" ".join([text_of(rng, "en", 30), text_of(rng, "de", 30)])])
    words, chance = model.label(column)
    named = [model.languages[k] for k in chance.argmax(axis=1)]
    assert named[:25].count("en") >= 22 and named[-25:].count("de") >= 22
    assert chance.sum(axis=1) == pytest.approx(np.ones(len(chance)))


def test_forward_backward_like_enumeration():
    rng = np.random.default_rng(0)
    k, offsets = 3, np.array([0, 4, 4, 5, 10])
    emission, start, change = rng.normal(size=(10, k)), rng.normal(size=k), rng.normal(size=(k, k))
    got = forward_backward(emission, offsets, start, change)
    for a, b in zip(offsets, offsets[1:]):
        total, want = 0.0, np.zeros((b - a, k))
        for path in itertools.product(range(k), repeat=b - a):
            if not path:
                continue
            weight = start[path[0]] + sum(emission[a + t, y] for t, y in enumerate(path))
            weight = np.exp(weight + sum(change[x, y] for x, y in zip(path, path[1:])))
            total += weight
            for t, y in enumerate(path):
                want[t, y] += weight
        if b > a:
            assert got[a:b] == pytest.approx(want / total)


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert identify(df, language_model(df)).first().lang_pred == langid.UNKNOWN
    assert identify(df.limit(0), language_model(df.limit(0))).count() == 0


INSULTS = ["idiot", "moron", "scum", "loser", "clown"]


def rude(rng, n):
    w = prose(rng, n)
    for _ in range(max(2, n // 25)):
        w[rng.randrange(n)] = rng.choice(INSULTS)
    return " ".join(w)


def test_toxic_documents_are_found(spark):
    rng = random.Random(2)
    rows = [(i, rude(rng, 80) if i % 3 == 0 else " ".join(prose(rng, 80))) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id long, toxic int")
    got = [r for r in toxicity(frame(spark, rows), labels).collect() if r.held_out]
    assert len(got) > 150
    right = sum(r.predicted == (r.doc_id % 3 == 0) for r in got)
    assert right >= 0.9 * len(got) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_toxic_phrases_of_ordinary_words(spark):
    rng = random.Random(12)
    phrases = [" ".join(prose(rng, 6, 60)) for _ in range(12)]

    def text(i):
        parts = [" ".join(prose(rng, 6, 60)) for _ in range(8)]
        return " ".join([rng.choice(phrases) for _ in range(6)] + parts[:2] if i % 3 == 0 else parts)

    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    got = [r for r in toxicity(frame(spark, [(i, text(i)) for i in range(600)]), labels).collect() if r.held_out]
    right = sum((r.score >= 0.5) == (r.doc_id % 3 == 0) for r in got)
    assert right > 0.9 * len(got)


def test_toxicity_draws_labels_with_a_usable_text(spark):
    """Labels without a document, and copies of one text, use up no place of the sample."""
    rng = random.Random(13)
    rows = [(i, " ".join(rude(rng, 40) if i % 3 == 0 else prose(rng, 40)) if i < 600 else "the same text") for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(6000)], "doc_id long, toxic int")
    got = [r for r in toxicity(frame(spark, rows), labels, per_label=100).collect() if r.held_out and r.doc_id < 600]
    right = sum((r.score >= 0.3) == (r.doc_id % 3 == 0) for r in got)
    assert right > 0.9 * len(got)
    seen = []
    sample = toxicity_module.labelled_sample

    def spied(*args):
        seen.extend(sample(*args))
        return seen

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity_module, "labelled_sample", spied)
        toxicity(frame(spark, rows), labels, per_label=100)
    assert sum(y for _, y in seen) == 100 and len(seen) == 200


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (77, 1)], "doc_id long, toxic int")
    rows = [(1, "x"), (2, None), (3, ""), (None, "a " * 10)]
    got = toxicity(frame(spark, rows), labels).collect()
    assert len(got) == 4 and {r.score for r in got} == {1.0}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity(frame(spark, rows), none).collect()} == {0.0}
    assert toxicity(spark.createDataFrame([], SCHEMA), none).count() == 0
    df = frame(spark, rows).withColumnRenamed("lang", "toxic").withColumnRenamed("source", "predicted")
    assert toxicity(df, labels).count() == 4


def test_windows_cover_the_text():
    text = "".join(chr(97 + i % 26) for i in range(500))
    covered = windows(text)
    assert covered[0][:3] == b"abc" and covered[-1].endswith(text[-3:].encode()) and windows(None) == [b""]


def test_typical_beginnings():
    rng = random.Random(1)
    toxic = [rude(rng, 40) for _ in range(400)]
    plain = [" ".join(prose(rng, 40)) for _ in range(400)]
    parts = b"".join(typical(toxic, plain)).split()
    usual = [p.decode() for p, _ in Counter(parts).most_common(len(INSULTS))]
    assert all(any(i.startswith(p) for i in INSULTS) for p in usual) and b"idiot" in parts
    assert len(unlike([plain[0], plain[0] + " more", plain[1]])) == 2


def test_short_texts_and_texts_without_spaces_train_their_language():
    rng = random.Random(3)
    kana, latin = "あいうえおかきくけこさしすせそ", ["mora", "tildo", "venka", "sult", "brimo", "gasta", "pello"]
    texts = lambda n: [("".join(rng.choice(kana) for _ in range(20)), "kana") for _ in range(n)] + [(" ".join(rng.sample(latin, 3)), "few") for _ in range(n)]
    model = langid.fit(texts(60))
    fresh = texts(20)
    names, score = model.predict(pa.array([t for t, _ in fresh]))
    assert names == [y for _, y in fresh] and min(score) > 0.5
    one = langid.fit([("solo", "x"), ("くけこ", "y")])
    assert one.predict(pa.array(["solo", "くけこ"]))[0] == ["x", "y"]
