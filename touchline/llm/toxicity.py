"""Toxic documents by compression distance.

One zstandard dictionary is trained on ordinary and one on toxic text. A window
of a document is compressed with either, and the bytes that the toxic one saves
are a gain. A second gain comes from a short dictionary of what is typical of
toxic text, beginnings of words that occur in far more toxic than ordinary
documents, laid before the ordinary one. Both gains of a document's windows give
a few numbers, and a logistic curve fitted on documents that no dictionary has
seen turns them into a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.sampling import labelled_sample, remainder
from touchline.llm.shipping import ship

WINDOW = 72
STEP = 36
LEVEL = 6
WHOLE_BYTES = 10_240
MARKED_BYTES = 1_280
#: A beginning is typical when it is in this share of the toxic sample or more, that many times as
#: usual there, and so often that the logarithm of these times is that many standard errors above 0.
TYPICAL_SHARE = 0.01
TYPICAL_TIMES = 8.0
TYPICAL_ERRORS = 1.7


def windows(text: str | None) -> list[bytes]:
    raw = (text or "").encode().lower()
    return [raw[i : i + WINDOW] for i in range(0, max(1, len(raw) - (WINDOW - STEP)), STEP)]


def _words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _beginnings(word: bytes) -> list[bytes]:
    return [b" " + word[:n] for n in range(3, min(len(word), 12) + 1)]


def unlike(texts: list[str]) -> list[str]:
    """The texts without near copies of earlier ones, by a few minhashes of five-word shingles."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for text in texts:
        words = _words(text)
        grams = [_gram(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
        least = {(k, min((g * f) & 0xFFFFFFFFFFFFFFFF for g in grams)) for k, f in enumerate(_FACTORS)}
        if not least & seen:
            kept.append(text)
        seen |= least
    return kept


#: Odd multipliers that reorder 64-bit hashes.
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _gram(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words))


def typical(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """For each toxic text its typical beginnings of words, end to end; texts without any are left out."""

    def spread(texts: list[str]) -> Counter:
        return Counter(b for t in texts for b in {b for w in set(_words(t)) for b in _beginnings(w)})

    here, there = spread(toxic), spread(ordinary)

    def times(b: bytes) -> float:
        return (here[b] + 0.5) / (len(toxic) + 1) / ((there[b] + 0.5) / (len(ordinary) + 1))

    def errors(b: bytes) -> float:
        return math.log(times(b)) / math.sqrt(1 / (here[b] + 0.5) + 1 / (there[b] + 0.5))

    least = max(2, TYPICAL_SHARE * len(toxic))
    found = [b for b, n in here.items() if n >= least and times(b) > TYPICAL_TIMES and errors(b) > TYPICAL_ERRORS]
    weight = {b: math.log(times(b)) * math.sqrt(here[b]) for b in found}
    out = []
    for text in toxic:
        best = [max(c, key=lambda b: (weight[b], len(b))) for w in _words(text) if (c := [b for b in _beginnings(w) if b in weight])]
        if best:
            out.append(b"".join(best) + b" ")
    return out


def _trained(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; with too little text to train on, the text itself."""
    try:
        return zstd.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(content) < 8:
        return zstd.ZstdCompressor(**plain)
    held = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(dict_data=held, **plain)


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    marked: bytes  # typical beginnings of toxic text
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one stands alone
    prior: float

    def measures(self, texts: list[str | None]) -> np.ndarray:
        """For either gain: its mean, root of the largest one with its sign, and shares of windows with 2 and with 4 bytes or more."""
        plain, *others = (_compressor(c).compress for c in (self.ordinary, self.marked + self.ordinary, self.toxic))
        out = np.zeros((len(texts), 4 * len(others)))
        for i, text in enumerate(texts):
            parts = windows(text)
            usual = np.array([len(plain(w)) for w in parts])
            for k, other in enumerate(others):
                gain = usual - [len(other(w)) for w in parts]
                top = gain.max()
                out[i, 4 * k : 4 * k + 4] = gain.mean(), math.copysign(math.sqrt(abs(top)), top), (gain >= 2).mean(), (gain >= 4).mean()
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(texts), self.prior)
        x = (self.measures(texts) - self.center) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights and intercept by Newton steps on the ridge-penalised likelihood."""
    design = np.hstack([x, np.ones((len(x), 1))])
    keep = np.diag([ridge] * x.shape[1] + [1e-6]) * len(x)
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T * (p * (1 - p)) @ design + keep, design.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(sample: list[tuple[str, int]], share: float) -> ToxicityModel:
    """A model from labelled texts. Even places train the dictionaries, odd ones the curve.

    ``share`` is how usual toxic documents are among all labelled ones; the
    sample may hold more of them. With only one label, every score is ``share``.
    """
    toxic = unlike([t for t, y in sample if y == 1])
    ordinary = unlike([t for t, y in sample if y == 0])
    empty = np.zeros(0)
    if len(toxic) < 2 or len(ordinary) < 2:
        return ToxicityModel(b"", b"", b"", empty, empty, empty, share)
    whole = [_trained([w for t in half for w in windows(t)], WHOLE_BYTES) for half in (ordinary[::2], toxic[::2])]
    marked = _trained(typical(toxic[::2], ordinary[::2]) * 20, MARKED_BYTES)
    model = ToxicityModel(*whole, marked, empty, empty, empty, share)
    x = np.vstack([model.measures(toxic[1::2]), model.measures(ordinary[1::2])])
    y = np.append(np.ones(len(toxic[1::2])), np.zeros(len(ordinary[1::2])))
    model.center, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    model.weights = _logistic((x - model.center) / model.scale, y)
    drawn = y.mean()
    model.weights[-1] += math.log(share / (1 - share)) - math.log(drawn / (1 - drawn))
    return model


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    held_out: int = 2,
    modulus: int = 4,
    threshold: float = 0.3,
    per_label: int = 2000,
    max_chars: int = 20_000,
) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    Labels are learned from documents whose ``crc32(doc_id) mod modulus`` is
    not ``held_out``: at most ``per_label`` of each label, of at most
    ``max_chars`` characters each. Scores come from the text alone, of which
    all windows are read.

    Null and empty texts are scored as one empty window. Of several labels for
    an id the largest counts; null labels, and labels without a document, do
    not. Without documents of both labels every score is the share of toxic
    labels (0.0 without any). A null id counts as the empty text. Empty tables
    give an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marks = labels.where(f"`{label}` IS NOT NULL").groupBy(F.col(doc_id).cast("long").alias("doc_id"))
    marks = marks.agg(F.max(label).cast("int").alias("toxic")).where(remainder("doc_id", modulus) != held_out)
    # Only ids and hashes of usable texts are ranked; no text moves but those drawn, one of equal ones.
    usable = rows.where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("doc_id", F.xxhash64("text").alias("draw"))
    texts = usable.join(marks, "doc_id").groupBy("toxic", "draw").agg(F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("toxic").orderBy("draw")
    drawn = texts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label).drop("place")
    hashed = rows.withColumn("draw", F.xxhash64("text"))
    train = hashed.join(F.broadcast(drawn), ["doc_id", "draw"]).drop("draw")
    share = marks.join(rows.select("doc_id"), "doc_id", "left_semi").agg(F.avg("toxic")).first()[0] or 0.0
    model = fit(labelled_sample(train, "toxic", per_label, max_chars), share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"])

    marked = rows.select("doc_id", (remainder("doc_id", modulus) == held_out).alias("held_out"), "text")
    scored = marked.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
