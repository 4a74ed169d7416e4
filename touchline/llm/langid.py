"""Language identification by a linear-chain conditional random field over words.

A word's features are its affixes, the n-grams of its bytes, and whether it is
in the lexicon of each language; they are hashed into one table of weights.
Learned transitions say how often the language changes from one word to the
next, so a borrowed word in a sentence does not flip, and code-switched text
is labelled in stretches. Forward-backward gives each word the probability of
each language, and a document takes the language with the largest share of its
letters.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.sampling import labelled_sample, remainder
from touchline.llm.shipping import ship
from touchline.llm.text import LOWER, Words, carried_columns, mix, pieces, text_bytes

UNKNOWN = "und"
_TABLE_BITS = 16
_LEXICON = 2000
#: Bytes that are not part of a word: all of ASCII but letters. Other scripts' letters are bytes above it.
_NO_LETTER = np.ones(256, dtype=bool)
_NO_LETTER[65:91] = _NO_LETTER[97:123] = False
_NO_LETTER[128:] = False


def _slot(code: np.ndarray, kind: int) -> np.ndarray:
    spread = mix(code + np.uint64(kind * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return (spread >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, slot) pairs of all words, in word order: n-grams of two to four bytes, marked where they touch an end, and the word."""
    size = ends - starts
    width = size + 2
    first = np.cumsum(width) - width
    word = np.repeat(np.arange(len(starts)), width)
    place = np.arange(len(word)) - first[word]
    inner = (place > 0) & (place <= size[word])
    code = np.full(len(word) + 3, 256, dtype=np.uint64)  # 256 stands for a word's end
    code[:-3][inner] = data[(starts[word] + place - 1)[inner]]
    out_word, out_slot = [np.arange(len(starts))], [_slot(hashes, 9)]
    for n in (2, 3, 4):
        gram = np.zeros(len(word), dtype=np.uint64)
        for k in range(n):
            gram = gram * np.uint64(257) + code[k : len(word) + k]
        keep = place + n <= width[word]
        out_word.append(word[keep])
        out_slot.append(_slot(gram[keep], n))
    words, slots = np.concatenate(out_word), np.concatenate(out_slot)
    order = np.argsort(words, kind="stable")
    return words[order], slots[order]


def forward_backward(emission: np.ndarray, offsets: np.ndarray, start: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The probability of each label for each word of chains laid end to end.

    ``emission`` holds log weights. Chains go side by side, longest first, one
    word a step; every step is normalised.
    """
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    size, begin = size[order], offsets[:-1][order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    weight = np.exp(emission - emission.max(axis=1, keepdims=True)) if len(emission) else emission
    ahead, back = np.empty_like(weight), np.empty_like(weight)
    step = np.exp(change)
    state = np.exp(start)[None, :]
    for t in range(longest):
        at = begin[: active[t]] + t
        state = (state[: active[t]] @ step if t else np.repeat(state, active[t], axis=0)) * weight[at]
        state /= state.sum(axis=1, keepdims=True)
        ahead[at] = state
    state = np.ones((0, weight.shape[1]))
    for t in range(longest - 1, -1, -1):
        at = begin[: active[t]] + t
        new = np.ones((active[t], weight.shape[1]))
        if len(state):
            # Chains that end here start from ones.
            new[: len(state)] = (state * weight[at[: len(state)] + 1]) @ step.T
            new /= new.sum(axis=1, keepdims=True)
        back[at] = state = new
    both = ahead * back
    return both / both.sum(axis=1, keepdims=True) if len(both) else both


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # slot x language
    lexicon: np.ndarray  # sorted word hashes
    member: np.ndarray  # lexicon word x language, 0 or 1
    lexicon_weights: np.ndarray  # language of the lexicon x language
    start: np.ndarray
    change: np.ndarray

    def membership(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(hashes), len(self.languages)))
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where((self.lexicon[at] == hashes)[:, None], self.member[at], 0.0)

    def emission(self, words: Words) -> np.ndarray:
        """Log weights of each word; each different word is looked at once."""
        unique, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        out = np.empty((len(unique), len(self.languages)), dtype=np.float32)
        step = 1 << 13
        for a in range(0, len(unique), step):
            at = first[a : a + step]
            word, slot = features(words.data, words.starts[at], words.ends[at], unique[a : a + step])
            edges = np.searchsorted(word, np.arange(len(at)))
            out[a : a + step] = np.add.reduceat(self.weights[slot], edges, axis=0) + self.membership(unique[a : a + step]) @ self.lexicon_weights
        return out[back]

    def label(self, column: pa.Array) -> tuple[Words, np.ndarray]:
        """The words of the texts and each word's probability of each language."""
        words = words_with_letters(column)
        return words, forward_backward(self.emission(words), words.offsets, self.start, self.change)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, share of the letters that it explains) of each text; ``und`` and 0.0 without letters."""
        number = len(column)
        if not self.languages:
            return [UNKNOWN] * number, np.zeros(number)
        words, chance = self.label(column)
        letters = (words.ends - words.starts).astype(float)
        sums = np.vstack([np.zeros(len(self.languages)), np.cumsum(chance * letters[:, None], axis=0)])
        total = sums[words.offsets[1:]] - sums[words.offsets[:-1]]
        weight = np.append(0.0, np.cumsum(letters))
        weight = weight[words.offsets[1:]] - weight[words.offsets[:-1]]
        best = total.argmax(axis=1)
        score = np.clip(total[np.arange(number), best] / np.maximum(weight, 1.0), 0.0, 1.0)
        plain = np.append(0, np.cumsum(~_NO_LETTER[words.data] & (words.data < 128)))
        ascii_letters = plain[words.edges[1:]] - plain[words.edges[:-1]]
        names = [self.languages[b] for b in best]
        for i in np.flatnonzero(ascii_letters == 0):
            # Bytes above ASCII may be letters or not.
            if not any(c.isalpha() for c in column[int(i)].as_py() or ""):
                names[i], score[i] = UNKNOWN, 0.0
        return names, score


def words_with_letters(column: pa.Array) -> Words:
    data, offsets = text_bytes(column)
    words = Words(LOWER[data], offsets, _NO_LETTER)
    words.edges = offsets
    return words


def _switching(words: list[np.ndarray], labels: Sequence[int], length: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Training chains of ``length`` words, put together from stretches of random documents.

    All words of all documents are in some stretch: a last or only one that is
    too short goes on with its document's words from the start, again and again.
    """
    stretch = 8
    need = length // stretch
    pieces_, marks = [], []
    for at, label in zip(words, labels):
        for a in range(0, len(at), stretch):
            part = at[a : a + stretch]
            pieces_.append(part if len(part) == stretch else np.resize(np.concatenate([part, at]), stretch))
            marks.append(label)
    if not pieces_:
        return np.zeros((0, length), dtype=np.int64), np.zeros((0, length), dtype=np.int64)
    # A sample of too few stretches for one chain is taken several times over.
    times = -(-need // len(pieces_))
    pieces_, marks = pieces_ * times, marks * times
    order = rng.permutation(len(pieces_))
    # Every other chain keeps to one language, so that staying is learned as well.
    marks = np.array(marks)
    grouped = order[np.argsort(marks[order], kind="stable")]
    both = np.concatenate([order[: len(order) // need * need], grouped[: len(order) // need * need]]).reshape(-1, need)
    both = both[rng.permutation(len(both))]
    stacked = np.array(pieces_)
    return stacked[both].reshape(len(both), -1), np.repeat(marks[both], stretch, axis=1)


def fit(sample: list[tuple[str, str]], length: int = 32, epochs: int = 1, rate: float = 0.2, ridge: float = 1e-6) -> LanguageModel:
    """Weights that make the languages of the sample's words likely: stochastic gradient steps over chains.

    Documents name the language of all their words. Half of the chains mix
    stretches of different documents, so that transitions between languages
    are seen as well. All chains are learned from, ``epochs`` times.
    """
    languages = sorted({y for _, y in sample})
    k = len(languages)
    weights = np.zeros((1 << _TABLE_BITS, k))
    if not k:
        none = np.zeros((0, 0))
        return LanguageModel([], none, np.zeros(0, np.uint64), none, none, np.zeros(0), none)
    labels = [languages.index(y) for _, y in sample]
    words = words_with_letters(pa.array([t for t, _ in sample], pa.string()))
    own = np.repeat(np.array(labels), np.diff(words.offsets))
    seen = [Counter(words.hashes[own == j].tolist()) for j in range(k)]
    common = [{w for w, _ in c.most_common(_LEXICON)} for c in seen]
    lexicon = np.array(sorted(set().union(*common)), dtype=np.uint64)
    member = np.array([[w in c for c in common] for w in lexicon.tolist()], dtype=float).reshape(-1, k)
    model = LanguageModel(languages, weights, lexicon, member, np.zeros((k, k)), np.zeros(k), np.zeros((k, k)))

    unique, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
    slots_of, sizes = [], []
    for a in range(0, len(unique), 1 << 13):
        at = first[a : a + (1 << 13)]
        word, part = features(words.data, words.starts[at], words.ends[at], unique[a : a + (1 << 13)])
        slots_of.append(part.astype(np.int32))
        sizes.append(np.bincount(word, minlength=len(at)))
    slot = np.concatenate([np.zeros(0, np.int32), *slots_of])
    edges = np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes])))
    inside = model.membership(unique)
    rng = np.random.default_rng(1)
    parts = [back[a:b] for a, b in zip(words.offsets, words.offsets[1:])]
    chains, marks = _switching(parts, labels, length, rng)
    squares = [np.full_like(weights, 1e-8), np.full((k, k), 1e-8), np.full((k, k), 1e-8), np.full(k, 1e-8)]
    batch = 64
    for _ in range(epochs):
        for a in range(0, len(chains), batch):
            ids, truth = chains[a : a + batch], marks[a : a + batch]
            flat, where = np.unique(ids, return_inverse=True)
            number = edges[flat + 1] - edges[flat]
            at = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number) + np.repeat(edges[flat], number)
            emission = np.add.reduceat(model.weights[slot[at]], np.cumsum(number) - number, axis=0) + inside[flat] @ model.lexicon_weights
            chain = emission[where.reshape(ids.shape)]
            chance, pair = _expected(chain, model.start, model.change)
            wanted = np.eye(k)[truth]
            error = (wanted - chance).reshape(-1, k)
            per_word = np.zeros((len(flat), k))
            np.add.at(per_word, where.ravel(), error)
            slots, inverse = np.unique(slot[at], return_inverse=True)
            gradient = np.zeros((len(slots), k))
            np.add.at(gradient, inverse, np.repeat(per_word, number, axis=0))
            gradient -= ridge * len(ids) * model.weights[slots]
            squares[0][slots] += gradient**2
            model.weights[slots] += rate * gradient / np.sqrt(squares[0][slots])
            moves = np.zeros((k, k))
            np.add.at(moves, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1.0)
            for value, square, g in (
                (model.lexicon_weights, squares[1], inside[flat].T @ per_word),
                (model.change, squares[2], moves - pair),
                (model.start, squares[3], (wanted - chance)[:, 0].sum(axis=0)),
            ):
                square += g**2
                value += rate * g / np.sqrt(square)
    return model


def _expected(chain: np.ndarray, start: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of equally long chains, and the expected number of each transition."""
    number, length, k = chain.shape
    offsets = np.arange(number + 1) * length
    chance = forward_backward(chain.reshape(-1, k), offsets, start, change).reshape(number, length, k)
    weight = np.exp(chain - chain.max(axis=2, keepdims=True))
    step = np.exp(change)
    ahead = np.empty_like(weight)
    state = np.exp(start) * weight[:, 0]
    ahead[:, 0] = state / state.sum(axis=1, keepdims=True)
    for t in range(1, length):
        state = (ahead[:, t - 1] @ step) * weight[:, t]
        ahead[:, t] = state / state.sum(axis=1, keepdims=True)
    # chance = ahead * back up to a factor, so back follows from both.
    back = chance / np.maximum(ahead, 1e-300)
    pair = np.zeros((k, k))
    for t in range(1, length):
        joint = ahead[:, t - 1, :, None] * step[None] * (weight[:, t] * back[:, t])[:, None, :]
        pair += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return chance, pair


def language_model(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    held_out: int = 0,
    modulus: int = 5,
    per_language: int = 300,
    max_chars: int = 20_000,
) -> LanguageModel:
    """A model of documents whose ``crc32(doc_id) mod modulus`` is not ``held_out`` and whose language is known.

    It is fitted on at most ``per_language`` documents of each language, of at
    most ``max_chars`` characters each.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return fit(labelled_sample(rows.where(remainder("doc_id", modulus) != held_out), "lang", per_language, max_chars))


def identify(
    docs: DataFrame,
    model: LanguageModel,
    doc_id: str = "doc_id",
    text: str = "text",
    held_out: int = 0,
    modulus: int = 5,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (0 to 1), and ``row``; all words of the text are labelled.

    ``lang_pred`` is ``und``, with score 0.0, for null texts and texts without
    letters, and for all texts if no language was learned. Equal texts get
    equal results. A null id counts as the empty text in ``held_out``. An empty
    table gives an empty result. ``carried`` columns come back in ``row``.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *carried_columns(text, carried))
    marked = rows.withColumn("held_out", remainder("doc_id", modulus) == held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1_500_000):
            names, score = model.predict(batch.column("text"))
            columns = {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(score, pa.float64()),
            }
            if carried:
                columns["row"] = batch.column("row")
            yield pa.RecordBatch.from_pydict(columns)

    tail = ", row " + marked.schema["row"].dataType.simpleString() if carried else ""
    return marked.mapInArrow(run, f"doc_id long, held_out boolean, lang_pred string, score double{tail}")
