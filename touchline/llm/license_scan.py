"""Licence notices in documents, with DataFrame functions alone.

Texts are compared by shingles of five words; a word is a run of letters and
digits in lower case. Windows as long as a notice slide over a document and
overlap by seven eighths or more. For each of a number of hash functions (the
bands, of one row each) a window keeps the least hash of its shingles; a
window and a notice that share such a value are candidates. A notice of which
``contained`` is present lies in some window with a similarity that the window
length and step bound from below, so the number of bands follows from the
probability with which a candidate may be missed. Candidates are then checked
exactly: which share of the notice's shingles lies in the window and the steps
beside it.

In a notice of few words one changed word touches most shingles of five words.
Such notices are also searched word by word: around each place that names the
licence, in a window of the notice's length, ``contained`` of its words must lie.

Most documents hold no notice. Before any shingle is made, documents are kept
that contain one of a few words of a notice. The words are chosen so that
text without them cannot contain enough of it. Each length of windows is
made only for the documents that passed the gate of a notice of that length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce
from importlib.resources import files

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from touchline.sources.tables import staged

SIZE = 5

#: Short notices by which works declare their licence, as (SPDX id, text). Fixed values.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


#: What a text must say to declare the licence, whichever other word of its notice is changed: a phrase, and words near it.
NAMES = {
    "Apache-2.0": ("apache", ["2"]),
    "MIT": ("mit", []),
    "GPL-3.0": ("gnu general public", ["3"]),
    "CC-BY-NC-4.0": ("by nc 4", []),
    "CC-BY-4.0": ("creative commons attribution 4", []),
    "BSD-3-Clause": ("bsd", []),
    "MPL-2.0": ("mozilla public", ["2"]),
}

#: Terms and usual file headers, as (SPDX id, file).
TEXTS = [
    ("Apache-2.0", "apache-2.0-terms"),
    ("Apache-2.0", "apache-2.0-header"),
    ("MIT", "mit-terms"),
    ("GPL-3.0", "gpl-3.0-terms"),
    ("GPL-3.0", "gpl-3.0-preamble"),
    ("GPL-3.0", "gpl-3.0-header"),
    ("BSD-3-Clause", "bsd-3-clause-terms"),
    ("MPL-2.0", "mpl-2.0-terms"),
]

#: Shingles that tell a text of TEXTS from its relatives: BSD with two clauses, the Affero and Lesser GPL, older versions.
TELLING = {
    "gpl-3.0-terms": ["use with the gnu affero"],
    "gpl-3.0-header": ["the gnu general public license", "foundation either version 3 of"],
    "bsd-3-clause-terms": ["neither the name of the"],
}

#: Notices of fewer words are also searched word by word.
FEW_WORDS = 40

#: Gate words have this many characters where such words suffice.
LONG_WORD = 7


def license_texts() -> list[tuple[str, str, list[str]]]:
    """(SPDX id, text, telling shingles) of the terms and headers."""
    folder = files("touchline.llm") / "licenses"
    return [(i, (folder / f"{name}.txt").read_text(), TELLING.get(name, [])) for i, name in TEXTS]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _as_column(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``value`` as a column that is computed once per row, also when lambdas use it for each element."""
    return df.withColumn(name, F.explode(F.array(value)))


def _shingled(df: DataFrame, text: str) -> DataFrame:
    """Adds ``h``, the shingle hashes in order; a text with fewer words has one shingle of them all, one without words none."""
    hashed = _as_column(df, F.transform(_words(F.col(text)), lambda w: F.xxhash64(w)), "w")
    whole = F.when(F.size("w") > 0, F.array(F.xxhash64("w"))).otherwise(F.array().cast("array<bigint>"))
    each = F.transform(F.sequence(F.lit(1), F.size("w") - (SIZE - 1)), lambda i: F.xxhash64(F.slice("w", i, SIZE)))
    return _as_column(hashed, F.when(F.size("w") >= SIZE, each).otherwise(whole), "h")


def _length_class(shingles: int) -> int:
    """Window lengths grow by a quarter, so a notice has four fifths of its window's shingles or more."""
    length = 1
    while length < shingles:
        length = max(length + 1, math.floor(length * 1.25))
    return length


def _step(length: int) -> int:
    return max(1, length // 8)


def bands_needed(length: int, contained: float, miss: float) -> int:
    """Bands so that the best window over a contained notice misses all of its values with probability ``miss`` at most.

    The shortest notice of the class, of which just enough is present, may lie
    half a step beside the window.
    """
    shortest = min(n for n in range(1, length + 1) if _length_class(n) == length)
    common = max(1.0, contained * shortest - (_step(length) // 2))
    similarity = common / (length + shortest - common)
    return 1 if similarity >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - similarity)))


def gate_words(notices: list[list[str]], contained: float) -> list[str]:
    """Words such that ``contained`` of any notice's shingles cannot be present without one of them.

    From each notice, the word that is in most of the shingles left, until those
    left are too few to be enough: long words first, as they are rare elsewhere,
    and short ones only where these do not reach.
    """
    chosen: set[str] = set()
    for words in notices:
        shingles = [set(words[i : i + SIZE]) for i in range(max(1, len(words) - SIZE + 1))]
        enough = contained * len(shingles)
        free = [s for s in shingles if not chosen & s]
        for least in (LONG_WORD, 1):
            left = {w for s in free for w in s if len(w) >= least}
            while len(free) >= enough and left:
                word = max(left, key=lambda w: (sum(w in s for s in free), len(w), w))  # noqa: B023
                chosen.add(word)
                free = [s for s in free if word not in s]
                left = {w for s in free for w in s if len(w) >= least}
    # A word that holds another one adds nothing.
    return sorted(w for w in chosen if not any(o != w and o in w for o in chosen))


def _permutation(band: int) -> Callable[[Column], Column]:
    return lambda x: F.xxhash64(x, F.lit(band))


def _says(lower: Column, phrase: str) -> Column:
    """Whether the words of a phrase stand in a text in lower case, one after the other."""
    words = phrase.split()
    gap = r"[^\p{L}\p{N}]"
    return lower.contains(max(words, key=len)) & lower.rlike(f"(^|{gap})" + f"{gap}+".join(re.escape(w) for w in words) + f"({gap}|$)")


def _edited(rows: DataFrame, notice: int, words: list[str], name: tuple[str, list[str]], contained: float) -> DataFrame:
    """(row, notice, containment, s): windows around the licence's name that hold ``contained`` of a notice's words."""
    phrase, near = name[0].split(), name[1]
    own = F.array(*[F.xxhash64(F.lit(w)) for w in dict.fromkeys(words)])
    before = next((i for i in range(len(words)) if words[i : i + len(phrase)] == phrase), 0)
    slack = 1 + len(words) // 8
    asked = F.array(*[F.xxhash64(F.lit(w)) for w in phrase])
    held = rows.where(F.arrays_overlap("w", asked)).select("row", "w")
    at = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: F.slice("w", i, len(phrase)) == asked)
    first = F.greatest(F.lit(1), F.col("at") - (before + slack))
    placed = held.select("row", "w", F.explode(at).alias("at"))
    last = F.col("at") + (len(words) - before + slack)
    placed = placed.select("row", F.slice("w", first, last - first).alias("span"), F.greatest(F.lit(1), F.col("at") - before).alias("s"))
    for word in near:
        placed = placed.where(F.array_contains("span", F.xxhash64(F.lit(word))))
    share = F.size(F.array_intersect("span", own)) / F.size(own)
    return placed.select("row", F.lit(notice).alias("notice"), share.alias("containment"), "s").where(F.col("containment") >= contained)


def _least(values: str, starts: Column, length: int) -> Column:
    return F.transform(starts, lambda s: F.array_min(F.slice(values, s, length)))


def _enough(known: Row, contained: float) -> int:
    """Shingles that a document has at least if it contains enough of a notice."""
    return max(1, math.floor(contained * len(known["own"])))


def license_scan(
    docs: DataFrame,
    notices: list[tuple[str, str]] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    contained: float = 0.8,
    miss: float = 1e-4,
    texts: list[tuple[str, str, list[str]]] | None = None,
    names: dict[str, tuple[str, list[str]]] | None = None,
) -> DataFrame:
    """(doc_id, license_id, containment, first_shingle) for each document and notice that it contains.

    ``containment`` is the largest share of the notice's shingles in one
    window, ``contained`` or more; ``first_shingle`` counts from 0 and is the
    start of the first such window.

    ``notices`` is a list of (id, text), which is handed to all tasks; a
    notice without words matches nothing, and one of fewer than five words
    only a document of just these words. Null and empty texts contain nothing.
    Repeated documents give a row each; repeated notice ids give a row per
    notice text. An empty table gives an empty result.

    ``texts`` are further ones, as (id, text, shingles that must be there).
    ``names`` has, for ids of ``notices``, a phrase and words that must be
    there: notices of fewer than FEW_WORDS words are then also found around
    it by ``contained`` of their words, in any order, which is their
    containment if it is the larger one.
    """
    spark = docs.sparkSession
    listed_notices = list(NOTICES if notices is None else notices)
    named = [(i, name, body) for i, (name, body) in enumerate([*listed_notices, *(t[:2] for t in texts or [])])]
    telling = {len(listed_notices) + i: t[2] for i, t in enumerate(texts or []) if t[2]}
    given = spark.createDataFrame(named, "notice int, license_id string, body string").where("body IS NOT NULL")
    known = _shingled(given, "body").select("notice", "license_id", F.array_distinct("h").alias("own"), _words(F.col("body")).alias("words"))
    listed = [r for r in known.collect() if r["own"]]
    empty = docs.select(F.col(doc_id).cast("long").alias("doc_id")).limit(0)
    if not listed:
        nothing = [F.lit(None).cast(t).alias(n) for n, t in (("license_id", "string"), ("containment", "double"), ("first_shingle", "long"))]
        return empty.select("doc_id", *nothing)
    own = spark.createDataFrame(
        [(r["notice"], r["license_id"], r["own"], _length_class(len(r["own"]))) for r in listed],
        "notice int, license_id string, own array<bigint>, length int",
    )

    # The text in lower case is made once for all gates, and so is the list of the length classes that a document may hold a notice of.
    lower = _as_column(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), F.lower("text"), "lower")
    by_class: dict[int, Column] = {}
    for r in listed:
        length = _length_class(len(r["own"]))
        # Each word has a letter and is followed by another character.
        held = reduce(Column.__or__, [F.col("lower").contains(w) for w in gate_words([r["words"]], contained)])
        held &= F.length("text") >= 2 * _enough(r, contained) - 1
        by_class[length] = by_class[length] | held if length in by_class else held
    short = [r for r in listed if len(r["words"]) < FEW_WORDS]
    edits = [(r, names[r["license_id"]]) for r in short if r["notice"] < len(listed_notices) and r["license_id"] in (names or {})]
    phrases = list(dict.fromkeys(name[0] for _, name in edits))
    # Classes by their length, phrases by numbers below 0.
    gates = by_class | {-1 - i: _says(F.col("lower"), p) for i, p in enumerate(phrases)}
    passed = F.array_compact(F.array(*[F.when(held, F.lit(k)) for k, held in gates.items()]))
    kept = _as_column(lower, passed, "passed").where(F.size("passed") > 0).select("doc_id", "text", "passed")
    # The row's number is written with it, so it stays the same for all readers.
    columns = ["doc_id", "passed", "h", *(["w"] if edits else [])]
    rows = staged(_shingled(kept, "text").select(F.monotonically_increasing_id().alias("row"), *columns), "shingles")

    found = []
    for length in sorted({_length_class(len(r["own"])) for r in listed}):
        bands, step = bands_needed(length, contained, miss), _step(length)
        permuted = F.posexplode(F.array(*[F.transform("h", _permutation(b)) for b in range(bands)])).alias("band", "p")
        last = F.greatest(F.lit(1), F.size("p") - (length - 1))
        starts = F.array_union(F.sequence(F.lit(1), last, F.lit(step)), F.array(last))
        enough = min(_enough(r, contained) for r in listed if _length_class(len(r["own"])) == length)
        windows = rows.where(F.array_contains("passed", length) & (F.size("h") >= enough)).select("row", permuted)
        windows = windows.select("row", "band", F.explode(F.arrays_zip(starts.alias("s"), _least("p", starts, length).alias("least"))).alias("x"))
        marks = own.where(F.col("length") == length).select("notice", F.explode("own").alias("x"))
        marks = marks.select("notice", F.posexplode(F.array(*[_permutation(b)(F.col("x")) for b in range(bands)])).alias("band", "v"))
        marks = marks.groupBy("notice", "band").agg(F.min("v").alias("least"))
        # One row per notice and band.
        met = windows.select("row", "band", "x.s", "x.least").join(F.broadcast(marks), ["band", "least"])
        found.append(met.select("row", "notice", "s", F.lit(length).alias("length"), F.lit(step).alias("step")).distinct())
    candidates = reduce(DataFrame.unionByName, found)

    first = F.greatest(F.lit(1), F.col("s") - F.col("step"))
    span = F.slice("h", first, F.col("s") + F.col("length") + F.col("step") - first)
    checked = candidates.join(rows, "row").join(F.broadcast(own.drop("length")), "notice")
    checked = checked.withColumn("containment", F.size(F.array_intersect(span, F.col("own"))) / F.size("own"))
    hits = checked.where(F.col("containment") >= contained)
    for notice, shingles in telling.items():
        for shingle in shingles:
            there = F.array_contains(span, F.xxhash64(F.array(*[F.xxhash64(F.lit(w)) for w in shingle.split()])))
            hits = hits.where((F.col("notice") != notice) | there)
    if edits:
        columns = ["row", "notice", "containment", "s", "doc_id", "license_id"]
        said = {p: rows.where(F.array_contains("passed", -1 - i)) for i, p in enumerate(phrases)}
        around = reduce(DataFrame.unionByName, [_edited(said[name[0]], r["notice"], r["words"], name, contained) for r, name in edits])
        around = around.join(rows.select("row", "doc_id"), "row").join(F.broadcast(own.select("notice", "license_id")), "notice")
        hits = hits.select(*columns).unionByName(around.select(*columns))
    return (
        hits.groupBy("row", "notice")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("license_id").alias("license_id"),
            F.max("containment").alias("containment"),
            (F.min("s") - 1).cast("long").alias("first_shingle"),
        )
        .drop("row", "notice")
    )
