"""Small corpora with planted repeats, and plain versions of the definitions."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    w = words(lower(text))
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


def prose(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def planted(seed: int = 1, docs: int = 60) -> list[tuple[int, str | None]]:
    """Documents with exact copies, near copies, shared passages, nulls, empty and very long texts."""
    rng = random.Random(seed)
    passage, line = prose(rng, 70), prose(rng, 12)
    out: list[tuple[int, str | None]] = []
    base = prose(rng, 160)
    for i in range(docs):
        kind = i % 6
        if kind == 0:
            w = prose(rng, 120)
        elif kind == 1:  # a passage at a random place
            w = prose(rng, 40)
            at = rng.randrange(len(w))
            w = w[:at] + passage + w[at:]
        elif kind == 2:  # near copies with a few edits
            w = list(base)
            for _ in range(rng.randrange(6)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
        elif kind == 3:  # exact copies
            w = list(base)
        elif kind == 4:  # a common line
            w = prose(rng, 30) + line + prose(rng, 30)
        else:  # part of the passage, one word short of a window or more
            cut = 49 + i % 3
            w = prose(rng, 20) + passage[:cut] + prose(rng, 20)
        out.append((i * 3, rng.choice([" ", "\n", " \t"]).join(w)))
    out += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one"), (1004, "one two three"), (1005, "é" * 80)]
    out.append((1006, " ".join(prose(rng, 9000) + passage + prose(rng, 3000) + base)))
    out.append((1007, "aaaa " * 400))
    out.append((1008, "aaaa " * 300 + "b"))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], SCHEMA)
