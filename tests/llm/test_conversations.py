"""Repair of conversations against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import conversation_repair as R
from touchline.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
SEP = " \t\n\x0b\x0c\r"


def faults(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(SEP)
        fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def search(marked):
    """(cost, audit, lines) of the best edits: a queue over (cost, audit) that looks at every edit in every place."""
    queue = [(0, "", 0, "", ())]
    best = {}
    while queue:
        cost, audit, i, initials, lines = heapq.heappop(queue)
        state = initials[-2:] if not initials.startswith("s") or len(initials) > 2 else initials
        key = (i, state, audit)
        if key in best:
            continue
        best[key] = cost
        if i == len(marked) and re.fullmatch("(s?(ua)+)?", initials):
            least = [(cost, audit, lines)]
            while queue and queue[0][0] == cost:
                c, a, j, ini, ls = heapq.heappop(queue)
                if j == len(marked) and re.fullmatch("(s?(ua)+)?", ini):
                    least.append((c, a, ls))
                else:
                    for x in steps(marked, c, a, j, ini, ls):
                        heapq.heappush(queue, x)
            return min(least)
        for x in steps(marked, cost, audit, i, initials, lines):
            heapq.heappush(queue, x)
    raise AssertionError


def steps(marked, cost, audit, i, initials, lines):
    fits = lambda x: re.fullmatch("s?(ua)*u?", x)
    if not audit.endswith("III"):
        for role in ("user", "assistant"):
            if fits(initials + role[0]):
                yield cost + 5, audit + "I", i, initials + role[0], (*lines, role + ":")
    if i == len(marked):
        return
    role, text, fault = marked[i]
    yield cost + 2, audit + "D", i + 1, initials, lines
    if fault in ("b", "d"):
        return
    more = 5 if fault == "t" else 0
    if role and fits(initials + role[0]):
        yield cost + more, audit + "K", i + 1, initials + role[0], (*lines, f"{role}:{text}")
    for to in ("user", "assistant"):
        if fits(initials + to[0]):
            yield cost + 1 + more, audit + "R", i + 1, initials + to[0], (*lines, f"{to}:{text}")


def codes(marked):
    kinds = {"": 0, "b": 1, "d": 2, "t": 3}
    return [(R.symbol(r[:1], kinds[f]), 1) for r, _, f in marked]


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_edits(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["system", "user", "assistant", "tool", "", " "]), rng.choice(["", " ", "a.", "b!", "c", "d? \n", f"{i}."])) for i in range(rng.randrange(7))]
    marked = faults(rows)
    cost, audit, _ = search(marked)
    assert R.cheapest(codes(marked)) == (cost, audit) == R.cheapest(R.joined(codes(marked)))


def test_runs_by_powers():
    for code in range(16):
        after = R._END
        for n in range(1, 70):
            step = R.advance(code, 1, R.advance(code, n - 1, R._END))
            assert R.advance(code, n, R._END) == step
            after = R.advance(code, 1, after)
            assert after == step
    cost, audit = R.cheapest([(R.symbol("u", 0), 1_000_001)])
    assert len(audit.replace("I", "")) == 1_000_001 and cost == 500_000 + 2


def plain(rows):
    """The contract's columns of one conversation, by the search above where it is short and by single steps else."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], hashlib.md5(r[2].encode()).digest()))
    marked = faults([r[1:] for r in rows])
    turns = {r[0] for r in rows if r[0] is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = search(marked) if len(marked) < 10 else (*R.cheapest(codes(marked)), None)
    count = [sum(f == k for *_, f in marked) for k in "bdt"]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *count, illegal, cost, audit), None if lines is None else hashlib.sha256("\n".join(lines).encode()).hexdigest()


def random_rows(rng, conv, n):
    text = lambda: rng.choice(["", " \t", "Yes.", "No!", "what", "é?\n", "x" * 40 + rng.choice("ab."), "w " * 3000 + "."])
    return [(conv, rng.choice([None, *range(n)]), rng.choice(["system", "user", "assistant", "tool", "", " "]), text()) for _ in range(n)]


def result(df):
    return {r.conv_id: (tuple(r.summary)[:6] + (r.summary.audit,), r.repaired_sha256) for r in df.collect()}


def test_operator(spark):
    rng = random.Random(4)
    rows = [x for c in [None, *range(30)] for x in random_rows(rng, c, rng.randrange(1, 8))]
    # One conversation holds most rows, many of them equal, and reaches over many partitions.
    hot = [(99, i, "user" if i % 3 else "assistant", f"turn {i}.") for i in range(3000)] + [(99, 7, "user", "again.")] * 3000
    df = spark.createDataFrame(rows + hot, SCHEMA).withColumns({"kind": F.lit(1), "summary": F.lit("x"), "place": F.lit(0)})
    edits = R.repair_conversations(df)
    got = result(R.repaired_digests(edits))
    assert set(got) == {None, *range(30), 99}
    for conv in got:
        own = [r[1:] for r in rows + hot if r[0] == conv]
        want, digest = plain(own)
        assert got[conv][0] == want and digest in (None, got[conv][1])
    listed = edits.where("conv_id = 99 AND place > 0").orderBy("place").collect()
    assert "".join(r.edit for r in listed) == got[99][0][6] and [r.place for r in listed] == list(range(1, len(listed) + 1))
    kept = [f"{r.role}:{r.text}" for r in listed if r.edit != "D"]
    assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == got[99][1]
    assert re.fullmatch("(s?(ua)+)?", "".join(k[0] for k in kept))


def test_empty_table(spark):
    edits = R.repair_conversations(spark.createDataFrame([], SCHEMA))
    assert edits.collect() == [] and R.repaired_digests(edits).collect() == []


def test_query_damages(spark, tmp_path):
    rng = random.Random(6)
    rows = [x for c in [None, *range(60)] for x in random_rows(rng, c, rng.randrange(1, 6))] + [(c, 0, "user", None) for c in range(200, 260)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    lost = 0
    for conv, found in got.items():
        after = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            after += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
        lost += not after
        want, digest = plain(after)
        assert (found.gaps, found.blank, found.duplicate, found.truncated, found.illegal, found.cost, found.audit) == want
        assert digest in (None, found.repaired_sha256)
    assert lost
