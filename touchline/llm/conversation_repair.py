"""Cheapest repair of the turn structure of conversations.

The role initials of a repaired conversation are ``(s?(ua)+)?``. Four states
stand for what was written so far: nothing, a system turn, a user turn, an
assistant turn. A row is a symbol (class of its role's initial, fault), and
equal consecutive symbols are one run. A symbol's least costs from state to
state are a 4 x 4 matrix over (min, +); a run of n rows applies its n-th power
to the costs of what follows, through binary powers that are kept by symbol.
The choices are then unrolled forwards: in each state the ASCII-least edit that
the least cost allows.

Rows are sorted by range and collapsed to runs where they lie, so the order of
a conversation that holds most rows is made by many tasks. Its runs, and its
texts one after the other, then pass through one task as a stream, because the
audit is one value and a digest of a text has to read it in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shipping import ship
from touchline.sources.tables import staged

SEPARATORS = " \t\n\v\f\r"

KEEP, REROLE, DELETE, INSERT, TRUNCATED_STAYS = 0, 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
_CLASS = {"s": 0, "u": 1, "a": 2}
_OTHER = 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

#: The state after the one turn that may be added to a state, and the role of that turn.
_NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state after a row is kept, by state and class of its initial; -1 where the grammar forbids it.
_KEPT = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
#: Least cost of ending in a state: inserted turns complete a pair.
_END = (0, 2 * INSERT, INSERT, 0)
_NEVER = 1 << 60

Costs = tuple[int, int, int, int]
Matrix = tuple[Costs, Costs, Costs, Costs]


def symbol(initial: str, fault: int) -> int:
    return 4 * _CLASS.get(initial, _OTHER) + fault


@lru_cache(maxsize=None)
def _options(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(edit, cost, next state) for a row in a state, by ASCII order of the edits; inserting leaves the row in place."""
    kind, fault = divmod(code, 4)
    found = [("D", DELETE, state), ("I", INSERT, _NEXT[state])]
    if fault in (SOUND, TRUNCATED):
        more = TRUNCATED_STAYS if fault == TRUNCATED else 0
        if _KEPT[state][kind] >= 0:
            found.append(("K", KEEP + more, _KEPT[state][kind]))
        found.append(("R", REROLE + more, _NEXT[state]))
    return tuple(found)


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in range(4)), _NEVER) for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def _power(code: int, bit: int) -> Matrix:
    """Least costs from state to state over ``2 ** bit`` rows of one symbol, turns inserted before each row included."""
    if bit:
        half = _power(code, bit - 1)
        return _times(half, half)
    rows = [[_NEVER] * 4 for _ in range(4)]
    for state in range(4):
        for edit, cost, after in _options(code, state):
            if edit != "I":
                rows[state][after] = min(rows[state][after], cost)
    for _ in range(3):  # more than three turns inserted in a row lead nowhere new
        for state in range(4):
            rows[state] = [min(x, INSERT + y) for x, y in zip(rows[state], rows[_NEXT[state]])]
    return tuple(tuple(r) for r in rows)


@lru_cache(maxsize=200_000)
def _apply(code: int, bit: int, after: Costs) -> Costs:
    matrix = _power(code, bit)
    return tuple(min(c + x for c, x in zip(row, after)) for row in matrix)


def advance(code: int, count: int, after: Costs) -> Costs:
    """Costs to go before ``count`` rows of one symbol, from those after them."""
    least = min(after)
    costs: Costs = tuple(c - least for c in after)  # few different ones, so the cache holds them
    bit = 0
    while count:
        if count & 1:
            costs = _apply(code, bit, costs)
            low = min(costs)
            least, costs = least + low, tuple(c - low for c in costs)
        count >>= 1
        bit += 1
    return tuple(c + least for c in costs)


def _unroll(code: int, count: int, after: Costs, state: int, out: list[str]) -> int:
    """Append the edits of ``count`` rows of one symbol and give the state after them; halves keep the memory small."""
    pending = [(count, after)]
    while pending:
        count, after = pending.pop()
        if count > 1:
            first = count // 2
            pending += [(count - first, after), (first, advance(code, count - first, after))]
            continue
        before = advance(code, 1, after)
        while True:
            for edit, cost, to in _options(code, state):
                if cost + (before if edit == "I" else after)[to] == before[state]:
                    break
            out.append(edit)
            state = to
            if edit != "I":
                break
    return state


def cheapest(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of (symbol, count) runs, ASCII-least among them."""
    costs = [tuple(_END)]
    for code, count in reversed(runs):
        costs.append(advance(code, count, costs[-1]))
    costs.reverse()
    out: list[str] = []
    state = START
    for (code, count), after in zip(runs, costs[1:]):
        state = _unroll(code, count, after, state, out)
    out.append("I" * (_END[state] // INSERT))
    return costs[0][START], "".join(out)


def facts(runs: list[tuple[int, int]]) -> dict[str, int]:
    """Rows by fault, and neighbours whose initials are not su, ua or au."""
    found = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    names = {BLANK: "blank", DUPLICATE: "duplicate", TRUNCATED: "truncated"}
    before = None
    for code, count in runs:
        kind, fault = divmod(code, 4)
        if fault:
            found[names[fault]] += count
        found["illegal"] += count - 1
        if before is not None:
            found["illegal"] += (before, kind) not in ((0, 1), (1, 2), (2, 1))
        before = kind
    return found


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring runs of one symbol as one run."""
    out: list[tuple[int, int]] = []
    for code, count in runs:
        if out and out[-1][0] == code:
            out[-1] = (code, out[-1][1] + count)
        else:
            out.append((code, count))
    return out


_SUMMARY = "struct<gaps: bigint, blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, cost: bigint, audit: string>"
_SUMMARY_ARROW = pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition to one row per conversation in it: its runs, and its turns."""
    part = TaskContext.get().partitionId()
    names = ("conv", "runs", "low", "high", "turns")
    done: dict[str, list] = {n: [] for n in names}
    held: list | None = None  # conv, runs, low, high, turns
    conv_type = pa.int64()

    def flush() -> pa.RecordBatch:
        columns = [
            pa.array(done["conv"], conv_type),
            pa.array([part] * len(done["conv"]), pa.int32()),
            pa.array([[16 * n + c for c, n in r] for r in done["runs"]], pa.list_(pa.int64())),
            *[pa.array(done[n], pa.int64()) for n in ("low", "high", "turns")],
        ]
        for values in done.values():
            values.clear()
        return pa.RecordBatch.from_arrays(columns, ["conv", "part", "runs", "low", "high", "turns"])

    def close() -> None:
        if held is not None:
            for name, value in zip(names, held):
                done[name].append(value)

    for batch in batches:
        conv_type = batch.column("conv").type
        columns = [batch.column(n).to_pylist() for n in ("conv", "turn", "initial", "last", "copies", "is_first")]
        for conv, turn, initial, last, copies, first in zip(*columns):
            if held is None or held[0] != conv:
                close()
                held = [conv, [], None, None, 0]
            if turn is not None and turn != held[3]:
                held[2] = turn if held[2] is None else held[2]
                held[3] = turn
                held[4] += 1
            if not last:
                new = [(symbol(initial, BLANK), copies)]
            else:
                sound = symbol(initial, SOUND if last in ".!?" else TRUNCATED)
                new = [(sound, 1)] * first + [(symbol(initial, DUPLICATE), copies - first)] * (copies > first)
            runs = held[1]
            for code, count in new:
                if runs and runs[-1][0] == code:
                    runs[-1] = (code, runs[-1][1] + count)
                else:
                    runs.append((code, count))
            if len(done["conv"]) >= 4096:
                yield flush()
    close()
    if done["conv"]:
        yield flush()


class _Edits:
    """Edits of one conversation after the other, given out in batches of bounded size."""

    def __init__(self, conv_type: pa.DataType):
        self.conv_type = conv_type
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, *row) -> None:
        self.rows.append(row)
        self.size += 64 + len(row[4] or "")

    def full(self) -> bool:
        return self.size >= 4_000_000 or len(self.rows) >= 8192

    def batch(self) -> pa.RecordBatch:
        conv, place, edit, role, text, summary = (list(c) for c in zip(*self.rows))
        self.rows, self.size = [], 0
        columns = [pa.array(conv, self.conv_type), pa.array(place, pa.int64()), pa.array(edit, pa.string()), pa.array(role, pa.string())]
        columns += [pa.array(text, pa.string()), pa.array(summary, _SUMMARY_ARROW)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "edit", "role", "text", "summary"])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its fragments, then its rows in order: to its summary, then its edits."""
    out: _Edits | None = None
    conv, known, fragments = None, False, []
    audit, at, place, state = None, 0, 0, START

    def summarise() -> None:
        nonlocal audit, at, place, state
        runs = joined([divmod(x, 16)[::-1] for f in fragments for x in f[0]])
        cost, audit = cheapest(runs)
        spans = [f[1:] for f in fragments if f[1] is not None]
        turns = sum(n for _, _, n in spans) - sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        gaps = spans[-1][1] - spans[0][0] + 1 - turns if spans else 0
        out.add(conv, 0, None, None, None, {"gaps": gaps, **facts(runs), "cost": cost, "audit": audit})
        at, place, state = 0, 0, START

    def inserted() -> None:
        nonlocal at, place, state
        while at < len(audit) and audit[at] == "I":
            at, place, state = at + 1, place + 1, _NEXT[state]
            out.add(conv, place, "I", ROLE[state], "", None)

    for batch in batches:
        out = out or _Edits(batch.column("conv").type)
        columns = [batch.column(n).to_pylist() for n in ("conv", "kind", "runs", "low", "high", "turns", "role", "text")]
        for now, kind, runs, low, high, turns, role, text in zip(*columns):
            if kind == 0:
                if audit is not None:
                    inserted()
                if not known or now != conv:
                    conv, known, fragments = now, True, []
                audit = None
                fragments.append((runs, low, high, turns))
                continue
            if audit is None:
                summarise()
            inserted()
            edit = audit[at]
            at, place = at + 1, place + 1
            if edit == "K":
                state = _KEPT[state][_CLASS[role[0]]]
            elif edit == "R":
                state = _NEXT[state]
                role = ROLE[state]
            out.add(conv, place, edit, role, text, None)
            if out.full():
                yield out.batch()
    if out is not None:
        if audit is not None:
            inserted()
        if out.rows:
            yield out.batch()


def repair_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, edit, role, text, summary): each conversation's edits in order, after one row with its summary.

    The row with place 0 holds the summary: gaps, faults by kind, neighbours
    that may not follow each other, cost, and the audit, one letter per edit.
    From place 1 on there is one row per edit: K and R with the role and text that
    stay, D with those that go, I with a role and an empty text. The rows of a
    conversation lie in one partition and follow each other.

    Rows stand in the order of their turn, nulls first; equal turns in that of
    role, of the text's first 32 characters, and of its MD5 digest. A null role
    or text is one space. Rows of a null ``conv_id`` are one conversation. A
    role without a first letter s, u or a, the empty role too, cannot be kept. Equal
    rows are rows of their own, all but the first of them duplicates. Gaps
    count distinct turns and are 0 if all turns are null. An empty table gives
    an empty table; other columns are ignored.
    """
    ship(rows.sparkSession)
    given = rows.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    ).withColumns({"head": F.substring("text", 1, 32), "digest": F.unhex(F.md5(F.col("text").cast("binary")))})
    # What the order and the faults need, without the texts; equal rows once, with their number.
    last = F.right(F.rtrim(F.col("text"), F.lit(SEPARATORS)), F.lit(1))
    narrow = given.select("conv", "turn", "role", "head", "digest", last.alias("last"))
    narrow = staged(narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("copies")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = narrow.groupBy(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest")).agg(F.min(place).alias("_first"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    order = ["conv", "turn", "role", "head", "digest"]
    marked = narrow.join(first, same).select(*order, "last", "copies", (place == F.col("_first")).alias("is_first"))
    in_order = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    conv_type = given.schema["conv"].dataType.simpleString()
    fragments = in_order.select("conv", "turn", F.left("role", F.lit(1)).alias("initial"), "last", "copies", "is_first").mapInArrow(
        _fragments, f"conv {conv_type}, part int, runs array<long>, low long, high long, turns long"
    )
    mixed = fragments.withColumn("kind", F.lit(0)).unionByName(given.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    streams = mixed.repartition("conv").sortWithinPartitions("conv", "kind", "part", *order[1:])
    return streams.select("conv", "kind", "runs", "low", "high", "turns", "role", "text").mapInArrow(
        _edited, f"conv_id {conv_type}, place long, edit string, role string, text string, summary {_SUMMARY}"
    )


def repaired_digests(edits: DataFrame) -> DataFrame:
    """(conv_id, summary, repaired_sha256): SHA-256 of the kept, changed and inserted turns as ``role:text`` lines.

    ``edits`` is what ``repair_conversations`` gives, as it lies: the texts are
    hashed while they stream by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # conv, summary, hash, whether a line was written
        done: list[tuple] = []
        conv_type = pa.int64()

        def flush() -> pa.RecordBatch:
            conv, summary, digest = (list(c) for c in zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(conv, conv_type), pa.array(summary, _SUMMARY_ARROW), pa.array(digest, pa.string())],
                ["conv_id", "summary", "repaired_sha256"],
            )

        for batch in batches:
            conv_type = batch.column("conv_id").type
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "place", "edit", "role", "text", "summary")]
            for conv, place, edit, role, text, summary in zip(*columns):
                if place == 0:
                    if held:
                        done.append((held[0], held[1], held[2].hexdigest()))
                    held = [conv, summary, hashlib.sha256(), False]
                elif edit != "D":
                    held[2].update((("\n" if held[3] else "") + role + ":" + text).encode())
                    held[3] = True
                if len(done) >= 4096:
                    yield flush()
        if held:
            done.append((held[0], held[1], held[2].hexdigest()))
        if done:
            yield flush()

    conv_type = edits.schema["conv_id"].dataType.simpleString()
    return edits.mapInArrow(run, f"conv_id {conv_type}, summary {_SUMMARY}, repaired_sha256 string")
