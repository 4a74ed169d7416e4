"""Stream sessions that end on an event as well as on silence.

Spark's session windows know silence only. Here users are dealt to groups by
hash, and a group has a state of its own: the cells of time that have events
and are not complete yet, and the open sessions. Event-time timers go off when
the watermark passes a cell's end, or the time at which silence ends a session,
so events may come in any order and late ones count like others until the
watermark has passed them.

A call to the state store costs as much as hundreds of rows do, so state is kept
for groups of users, packed, and their sessions are found at once.

Events are counted per (user, cell) where they are read, so a very busy user
moves as one row per cell and batch of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from touchline.functions.times import MICROS

# What runs in Python tasks is sent to them, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keyed state with timers needs this state store.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

#: Cells are this wide; a closing event ends its session with the cell that it lies in.
CELL_US = MICROS

#: Groups that users are dealt to: what is held in memory at a time, and sent to the state store at once, is one of them.
GROUPS = 1024

#: Rows in one entry of the state.
PACKED = 65_536

_NUMBERS = ("first", "last", "events", "closes")
_HOW = {"first": "min", "last": "max", "events": "sum", "closes": "max"}


def _merged(cells: pa.Table) -> pa.Table:
    """One row per user and cell (user, cell, first, last, events, closes), in their order."""
    one = cells.group_by(["user", "cell"], use_threads=False).aggregate(list(_HOW.items()))
    one = one.rename_columns([c.removesuffix(f"_{_HOW[c.rsplit('_', 1)[0]]}") if "_" in c else c for c in one.column_names])
    return one.select(["user", "cell", *_NUMBERS]).sort_by([("user", "ascending"), ("cell", "ascending")])


def _pack(table: pa.Table) -> list[tuple[bytes]]:
    """A table as entries of a list state, of at most PACKED rows each."""
    entries = []
    for at in range(0, table.num_rows, PACKED):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table.slice(at, PACKED))
        entries.append((sink.getvalue().to_pybytes(),))
    return entries


class ClosingSessions(StatefulProcessor):
    """Cells of a group of users in, closed sessions out: user, start, end, number of events, and whether an event closed it."""

    def __init__(self, gap_us: int, cell_us: int):
        self.gap_us, self.cell_us = gap_us, cell_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        packed = T.StructType([T.StructField("packed", T.BinaryType())])
        self.cells = handle.getListState("cells", packed)
        self.open = handle.getListState("open", packed)
        self.timer = handle.getValueState("timer", T.StructType([T.StructField("due_ms", T.LongType())]))
        self.cell_schema = pa.schema([("user", pa.string()), *[(n, pa.int64()) for n in ("cell", *_NUMBERS)]])
        self.open_schema = pa.schema([("user", pa.string()), *[(n, pa.int64()) for n in ("first", "last", "events")]])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = timerValues.getCurrentWatermarkInMs() * 1000
        came, parts, waiting = self.cell_schema.empty_table(), [], 0
        for chunk in rows:
            parts.append(pa.Table.from_pandas(chunk[self.cell_schema.names], self.cell_schema, preserve_index=False))
            waiting += len(chunk)
            if waiting >= max(PACKED, came.num_rows):
                came, parts, waiting = _merged(pa.concat_tables([came, *parts])), [], 0
        came = _merged(pa.concat_tables([came, *parts]))
        ends = (int(np.min(came.column("cell").to_numpy())) + 1) * self.cell_us
        held = self.timer.get()
        due = int(held[0]) if held is not None else None
        if ends <= now:
            yield from self._advance(now, due, None, [came])
            return
        self.cells.appendList(_pack(came))
        ends_ms = -(-ends // 1000)
        self._wake(due, ends_ms if due is None else min(due, ends_ms), None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = self.timer.get()
        due = int(held[0]) if held is not None else None
        yield from self._advance(timerValues.getCurrentWatermarkInMs() * 1000, due, expiredTimerInfo.getExpiryTimeInMs(), [])

    def _advance(self, now: int, due: int | None, expired: int | None, came: list[pa.Table]) -> Iterator[pd.DataFrame]:
        """Take the cells that are complete, in order, and set the next timer."""
        cells = _merged(pa.concat_tables([*self._read(self.cells, self.cell_schema), *came])).to_pandas()
        complete = (cells["cell"] + 1) * self.cell_us <= now
        waiting, cells = cells[~complete], cells[complete]
        # An open session comes before the cells of its user.
        held = pa.concat_tables(self._read(self.open, self.open_schema)).to_pandas().assign(closes=0)
        rows = pd.concat([held, cells[held.columns]], ignore_index=True)
        rows = rows.iloc[np.argsort(rows["user"].to_numpy(), kind="stable")]
        sessions = self._sessions(rows)

        following = waiting.groupby("user")["first"].min().reindex(sessions["user"]).to_numpy()
        # An event of a cell that is not complete may still belong to the session.
        goes_on = following - sessions["last"].to_numpy() < self.gap_us  # without such a cell: NaN, and false
        final = sessions["user"].to_numpy() != sessions["user"].shift(-1).to_numpy()
        silent = (sessions["last"].to_numpy() + self.gap_us <= now) & ~goes_on
        over = ~final | (sessions["closes"].to_numpy() > 0) | silent
        closed = sessions[over]
        if len(closed):
            yield pd.DataFrame(
                {"user": closed["user"], "start_us": closed["first"], "end_us": closed["last"], "events": closed["events"], "closed_by_event": closed["closes"] > 0}
            )
        opened = sessions[~over]
        self._keep(self.cells, waiting, self.cell_schema)
        self._keep(self.open, opened, self.open_schema)
        ends = [(int(waiting["cell"].min()) + 1) * self.cell_us] if len(waiting) else []
        silences = opened["last"].to_numpy()[~goes_on[~over]] + self.gap_us
        ends += [int(silences.min())] if len(silences) else []
        self._wake(due, -(-min(ends) // 1000) if ends else None, expired)

    def _sessions(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Rows in the order of user and time to sessions (user, first, last, events, closes)."""
        user, first = rows["user"].to_numpy(), rows["first"].to_numpy()
        begins = np.ones(len(rows), dtype=bool)
        begins[1:] = (user[1:] != user[:-1]) | (rows["closes"].to_numpy()[:-1] > 0)
        latest = rows["last"].groupby(np.cumsum(begins)).cummax().to_numpy()
        begins[1:] |= first[1:] - latest[:-1] >= self.gap_us
        return rows.groupby(np.cumsum(begins)).agg(user=("user", "first"), first=("first", "first"), last=("last", "max"), events=("events", "sum"), closes=("closes", "max"))

    def _read(self, state, schema: pa.Schema) -> list[pa.Table]:
        return [schema.empty_table(), *[pa.ipc.open_stream(bytes(packed)).read_all() for (packed,) in state.get()]]

    def _keep(self, state, rows: pd.DataFrame, schema: pa.Schema) -> None:
        if len(rows):
            state.put(_pack(pa.Table.from_pandas(rows[schema.names], schema, preserve_index=False)))
        else:
            state.clear()

    def _wake(self, old: int | None, new: int | None, expired: int | None) -> None:
        """Have one timer, at the time that is due."""
        if old is not None and old != new and old != expired:  # a timer that went off is removed for us
            self.handle.deleteTimer(old)
        if new is None:
            self.timer.clear()
        elif old != new:
            self.handle.registerTimer(new)
            self.timer.update((new,))

    def close(self) -> None:
        pass


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, user, cell, event_time, us, closes) to one row per user, cell and batch of rows."""
    for rows in batches:
        counted = pa.Table.from_batches([rows]).group_by(["group", "user", "cell"], use_threads=False)
        counted = counted.aggregate([("event_time", "max"), ("us", "min"), ("us", "max"), ("us", "count"), ("closes", "max")])
        names = {"event_time_max": "event_time", "us_min": "first", "us_max": "last", "us_count": "events", "closes_max": "closes"}
        counted = counted.rename_columns([names.get(c, c) for c in counted.column_names])
        yield from counted.select(["group", "user", "cell", "event_time", *_NUMBERS]).combine_chunks().to_batches()


def stream_closing_sessions(
    stream: DataFrame, user: str, gap_s: int, closing: str, event_time: str = "event_time", delay: str = "1 hour", cell_us: int = CELL_US, groups: int = GROUPS
) -> DataFrame:
    """(user, start_us, end_us, events, closed_by_event): sessions as they end.

    A session ends with the cell of an event for which the SQL condition ``closing`` holds, and
    when the user was idle for the gap or longer. Events later than the watermark
    are dropped; rows without a user are left out. The session needs STATE_STORE,
    and ``cell_us`` must not be wider than the gap. ``groups`` must stay the same when
    a stream goes on from its checkpoint.
    """
    if cell_us > gap_s * MICROS:
        raise ValueError("a cell must not be wider than the gap")
    us = F.unix_micros(event_time)
    marked = stream.where(F.col(user).isNotNull()).select(
        F.pmod(F.xxhash64(F.col(user).cast("string")), F.lit(groups)).alias("group"),
        F.col(user).cast("string").alias("user"),
        F.floor((us - F.pmod(us, F.lit(cell_us))) / F.lit(cell_us)).cast("long").alias("cell"),
        F.col(event_time).alias("event_time"),
        us.alias("us"),
        F.coalesce(F.expr(closing), F.lit(False)).cast("long").alias("closes"),
    )
    schema = "group long, user string, cell long, event_time timestamp, first long, last long, events long, closes long"
    counted = marked.mapInArrow(_cells, schema).withWatermark("event_time", delay)
    out = T.StructType(
        [T.StructField("user", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("start_us", "end_us", "events")], T.StructField("closed_by_event", T.BooleanType())]
    )
    return counted.groupBy("group").transformWithStateInPandas(ClosingSessions(gap_s * MICROS, cell_us), out, "append", "eventTime")
