import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline.operators import sessions as S
from touchline.operators import sketches as K
from touchline.session import releasing, remove, shared_folder, work_path
from touchline.streaming import closing as C
from touchline.streaming import events as E
from touchline.streaming import metrics as R
from touchline.streaming.upsert import Upsert

SCHEMA = "event_id int, user string, ts timestamp_ntz"
START = datetime(2024, 1, 1)


def write(spark, folder, *entries):
    made = [(i, u, START + timedelta(seconds=s)) for i, u, s in entries]
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream_of(spark, folder, files=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    return E.with_event_time(E.read_stream(spark, folder, schema, files_per_batch=files), "ts")


def test_restart_reads_only_what_is_new_and_drops_copies(spark):
    source, target, state = (work_path(spark, n) for n in ("in", "out", "state"))
    write(spark, source, (1, "a", 0), (1, "a", 0), (2, "a", 5))
    for salts in (3,):
        E.write_stream(E.deduplicated(stream_of(spark, source), "event_id", salts=salts).select("event_id"), target, state)
        assert rows(spark.read.parquet(target), "event_id") == [(1,), (2,)]
        write(spark, source, (2, "a", 5), (3, "b", 9))
        E.write_stream(E.deduplicated(stream_of(spark, source), "event_id", salts=salts).select("event_id"), target, state)
    assert rows(spark.read.parquet(target), "event_id") == [(1,), (2,), (3,)]


def test_running_stream_picks_up_new_files(spark):
    source, target = work_path(spark, "in"), work_path(spark, "out")
    write(spark, source, (1, "a", 0))
    query = E.start_stream(stream_of(spark, source).select("event_id"), target, work_path(spark, "state"), "1 second")
    query.processAllAvailable()
    write(spark, source, (2, "a", 1))
    query.processAllAvailable()
    query.stop()
    assert rows(spark.read.parquet(target), "event_id") == [(1,), (2,)]


def test_stream_sessions_equal_batch_once_closed(spark):
    source = work_path(spark, "in")
    entries = [(i, u, s) for i, (u, s) in enumerate([("a", 0), ("a", 1000), ("a", 2800), ("b", 100), ("b", 5000), ("end", 90_000)])]
    write(spark, source, *entries)
    got = E.run_to_table(R.stream_sessions(stream_of(spark, source), "user", 1800), "sessions")
    streamed = rows(got.select("user", F.unix_micros("start_tstamp"), F.unix_micros("end_tstamp"), "events"), "user", "start_tstamp")
    batch = S.session_bounds(spark.read.parquet(source), "user", "ts", 1800).where("user <> 'end'")
    assert streamed == rows(batch.select("user", "start_us", "end_us", "events"), "user", "start_us")


def test_daily_users_are_exact(spark):
    source = work_path(spark, "in")
    write(spark, source, (1, "a", 0), (2, "a", 50), (3, "b", 60), (4, "a", 90_000), (5, "z", 400_000))
    got = E.run_to_table(R.stream_daily_activity(stream_of(spark, source), "user"), "daily")
    assert [r[1:] for r in rows(got, "day")] == [(2, 3), (1, 1)]


def sessions_of(df):
    return S.session_bounds(df, "user", "ts", 1800).drop("domain_sessionidx")


def test_upsert_over_many_batches_equals_one_run(spark):
    source = work_path(spark, "in")
    day = 86_400
    write(spark, source, (1, "a", 0), (2, "b", 10), (3, "a", 4000))
    write(spark, source, (4, "a", 1500), (7, "b", day - 5))
    write(spark, source, (5, "a", 2900), (6, "c", 1), (8, "b", day + 5))
    write(spark, source, (9, "b", day + 1700), (10, "a", 3 * day))
    write(spark, source, (11, "c", 1000), (12, "b", day + 4000))
    upsert = Upsert(spark, work_path(spark, "upsert"), "user", "ts", sessions_of, gap_s=1800)
    schema = spark.createDataFrame([], SCHEMA).schema
    upsert.run(E.read_stream(spark, source, schema, files_per_batch=1), work_path(spark, "state"))
    full = sessions_of(spark.read.parquet(source))
    got = upsert.current(schema)
    assert rows(got, "user", "start_us") == rows(full, "user", "start_us")


def test_replayed_batch_changes_nothing(spark):
    def build(df):
        return df.groupBy("user").agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("start_us"), F.lit(0).cast("bigint").alias("end_us"), F.count(F.lit(1)).alias("n"))

    upsert = Upsert(spark, work_path(spark, "upsert"), "user", "ts", build)
    batch = spark.createDataFrame([(1, "a", START), (2, "b", START)], SCHEMA)
    for batch_id in (0, 0, 1, 1):
        upsert.on_batch(batch.where(f"event_id = {batch_id + 1}"), batch_id)
    upsert.on_batch(batch.limit(0), 2)
    got = upsert.current(batch.schema).select("user", "n")
    assert rows(got, "user") == [("a", 1), ("b", 1)]


def test_old_events_are_not_read_and_old_versions_go(spark):
    """Raw folders of days before the oldest open session may even be gone."""
    root = work_path(spark, "upsert")
    upsert = Upsert(spark, root, "user", "ts", sessions_of, gap_s=1800)
    day = 86_400
    made = lambda *e: spark.createDataFrame([(i, u, START + timedelta(seconds=s)) for i, u, s in e], SCHEMA)
    for number in range(20):
        upsert.on_batch(made((2 * number, "a", number * day + 50_000), (2 * number + 1, f"u{number}", number * day + 60_000)), number)
        if number:
            remove(spark, f"{root}/raw/batch={number - 1}")
    got = upsert.current(made((0, "a", 0)).schema)
    assert got.count() == 40 and got.where("events = 1").count() == 40
    # Each day comes from the batch that wrote it: one day is written a batch.
    for number in range(20):
        assert spark.read.parquet(f"{root}/derived/batch={number}").select("day").distinct().count() == 1
    assert upsert._versions(None)[0][0] == 19
    upsert.on_batch(made((100, "a", 50_100)), 20)
    assert [v[0] for v in upsert._versions(None)] == [20]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert work_path(spark, "x").startswith(shared_folder(spark))


def test_a_run_leaves_nothing(spark):
    from workload.storage import gold_as_temporary_view, replace_table_and_schema

    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    system = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = lambda: {str(f.getPath().getName()) for f in system.listStatus(fs)} if system.exists(fs) else set()
    names = lambda: {t.name for t in spark.catalog.listTables()}
    folders, tables = listed(), names()
    with releasing():
        assert gold_as_temporary_view(spark, "/root/testdata/sf0.001").count() > 0
        assert replace_table_and_schema(spark, "/root/testdata/sf0.001").count() > 0
        assert listed() > folders and names() > tables
    assert listed() == folders and names() == tables


# ---- sessions that close on an event --------------------------------------------


CLOSING = "event_id int, user string, ts timestamp_ntz, kind string"


def write_kinds(spark, folder, entries):
    made = [(i, u, START + timedelta(seconds=s), k) for i, (u, s, k) in enumerate(entries)]
    spark.createDataFrame(made, CLOSING).coalesce(1).write.mode("append").parquet(folder)


def by_rule(entries, gap, until):
    """Sessions by the rule, over cells of one second: (user, start, end, events, closed by an event) that are over by ``until``."""
    found = []
    for user in sorted({u for u, *_ in entries}):
        held = None
        own = sorted((s, k) for u, s, k in entries if u == user)
        for cell in sorted({int(s) for s, _ in own}):
            inside = [(s, k) for s, k in own if int(s) == cell]
            if held and inside[0][0] - held[1] >= gap:
                found.append((user, *held, False))
                held = None
            held = (held[0] if held else inside[0][0], inside[-1][0], (held[2] if held else 0) + len(inside))
            if any(k == "buy" for _, k in inside):
                if cell + 1 <= until:
                    found.append((user, *held, True))
                held = None
        if held and held[1] + gap <= until:
            found.append((user, *held, False))
    return sorted(found)


def test_sessions_close_on_events_and_silence_with_late_events_and_a_restart(spark):
    rng = random.Random(5)
    entries = [(rng.choice("abc"), rng.randrange(40_000) / 2, rng.choice(["view", "view", "view", "buy"])) for _ in range(300)]
    entries.sort(key=lambda e: e[1])
    parts = [entries[:100], entries[100:220], entries[220:]]
    # Late rows, still ahead of the watermark: they come a batch later than their time.
    late = [e for e in parts[0] if e[1] > parts[0][-1][1] - 1500][::3]
    parts[0] = [e for e in parts[0] if e not in late]
    parts[1] = late + parts[1]
    parts.append([("end", 100_000, "view")])
    source, target, state = (work_path(spark, n) for n in ("in", "out", "state"))
    for name, value in C.STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        for part in parts:  # the stream stops and starts again from its checkpoint for each part
            write_kinds(spark, source, part)
            schema = spark.createDataFrame([], CLOSING).schema
            stream = E.with_event_time(E.read_stream(spark, source, schema), "ts")
            E.write_stream(C.stream_closing_sessions(stream, "user", 900, "kind = 'buy'", delay="30 minutes"), target, state)
    finally:
        for name in C.STATE_STORE:
            spark.conf.unset(name)
    us = int((START - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    got = [((r.user, (r.start_us - us) / 1e6, (r.end_us - us) / 1e6, r.events, r.closed_by_event)) for r in spark.read.parquet(target).collect()]
    assert sorted(got) == by_rule([e for p in parts for e in p], 900, 100_000 - 1800)
    assert {c for *_, c in got} == {True, False} and len(late) > 2


class CountedState:
    """State variables and timers of one key in memory; calls are counted."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getListState(self, name, schema):  # noqa: N802
        return CountedVariable(self, list)

    def getValueState(self, name, schema):  # noqa: N802
        return CountedVariable(self, lambda _: None)

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.remove(at)


class CountedVariable:
    def __init__(self, handle, empty):
        self.handle, self.empty, self.held = handle, empty, empty(())

    def __getattribute__(self, name):
        if name in ("get", "put", "appendList", "update", "clear"):
            self.handle.calls += 1
        return object.__getattribute__(self, name)

    def get(self):
        return self.held

    def put(self, held):
        self.held = held

    update = put

    def appendList(self, entries):  # noqa: N802
        self.held = self.held + entries

    def clear(self):
        self.held = self.empty(())


class At:
    def __init__(self, us):
        self.ms = us // 1000

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815


def closing_state(entries, gap_s):
    """A group's state with the events (user, second, whether it closes) in it."""
    handle, processor = CountedState(), C.ClosingSessions(gap_s * 1_000_000, 1_000_000)
    processor.init(handle)
    made = pd.DataFrame([(u, int(s), round(s * 1e6), round(s * 1e6), 1, int(closes)) for u, s, closes in entries], columns=["user", "cell", "first", "last", "events", "closes"])
    assert list(processor.handleInputRows((0,), iter([made]), At(0))) == []
    return handle, processor


def gone_off(processor, us):
    found = [tuple(r) for part in processor.handleExpiredTimer((0,), At(us), At(us)) for r in part.itertuples(index=False)]
    return [(u, start / 1e6, end / 1e6, n, closed) for u, start, end, n, closed in found]


def test_state_calls_do_not_grow_with_users_and_events():
    entries = [(f"u{i % 50:02}", 4000.0 * i, False) for i in range(5000)]
    few, many = [closing_state(e, 1800) for e in (entries[:50], entries)]
    for handle, processor in (few, many):
        assert len(gone_off(processor, 10**14)) == (5000 if handle is many[0] else 50)
        assert handle.calls < 20 and not processor.cells.held and not processor.open.held
    assert few[0].calls == many[0].calls


def test_silence_waits_for_a_cell_that_is_not_complete():
    handle, processor = closing_state([("a", 0.3, False), ("a", 900.1, False), ("b", 0.2, True), ("b", 0.1, False), ("b", 900.4, False)], 900)
    # The watermark lies in the cell of events that came in time: a's second is less than the gap after its first.
    assert gone_off(processor, 900_500_000) == [("b", 0.1, 0.2, 2, True)]
    assert handle.timers == {901_000}
    assert gone_off(processor, 901_000_000) == []
    assert gone_off(processor, 10**10) == [("a", 0.3, 900.1, 2, False), ("b", 900.4, 900.4, 1, False)]


def test_a_cell_is_no_wider_than_the_gap(spark):
    source = work_path(spark, "in")
    write_kinds(spark, source, [("a", 1, "view")])
    stream = E.with_event_time(E.read_stream(spark, source, spark.createDataFrame([], CLOSING).schema), "ts")
    with pytest.raises(ValueError):
        C.stream_closing_sessions(stream, "user", 1, "kind = 'buy'", cell_us=2_000_000)


def test_sketches_of_closed_days(spark):
    source = work_path(spark, "in")
    write(spark, source, (1, "a", 0), (2, "a", 50), (3, "b", 60), (4, "a", 90_000), (5, None, 90_001), (6, "z", 400_000))
    daily = E.run_to_table(R.stream_user_sketches(stream_of(spark, source), "user"), "sketches")
    found = daily.select(F.col("day").cast("string").alias("day"), "events", F.theta_sketch_estimate("theta"), F.hll_sketch_estimate("hll"))
    assert rows(found, "day") == [("2024-01-01", 3, 2, 2), ("2024-01-02", 2, 1, 1)]
    assert rows(K.merged_users(daily, F.lit("all"))) == [("all", 5, 2, 2)]
