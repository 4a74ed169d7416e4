"""Session set-up and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings a session for streams should be made with: rows are merged into sessions before they are shuffled.
STREAM_SETTINGS = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}

_used: list[Callable[[], None]] = []


def local_session(cores: int | str = "*", app: str = "touchline", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    cores_n = cores if isinstance(cores, int) or str(cores).isdigit() else 8
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores_n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(map=STREAM_SETTINGS)
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without that setting it is a folder below the warehouse, which executors
    share as well.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    folder = configured or current or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared-{uuid.uuid4().hex}"
    if current is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed by ``releasing``."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    on_release(lambda: remove(spark, path))
    return path


def on_release(action: Callable[[], None]) -> None:
    """Have something removed when the run that made it is over."""
    _used.append(action)


@contextmanager
def releasing() -> Iterator[None]:
    """Around a run: removes the folders, tables, views and caches it made, once its results are written or read.

    Results are computed when they are used, so they must be used inside.
    """
    before = len(_used)
    try:
        yield
    finally:
        while len(_used) > before:
            _used.pop()()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever the session's file systems have it."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and carry on from the written copy.

    A written copy outlives the executors, so a lost executor costs one task
    and not the whole loop that led here.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
