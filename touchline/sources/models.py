"""Fitted models on disk: versions, stages, input contracts and run logs.

Everything is an append to a small Parquet table below one root folder, which
all executors must reach, and nothing is updated in place. Numbers are claimed by
creating a file that must not be there yet, so of two writers one gets a number
and the other the next one: version numbers, and the turns in which stages are
given. The holder of a stage is the version that was given it in the last turn;
those before it are archived, whoever wrote when.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators.features import enforce_contract

_STAGES = "name string, version int, stage string, contract string, metrics map<string,double>, folder string, turn long, at timestamp"
_RUNS = "run_id string, run_name string, kind string, key string, value string, at timestamp"


@dataclass
class ModelStore:
    spark: SparkSession
    root: str

    # -- versions

    def _append(self, table: str, rows: list[tuple], schema: str) -> None:
        # A folder of its own: jobs that append to one folder at the same time undo each other's work.
        self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{self.root}/{table}/{uuid.uuid4().hex}")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _claim(self, kind: str, name: str, number: int) -> int:
        """The first free number from ``number`` on, taken for good."""
        while not claimed(self.spark, f"{self.root}/claims/{kind}/{name}/{number}"):
            number += 1
        return number

    def versions(self, name: str) -> DataFrame:
        """One row per version with its current stage; a stage has one holder, and "None" and "Archived" any number."""
        written = self._read("model_versions", _STAGES).where(F.col("name") == name)
        last = written.groupBy("name", "version").agg(F.max_by(F.struct("stage", "contract", "metrics", "folder", "turn"), "turn").alias("_last"))
        last = last.select("name", "version", "_last.*")
        # Versions of one model are few: one small window.
        newest = F.max("turn").over(Window.partitionBy("stage"))
        free = F.col("stage").isin("None", "Archived") | (F.col("turn") == newest)
        return last.withColumn("stage", F.when(free, F.col("stage")).otherwise("Archived")).drop("turn")

    def register(self, name: str, model: PipelineModel, contract: str, metrics: dict[str, float] | None = None) -> int:
        """Save a fitted model as the next version of ``name``; its stage is "None".

        The model is written before its number is claimed. A writer that is lost
        between the two leaves a number that no version has.
        """
        folder = f"models/{name}/{uuid.uuid4().hex}"
        model.write().save(f"{self.root}/{folder}")
        version = self._claim("version", name, (self.versions(name).agg(F.max("version")).first()[0] or 0) + 1)
        self._append("model_versions", [(name, version, "None", contract, metrics or {}, folder, 0, _now())], _STAGES)
        return version

    def promote(self, name: str, version: int, stage: str = "Production") -> None:
        """Give a version a stage; the version that held it is archived."""
        row = self.versions(name).where(F.col("version") == version).first()
        if row is None:
            raise ValueError(f"no version {version} of {name}")
        before = self._read("model_versions", _STAGES).where(F.col("name") == name).agg(F.max("turn")).first()[0] or 0
        turn = self._claim("turn", name, before + 1)
        self._append("model_versions", [(name, version, stage, row["contract"], row["metrics"], row["folder"], turn, _now())], _STAGES)

    def load(self, name: str, stage: str = "Production") -> tuple[PipelineModel, str]:
        """The newest version in a stage, with its input contract."""
        row = self.versions(name).where(F.col("stage") == stage).orderBy(F.col("version").desc()).first()
        if row is None:
            raise ValueError(f"{name} has no version in {stage}")
        return PipelineModel.load(f"{self.root}/{row['folder']}"), row["contract"]

    def transform(self, name: str, df: DataFrame, stage: str = "Production") -> DataFrame:
        """Score with the model in a stage, after checking the inputs."""
        model, contract = self.load(name, stage)
        return model.transform(enforce_contract(df, contract))

    # -- runs

    def log_run(self, run_name: str, params: dict, metrics: dict[str, float]) -> str:
        """Write the settings and metrics of one training run; metrics keep their own sign."""
        run_id, now = uuid.uuid4().hex, _now()
        rows = [(run_id, run_name, "param", k, str(v), now) for k, v in params.items()]
        rows += [(run_id, run_name, "metric", k, str(float(v)), now) for k, v in metrics.items()]
        self._append("runs", rows, _RUNS)
        return run_id

    def runs(self) -> DataFrame:
        return self._read("runs", _RUNS)


def claimed(spark: SparkSession, path: str) -> bool:
    """Create an empty file and say whether it is ours: False if it was there already.

    File systems create a file without overwriting it as one step. The local one
    of Hadoop looks first and creates then, so there Java's own exclusive create is used.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    try:
        if system.getScheme() == "file":
            nio = jvm.java.nio.file
            no_attributes = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("java.nio.file.attribute.FileAttribute"), 0)
            nio.Files.createFile(nio.Path.of(system.makeQualified(target).toUri()), no_attributes)
        else:
            system.create(target, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _now() -> datetime:
    return datetime.now(timezone.utc)
