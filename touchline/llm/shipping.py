"""The package's code for Python workers."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import touchline
from touchline.session import shared_folder

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers, wherever they run; once per session."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(touchline.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, f"{root.name}/{source.relative_to(root)}")
    # It stays as long as the session, because executors may start later.
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/code-{uuid.uuid4().hex}/{root.name}.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target.toString())
    _shipped.add(sc.applicationId)
