"""A work folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from umitally.package import is_local

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A fresh path below spark.checkpoint.dir.

    Only where that setting is absent and the master is local (tests) is a folder of this machine used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="umitally-")
            atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
        base = "file://" + _own_dirs[app]
    return f"{base.rstrip('/')}/umitally/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to a shared folder and read back: it is computed once, and lost executors do not undo it."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
