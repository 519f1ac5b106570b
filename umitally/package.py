"""The package on executors of other machines."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
#: Applications whose executors have been sent the package.
_sent: set[str] = set()


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def send_package(spark: SparkSession) -> None:
    """Let Python workers find the package, wherever the session was started from: by their path on this machine, and on
    others through Spark's own file server, once an application."""
    context = spark.sparkContext
    workers = context.environment
    if HERE not in workers.get("PYTHONPATH", "").split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, workers.get("PYTHONPATH")]))
    if context.applicationId in _sent or is_local(spark):
        return
    folder = tempfile.mkdtemp()  # the driver serves the file from here as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/umitally.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(os.path.join(HERE, "umitally")):
            for name in (n for n in names if n.endswith(".py")):
                z.write(os.path.join(top, name), os.path.relpath(os.path.join(top, name), HERE))
    context.addPyFile(f"{folder}/umitally.zip")
    _sent.add(context.applicationId)
