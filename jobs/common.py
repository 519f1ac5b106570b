"""What the jobs share: config files, the log, and sessions of the command line."""

from __future__ import annotations

import json
import logging
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from umitally.package import send_package
from umitally.plans.layout import ReadLayout

log = logging.getLogger("umitally.jobs")


def default_config(name: str) -> dict:
    """The config file that lies beside the jobs."""
    return json.loads((Path(__file__).parent / f"{name}.json").read_text())


def read_config(spark: SparkSession, path: str) -> dict:
    """A config file from any store that Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def layout_of(config: dict) -> ReadLayout:
    return ReadLayout(**config["layout"])


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at path with the schema, or None where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def start_session(name: str) -> SparkSession:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(name).getOrCreate()
    send_package(spark)
    return spark
