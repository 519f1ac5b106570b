"""Tallies of reads that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from umitally.operators.parse import parse_reads
from umitally.operators.tally import barcode_summary, merge_tallies, tuple_counts
from umitally.plans.layout import ReadLayout


def stream_tuple_counts(reads: DataFrame, layout: ReadLayout) -> DataFrame:
    """A streaming tuple_counts: write it in complete or update mode."""
    return tuple_counts(parse_reads(reads, layout))


def start_tally(reads: DataFrame, layout: ReadLayout, path: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch's tuple counts to path, a folder a batch, so that a batch that runs again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        tuple_counts(parse_reads(batch, layout)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return reads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def current(spark, path: str) -> DataFrame:
    """The barcode summary of all batches so far."""
    return barcode_summary(merge_tallies(spark.read.parquet(path).drop("batch")))
