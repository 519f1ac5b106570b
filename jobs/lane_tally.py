"""The tally of a sequencing run whose files keep arriving, by lane.

    python -m jobs.lane_tally --reads PATH --output PATH --checkpoint PATH [--config PATH]

Each run takes the Parquet files that have come to the folder since the run before, by a file stream with a checkpoint that
ends when nothing is left. A micro-batch is parsed, its reads are counted by lane and (umi5, barcode, umi3), and the counts
alone are written, to a folder named by the batch's number: a batch that runs again after a failure replaces its own folder,
so no read counts twice. Reads are never read again.

Then the lanes that have new counts are summed up, and only their folders of the summary are replaced (dynamic partition
overwrite). Each row of the summary tells up to which batch it goes, so a run that failed in between is made up for by the
next, even one that finds no new file.

Output, Parquet:

* tuples/batch=N/lane=L: barcode, umi5, umi3, n; a batch's rejected reads of a lane are one row with nulls.
* summary/lane=L: barcode, total_reads, num_unique_umis, and the lane's n_total, n_parsed, n_failed, n_tuples, gini, max_reads,
  through_batch on each of its rows; a lane without a parsed read has one row without a barcode.

The config gives header, seq and lane as SQL expressions over the table's columns (lane: over header and seq as well), so any
table that reads can be made of will do. Reads whose lane is null or empty are in lane "none". Lanes are folders, so they
are few, and the list of those with new counts reaches the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import default_config, layout_of, log, read_config, read_if_there, start_session
from umitally.operators import jackpot, parse, tally

TUPLES = "barcode string, umi5 string, umi3 string, n bigint, batch bigint, lane string"
SUMMARY = "barcode string, total_reads bigint, num_unique_umis bigint, n_total bigint, n_parsed bigint, n_failed bigint, n_tuples bigint, gini double, max_reads bigint, through_batch bigint, lane string"


def reads_of(table: DataFrame, config: dict) -> DataFrame:
    """header, seq, lane of the rows of a table, which may be a stream."""
    reads = table.selectExpr(f"{config['header']} AS header", f"{config['seq']} AS seq")
    return reads.withColumn("lane", F.coalesce(F.nullif(F.expr(config["lane"]).cast("string"), F.lit("")), F.lit("none")))


def take_new(spark: SparkSession, reads: str, output: str, checkpoint: str, config: dict) -> int:
    """Count what has come since the checkpoint; the number of reads."""
    layout = layout_of(config)

    def count(batch: DataFrame, number: int) -> None:
        tuples = tally.tuple_counts(parse.parse_reads(reads_of(batch, config), layout), by=["lane"], rejects=True)
        tuples.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("lane").parquet(f"{output}/tuples/batch={number}")

    schema = spark.read.parquet(reads).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", config["files_a_batch"]).parquet(reads)
    query = stream.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress)


def sum_up(spark: SparkSession, output: str) -> list[str]:
    """Bring the summary up to the counts; the lanes that it was brought up for."""
    tuples = read_if_there(spark, f"{output}/tuples", TUPLES)
    if tuples is None:
        return []
    newest = tuples.groupBy("lane").agg(F.max("batch").alias("newest"))
    done = read_if_there(spark, f"{output}/summary", SUMMARY)
    if done is not None:
        newest = newest.join(done.groupBy("lane").agg(F.max("through_batch").alias("through")), "lane", "left").where("through IS NULL OR through < newest").select("lane", "newest")
    lanes = newest.orderBy("lane").collect()
    if not lanes:
        return []
    fresh = tuples.where(F.col("lane").isin([r.lane for r in lanes]))
    merged = tally.merge_tallies(fresh.drop("batch"), by=["lane"])
    through = F.create_map(*(F.lit(x) for r in lanes for x in (r.lane, r.newest)))
    summary = jackpot.audit(merged, ["lane"]).withColumn("through_batch", through[F.col("lane")])
    summary.select(*(c.split()[0] for c in SUMMARY.split(", "))).hint("rebalance", "lane").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lane").parquet(f"{output}/summary")
    return [r.lane for r in lanes]


def run(spark: SparkSession, reads: str, output: str, checkpoint: str, config: dict) -> dict:
    """Take the new files, bring the summary up to date; what was read and written."""
    n = take_new(spark, reads, output, checkpoint, config)
    log.info("read %d new reads of %s, wrote their counts to %s/tuples", n, reads, output)
    lanes = sum_up(spark, output)
    log.info("wrote %d lanes to %s/summary: %s", len(lanes), output, ", ".join(lanes) or "nothing new")
    return {"reads": n, "lanes": lanes}


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lane_tally", description=__doc__.split("\n")[0])
    p.add_argument("--reads", required=True, help="folder to which Parquet files of reads come, or a pattern of files or folders")
    p.add_argument("--output", required=True, help="folder for the tables that are written")
    p.add_argument("--checkpoint", required=True, help="folder of the stream's checkpoint, one for each output")
    p.add_argument("--config", help="JSON file; the one beside the job if none is given")
    o = p.parse_args(args)
    spark = start_session("lane_tally")
    try:
        run(spark, o.reads, o.output, o.checkpoint, read_config(spark, o.config) if o.config else default_config("lane_tally"))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
