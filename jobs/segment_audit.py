"""Which sources of a text collection repeat themselves: the jackpot audit of reads, on texts.

    python -m jobs.segment_audit --documents PATH --output PATH [--config PATH]

Each text is searched for a segment between two approximate anchors, as a read for its barcode. What stands before and after
it identifies the text, as UMIs do a molecule, so texts with the same three parts are copies. For each source the job tells
how many texts have the segment, how evenly they fall on distinct texts (Gini, largest number of copies), and for each of
its segments the texts and the distinct texts.

Output, Parquet partitioned by source (folder `part`, as a null source and an empty one are different sources):

* tuples: source, barcode, umi5, umi3 (MD5 of the text before and after), n; a source's texts without a segment are one row
  with nulls.
* audit: source, barcode, total_reads, num_unique_umis, and the source's n_total, n_parsed, n_failed, n_tuples, gini, max_reads
  on each of its rows; a source without a segment has one row without one.

Each run replaces both. A run that fails leaves them to the next one, which needs nothing of them.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import default_config, layout_of, log, read_config, start_session
from umitally.operators import jackpot, parse, tally


def part(group: str) -> Column:
    return F.coalesce(F.concat(F.lit("of "), F.col(group)), F.lit("none"))


def replace(df: DataFrame, path: str, group: str) -> DataFrame:
    """Replace the table at path and read it back. A task has rows of few folders, and AQE splits a hot group's."""
    df.withColumn("part", part(group)).hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run(spark: SparkSession, documents: str, output: str, config: dict) -> dict[str, int]:
    """Read documents, write output/tuples and output/audit; what was read and written."""
    group, text = config["group"], config["text"]
    docs = spark.read.parquet(documents).select(F.col(group).cast("string").alias(group), text)
    parsed = parse.parse_reads(docs, layout_of(config), seq_col=text)
    parsed = parsed.select(group, "barcode", F.md5(F.col("umi5").cast("binary")).alias("umi5"), F.md5(F.col("umi3").cast("binary")).alias("umi3"))
    tuples = replace(tally.tuple_counts(parsed, by=[group], rejects=True), f"{output}/tuples", group)
    n = tuples.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("documents"), F.count(F.lit(1)).alias("tuples")).first()
    log.info("read %d documents of %s, wrote %d tuples to %s/tuples", n.documents, documents, n.tuples, output)
    audit = replace(jackpot.audit(tuples, [group]), f"{output}/audit", group).count()
    log.info("wrote %d rows to %s/audit", audit, output)
    return {"documents": n.documents, "tuples": n.tuples, "audit": audit}


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="segment_audit", description=__doc__.split("\n")[0])
    p.add_argument("--documents", required=True, help="Parquet table with the text and its group")
    p.add_argument("--output", required=True, help="folder for the tables that are written")
    p.add_argument("--config", help="JSON file; the one beside the job if none is given")
    o = p.parse_args(args)
    spark = start_session("segment_audit")
    try:
        run(spark, o.documents, o.output, read_config(spark, o.config) if o.config else default_config("segment_audit"))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
