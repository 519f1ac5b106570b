"""Outputs: the counts table, rejected reads, and the text report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from umitally.sources.fastq import write_fastq


HEADER = ["barcode", "total_reads", "num_unique_umis"]


def write_counts_tsv(summary: DataFrame, path: str, *, single_file: bool = False, first_seen: DataFrame | None = None) -> None:
    """barcode, total_reads, num_unique_umis as tab-separated text with a header, largest number of UMIs first.

    The order is global over the part files, each of which has the header. single_file gives one part, sorted by one task,
    for tables of a size that one task can write. An empty table gives one file with the header alone. Ties go by barcode or,
    with the reads that were accepted (read_id, barcode) as first_seen, by the barcode's first read.
    """
    rows, by = summary.select(*HEADER), [F.desc("num_unique_umis"), F.col("barcode")]
    if first_seen is not None:
        rows, by = rows.join(first_seen.groupBy("barcode").agg(F.min("read_id").alias("_first")), "barcode"), [by[0], F.col("_first")]
    ordered = rows.repartition(1).sortWithinPartitions(*by) if single_file else rows.orderBy(*by)
    ordered.select(*HEADER).write.mode("errorifexists").option("sep", "\t").option("header", True).option("quote", "").csv(path)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """The reads that could not be parsed, as FASTQ in input order, by read_id of any type that sorts."""
    write_fastq(rejects.orderBy("read_id"), path)


def format_report(summary: Row, thousands: bool = True) -> str:
    """The one row of run_summary as text."""
    n = (lambda x: f"{x:,}") if thousands else str
    total = summary["n_total"]
    share = lambda x: 100 * x / total if total else 0.0
    lines = [
        f"Total reads:       {n(total)}",
        f"Parsed:            {n(summary['n_parsed'])} ({share(summary['n_parsed']):.1f}%)",
        f"Failed:            {n(summary['n_failed'])} ({share(summary['n_failed']):.1f}%)",
        f"Distinct tuples:   {n(summary['n_tuples'])}",
        f"Distinct barcodes: {n(summary['n_barcodes'])}",
        f"Gini:              {summary['gini']:.6f}",
        f"Reads a tuple:     mean {summary['mean_reads']:.2f}, max {n(summary['max_reads'])}",
    ]
    return "\n".join(lines)
