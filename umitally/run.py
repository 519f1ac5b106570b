"""The whole run: reads in; counts, rejected reads and a report out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from umitally.operators import jackpot, parse, tally
from umitally.plans.layout import ReadLayout
from umitally.sources.fastq import read_fastq
from umitally.sources.sinks import format_report, write_counts_tsv, write_rejects


@dataclass
class Run:
    """What a run found: the one row of run_summary, the barcode table, and the report as text."""

    summary: Row
    barcodes: DataFrame
    report: str


def run(spark: SparkSession, input: str | list[str], output: str | None, rejects: str | None, layout: ReadLayout, *, gini_cap: int | None = None, incomplete: str = "drop", single_file: bool = False, ties: str = "barcode") -> Run:
    """Scan FASTQ, parse every read once, write the counts table and the rejected reads (folders; None writes none).

    ties says which of two barcodes with equally many UMIs comes first in the table: "barcode", the lesser, or "first_seen",
    that whose first read comes first.

    An input without reads gives a table with the header alone and a report whose Gini is nan.
    """
    if ties not in ("barcode", "first_seen"):
        raise ValueError('ties must be "barcode" or "first_seen"')
    kept, lost = parse.split_once(parse.parse_reads(read_fastq(spark, input, incomplete=incomplete), layout))
    barcodes = tally.barcode_summary(tally.tuple_counts(kept))
    if rejects is not None:
        write_rejects(lost, rejects)
    if output is not None:
        write_counts_tsv(barcodes, output, single_file=single_file, first_seen=kept if ties == "first_seen" else None)
    both = kept.select("umi5", "barcode", "umi3").unionByName(lost.selectExpr("cast(null AS string) AS umi5", "cast(null AS string) AS barcode", "cast(null AS string) AS umi3"))
    summary = jackpot.run_summary(both, gini_cap=gini_cap).first()
    return Run(summary, barcodes, format_report(summary))
