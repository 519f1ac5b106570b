"""Counts of (umi5, barcode, umi3) tuples and their summary by barcode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["barcode", "umi5", "umi3"]


def tuple_counts(parsed: DataFrame, by: Sequence[str] = (), *, rejects: bool = False) -> DataFrame:
    """barcode, umi5, umi3, n of accepted reads; partial counts are combined before the shuffle.

    by: columns whose groups (samples, lanes) are counted apart. rejects: rejected reads are counted, too, a row a group with
    nulls for the tuple.
    """
    rows = parsed if rejects else parsed.where("barcode IS NOT NULL")
    return rows.groupBy(*by, *KEY).agg(F.count(F.lit(1)).alias("n"))


def merge_tallies(*tallies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sum of tables of tuple counts, as if their reads had been counted together."""
    rows = tallies[0]
    for t in tallies[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy(*by, *KEY).agg(F.sum("n").alias("n"))


def barcode_summary(tuples: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """barcode, total_reads, num_unique_umis. Tuples are distinct, so a barcode's UMI pairs are its rows."""
    return tuples.groupBy(*by, "barcode").agg(F.sum("n").alias("total_reads"), F.count(F.lit(1)).alias("num_unique_umis"))


def ranked(summary: DataFrame, ties: str = "barcode", first_seen: DataFrame | None = None) -> DataFrame:
    """summary by num_unique_umis, largest first. Ties go by barcode, or by the first read of the barcode, for which
    first_seen gives barcode and read_id of accepted reads."""
    if ties == "barcode":
        return summary.orderBy(F.desc("num_unique_umis"), "barcode")
    if ties != "first_seen" or first_seen is None:
        raise ValueError('ties must be "barcode", or "first_seen" with the reads')
    first = first_seen.where("barcode IS NOT NULL").groupBy("barcode").agg(F.min("read_id").alias("_first"))
    return summary.join(first, "barcode").orderBy(F.desc("num_unique_umis"), "_first").drop("_first")
