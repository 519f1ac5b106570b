"""Jackpot statistics: how unevenly reads fall on tuples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from umitally.operators import tally
from umitally.operators.tally import KEY
from umitally.sources.workdir import stored


def _ratio(up: Column, mass: Column, total: Column) -> Column:
    """The sum of x m (N + 1) is the mass times N + 1, which the numerator lacks yet."""
    numerator = (up - (mass * (total + 1)).cast("decimal(38,0)")).cast("double")
    return F.when(total.isNull(), F.lit(float("nan"))).when(mass == 0, F.lit(0.0)).otherwise(numerator / (total * mass).cast("double"))


def gini(counts: DataFrame, column: str = "n") -> DataFrame:
    """One row: gini. No counts give NaN, counts that are all zero 0.

    From the histogram of counts: equal counts share a block of ranks, so with c smaller counts in all, a block of m counts
    of x adds x * (2 m c + m (m + 1) - m (N + 1)) to the numerator. The histogram has as many rows as there are different
    counts, at most the square root of twice their sum; only it meets in one task. Sums are exact decimals.
    """
    big = "decimal(38,0)"
    hist = counts.where(F.col(column).isNotNull()).groupBy(F.col(column).cast(big).alias("x")).agg(F.count(F.lit(1)).cast(big).alias("m"))
    run = hist.select("x", "m", (F.sum("m").over(W.orderBy("x")) - F.col("m")).cast(big).alias("c"))
    sums = run.agg(
        F.sum("m").cast(big).alias("total"),
        F.sum((F.col("x") * F.col("m")).cast(big)).cast(big).alias("mass"),
        F.sum((F.col("x") * (2 * F.col("m") * F.col("c") + F.col("m") * (F.col("m") + 1)).cast(big)).cast(big)).cast(big).alias("up"),
    )
    return sums.select(_ratio(F.col("up"), F.col("mass"), F.col("total")).alias("gini"))


def summary_by(tuples: DataFrame, by: Sequence[str]) -> DataFrame:
    """For each group: n_total, n_parsed, n_failed, n_tuples, gini, max_reads, from tuple counts that tell rejected reads too.

    The groups' histograms are summed as in gini(); a group's histogram meets in one task, its tuples do not. A group without
    accepted reads has no Gini (NaN) and 0 for the rest.
    """
    big = "decimal(38,0)"
    ok = F.col("barcode").isNotNull()
    hist = tuples.groupBy(*by, ok.alias("_ok"), F.col("n").cast(big).alias("_x")).agg(F.count(F.lit(1)).cast(big).alias("_m"))
    of = lambda e: F.when(F.col("_ok"), e)
    run = hist.withColumn("_c", (F.sum(of(F.col("_m"))).over(W.partitionBy(*by).orderBy("_x", "_ok")) - F.col("_m")).cast(big))
    mass = (F.col("_x") * F.col("_m")).cast(big)
    sums = run.groupBy(*by).agg(
        F.sum(mass).cast("bigint").alias("n_total"), F.sum(of(mass)).cast(big).alias("_mass"), F.sum(of(F.col("_m"))).cast(big).alias("_total"), F.max(of(F.col("_x"))).alias("_most"),
        F.sum(of((F.col("_x") * (2 * F.col("_m") * F.col("_c") + F.col("_m") * (F.col("_m") + 1)).cast(big)).cast(big))).cast(big).alias("_up"),
    )
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    parsed = count("_mass")
    return sums.select(*by, "n_total", parsed.alias("n_parsed"), (F.col("n_total") - parsed).alias("n_failed"), count("_total").alias("n_tuples"), _ratio(F.col("_up"), F.col("_mass"), F.col("_total")).alias("gini"), count("_most").alias("max_reads"))


def audit(tuples: DataFrame, by: Sequence[str]) -> DataFrame:
    """summary_by() beside each of the group's barcodes with total_reads and num_unique_umis; a group without one has one row.

    Groups may be null. The barcodes were combined before they are joined to the groups.
    """
    barcodes = tally.barcode_summary(tuples.where("barcode IS NOT NULL"), by).withColumnsRenamed({c: f"_{c}" for c in by})
    groups = summary_by(tuples, by)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return groups.join(barcodes, same, "left").select(*by, "barcode", "total_reads", "num_unique_umis", *(c for c in groups.columns if c not in by))


def first_tuples(tuples: DataFrame, cap: int) -> DataFrame:
    """The first cap tuples in key order, whatever their number: no task sorts more than its range of keys.

    Tuples are sorted in ranges, which are counted. The ranges before the cut are taken whole, and the one that the cut is in
    is numbered alone.
    """
    if cap < 1:
        raise ValueError("cap must be at least 1")
    ranges = stored(tuples.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    # A row a range: ranges are as many as shuffle partitions.
    before = counts.select("_range", "_rows", (F.sum("_rows").over(W.orderBy("_range")) - F.col("_rows")).alias("_before")).where(F.col("_before") < cap)
    placed = ranges.join(F.broadcast(before), "_range")
    whole = placed.where(F.col("_before") + F.col("_rows") <= cap)
    cut = placed.where(F.col("_before") + F.col("_rows") > cap).withColumn("_place", F.row_number().over(W.partitionBy("_range").orderBy(*KEY)))
    return whole.select(*tuples.columns).unionByName(cut.where(F.col("_before") + F.col("_place") <= cap).select(*tuples.columns))


def gini_capped(tuples: DataFrame, cap: int) -> DataFrame:
    """gini of the first cap tuples in key order."""
    return gini(first_tuples(tuples, cap))


def run_summary(parsed: DataFrame, *, gini_cap: int | None = None) -> DataFrame:
    """One row: n_total, n_parsed, n_failed, n_tuples, n_barcodes, gini, mean_reads, max_reads, pct_parsed, pct_failed.

    One chain of groupings, so that reads are parsed once: tuples (rejects are one more group), then barcodes with the
    histogram of their tuples' counts, then the histogram of all counts, from which every figure follows. Only the last
    meets in one task; see gini().
    """
    big = "decimal(38,0)"
    tuples = parsed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    if gini_cap is not None:
        tuples = stored(tuples)
    by_count = tuples.groupBy("barcode", "n").agg(F.count(F.lit(1)).alias("m"))
    # A barcode's smallest count stands for the barcode, so that summing the marks counts barcodes.
    marked = by_count.groupBy("barcode").agg(F.array_sort(F.collect_list(F.struct("n", "m"))).alias("h")).select(F.col("barcode").isNotNull().alias("ok"), F.posexplode("h").alias("pos", "at"))
    hist = marked.groupBy("ok", F.col("at.n").cast(big).alias("x")).agg(F.sum("at.m").cast(big).alias("m"), F.sum((F.col("pos") == 0).cast("long")).alias("b"))
    run = hist.withColumn("c", (F.sum(F.when(F.col("ok"), F.col("m"))).over(W.orderBy("x", "ok")) - F.col("m")).cast(big))
    of = lambda e: F.sum(F.when(F.col("ok"), e))
    sums = run.agg(
        F.sum((F.col("x") * F.col("m")).cast(big)).cast(big).alias("reads"), of((F.col("x") * F.col("m")).cast(big)).cast(big).alias("mass"),
        of(F.col("m")).cast(big).alias("total"), of(F.col("b")).alias("b"), F.max(F.when(F.col("ok"), F.col("x"))).alias("most"),
        of((F.col("x") * (2 * F.col("m") * F.col("c") + F.col("m") * (F.col("m") + 1)).cast(big)).cast(big)).cast(big).alias("up"),
    )
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    exact = _ratio(F.col("up"), F.col("mass"), F.col("total")).alias("gini")
    one = sums.select(count("reads").alias("n_total"), count("mass").alias("n_parsed"), count("total").alias("n_tuples"), count("b").alias("n_barcodes"), exact, F.coalesce(F.col("mass").cast("double") / F.col("total").cast("double"), F.lit(0.0)).alias("mean_reads"), count("most").alias("max_reads"))
    if gini_cap is not None:
        one = one.drop("gini").crossJoin(F.broadcast(gini_capped(tuples.where("barcode IS NOT NULL"), gini_cap)))  # single rows
    failed = F.col("n_total") - F.col("n_parsed")
    share = lambda x: F.when(F.col("n_total") > 0, 100.0 * x / F.col("n_total")).otherwise(F.lit(0.0))
    return one.select("n_total", "n_parsed", failed.alias("n_failed"), "n_tuples", "n_barcodes", "gini", "mean_reads", "max_reads", share(F.col("n_parsed")).alias("pct_parsed"), share(failed).alias("pct_failed"))
