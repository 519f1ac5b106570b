"""python -m umitally: the run on the command line."""

from __future__ import annotations

import argparse
import sys

from umitally.plans.layout import MODES, ReadLayout


class _Parser(argparse.ArgumentParser):
    def error(self, message: str) -> None:
        """Bad options: the usage on stderr, exit status 1."""
        self.print_usage(sys.stderr)
        self.exit(1, f"{self.prog}: {message}\n")


def parser() -> argparse.ArgumentParser:
    p = _Parser(prog="umitally", description="Tally barcodes and UMIs of reads [outer5] umi5 inner5 BARCODE inner3 umi3 [outer3].")
    p.add_argument("--in", dest="input", required=True, help="FASTQ file, folder or pattern, plain or compressed")
    p.add_argument("--out", dest="output", required=True, help="folder for the counts table")
    p.add_argument("--fail", dest="rejects", required=True, help="folder for reads that do not parse")
    p.add_argument("--inner5", required=True)
    p.add_argument("--inner3", required=True)
    p.add_argument("--outer5")
    p.add_argument("--outer3")
    p.add_argument("--barcode-length", type=int, required=True)
    p.add_argument("--min-umi", type=int, default=1)
    p.add_argument("--max-umi", type=int, default=100)
    p.add_argument("--max-errors", type=int, default=2)
    p.add_argument("--mode", choices=MODES, default="hamming")
    p.add_argument("--regex-anchors", action="store_true", help="anchors are pattern source (edit mode)")
    p.add_argument("--c-limits", action="store_true", help="reject UMIs of 256 characters or more")
    p.add_argument("--incomplete", choices=["drop", "keep"], default="drop", help="what becomes of a last record of fewer than four lines")
    p.add_argument("--ties", choices=["barcode", "first_seen"], default="barcode", help="order of barcodes with equally many UMIs")
    p.add_argument("--tmp-dir", help="folder for work tables that all executors share (spark.checkpoint.dir)")
    p.add_argument("--gini-cap", type=int, help="Gini of the first so many tuples in key order")
    p.add_argument("--single-file", action="store_true", help="the counts table as one part file")
    p.add_argument("--threads", type=int, help="run in this process with so many threads, where no master is set")
    return p


def main(args: list[str] | None = None) -> int:
    p = parser()
    o = p.parse_args(args)
    try:
        layout = ReadLayout(o.inner5, o.inner3, o.barcode_length, outer5=o.outer5, outer3=o.outer3, min_umi=o.min_umi, max_umi=o.max_umi, max_errors=o.max_errors, mode=o.mode, regex_anchors=o.regex_anchors, c_limits=o.c_limits)
    except ValueError as e:
        p.error(str(e))
    if o.gini_cap is not None and o.gini_cap < 1 or o.threads is not None and o.threads < 1:
        p.error("--gini-cap and --threads must be at least 1")
    from pyspark.sql import SparkSession

    from umitally.package import send_package
    from umitally.run import run

    builder = SparkSession.builder.appName("umitally")
    if o.tmp_dir:
        builder = builder.config("spark.checkpoint.dir", o.tmp_dir)
    spark = (builder.master(f"local[{o.threads}]") if o.threads else builder).getOrCreate()
    send_package(spark)
    print(run(spark, o.input, o.output, o.rejects, layout, gini_cap=o.gini_cap, incomplete=o.incomplete, single_file=o.single_file, ties=o.ties).report, file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
