"""Synthetic reads from the lineitem table, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from umitally.plans.layout import ReadLayout

INNER5, INNER3 = "GAAGAGAAACC", "TAGAAGCTTA"
LAYOUT = ReadLayout(inner5=INNER5, inner3=INNER3, barcode_length=8, max_errors=1, min_umi=4, max_umi=8)
_BASES = "translate(md5(cast({key} as string)), '0123456789abcdef', 'ACGTACGTACGTACGT')"

#: One error in inner5 for every eleventh order, two (one too many) for every thirteenth, one in inner3 for every
#: seventeenth. A read's header is made of its line's keys.
HEADER_SQL = "concat('@', cast(l_orderkey as string), ':', cast(l_linenumber as string), ':', cast(l_partkey as string), ':', cast(l_suppkey as string))"
SEQ_SQL = f"""concat(substr({_BASES.format(key="l_suppkey % 7")}, 1, cast(4 + l_linenumber % 5 as int)),
              CASE WHEN l_orderkey % 11 = 0 THEN 'GAACAGAAACC' WHEN l_orderkey % 13 = 0 THEN 'GATCAGAAACC' ELSE '{INNER5}' END,
              substr({_BASES.format(key="l_partkey % 50")}, 1, 8),
              CASE WHEN l_orderkey % 17 = 0 THEN 'TAGAAGCTTC' ELSE '{INNER3}' END,
              substr({_BASES.format(key="l_suppkey % 3")}, 5, cast(5 + l_linenumber % 4 as int)))"""
READS_SQL = f"""
SELECT {HEADER_SQL} AS header,
       {SEQ_SQL} AS seq
FROM lineitem
"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """header, seq of the synthetic reads. Catalyst reads four columns of the table."""
    query = READS_SQL.replace("FROM lineitem", "FROM {lineitem}")
    return spark.sql(query, lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
