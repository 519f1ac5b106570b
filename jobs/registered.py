"""The jobs as queries: each runs twice over the whole tables into one new folder, and its output is read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobs import lane_tally, segment_audit
from jobs.common import default_config
from umitally.plans import registry, synth
from umitally.sources.workdir import shared_dir


def job1_segment_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of documents and how unevenly each source's texts are copied."""
    folder = shared_dir(spark)
    for _ in range(2):
        segment_audit.run(spark, f"{sf_dir}/documents.parquet", folder, default_config("segment_audit"))
    return spark.read.parquet(f"{folder}/audit").drop("part")


def job2_lane_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The synthetic reads, taken from the table of line items by a stream; the second run finds nothing new."""
    folder = shared_dir(spark)
    config = default_config("lane_tally") | {"header": synth.HEADER_SQL, "seq": synth.SEQ_SQL}
    for _ in range(2):
        # A pattern, as the table may be a single file, of which the stream takes no plain path.
        lane_tally.run(spark, f"{sf_dir}/lineitem.*", f"{folder}/out", f"{folder}/checkpoint", config)
    return spark.read.schema(lane_tally.SUMMARY).parquet(f"{folder}/out/summary").drop("through_batch")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (job1_segment_audit, job2_lane_tally)}


def _audit_sql(rows: str, by: str) -> str:
    """WITH clauses and a query: rows is a table of by, barcode, umi5, umi3 (null where rejected); Gini by its definition."""
    return f"""t AS (SELECT {by}, barcode, umi5, umi3, count(*) AS n FROM {rows} GROUP BY ALL),
        ranks AS (SELECT {by}, n::HUGEINT AS n, row_number() OVER (PARTITION BY {by} ORDER BY n) AS i, count(*) OVER (PARTITION BY {by}) AS k FROM t WHERE barcode IS NOT NULL),
        g AS (SELECT {by}, sum((2 * i - k - 1) * n)::DOUBLE / (max(k) * sum(n))::DOUBLE AS gini, max(n)::BIGINT AS max_reads, count(*)::BIGINT AS n_tuples FROM ranks GROUP BY {by}),
        c AS (SELECT {by}, sum(n)::BIGINT AS n_total, coalesce(sum(n) FILTER (barcode IS NOT NULL), 0)::BIGINT AS n_parsed FROM t GROUP BY {by}),
        b AS (SELECT {by}, barcode, sum(n)::BIGINT AS total_reads, count(*)::BIGINT AS num_unique_umis FROM t WHERE barcode IS NOT NULL GROUP BY ALL)
        SELECT c.{by}, barcode, total_reads, num_unique_umis, n_total, n_parsed, n_total - n_parsed AS n_failed, coalesce(n_tuples, 0) AS n_tuples, coalesce(gini, 'NaN'::DOUBLE) AS gini, coalesce(max_reads, 0) AS max_reads
        FROM c LEFT JOIN g ON g.{by} IS NOT DISTINCT FROM c.{by} LEFT JOIN b ON b.{by} IS NOT DISTINCT FROM c.{by}"""


def oracle_sql() -> dict[str, str]:
    text = registry.TEXT
    a, gap, b = len(text.inner5), text.barcode_length, len(text.inner3)
    return {
        "job1_segment_audit": f"""WITH found AS ({registry.text_anchor_sql(text)}),
            cut AS (SELECT d.source, CASE WHEN f.pos IS NOT NULL THEN substr(text, f.pos + {a + 1}, {gap}) END AS barcode,
                           CASE WHEN f.pos IS NOT NULL THEN md5(substr(text, 1, f.pos)) END AS umi5, CASE WHEN f.pos IS NOT NULL THEN md5(substr(text, f.pos + {a + gap + b + 1})) END AS umi3
                    FROM documents d LEFT JOIN found f USING (doc_id)), {_audit_sql("cut", "source")}""",
        "job2_lane_tally": f"{registry.parse_sql(synth.LAYOUT)}, by_lane AS (SELECT string_split(header, ':')[2] AS lane, barcode, umi5, umi3 FROM parsed), {_audit_sql('by_lane', 'lane')}",
    }
