"""The registered queries and their SQL.

The SQL is written apart from the engine: it tries every position by unnesting them and counts mismatches with hamming(),
where the engine compares matrices; its Gini ranks all rows, where the engine uses a histogram.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umitally.operators import jackpot, keyed, parse, tally
from umitally.plans import synth
from umitally.plans.layout import ReadLayout
from umitally.run import run
from umitally.sources.fastq import read_fastq, write_fastq
from umitally.sources.sinks import write_counts_tsv, write_rejects
from umitally.sources.workdir import shared_dir

L = synth.LAYOUT
#: Searched alone in whole reads: the anchors of L, and ones for the outer searches (the reads have none of their own).
OUTER = L.with_(outer5="AGAAACC", outer3="GCTTA")
#: Outer anchors in edit mode, short enough to be found in the UMIs of these reads.
EDIT_OUTER = L.with_(outer5="CTA", outer3="GAT", min_umi=0, max_umi=20, max_errors=1, mode="edit")
#: Compared with the beginnings of part names.
NAME_START = "part 1"
#: Whole texts of documents, searched for a joint match.
TEXT = ReadLayout(inner5="tion ", inner3=" the", barcode_length=3, max_errors=1)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _parsed(spark: SparkSession, sf_dir: str, layout: ReadLayout = L) -> DataFrame:
    return parse.parse_reads(synth.reads(spark, sf_dir), layout)


def _tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally.tuple_counts(_parsed(spark, sf_dir))


def _event_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select((F.col("user_id") % 37).cast("string").alias("umi5"), F.col("event_type").alias("barcode"), F.hour("ts").cast("string").alias("umi3"))
    return tally.tuple_counts(events)


def reads_synth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.reads(spark, sf_dir)


def _fastq(spark: SparkSession, sf_dir: str, compression: str | None = None) -> str:
    """A folder with all reads as FASTQ."""
    folder = shared_dir(spark)
    write_fastq(synth.reads(spark, sf_dir).withColumn("qual", F.translate("seq", "ACGT", "@#IN")), folder, compression=compression)
    return folder


def fastq_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all reads as FASTQ and scans them again; read_id depends on the order of the files and is left out."""
    return read_fastq(spark, _fastq(spark, sf_dir)).select("header", "seq", "qual")


def fastq_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_fastq(spark, _fastq(spark, sf_dir, "gzip")).select("header", "seq", "qual")


def rejects_fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected reads written in the order of their line's keys and scanned again, so that read_id is their rank."""
    keys = F.split(F.substring("header", 2, 100), ":")
    # Key by key, as no number holds four keys of any size.
    place = F.struct(*(keys[k].cast("bigint").alias(f"k{k}") for k in range(4)))
    reads = synth.reads(spark, sf_dir).withColumn("qual", F.translate("seq", "ACGT", "@#IN")).withColumn("read_id", place)
    folder = shared_dir(spark)
    write_rejects(parse.split_once(parse.parse_reads(reads, L))[1], folder)
    return read_fastq(spark, folder)


def counts_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts table of a whole run over FASTQ files, as text and back."""
    folder = shared_dir(spark)
    run(spark, _fastq(spark, sf_dir), folder, None, L)
    return spark.read.option("sep", "\t").option("header", True).schema("barcode string, total_reads bigint, num_unique_umis bigint").csv(folder)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a whole run's report."""
    lines = run(spark, _fastq(spark, sf_dir), None, None, L).report.split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "place int, line string")


def _nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those of all reads that are shorter than both anchors: the table is read, and no read is left."""
    return synth.reads(spark, sf_dir).where(F.char_length("seq") < len(L.inner5) + len(L.inner3))


def empty_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts table of no read is its header."""
    folder = shared_dir(spark)
    write_counts_tsv(tally.barcode_summary(tally.tuple_counts(parse.parse_reads(_nothing(spark, sf_dir), L))), folder)
    return spark.read.text(folder)


def hamming_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.bounded_hamming(_table(spark, sf_dir, "part").select("p_partkey", "p_name"), NAME_START, 4, text_col="p_name")


def core_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.core_search(synth.reads(spark, sf_dir), L)


def outer5_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.anchor_search(synth.reads(spark, sf_dir), OUTER.outer5, 1)


def outer3_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.anchor_search(synth.reads(spark, sf_dir), OUTER.outer3, 1)


def parse_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("header", "umi5", "barcode", "umi3")


def parse_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With outer anchors of one base, so that reads are trimmed at both ends or rejected."""
    return _parsed(spark, sf_dir, L.with_(outer5="AC", outer3="GT", min_umi=0, max_umi=20, max_errors=1)).select("header", "umi5", "barcode", "umi3")


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.rejected(_parsed(spark, sf_dir))


def umi_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.accepted(_parsed(spark, sf_dir, L.with_(min_umi=6, max_umi=7))).select("header", "umi5", "barcode", "umi3")


def tuple_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tuples(spark, sf_dir)


def merge_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tallies of reads with and without a first A, merged: the tally of all reads."""
    parsed = _parsed(spark, sf_dir)
    first = F.col("seq").startswith("A")
    return tally.merge_tallies(tally.tuple_counts(parsed.where(first)), tally.tuple_counts(parsed.where(~first)))


def barcode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally.ranked(tally.barcode_summary(_tuples(spark, sf_dir)))


def natural_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally.barcode_summary(_event_tuples(spark, sf_dir))


def gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jackpot.gini(_event_tuples(spark, sf_dir))


def gini_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jackpot.gini_capped(_tuples(spark, sf_dir), 1000)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jackpot.run_summary(_parsed(spark, sf_dir))


def empty_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of no read at all is one row; NaN is told as null, as equal NaNs need not compare equal."""
    return jackpot.run_summary(parse.parse_reads(_nothing(spark, sf_dir), L)).withColumn("gini", F.nanvl("gini", F.lit(None).cast("double")))


def text_anchor_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.core_search(_table(spark, sf_dir, "documents").select("doc_id", "text"), TEXT, text_col="text").select("doc_id", "pos", "e5", "e3")


def parse_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, L.with_(mode="edit")).select("header", "umi5", "barcode", "umi3")


def parse_edit_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outer anchors in edit mode, of which the first acceptable match counts."""
    return _parsed(spark, sf_dir, EDIT_OUTER).select("header", "umi5", "barcode", "umi3")


def hash_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.find(_table(spark, sf_dir, "customer"), _table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


def hash_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order."""
    urgent = _table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return keyed.delete(_table(spark, sf_dir, "customer"), urgent.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


def hash_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, and those in debt once more."""
    customers = _table(spark, sf_dir, "customer")
    return keyed.add(customers, customers.where("c_acctbal < 0"))


def hash_add_inorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return keyed.add_in_order(customers.where("c_custkey % 2 = 0"), customers.where("c_custkey % 2 = 1"), "c_custkey")


def hash_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.count(_table(spark, sf_dir, "customer"))


def hash_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.replace(_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), "o_custkey", ["o_orderdate", "o_orderkey"])


def _upserted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Balances of customers, replaced by the price of their last order of 1995 or later; orders of others are new keys."""
    customers = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit(0).cast("bigint").alias("at"), F.col("c_acctbal").cast("double").alias("v")).where("k % 3 <> 0")
    orders = _table(spark, sf_dir, "orders").where("o_orderdate >= DATE'1995-01-01'").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("at"), F.col("o_totalprice").cast("double").alias("v"))
    return keyed.upsert(customers, orders, "k", ["at"])


def hash_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir)[0]


def hash_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir)[1]


def hash_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.select(_table(spark, sf_dir, "customer"), F.col("c_acctbal") > 0)


def hash_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.sort(_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), F.desc("c_acctbal"), "c_custkey")


_QUERIES = [reads_synth, fastq_roundtrip, fastq_gzip, rejects_fastq, counts_tsv, report, empty_tsv, hamming_bounded, core_search, outer5_find, outer3_find, parse_reads, parse_outer, rejects, umi_bounds, tuple_counts, merge_tallies, barcode_summary, natural_tally, gini, gini_capped, run_summary, empty_input, text_anchor_search, parse_edit, parse_edit_outer, hash_find, hash_delete, hash_add, hash_add_inorder, hash_count, hash_replace, hash_upsert, hash_replaced, hash_select, hash_sort]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def _anchor_sql(source: str, anchor: str, limit: int, begin: str = "0", end: str = "length(seq)") -> str:
    """seq and pos of the best place of one anchor within [begin, end) of each distinct sequence of source."""
    k = len(anchor)
    return f"""SELECT seq, arg_min(p, e * 100000 + p) AS pos
        FROM (SELECT seq, p, hamming(substr(seq, p::INT + 1, {k}), '{anchor}') AS e
              FROM (SELECT seq, unnest(range({begin}, {end} - {k} + 1)) AS p FROM {source}))
        WHERE e <= {limit} GROUP BY seq"""


def _core_sql(layout: ReadLayout) -> str:
    a, b, gap = len(layout.inner5), len(layout.inner3), layout.barcode_length
    return f"""SELECT seq, arg_min(p, (e5 + e3) * 100000 + p) AS pos, arg_min(e5, (e5 + e3) * 100000 + p) AS e5, arg_min(e3, (e5 + e3) * 100000 + p) AS e3
        FROM (SELECT seq, p, hamming(substr(seq, p::INT + 1, {a}), '{layout.inner5}') AS e5, hamming(substr(seq, p::INT + {a + gap + 1}, {b}), '{layout.inner3}') AS e3
              FROM (SELECT seq, unnest(range(0, length(seq) - {a + gap + b} + 1)) AS p FROM u))
        WHERE e5 <= {layout.max_errors} AND e3 <= {layout.max_errors} GROUP BY seq"""


def _edit_sql(layout: ReadLayout) -> str:
    """Joint matches by edit distance: every start, and every length that the errors leave to either anchor, is tried; the
    fewest errors in all win, then the leftmost start; of equally good ends of an anchor that by substitutions alone (the
    length of the anchor) comes before longer and shorter ones, as the pattern search tries substitutions first."""
    a, b, gap, k = len(layout.inner5), len(layout.inner3), layout.barcode_length, layout.max_errors
    order = f"(((e5 + e3) * 1000 + p) * 100 + abs(i - {a}) * 10 + abs(j - {b})) * 10000 + (50 - i) * 100 + 50 - j"
    return f"""SELECT seq, arg_min(p, {order})::INT AS s, arg_min(p + i, {order})::INT AS bc, arg_min(p + i + {gap} + j, {order})::INT AS ce
        FROM (SELECT seq, p, i, j, levenshtein(substr(seq, p::INT + 1, i::INT), '{layout.inner5}') AS e5, levenshtein(substr(seq, (p + i)::INT + {gap + 1}, j::INT), '{layout.inner3}') AS e3
              FROM (SELECT seq, p, i, unnest(range({b - k}, {b + k + 1})) AS j
                    FROM (SELECT seq, p, unnest(range({a - k}, {a + k + 1})) AS i FROM (SELECT seq, unnest(range(0, length(seq))) AS p FROM u)))
              WHERE p + i + {gap} + j <= length(seq))
        WHERE e5 <= {k} AND e3 <= {k} GROUP BY seq"""


def _first_sql(source: str, anchor: str) -> str:
    """part, s and e (start and end) of the first acceptable match of anchor with at most one edit in each part of source.

    By the rules that the search is defined by, told by comparing strings: at a start without an exact match, the first
    difference decides, of which a substitution is tried before an insertion (not of the part's first character) and a
    deletion; a match with an error cannot end before the first difference.
    """
    k = len(anchor)
    return f"""SELECT part, min(p)::INT AS s, arg_min(e, p)::INT AS e FROM (
          SELECT part, p, CASE WHEN substr(rest, 1, {k}) = '{anchor}' THEN p + {k}
                 WHEN same < length(rest) AND substr(rest, same + 2, {k} - same - 1) = substr('{anchor}', same + 2) THEN p + {k}
                 WHEN p + same > 0 AND same < length(rest) AND substr(rest, same + 2, {k} - same) = substr('{anchor}', same + 1) THEN p + {k + 1}
                 WHEN substr(rest, same + 1, {k} - same - 1) = substr('{anchor}', same + 2) THEN p + {k - 1} END AS e
          FROM (SELECT part, p, substr(part, p::INT + 1) AS rest, CASE {" ".join(f"WHEN NOT starts_with(substr(part, p::INT + 1), '{anchor[: i + 1]}') THEN {i}" for i in range(k))} ELSE {k} END AS same
                FROM (SELECT part, unnest(range(0, length(part) + 1)) AS p FROM {source}))) WHERE e IS NOT NULL GROUP BY part"""


def parse_sql(layout: ReadLayout) -> str:
    """WITH clauses that end in parsed: header, seq, umi5, barcode, umi3 (null where rejected) of every read."""
    a, b, gap = len(layout.inner5), len(layout.inner3), layout.barcode_length
    core_end = f"pos + {a + gap + b}"
    out = f"WITH r AS ({synth.READS_SQL}), u AS (SELECT DISTINCT seq FROM r), core AS ({_core_sql(layout)})"
    begin, end, joins = "0", "length(core.seq)", ""
    if layout.outer5:
        out += f", o5 AS ({_anchor_sql('core', layout.outer5, layout.max_errors, end='pos')})"
        joins += " JOIN o5 ON o5.seq = core.seq"
        begin = f"o5.pos + {len(layout.outer5)}"
    if layout.outer3:
        out += f", o3 AS ({_anchor_sql('core', layout.outer3, layout.max_errors, begin=core_end)})"
        joins += " JOIN o3 ON o3.seq = core.seq"
        end = "o3.pos"
    return f"""{out}, cut AS (SELECT core.seq, core.pos, {begin} AS b5, {end} AS e3, core.{core_end} AS ce FROM core{joins}),
        ok AS (SELECT seq, substr(seq, b5::INT + 1, (pos - b5)::INT) AS umi5, substr(seq, pos::INT + {a + 1}, {gap}) AS barcode, substr(seq, ce::INT + 1, (e3 - ce)::INT) AS umi3
               FROM cut WHERE pos - b5 BETWEEN {layout.min_umi} AND {layout.max_umi} AND e3 - ce BETWEEN {layout.min_umi} AND {layout.max_umi}),
        parsed AS (SELECT header, r.seq, umi5, barcode, umi3 FROM r LEFT JOIN ok ON ok.seq = r.seq)"""


def text_anchor_sql(layout: ReadLayout) -> str:
    """doc_id, pos, e5, e3 of the best joint match in each document, by comparing the lists of their characters."""
    cells = "CAST(list_sum(list_transform(range(1, {k} + 1), lambda j : (chars[p + {at} + j] <> chars_{x}[j])::INT)) AS INT)"
    return f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), '') AS chars, string_split('{layout.inner5}', '') AS chars_a, string_split('{layout.inner3}', '') AS chars_b FROM documents),
        p AS (SELECT doc_id, chars, chars_a, chars_b, unnest(range(0, len(chars) - {len(layout.inner5) + layout.barcode_length + len(layout.inner3)} + 1)) AS p FROM d),
        e AS (SELECT doc_id, p, {cells.format(k=len(layout.inner5), at=0, x="a")} AS e5, {cells.format(k=len(layout.inner3), at=len(layout.inner5) + layout.barcode_length, x="b")} AS e3 FROM p),
        b AS (SELECT doc_id, arg_min(p, (e5 + e3) * 10000000 + p)::INT AS pos, arg_min(e5, (e5 + e3) * 10000000 + p) AS e5, arg_min(e3, (e5 + e3) * 10000000 + p) AS e3 FROM e WHERE e5 <= {layout.max_errors} AND e3 <= {layout.max_errors} GROUP BY doc_id)
        SELECT doc_id, pos, e5, e3 FROM documents LEFT JOIN b USING (doc_id)"""


def _gini_sql(counts: str) -> str:
    """By the definition: ranks of all counts in ascending order."""
    return f"""SELECT sum((2 * i - k - 1) * n)::DOUBLE / (max(k) * sum(n))::DOUBLE AS gini
        FROM (SELECT n::HUGEINT AS n, row_number() OVER (ORDER BY n) AS i, count(*) OVER () AS k FROM {counts})"""


def oracle_sql() -> dict[str, str]:
    parsed = parse_sql(L)
    upserted = """WITH c AS (SELECT c_custkey AS k, 0::BIGINT AS at, c_acctbal::DOUBLE AS v FROM customer WHERE c_custkey % 3 <> 0),
        n AS (SELECT o_custkey AS k, max(o_orderkey) AS at, arg_max(o_totalprice, o_orderkey)::DOUBLE AS v FROM orders WHERE o_orderdate >= DATE '1995-01-01' GROUP BY o_custkey)"""
    tuples = "SELECT barcode, umi5, umi3, count(*)::BIGINT AS n FROM {} WHERE barcode IS NOT NULL GROUP BY ALL"
    events = "SELECT event_type AS barcode, (user_id % 37)::VARCHAR AS umi5, hour(ts)::VARCHAR AS umi3 FROM events"
    by_barcode = "SELECT barcode, sum(n)::BIGINT AS total_reads, count(*)::BIGINT AS num_unique_umis FROM {} GROUP BY barcode"
    return {
        "reads_synth": synth.READS_SQL,
        "fastq_roundtrip": f"SELECT header, seq, translate(seq, 'ACGT', '@#IN') AS qual FROM ({synth.READS_SQL})",
        "hamming_bounded": f"SELECT p_partkey, p_name, CASE WHEN length(p_name) >= 6 THEN least(hamming(substr(p_name, 1, 6), '{NAME_START}'), 5)::BIGINT END AS distance FROM part",
        "core_search": f"WITH r AS ({synth.READS_SQL}), u AS (SELECT DISTINCT seq FROM r), c AS ({_core_sql(L)}) SELECT r.header, r.seq, pos::INT AS pos, e5::INT AS e5, e3::INT AS e3 FROM r LEFT JOIN c ON c.seq = r.seq",
        "outer5_find": f"WITH r AS ({synth.READS_SQL}), u AS (SELECT DISTINCT seq FROM r), c AS ({_anchor_sql('u', OUTER.outer5, 1)}) SELECT r.header, r.seq, pos::INT AS pos FROM r LEFT JOIN c ON c.seq = r.seq",
        "outer3_find": f"WITH r AS ({synth.READS_SQL}), u AS (SELECT DISTINCT seq FROM r), c AS ({_anchor_sql('u', OUTER.outer3, 1)}) SELECT r.header, r.seq, pos::INT AS pos FROM r LEFT JOIN c ON c.seq = r.seq",
        "parse_reads": f"{parsed} SELECT header, umi5, barcode, umi3 FROM parsed",
        "parse_outer": f"{parse_sql(L.with_(outer5='AC', outer3='GT', min_umi=0, max_umi=20, max_errors=1))} SELECT header, umi5, barcode, umi3 FROM parsed",
        "rejects": f"{parsed} SELECT header, seq FROM parsed WHERE barcode IS NULL",
        "umi_bounds": f"{parse_sql(L.with_(min_umi=6, max_umi=7))} SELECT header, umi5, barcode, umi3 FROM parsed WHERE barcode IS NOT NULL",
        "fastq_gzip": f"SELECT header, seq, translate(seq, 'ACGT', '@#IN') AS qual FROM ({synth.READS_SQL})",
        "rejects_fastq": f"""{parsed}, k AS (SELECT header, seq, string_split(substr(header, 2), ':') AS key FROM parsed WHERE barcode IS NULL)
            SELECT row_number() OVER (ORDER BY key[1]::BIGINT, key[2]::BIGINT, key[3]::BIGINT, key[4]::BIGINT) - 1 AS read_id, header, seq, translate(seq, 'ACGT', '@#IN') AS qual FROM k""",
        "counts_tsv": f"{parsed}, t AS ({tuples.format('parsed')}) {by_barcode.format('t')}",
        "report": f"""{parsed}, t AS ({tuples.format("parsed")}), g AS ({_gini_sql("t")}), c AS (SELECT count(*) AS n, count(barcode) AS ok FROM parsed),
            lines AS (SELECT [format('Total reads:       {{:,}}', n), format('Parsed:            {{:,}} ({{:.1f}}%)', ok, 100.0::DOUBLE * ok / n), format('Failed:            {{:,}} ({{:.1f}}%)', n - ok, 100.0::DOUBLE * (n - ok) / n),
                format('Distinct tuples:   {{:,}}', (SELECT count(*) FROM t)), format('Distinct barcodes: {{:,}}', (SELECT count(DISTINCT barcode) FROM t)), format('Gini:              {{:.6f}}', gini),
                format('Reads a tuple:     mean {{:.2f}}, max {{:,}}', (SELECT avg(n) FROM t), (SELECT max(n) FROM t))] AS all_lines FROM c, g)
            SELECT place::INT AS place, all_lines[place + 1] AS line FROM lines, range(7) AS r(place)""",
        "empty_tsv": "SELECT concat_ws(chr(9), 'barcode', 'total_reads', 'num_unique_umis') AS value",
        "parse_edit": f"""WITH r AS ({synth.READS_SQL}), u AS (SELECT DISTINCT seq FROM r), c AS ({_edit_sql(L)}),
            ok AS (SELECT seq, substr(seq, 1, s) AS umi5, substr(seq, bc + 1, {L.barcode_length}) AS barcode, substr(seq, ce + 1) AS umi3 FROM c
                   WHERE s BETWEEN {L.min_umi} AND {L.max_umi} AND length(seq) - ce BETWEEN {L.min_umi} AND {L.max_umi})
            SELECT header, umi5, barcode, umi3 FROM r LEFT JOIN ok ON ok.seq = r.seq""",
        "parse_edit_outer": f"""WITH r AS ({synth.READS_SQL}), u AS (SELECT DISTINCT seq FROM r), c AS ({_edit_sql(EDIT_OUTER)}),
            cut AS (SELECT seq, substr(seq, 1, s) AS before, substr(seq, bc + 1, {L.barcode_length}) AS barcode, substr(seq, ce + 1) AS after FROM c),
            p5 AS (SELECT DISTINCT before AS part FROM cut), p3 AS (SELECT DISTINCT after AS part FROM cut), o5 AS ({_first_sql("p5", EDIT_OUTER.outer5)}), o3 AS ({_first_sql("p3", EDIT_OUTER.outer3)}),
            ok AS (SELECT seq, substr(before, o5.e + 1) AS umi5, barcode, substr(after, 1, o3.s) AS umi3 FROM cut JOIN o5 ON o5.part = before JOIN o3 ON o3.part = after)
            SELECT header, umi5, barcode, umi3 FROM r LEFT JOIN ok ON ok.seq = r.seq""",
        "tuple_counts": f"{parsed} {tuples.format('parsed')}",
        "merge_tallies": f"{parsed} {tuples.format('parsed')}",
        "barcode_summary": f"{parsed}, t AS ({tuples.format('parsed')}) {by_barcode.format('t')}",
        "natural_tally": f"WITH e AS ({events}), t AS ({tuples.format('e')}) {by_barcode.format('t')}",
        "gini": f"WITH e AS ({events}), t AS ({tuples.format('e')}) {_gini_sql('t')}",
        "gini_capped": f"{parsed}, t AS ({tuples.format('parsed')}), f AS (SELECT * FROM t ORDER BY barcode, umi5, umi3 LIMIT 1000) {_gini_sql('f')}",
        "run_summary": f"""{parsed}, t AS ({tuples.format("parsed")}), g AS ({_gini_sql("t")}),
            c AS (SELECT count(*)::BIGINT AS n_total, count(barcode)::BIGINT AS n_parsed FROM parsed)
            SELECT n_total, n_parsed, n_total - n_parsed AS n_failed, (SELECT count(*) FROM t)::BIGINT AS n_tuples, (SELECT count(DISTINCT barcode) FROM t)::BIGINT AS n_barcodes,
                   gini, (SELECT avg(n) FROM t) AS mean_reads, (SELECT max(n) FROM t)::BIGINT AS max_reads, 100.0::DOUBLE * n_parsed / n_total AS pct_parsed, 100.0::DOUBLE * (n_total - n_parsed) / n_total AS pct_failed
            FROM c, g""",
        "empty_input": "SELECT 0::BIGINT AS n_total, 0::BIGINT AS n_parsed, 0::BIGINT AS n_failed, 0::BIGINT AS n_tuples, 0::BIGINT AS n_barcodes, NULL::DOUBLE AS gini, 0.0::DOUBLE AS mean_reads, 0::BIGINT AS max_reads, 0.0::DOUBLE AS pct_parsed, 0.0::DOUBLE AS pct_failed",
        "text_anchor_search": text_anchor_sql(TEXT),
        "hash_find": "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
        "hash_delete": "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT')",
        "hash_add": "SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_acctbal < 0",
        "hash_add_inorder": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_custkey",
        "hash_count": "SELECT count(*) AS n FROM customer",
        "hash_replace": "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1",
        "hash_upsert": f"{upserted} SELECT k, coalesce(n.at, c.at) AS at, CASE WHEN n.at IS NULL THEN c.v ELSE n.v END AS v FROM c FULL JOIN n USING (k)",
        "hash_replaced": f"{upserted} SELECT c.k, c.at, c.v FROM c JOIN n USING (k)",
        "hash_select": "SELECT * FROM customer WHERE c_acctbal > 0",
        "hash_sort": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey",
    }
