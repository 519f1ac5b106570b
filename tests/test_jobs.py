"""The jobs: two runs over growing input, runs that fail in between, reruns, edge cases and the command line."""

import json
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from jobs import lane_tally, segment_audit
from jobs.common import default_config, read_config
from test_match import plain_parse
from test_queries import canonical
from umitally.operators import jackpot
from umitally.plans import synth

SF = "/root/testdata/sf0.001"
CONFIG = default_config("lane_tally")
#: What the tables of reads in these tests hold.
READS = "header string, seq string"


@pytest.fixture(scope="module")
def reads(spark):
    return [(r.header, r.seq) for r in synth.reads(spark, SF).orderBy("header").limit(1500).collect()] + [("@9:7:1:1", "ACGT"), ("", None), ("@x", "AAAA")]


def plain_gini(counts):
    counts = sorted(counts)
    return sum((2 * i - len(counts) - 1) * c for i, c in enumerate(counts, 1)) / (len(counts) * sum(counts)) if counts else None


def by_hand(rows):
    """The summary of rows (lane, barcode, umi5, umi3), read by read."""
    total, tuples = Counter(), defaultdict(Counter)
    for lane, *key in rows:
        total[lane] += 1
        tuples[lane][tuple(key)] += key[0] is not None
    out = set()
    for lane, n in total.items():
        counts = {k: c for k, c in tuples[lane].items() if k[0] is not None}
        rest = (n, sum(counts.values()), n - sum(counts.values()), len(counts), round(plain_gini(counts.values()), 9) if counts else None, max(counts.values(), default=0))
        barcodes = {k[0] for k in counts}
        out |= {(lane, b, sum(c for k, c in counts.items() if k[0] == b), sum(k[0] == b for k in counts), *rest) for b in barcodes or ([None] if not counts else [])} if barcodes else {(lane, None, None, None, *rest)}
    return out


def lanes_by_hand(reads):
    rows = []
    for header, seq in reads:
        parts = header[1:].split(":")
        u5, b, u3 = (plain_parse(seq, synth.LAYOUT) if seq is not None else None) or (None, None, None)
        rows.append((parts[1] if len(parts) > 1 and parts[1] else "none", b, u5, u3))
    return by_hand(rows)


def summary(spark, out):
    columns = ["lane", "barcode", "total_reads", "num_unique_umis", "n_total", "n_parsed", "n_failed", "n_tuples", "gini", "max_reads"]
    rows = spark.read.schema(lane_tally.SUMMARY).parquet(f"{out}/summary").select(*columns).collect()
    assert len(set(map(tuple, rows))) == len(rows) or any(r.gini != r.gini for r in rows)
    return {tuple(None if v != v else round(v, 9) if isinstance(v, float) else v for v in r) for r in rows}


def add(spark, rows, folder):
    spark.createDataFrame(rows, READS).coalesce(1).write.mode("append").parquet(str(folder))


def files(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_lanes_of_growing_input(spark, reads, tmp_path):
    """Each run reads new files alone and replaces the lanes that have new counts alone."""
    incoming, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    later = [r for r in reads if r[0].split(":")[1:2] in (["1"], ["2"])][40:]
    first = [r for r in reads if r not in set(later)]
    add(spark, first, incoming)
    assert lane_tally.run(spark, incoming, out, mark, CONFIG)["reads"] == len(first)
    assert summary(spark, out) == lanes_by_hand(first)
    before = files(out)
    assert lane_tally.run(spark, incoming, out, mark, CONFIG) == {"reads": 0, "lanes": []} and files(out) == before
    add(spark, later, incoming)
    assert lane_tally.run(spark, incoming, out, mark, CONFIG) == {"reads": len(later), "lanes": ["1", "2"]}
    assert summary(spark, out) == lanes_by_hand(reads)
    kept = {p for p in before if p in files(out)}
    assert before.keys() - kept == {p for p in before if "/summary/lane=1/" in str(p) or "/summary/lane=2/" in str(p)}


def test_lanes_after_failures(spark, reads, tmp_path, monkeypatch):
    """A batch that fails after it wrote runs again and replaces itself; a run that fails before the summary is made up for."""
    incoming, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    add(spark, reads[:600], incoming)
    add(spark, reads[600:], incoming)
    config = CONFIG | {"files_a_batch": 1}
    write, made = DataFrameWriter.parquet, []

    def fails_once(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        made.append(path)
        if len(made) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(DataFrameWriter, "parquet", fails_once)
    with pytest.raises(Exception, match="lost"):
        lane_tally.run(spark, incoming, out, mark, config)
    assert not Path(out, "summary").exists()
    assert lane_tally.take_new(spark, incoming, out, mark, config) > 0
    assert lane_tally.run(spark, incoming, out, mark, config)["reads"] == 0
    assert summary(spark, out) == lanes_by_hand(reads) and len(list(Path(out, "tuples").glob("batch=*"))) == 2


def test_lanes_of_nothing(spark, tmp_path):
    incoming, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    add(spark, [], incoming)
    assert lane_tally.run(spark, incoming, out, mark, CONFIG) == {"reads": 0, "lanes": []}


TEXTS = [("a", "one tion abc the two"), ("a", "one tion abc the two"), ("a", "nothing here"), (None, "tion é🙂x the"), (None, None), ("", "x tion abc the y"), ("", ""), ("w/eird=ö", "no segment"), ("a", "one tiom abc thf two")]


def audit_of(spark, out):
    rows = spark.read.parquet(f"{out}/audit").select("source", "barcode", "total_reads", "num_unique_umis", "n_total", "n_parsed", "n_failed", "n_tuples", "gini", "max_reads").collect()
    return {tuple(None if v != v else round(v, 9) if isinstance(v, float) else v for v in r) for r in rows}


def test_segment_audit_and_rerun(spark, tmp_path):
    docs, out = str(tmp_path / "docs"), str(tmp_path / "out")
    spark.createDataFrame(TEXTS, "source string, text string").withColumns({"part": F.lit(1), "n": F.lit("x")}).write.parquet(docs)
    rows = [(s, *((m.group(0)[5:8], t[: m.start()], t[m.end() :]) if (m := re.search("tio[nm] ... th[ef]", t or "")) else (None, None, None))) for s, t in TEXTS]
    for _ in range(2):
        told = segment_audit.run(spark, docs, out, default_config("segment_audit"))
        assert audit_of(spark, out) == by_hand(rows)
    assert told == {"documents": len(TEXTS), "tuples": len(set(rows)), "audit": len(by_hand(rows))}
    spark.createDataFrame([], "source string, text string").write.mode("overwrite").parquet(docs)
    assert segment_audit.run(spark, docs, out, default_config("segment_audit")) == {"documents": 0, "tuples": 0, "audit": 0}


def test_audit_by_several_columns(spark):
    rows = [("x", None, "b", "u", "v", 3), ("x", None, "b", "u", "w", 1), ("x", None, None, None, None, 4), ("x", 1, "c", "u", "v", 2), (None, None, None, None, None, 5)]
    got = {tuple(r)[:9] for r in jackpot.audit(spark.createDataFrame(rows, "p string, q int, barcode string, umi5 string, umi3 string, n bigint"), ["p", "q"]).collect()}
    assert got == {("x", None, "b", 4, 2, 8, 4, 4, 2), ("x", 1, "c", 2, 1, 2, 2, 0, 1), (None, None, None, None, None, 5, 0, 5, 0)}


def test_settings_stay(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    add(spark, [("@1:2:3:4", "ACGT")], tmp_path / "in")
    lane_tally.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"), CONFIG)
    assert spark.conf.get(key) == before


def test_registered_jobs_against_sql(spark):
    import duckdb

    from jobs import registered

    con = duckdb.connect()
    for name in ("documents", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    for name, query in registered.queries().items():
        got, want = query(spark, SF).toPandas(), con.execute(registered.oracle_sql()[name]).df()
        numbers = lambda df: df.astype({c: float for c in df.columns if df[c].dtype != object and df[c].dtype.kind in "iuf"})
        assert sorted(got.columns) == sorted(want.columns) and canonical(numbers(got)) == canonical(numbers(want))


def test_command_line(spark, tmp_path):
    """A process of its own, with a config of its own that Spark reads."""
    config = default_config("segment_audit")
    (tmp_path / "config.json").write_text(json.dumps(config))
    assert read_config(spark, str(tmp_path / "config.json")) == config
    spark.createDataFrame(TEXTS, "source string, text string").write.parquet(str(tmp_path / "docs"))
    root = Path(__file__).resolve().parent.parent
    args = [sys.executable, "-m", "jobs.segment_audit", "--documents", str(tmp_path / "docs"), "--output", str(tmp_path / "out"), "--config", str(tmp_path / "config.json")]
    done = subprocess.run(args, cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "read 9 documents" in done.stderr, done.stderr[-2000:]
    assert spark.read.parquet(str(tmp_path / "out" / "audit")).count() > 0
