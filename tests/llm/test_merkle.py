"""The Merkle manifest against a plain tree, row by row."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from test_llm import LONG
from umitally.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def plain_tree(leaves):
    """Root and, for each leaf, the (siblings before, siblings after) of each level."""
    nodes, of, proofs = list(leaves), [[k] for k in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        up, held = [], []
        for k in range(0, len(nodes), 3):
            run = nodes[k : k + 3]
            for i in range(len(run)):
                for leaf in of[k + i]:
                    proofs[leaf].append((run[:i], run[i + 1 :]))
            up.append(h(*run))
            held.append(sum(of[k : k + 3], []))
        nodes, of = up, held
    return (nodes or [""])[0], proofs


def plain_manifest(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, plain_leaf(r, r[1]), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names}
    root, above = plain_tree([trees[s][0] for s in names])
    out = []
    for s, outer in zip(names, above, strict=True):
        for (_, _, leaf, r), inner in zip(sorted(sources[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            tampered = r[1].replace("\n", "") if r[1] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[1]
            digest = plain_leaf(r, tampered)
            for before, after in inner + outer:
                digest = h(*before, digest, *after)
            out.append((r[0], leaf, trees[s][0], root, h(*(x for level in inner + outer for side in level for x in side)), digest, digest == root))
    return sorted(out, key=repr)


def manifest(spark, rows, levels=merkle.LEVELS, **extra):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(extra)
    return sorted((tuple(r) for r in merkle.manifest(docs, levels).collect()), key=repr)


def made(n, sources, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice([None, "", "a\nb\n", "é\n🙂", "plain", f"t{i}\n"]), rng.choice([None, "en", "de"]), rng.choice(sources), rng.choice([None, 3, -1])) for i in rng.sample(range(10 * n + 10), n)]


@pytest.mark.parametrize(("n", "sources"), [(1, ["s"]), (2, ["s"]), (3, [None]), (4, ["a", None]), (60, [f"s{k}" for k in range(40)]), (1100, ["hot"] * 9 + [None, "", "é", "z"]), (800, ["hot"] + [f"s{k}" for k in range(300)])])
def test_manifest(spark, n, sources):
    rows = made(n, sources, n)
    assert manifest(spark, rows) == plain_manifest(rows)


@pytest.mark.parametrize("levels", [1, 2])
def test_blocks_of_blocks(spark, levels):
    """Blocks of three or nine nodes: several passes of traversals over one source, and over the sources."""
    rows = made(600, ["hot"] * 40 + [f"s{k}" for k in range(30)])
    assert manifest(spark, rows, levels) == plain_manifest(rows)


def test_many_partitions(spark):
    """Several ranges and blocks a task, as there are fewer files than partitions."""
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    rows = made(700, ["hot"] * 40 + [f"s{k}" for k in range(30)])
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert manifest(spark, rows, 2) == plain_manifest(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_edges(spark):
    """Null ids, repeated rows and ids, a very long text, columns whose names clash with the operator's own."""
    rows = [(None, "x\n", "en", "a", 1), (None, None, None, "a", None), (5, "one\n", "en", "a", 1), (5, "two\n", "en", "a", 1), (5, "two\n", "en", "a", 1), (6, LONG + "\n", "en", None, 9), (-3, "", "", "", 0)]
    extra = {c: F.lit("own") for c in ("tree", "digest", "tampered", "pos", "total", "block", "proof", "subroot", "root", "leaf", "part", "place", "of")}
    assert manifest(spark, rows, **extra) == plain_manifest(rows)
    assert manifest(spark, []) == []


@pytest.mark.parametrize("kind", ["int", "string", "date", "decimal(20,0)"])
def test_ids_of_any_type(spark, kind):
    cast = F.date_add(F.lit("2020-01-01").cast("date"), F.col("doc_id").cast("int")) if kind == "date" else F.col("doc_id").cast(kind)
    docs = spark.createDataFrame(made(30, ["a", None]), SCHEMA).withColumn("doc_id", cast)
    got = merkle.manifest(docs)
    assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType and got.count() == 30
    assert {r.verified for r in got.collect()} <= {True, False} and got.select("root").distinct().count() == 1
