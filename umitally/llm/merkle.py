"""A Merkle manifest of a dataset: a digest of each row, a tree over the rows of each source, and a tree over the sources.

H is the lowercase hexadecimal SHA-256 of its inputs one after the other, digests as hexadecimal text. A row's leaf is H of its
values, each `-` if it is null and else its UTF-8 byte count, a colon and the value. A tree takes nodes in order: every three
consecutive ones (the last run: fewer, even one) become their H until one remains; a lone leaf is its own root. The proof of a
leaf is the siblings on its way to the root.

* Order. Leaves are range-partitioned and sorted by (source, doc_id, leaf) and numbered within each range; ranges are counted
  by source, and a running sum over the counts gives positions. Texts stay where they are: leaves are made in the JVM, and
  ids and digests alone are shuffled.
* Traversal. A block is an aligned run of 3^LEVELS nodes of one tree, so it is exactly one node LEVELS levels up. Each block
  is visited in postorder by recursion, which returns the digest of the subtree and, while it unwinds, appends the siblings of
  each child to the leaves that the child contains. The roots of blocks are the leaves of another such distributed traversal,
  and so on until a tree has one node.
* Proofs. From the top down, each block gets the proof of its root once and appends it to the proofs within the block, so
  proofs are never stored for each row: a task holds those of one block.

A hot source is many blocks. Nothing but the root of all sources, 64 bytes, reaches the driver.

Defined cases: null values are `-`, empty ones `0:`; a null source is a source of its own, before all others; null ids come
first in a source; rows that repeat an id are ordered by their leaves, equal leaves are interchangeable; an empty table gives no
rows; texts may be of any length; columns that the leaf does not name are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from umitally.llm.common import files_for, positions, small_batches, temporary_tables, write_table

#: Children of a node, and levels of a block.
WAYS, LEVELS = 3, 5
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: A level of a proof: the siblings before and after, as text.
Proof = list[tuple[str, str]]
_PROOF = "array<struct<before:string,after:string>>"


def leaf(*values: Column) -> Column:
    """H of the values."""
    text = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def combined(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels_of(total: int, most: int) -> int:
    """Levels above the leaves of a tree, or of a block of a larger one."""
    levels = 0
    while total > 1 and levels < most:
        total, levels = -(-total // WAYS), levels + 1
    return levels


def traverse(digests: list[str], levels: int, proofs: list[Proof] | None = None) -> str:
    """The root of a block of leaves. proofs, one list a leaf, get the siblings of each level."""

    def visit(level: int, at: int) -> str:
        if not level:
            return digests[at]
        span = WAYS ** (level - 1)
        children = [visit(level - 1, c) for c in range(WAYS * at, min(WAYS * at + WAYS, -(-len(digests) // span)))]
        if proofs is not None:
            for i in range(len(children)):
                siblings = "".join(children[:i]), "".join(children[i + 1 :])
                first = (WAYS * at + i) * span
                for k in range(first, min(first + span, len(digests))):
                    proofs[k].append(siblings)
        return combined(children)

    return visit(levels, 0)


def folded(digest: str, proof: Proof) -> str:
    """The root that a leaf's digest and its proof lead to."""
    for before, after in proof:
        digest = sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


def proof_digest(proof: Proof) -> str:
    return combined([x for level in proof for x in level])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows that follow each other and agree in the keys."""
    run: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if run and any(row[k] != run[-1][k] for k in keys):
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _block(levels: int) -> Column:
    return F.expr(f"pos div {WAYS**levels}")


def _blocks(nodes: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """run over nodes, which come by blocks in order; a block is within one task."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(run, schema)


def _up(nodes: DataFrame, levels: int) -> DataFrame:
    """tree, pos, total, digest of the roots of the blocks of nodes (tree, pos, total, digest)."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["tree", "pos", "total", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _runs(batches, ["tree", "block"]):
            out.append((rows[0]["tree"], rows[0]["block"], -(-rows[0]["total"] // WAYS**levels), traverse([r["digest"] for r in rows], levels_of(rows[0]["total"], levels))))
            if len(out) >= 1000:
                yield batch(out)
                out = []
        yield batch(out)

    return _blocks(nodes.select("tree", "pos", "total", "digest", _block(levels).alias("block")), run, "tree string, pos bigint, total bigint, digest string")


def climb(leaves: DataFrame, levels: int, files: int | None) -> list[DataFrame]:
    """The leaves (tree, pos, total, digest) and the roots of their blocks, level by level, up to one node a tree."""
    out = [leaves]
    while out[-1].where("total > 1").limit(1).count():
        out.append(write_table(_up(out[-1], levels), files=files))
    return out


def descend(nodes: DataFrame, above: DataFrame, levels: int, finish: Callable[[dict, Proof, dict], tuple] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """tree, pos, proof (and the other columns of above) of each node, from those of the roots of the nodes' blocks.

    finish makes a row of schema from a node, its proof and the block's row of above, in place of these columns.
    """
    rest = [c for c in above.columns if c not in ("tree", "pos", "proof")]
    if finish is None:
        schema = above.schema
        at = {c: i for i, c in enumerate(above.columns)}

        def finish(node: dict, proof: Proof, of: dict) -> tuple:
            told = of | {"tree": node["tree"], "pos": node["pos"], "proof": [{"before": a, "after": b} for a, b in proof]}
            return tuple(told[c] for c in at)

    kinds = to_arrow_schema(schema)
    # A block's row of above comes before its nodes.
    head = above.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("bigint").alias("pos"), "proof", *rest)
    own = nodes.withColumn("block", _block(levels))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], kinds.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for of, *rows in _runs(batches, ["tree", "block"]):
            proofs: list[Proof] = [[] for _ in rows]
            traverse([r["digest"] for r in rows], levels_of(rows[0]["total"], levels), proofs)
            tail = [(x["before"], x["after"]) for x in of["proof"]]
            out += (finish(r, p + tail, of) for r, p in zip(rows, proofs, strict=True))
            if len(out) >= 1000:
                yield batch(out)
                out = []
        yield batch(out)

    return _blocks(own.unionByName(head, allowMissingColumns=True), run, schema)


def source_key(source: Column) -> Column:
    """A text that orders as sources do, null first."""
    return F.coalesce(F.concat(F.lit("x"), source.cast("string")), F.lit(""))


def root_and_proofs(leaves: DataFrame, finish: Callable[[dict, Proof, dict], tuple], schema: T.StructType, levels: int = LEVELS, files: int | None = None) -> DataFrame:
    """A row by finish(leaf's row, proof, {"subroot", "root"}) for each leaf (tree, doc_id, digest and more columns). files: the
    most files of each table on the way."""
    low = climb(write_table(positions(leaves, ["doc_id", "digest"], files), files=files), levels, files)
    tops = low[-1].select("tree", F.col("digest").alias("subroot"))
    sources = climb(write_table(positions(tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("digest")), ["of"], files), files=files), levels, files)
    first = sources[-1].select("digest").first()
    root = first["digest"] if first else ""
    above = sources[-1].select("tree", "pos", F.array().cast(_PROOF).alias("proof"))
    for nodes in reversed(sources[1:-1]):
        above = write_table(descend(nodes, above, levels), files=files)
    if len(sources) > 1:
        above = write_table(descend(sources[0].select("tree", "pos", "total", "digest"), above, levels), files=files)
    of_source = sources[0].select(F.col("of").alias("tree"), "pos", F.col("digest").alias("subroot")).join(above.select("pos", "proof"), "pos")
    above = write_table(of_source.select("tree", F.lit(0).cast("bigint").alias("pos"), "proof", "subroot", F.lit(root).alias("root")), files=files)
    for nodes in reversed(low[1:-1]):
        above = write_table(descend(nodes, above, levels), files=files)
    return descend(low[0], above, levels, finish, schema)


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 of every row, and the proof's trial: folded_root, verified.

    The trial takes the digest of a text without its line feeds where 2 divides the CRC-32 of the decimal doc_id (null ids
    are not tampered with), folds it with the proof of the untampered row, and compares what comes out with the root.
    The result is written; the tables on the way to it are deleted.
    """
    small_batches(docs.sparkSession)
    values = lambda text: [text if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    own = F.col("doc_id").cast("string")
    tampered = F.coalesce(F.crc32(own.cast("binary")) % 2 == 0, F.lit(False)) & F.coalesce(F.instr("text", "\n") > 0, F.lit(False))
    rows = docs.select(
        source_key(F.col("source")).alias("tree"), "doc_id", leaf(*values(F.col("text"))).alias("digest"),
        F.when(tampered, leaf(*values(F.replace("text", F.lit("\n"), F.lit(""))))).alias("tampered"),
    )
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), T.StructField("verified", T.BooleanType())])

    def finish(row: dict, proof: Proof, of: dict) -> tuple:
        found = folded(row["tampered"] or row["digest"], proof)
        return row["doc_id"], row["digest"], of["subroot"], of["root"], proof_digest(proof), found, found == of["root"]

    with temporary_tables(docs.sparkSession):
        files = files_for(docs)
        return write_table(root_and_proofs(rows, finish, schema, levels, files), keep=True, files=files)
