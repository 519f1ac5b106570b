"""Exact deduplication by content sort.

Equal texts are those that agree after every character of [\\x20\\x09-\\x0D] is deleted. The steps:

1. Each Arrow batch collapses its own equal texts (digest, then full comparison) to one row.
2. The rows left are range-partitioned by splitters that Spark samples from a 64-byte content key, the first 32
   normalised bytes followed by their SHA-256, and a row number. The key is short, so the sample that reaches the driver is
   bounded; texts that only share a beginning still go to different ranges, and a group of equal texts that is a third of
   the corpus is cut into many ranges by its row numbers.
3. Spark's external sort places equals adjacent; neighbours are compared in full and the row that stays is chosen:
   most code points in the original text, then the smallest doc_id (null ids last).
4. Only the first and the last group of a range can go on in the next. These edges, two rows a range, are chained where
   neighbours have one digest, and the members of a chain are grouped by their full normalised texts.

Defined cases: null text is empty; empty texts are one group; rows that repeat an id and a text are one group, of which
one row is kept; ids may be of any type that has an order; an empty table gives no rows; columns beside id and text are
carried by dedup_rows, whatever their names, and never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umitally.llm.common import slices, small_batches, string_buffers, unused, write_table

#: The characters that are deleted before texts are compared.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
PREFIX = 32


def normalise(text: str | None) -> bytes:
    return (text or "").encode().translate(None, WHITE)


def _better(a: tuple, b: tuple) -> bool:
    """Whether (code points, id) a is preferred to b."""
    if a[0] != b[0]:
        return a[0] > b[0]
    if a[1] is None or b[1] is None:
        return b[1] is None and a[1] is not None
    return a[1] < b[1]


#: What a row's group in its batch is told by, after the columns of the row.
_KEYS = {"gid": pa.int64(), "prefix": pa.binary(), "digest": pa.binary(), "points": pa.int64(), "count": pa.int64()}
_KEY_TYPES = [T.LongType(), T.BinaryType(), T.BinaryType(), T.LongType(), T.LongType()]


def _collapse(batches: Iterator[pa.RecordBatch], id_at: int, text_at: int, whole: bool, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns of each row and _KEYS under the given names; only the row that stays of each group of the batch (whole),
    or every row, of which those that do not stay have neither text nor keys but gid."""
    serial = TaskContext.get().partitionId() << 36
    for batch in slices(batches, names[text_at], 2 << 20):
        raw, off = string_buffers(batch.column(text_at))
        ids = batch.column(id_at).to_pylist()
        starts = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        points = starts[off[1:]] - starts[off[:-1]]
        data, groups, norms, leader, digests = raw.tobytes(), {}, [], [], []
        of = np.empty(len(ids), np.int64)
        count = []
        for i, id_ in enumerate(ids):
            norm = data[off[i] : off[i + 1]].translate(None, WHITE)
            digest = hashlib.sha256(norm).digest()
            for g in groups.get(digest, ()):
                if norms[g] == norm:
                    count[g] += 1
                    if _better((points[i], id_), (points[leader[g]], ids[leader[g]])):
                        leader[g] = i
                    break
            else:
                g = len(norms)
                groups.setdefault(digest, []).append(g)
                norms.append(norm), leader.append(i), digests.append(digest), count.append(1)
            of[i] = g
        leads = np.zeros(len(ids), bool)
        leads[leader] = True
        rows = np.flatnonzero(leads) if whole else np.arange(len(ids))
        out = [c.take(pa.array(rows)) for c in batch.columns]
        first = lambda values, kind: pa.array([values[of[i]] if leads[i] else None for i in rows], kind)
        if not whole:
            out[text_at] = pa.array([data[off[i] : off[i + 1]].decode() if leads[i] else None for i in rows], pa.string())
        out += [
            pa.array(serial + of[rows], pa.int64()), first([n[:PREFIX] for n in norms], pa.binary()), first(digests, pa.binary()),
            pa.array([int(points[i]) if leads[i] else None for i in rows], pa.int64()), first(count, pa.int64()),
        ]
        serial += len(norms)
        yield pa.RecordBatch.from_arrays(out, names)


def _sorted_by_content(reps: DataFrame, keys: list[str]) -> DataFrame:
    gid, prefix, digest = keys[:3]
    return reps.repartitionByRange(prefix, digest, gid).sortWithinPartitions(prefix, digest, gid)


class _Text:
    """A group of equal texts of one range: what is known of it so far. gids are at most the rows of the range."""

    def __init__(self, norm: bytes, digest: bytes):
        self.norm, self.digest, self.total, self.gids, self.rank, self.best, self.row = norm, digest, 0, [], None, None, None

    def add(self, rank: tuple, count: int, gid: int, row) -> None:
        self.total += count
        self.gids.append(gid)
        if self.rank is None or _better(rank, self.rank):
            self.rank, self.best, self.row = rank, gid, row()


def _runs(batches: Iterator[pa.RecordBatch], id_at: int, text_at: int, keep_rows: bool) -> Iterator[tuple[list[_Text], int | None]]:
    """The groups of each digest with 0 for the first digest of the range, 1 for the last, None for those between."""
    done, run, place = None, [], 0
    for batch in batches:
        gids, _, digests, points, counts = (c.to_pylist() for c in batch.columns[-len(_KEYS) :])
        raw, off = string_buffers(batch.column(text_at))
        data, ids = raw.tobytes(), batch.column(id_at).to_pylist()
        for i in range(batch.num_rows):
            if run and run[0].digest != digests[i]:
                if done is not None:
                    yield done, place
                    place = None
                done, run = run, []
            norm = data[off[i] : off[i + 1]].translate(None, WHITE)
            text = next((t for t in run if t.norm == norm), None)
            if text is None:
                text = _Text(norm, digests[i])
                run.append(text)
            text.add((points[i], ids[i]), counts[i], gids[i], lambda: batch.slice(i, 1) if keep_rows else None)  # noqa: B023
    if done is not None:
        yield done, place
    if run:
        yield run, 1


def _chains(edges: DataFrame) -> DataFrame:
    """edges (part, place, entry, digest, norm, points, id, total), a row for each group at the edge of a range ->
    entry, keep_id, group_size, best, sha: the groups that they are parts of. best is the entry whose row stays.

    Ranges are in order, so equal texts are in a row of neighbouring edges. Only (part, place, digest) of the edges, two
    rows a range, meet in one task.
    """
    in_order = W.orderBy("part", "place")
    keys = edges.groupBy("part", "place").agg(F.first("digest").alias("digest"))
    new = F.coalesce((F.lag("digest").over(in_order) != F.col("digest")).cast("long"), F.lit(0).cast("long"))
    chain = keys.withColumn("new", new).select("part", "place", F.sum("new").over(in_order).alias("chain"))
    placed = write_table(edges.join(chain, ["part", "place"]))
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("u"), "id", "entry")).alias("b")
    groups = placed.groupBy("chain", "norm").agg(best, F.sum("total").alias("group_size"))
    groups = groups.select("chain", "norm", F.col("b.id").alias("keep_id"), "group_size", F.col("b.entry").alias("best"), F.sha2("norm", 256).alias("sha"))
    return placed.select("entry", "chain", "norm").join(groups, ["chain", "norm"]).select("entry", "keep_id", "group_size", "best", "sha")


def dedup_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its group: id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    names = ["id", "text", *_KEYS]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [kind, T.StringType(), *_KEY_TYPES], strict=True)])
    rows = write_table(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(lambda it: _collapse(it, 0, 1, False, names), schema))

    def decide(batches):
        """A row for each gid, with its group or (entry) the edge that it is at, and a row without gid for each edge."""
        part, out, id_type = TaskContext.get().partitionId(), [], None
        kinds = [pa.int64(), None, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]

        def flush():
            cols = [pa.array(c, k or id_type) for k, c in zip(kinds, zip(*out, strict=True), strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, decided_names)

        def typed():
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        for texts, place in _runs(typed(), 0, 1, False):
            for t in texts:
                if place is None:
                    sha = hashlib.sha256(t.norm).hexdigest()
                    out += [(g, t.rank[1], t.total, t.best, sha, None, None, None, None, None, None) for g in t.gids]
                else:
                    out += [(g, None, None, None, None, t.best, None, None, None, None, None) for g in t.gids]
                    out.append((None, t.rank[1], t.total, None, None, t.best, part, place, t.digest, t.norm, t.rank[0]))
            if len(out) >= 5000:
                yield flush()
        if out:
            yield flush()

    decided_names = ["gid", "keep_id", "group_size", "best", "sha", "entry", "part", "place", "digest", "norm", "points"]
    types = [T.LongType(), kind, T.LongType(), T.LongType(), T.StringType(), T.LongType(), T.IntegerType(), T.IntegerType(), T.BinaryType(), T.BinaryType(), T.LongType()]
    decided = write_table(_sorted_by_content(rows.where("digest IS NOT NULL"), list(_KEYS)).mapInArrow(decide, T.StructType([T.StructField(n, t) for n, t in zip(decided_names, types, strict=True)])))
    edges = _chains(decided.where("gid IS NULL").select("part", "place", "entry", "digest", "norm", "points", F.col("keep_id").alias("id"), F.col("group_size").alias("total")))
    groups = decided.where("gid IS NOT NULL AND entry IS NULL").select("gid", "keep_id", "group_size", "best", "sha")
    groups = groups.unionByName(decided.where("gid IS NOT NULL AND entry IS NOT NULL").select("gid", "entry").join(edges, "entry").drop("entry"))
    members = rows.select("id", "gid", F.col("digest").isNotNull().alias("leads"))
    kept = (F.col("leads") & (F.col("gid") == F.col("best"))).alias("kept")
    return members.join(groups, "gid").select(F.col("id").alias(id_col), "keep_id", "group_size", kept, F.col("sha").alias("text_sha256"))


def dedup_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. The best row of a group so far is all that a task holds of it."""
    small_batches(docs.sparkSession)
    columns, n = docs.columns, len(docs.columns)
    id_at, text_at = columns.index(id_col), columns.index(text_col)
    keys = unused(docs, *_KEYS)
    extra = {"part": pa.int32(), "place": pa.int32(), "entry": pa.int64(), "digest": pa.binary(), "norm": pa.binary(), "points": pa.int64(), "total": pa.int64()}
    names = [*columns, *unused(docs, *extra)]

    def keep(batches):
        """The best row of each group, those at an edge with what tells their group."""
        part, held, edges, size = TaskContext.get().partitionId(), [], [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            cols = [table.column(k).combine_chunks() for k in range(n)] + [pa.array(c, t) for c, t in zip(zip(*edges, strict=True), extra.values(), strict=True)]
            held.clear(), edges.clear()
            return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols], names)

        for texts, place in _runs(batches, id_at, text_at, True):
            for t in texts:
                held.append(t.row)
                edges.append((None,) * len(extra) if place is None else (part, place, t.best, t.digest, t.norm, t.rank[0], t.total))
                size += len(t.norm)
            if len(held) >= 500 or size > 2 << 20:
                yield flush()
                size = 0
        if held:
            yield flush()

    reps = docs.mapInArrow(lambda it: _collapse(it, id_at, text_at, True, [*columns, *keys]), T.StructType([*docs.schema.fields, *(T.StructField(k, t) for k, t in zip(keys, _KEY_TYPES, strict=True))]))
    types = [T.IntegerType(), T.IntegerType(), T.LongType(), T.BinaryType(), T.BinaryType(), T.LongType(), T.LongType()]
    best = write_table(_sorted_by_content(reps, keys).mapInArrow(keep, T.StructType([*docs.schema.fields, *(T.StructField(k, t) for k, t in zip(names[n:], types, strict=True))])))
    at = dict(zip(extra, names[n:], strict=True))
    edges = best.where(F.col(at["place"]).isNotNull())
    stays = _chains(edges.select(*(F.col(name).alias(k) for k, name in at.items()), F.col(f"`{id_col}`").alias("id"))).where("entry = best").select(F.col("entry").alias(at["entry"]))
    quoted = [F.col(f"`{c}`") for c in columns]
    return best.where(F.col(at["place"]).isNull()).select(*quoted).unionByName(edges.join(stays, at["entry"], "left_semi").select(*quoted))
