"""FASTQ as DataFrames.

Spark's text source reads the files (plain or compressed, from any store) in splits. A record is four lines by count, as
quality lines may begin with "@", so a split must know how many lines come before it. A first pass counts the lines of each
split and keeps its first and last three, which are all that records cut by a split's edge can have in it. A running sum by
file gives each split its offset, and the second pass frames the records inside every split, four lines a step in Arrow; it
looks up the offset once a run of a split's lines. The cut records are put together from the lines of the first pass, so the
input is read twice and never shuffled.

Lines are bytes between the JVM and Python, so headers and qualities that are no UTF-8 keep their bytes. A file whose name
does not tell that it is compressed, but which begins with the two bytes of gzip, is unpacked by one task from Spark's
binary source (of which one file has at most 2 GB).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from umitally.sources.workdir import stored

#: Up to so many splits their offsets are sent to all tasks (32 bytes each); beyond, lines are joined to them by a shuffle.
BROADCAST_SPLITS = 500_000
#: Lines at either end of a split that can belong to records that the split does not hold whole.
EDGE = 3
GZIP = b"\x1f\x8b"
#: Bytes that one step unpacks.
CHUNK = 4 << 20


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """line (bytes), file, start (of the split) of every line, in order within each split."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _unpacked(spark: SparkSession, files: list[str]) -> DataFrame:
    """_lines of gzip files by content; each is one split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rest = b""
                for text in _inflated(memoryview(data.as_buffer())):
                    *lines, rest = (rest + text).split(b"\n")
                    yield made(lines, file)
                if rest:
                    yield made([rest], file)

    def made(lines: list[bytes], file: str) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), pa.array([file] * n, pa.string()), pa.array([0] * n, pa.int64())], ["line", "file", "start"])

    # Paths of metadata are escaped as in URIs; those of readers are not.
    content = spark.read.format("binaryFile").load([unquote(f) for f in files]).select(F.col("_metadata.file_path").alias("file"), "content")
    return content.repartition(len(files), "file").mapInArrow(run, "line binary, file string, start bigint")


def _inflated(data: memoryview) -> Iterator[bytes]:
    """The text of one or more gzip members, a piece at a time."""
    member = zlib.decompressobj(31)
    at = 0
    while at < len(data):
        part = bytes(data[at : at + CHUNK])
        at += len(part)
        while part:
            yield member.decompress(part, CHUNK)
            part = member.unconsumed_tail
            if member.eof:
                part, member = member.unused_data, zlib.decompressobj(31)
    if tail := member.flush():
        yield tail


def _fields(lines: pa.Array) -> pa.Array:
    """Fields end at a carriage return."""
    if lines.null_count == len(lines) or not pc.any(pc.match_substring(lines, "\r")).as_py():
        return lines
    return pa.array([None if x is None else x.split(b"\r", 1)[0] for x in lines.to_pylist()], pa.binary())


def _runs(*columns: pa.Array) -> list[tuple[int, int]]:
    """First and end row of each run of rows that agree in all the columns, none of which is null."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(new)
    return list(zip(at.tolist(), [*at[1:].tolist(), n], strict=True))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, start, n of each split, and its edge lines with their numbers in it."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary())]
    key, n, first, last = None, 0, [], []

    def row():
        at = [*range(len(first)), *range(n - len(last), n)]
        return [pa.array([x], k) for x, k in zip((*key, n, at, first + last), kinds, strict=True)]

    for batch in (b for b in batches if b.num_rows):
        line, file, start = batch.columns
        for i, j in _runs(file, start):
            own = (file[i].as_py(), start[i].as_py())
            if own != key:
                if key is not None:
                    yield pa.RecordBatch.from_arrays(row(), ["file", "start", "n", "at", "lines"])
                key, n, first, last = own, 0, [], []
            part = line.slice(i, j - i)
            k = min(EDGE - len(first), len(part))
            first += _fields(part.slice(0, k)).to_pylist()
            last = (last + _fields(part.slice(max(k, len(part) - EDGE))).to_pylist())[-EDGE:]
            n += len(part)
    if key is not None:
        yield pa.RecordBatch.from_arrays(row(), ["file", "start", "n", "at", "lines"])


def _frame(batches: Iterator[pa.RecordBatch], offsets: dict[int, tuple[int, int]] | None = None) -> Iterator[pa.RecordBatch]:
    """The records that lie whole in a split, from its lines in order with the numbers of lines and of reads before, or with
    the split by which offsets has these."""
    key, at, rest = None, 0, None
    for batch in (b for b in batches if b.num_rows):
        if rest is not None:
            at -= rest.num_rows
            batch = pa.concat_batches([rest, batch])
            rest = None
        line, *keys = batch.columns
        for i, j in _runs(*keys):
            own = tuple(k[i].as_py() for k in keys)
            own = offsets[own[0]] if offsets else own
            if own != key:
                key, at = own, own[0]
            skip = min(-at % 4, j - i)
            whole = (j - i - skip) // 4
            if whole:
                step = i + skip + 4 * np.arange(whole)
                ids = key[1] + (at + skip) // 4 + np.arange(whole)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(_fields(line.take(pa.array(step + k))) for k in (0, 1, 3))], ["read_id", "header", "seq", "qual"])
            end = i + skip + 4 * whole
            at += j - i
            if j == batch.num_rows and end < j:
                rest = batch.slice(end)


def read_fastq(spark: SparkSession, path: str | list[str], *, incomplete: str = "drop") -> DataFrame:
    """read_id, header, seq, qual. read_id numbers the reads in file order, files by name.

    incomplete says what becomes of a last record of fewer than four lines: "drop", or "keep" with empty fields. Fields end
    at a carriage return. Headers, third lines and lengths are not validated. The first pass runs when this is called; its
    result, six lines a split, is kept in the work folder.
    """
    if incomplete not in ("drop", "keep"):
        raise ValueError('incomplete must be "drop" or "keep"')
    edges = "file string, start bigint, n bigint, at array<bigint>, lines array<binary>"
    lines = _lines(spark, path)
    splits = stored(lines.mapInArrow(_edges, edges))
    packed = [r.file for r in splits.where((F.col("start") == 0) & (F.substring(F.get("lines", F.lit(0)), 1, 2) == F.lit(GZIP))).select("file").collect()]
    if packed:
        known, unpacked = ~F.col("file").isin(packed), _unpacked(spark, packed)
        splits = splits.where(known).unionByName(stored(unpacked.mapInArrow(_edges, edges)))
        lines = lines.where(known).unionByName(unpacked)
    in_file = W.partitionBy("file").orderBy("start")
    counts = splits.select("file", "start", "n").withColumn("before", F.sum("n").over(in_file) - F.col("n"))
    files = counts.groupBy("file").agg(F.sum("n").alias("lines"))
    # One row a file: numbers of reads are summed over the files before.
    firsts = files.withColumn("reads", F.ceil(F.col("lines") / 4)).withColumn("first", F.sum("reads").over(W.orderBy("file")) - F.col("reads"))
    key = ["file", "start"]
    offsets = stored(counts.join(firsts, "file").select("file", "start", F.xxhash64(*key).alias("split"), "n", "before", "first"))
    n_splits, n_hashes = offsets.agg(F.count(F.lit(1)), F.count_distinct("split")).first()
    kind = "read_id bigint, header binary, seq binary, qual binary"
    if n_splits <= BROADCAST_SPLITS and n_hashes == n_splits:
        known = spark.sparkContext.broadcast({r.split: (r.before, r.first) for r in offsets.select("split", "before", "first").toLocalIterator()})

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _frame(batches, known.value)

        whole = lines.select("line", F.xxhash64(*key).alias("split")).mapInArrow(placed, kind)
    else:
        joined = lines.withColumn("k", F.monotonically_increasing_id()).join(offsets.hint("merge"), key).repartition(*key).sortWithinPartitions(*key, "k")
        whole = joined.select("line", "before", "first").mapInArrow(_frame, kind)
    number = F.col("before") + F.col("e.at")
    begins = number - number % 4
    loose = splits.select(*key, F.explode(F.arrays_zip("at", "lines")).alias("e")).join(offsets, key)
    loose = loose.where((begins < F.col("before")) | (begins + 3 >= F.col("before") + F.col("n"))).select((F.col("first") + F.floor(number / 4)).alias("read_id"), (number % 4).alias("place"), F.col("e.lines").alias("line"))
    names = ("header", "seq", "plus", "qual")
    cut = loose.groupBy("read_id").agg(*(F.max(F.when(F.col("place") == k, F.col("line"))).alias(name) for k, name in enumerate(names)), F.count(F.lit(1)).alias("lines"))
    cut = cut.where("lines = 4") if incomplete == "drop" else cut
    fields = ("header", "seq", "qual")
    records = whole.unionByName(cut.select("read_id", *fields))
    return records.select("read_id", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in fields))


def write_fastq(reads: DataFrame, path: str, *, compression: str | None = None) -> None:
    """Four lines a read with a bare plus; a folder of part files. Rows keep their order within partitions."""
    text = reads.select(F.concat_ws("\n", *(F.coalesce(c, F.lit("")) for c in (F.col("header"), F.col("seq"), F.lit("+"), F.col("qual")))).alias("value"))
    writer = text.write.mode("errorifexists")
    (writer.option("compression", compression) if compression else writer).text(path)
