"""What the operators of this subpackage share: the shared work folder, table access and bounded labelled samples."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from umitally.sources.workdir import shared_dir


#: Paths that the innermost open temporary_tables() block of this thread deletes at its end.
_temporary: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what write_table() wrote within the block, but for tables that are to be kept."""
    paths: list[str] = []
    outer = _temporary.set(paths)
    try:
        yield
    finally:
        _temporary.reset(outer)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


def write_table(df: DataFrame, *, compression: str = "zstd", keep: bool = False, files: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts lineage: what follows rereads the files, so a lost executor never forces the work before to run again,
    and values that depend on task order are fixed once. keep: beyond the end of the enclosing temporary_tables(). files: at
    most so many are written, by as many tasks.
    """
    df = df.coalesce(files) if files else df
    path = shared_dir(df.sparkSession)
    paths = _temporary.get()
    if paths is not None and not keep:
        paths.append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch between the JVM and Python. The default of 64 MB is held several times over on both sides.
BATCH_BYTES = 4 << 20


def files_for(df: DataFrame, rows_each: int = 200_000) -> int:
    """How many files the rows of df, a table that is read, take: of about rows_each, or one for each core if that is more."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_each))


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_BYTES; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before each as it takes that df has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, modulus: int) -> F.Column:
    """crc32(id as text) mod modulus; null ids have no fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> F.Column:
    """True for rows whose fold is kept from training; rows without an id are false and are never trained on either."""
    return F.coalesce(fold(column, modulus) == F.lit(remainder), F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, *, modulus: int, remainder: int, limit: int, columns: list[str]) -> pa.Table:
    """At most `limit` labelled training rows: the given columns of docs and `_label`, in an order that is always the same.

    The sample is the `limit` training ids with the smallest xxhash64, so it is spread over the whole table. Only these
    ids (16 bytes each) are broadcast; the texts are scanned once, and one row of each id, whole texts of any length, reaches
    the driver: of rows that repeat an id the one with the least text. Repeated label rows of an id count once, with the
    larger label; null ids, labels and texts are not learnt from.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (fold("doc_id", modulus) != remainder))
        .groupBy("doc_id").agg(F.max(target).cast("int").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    rows = docs.select("doc_id", *columns).where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")
    one = rows.groupBy("doc_id", "_label").agg(F.min(F.struct("text", *(c for c in columns if c != "text"))).alias("_row"))
    return one.select("doc_id", *(F.col(f"_row.{c}").alias(c) for c in columns), "_label").toArrow().sort_by([("doc_id", "ascending")])


def stable_hash(words: list[str]) -> np.ndarray:
    """A stable 64-bit hash of each string, whatever process computes it (xxhash of the UTF-8 bytes)."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of an Arrow string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def positions(nodes: DataFrame, by: list[str], files: int | None = None) -> DataFrame:
    """nodes with pos, the place among the rows of their tree in the order `by`, and total, the number of these."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in (b for b in batches if b.num_rows):
            trees = batch.column(batch.schema.get_field_index("tree")).to_pylist()
            place = np.empty(len(trees), np.int64)
            for i, tree in enumerate(trees):
                last, n = tree, n + 1 if tree == last else 0
                place[i] = n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])

    order = [F.col(c).asc_nulls_first() for c in ["tree", *by]]
    # The number of the range, as a task can write several.
    ranges = nodes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    numbered = write_table(ranges.mapInArrow(number, f"{kind}, part int, place bigint"), files=files)
    counts = numbered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    tree = W.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part")) - F.col("n")
    offsets = write_table(counts.select("tree", "part", before.alias("before"), F.sum("n").over(tree).alias("total")), files=files)
    return numbered.join(offsets, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("place")).drop("part", "place", "before")


#: How to empty what an operator remembers in this Python worker between tasks, by operator.
_remembered: dict[str, Callable[[], None]] = {}


def remember(owner: str, clear: Callable[[], None]) -> None:
    """Say how to empty the owner's cache when a task of another operator runs in this worker."""
    _remembered[owner] = clear


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20, owner: str = "") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that `column` holds about most_bytes or a single row; bounds what one step holds in memory.

    Python workers live on between tasks, so the caches of other operators are emptied first, and at the end of its input
    a task gives unused memory back to the system.
    """
    for other in [x for x in _remembered if x != owner]:
        _remembered.pop(other)()
    for batch in batches:
        k = batch.schema.get_field_index(column)
        n = batch.num_rows
        if not n:
            continue
        _, off = string_buffers(batch.column(k))
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(off, off[at] + most_bytes, "right")) - 1)
            yield batch.slice(at, min(to, n) - at)
            at = to
    release()


def release() -> None:
    """Return free memory of Arrow's pool and of the C library (where it is one that can) to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
