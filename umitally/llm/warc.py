"""A deterministic sharded WARC writer and its reader.

Writing: the digest of every payload names the record that holds it (the largest id; the others become revisits). Records
are range-sorted by id into shards whose splitters come from a hash-chosen sample, so equal input gives equal shards. A
task streams its shard into gzip members, rolls to a new file when the compressed size is reached, and writes each file
under a temporary name that it renames when the file is whole. Contents do not depend on attempts, so a task that runs
twice replaces a file by an equal one. When a shard's files are whole its task writes a manifest of them, also under a
temporary name. A small root manifest with the number of shards is renamed into place last and is the commit: readers open
what the manifests of its shards list and nothing else. The driver sees sums, never a row a file.

Output goes through pyarrow's file systems (local, HDFS, S3 and others by the scheme of the folder), as Spark has no sink
for binary files.

Defined cases: null or empty payloads are empty payloads and take part in revisits; a null id sorts first and never names
a payload unless all its copies lack an id; a row that repeats an id and a payload is a revisit of the first; rows of one
id with other payloads get record ids of their own; a null URL becomes the record's id; an empty table gives a shard
without files; ids may be integers or strings; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umitally.llm.common import positions, small_batches, temporary_tables

#: Rows of a shard, compressed bytes at which a file is closed, and ids a shard in the splitters' sample.
SHARD_ROWS, ROLL_BYTES, SAMPLE = 4096, 64 << 20, 64
#: Records carry no capture time of their own, and the clock would make files differ.
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "MANIFEST.json"
CRLF = b"\r\n"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(data: bytes, level: int = 6) -> bytes:
    """One gzip member without a time stamp."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_urn(id_) -> str:
    return "urn:nopage" if id_ is None else "urn:page:" + quote(str(id_), safe="")


def record(record_id: str, url: str, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """A response record, or a revisit record, which keeps the HTTP header of the full payload but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    head = {
        "WARC-Type": "revisit" if refers_to else "response",
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": quote(url, safe="%/:=&?~#+!$,;'@()*[]"),
        "WARC-Payload-Digest": "sha1:" + digest32(payload),
        "WARC-Block-Digest": "sha1:" + digest32(block),
    }
    if refers_to:
        head |= {"WARC-Refers-To": f"<{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    return b"WARC/1.1\r\n" + lines + CRLF + block + CRLF + CRLF


def _target(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _put(store: fs.FileSystem, path: str, data: bytes) -> None:
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temporary, compression=None) as f:
        f.write(data)
    store.move(temporary, path)


def shard_manifest(shard: int) -> str:
    return f"shard-{shard:06d}.json"


class _Shard:
    """Files of one shard, written one after another."""

    def __init__(self, uri: str, shard: int, roll: int):
        self.store, self.base = _target(uri)
        self.shard, self.roll, self.made, self.out = shard, roll, [], None

    def add(self, data: bytes) -> None:
        if self.out is not None and self.size + len(data) > self.roll:
            self.close()
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{len(self.made):04d}.warc.gz"
            self.temporary = f"{self.base}/{self.name}.{uuid.uuid4().hex}.tmp"
            self.out, self.size, self.records, self.sha = self.store.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
            self.add_raw(member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:%s>\r\nWARC-Date: %s\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n" % (self.name.encode(), DATE.encode())))
        self.add_raw(data)
        self.records += 1

    def add_raw(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.base}/{self.name}")
            self.made.append({"name": self.name, "bytes": self.size, "records": self.records, "sha256": self.sha.hexdigest()})
            self.out = None

    def commit(self) -> tuple[int, int, int]:
        """Close the shard and write its manifest; numbers of files, records and bytes."""
        self.close()
        _put(self.store, f"{self.base}/{shard_manifest(self.shard)}", json.dumps({"files": self.made}, sort_keys=True).encode())
        return len(self.made), sum(x["records"] for x in self.made), sum(x["bytes"] for x in self.made)


def splitters(pages: DataFrame, id_col: str, shards: int) -> list:
    """shards - 1 ids that cut the table into about equal ranges; the same for equal tables.

    Every id whose hash is under a threshold is taken, SAMPLE a shard, and sorted in ranges; of these the ids at the cuts
    alone reach the driver, one a shard.
    """
    ids = pages.where(F.col(id_col).isNotNull()).select(F.lit("").alias("tree"), F.col(id_col).alias("id")).distinct()
    n = ids.count() if shards > 1 else 0
    if not n:
        return []
    share = min(1.0, SAMPLE * shards / n)
    with temporary_tables(pages.sparkSession):
        placed = positions(ids.where(F.shiftrightunsigned(F.xxhash64("id"), 1).cast("double") <= share * 2.0**63), ["id"])
        # The cut of shard k is the id at total * k div shards.
        cuts = placed.withColumn("k", F.expr(f"(pos * {shards} + total - 1) div total")).where(f"k BETWEEN 1 AND {shards - 1} AND k * total div {shards} = pos")
        return sorted(r["id"] for r in cuts.select("id").collect())


def write_archives(pages: DataFrame, uri: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, shard_rows: int = SHARD_ROWS, roll_bytes: int = ROLL_BYTES) -> dict:
    """Write every row and return the root manifest. Payloads under least_bytes are never revisits.

    The payloads are shuffled once. Which record holds a payload is found from ids and digests alone: a grouped maximum
    that is combined on the map side, joined back to ids and digests, where AQE splits a digest that many rows share.
    """
    small_batches(pages.sparkSession)
    store, base = _target(uri)
    store.create_dir(base, recursive=True)
    kind = pages.schema[id_col].dataType
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.where(F.octet_length("payload") >= least_bytes).select("id", F.sha1("payload").alias("sha1"))
    holders = keyed.groupBy("sha1").agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("sha1", "holder")
    notices = keyed.join(holders, "sha1").where(~F.col("id").eqNullSafe(F.col("holder"))).select("id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "sha1", "holder")
    all_rows = rows.select("*", F.lit(None).cast("string").alias("sha1"), F.lit(None).cast(kind).alias("holder")).unionByName(notices)
    cuts = splitters(pages, id_col, max(1, -(-pages.count() // shard_rows)))

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        out = np.zeros(len(ids), np.int32)
        edges = np.array(cuts, object if isinstance(cuts[0], str) else None)
        out[known] = np.searchsorted(edges, ids[known].to_numpy().astype(edges.dtype), "right")
        return pd.Series(out)

    parted = all_rows.withColumn("shard", shard_of("id") if cuts else F.lit(0)).repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("id", F.col("sha1").isNull(), "sha1", "url", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, notice, seen, nth = _Shard(uri, TaskContext.get().partitionId(), roll_bytes), object(), {}, {}, 0
        for batch in batches:
            for r in batch.to_pylist():
                if r["id"] != last:
                    last, notice, seen, nth = r["id"], {}, {}, 0
                if r["sha1"] is not None:
                    notice[r["sha1"]] = r["holder"]
                    continue
                payload = r["payload"]
                sha = hashlib.sha1(payload).hexdigest()
                name = page_urn(last)
                own = name if not nth else f"{name}:{nth}"
                nth += 1
                refers = None
                if len(payload) >= least_bytes:
                    if sha in notice:
                        refers = page_urn(notice[sha])
                    elif sha in seen:
                        refers = seen[sha]
                    seen.setdefault(sha, own)
                out.add(member(record(own, r["url"] or own, payload, refers)))
        sums = [pa.array([x], pa.int64()) for x in out.commit()]
        yield pa.RecordBatch.from_arrays(sums, ["files", "records", "bytes"])

    made = parted.mapInArrow(write, "files bigint, records bigint, bytes bigint")
    sums = made.agg(F.count(F.lit(1)).alias("shards"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files", "records", "bytes"))).first().asDict()
    if not sums["shards"]:  # no task runs where there is nothing to write
        sums["shards"], _ = 1, _Shard(uri, 0, roll_bytes).commit()
    elif sums["shards"] != len(cuts) + 1:
        raise RuntimeError(f"{sums['shards']} of {len(cuts) + 1} shards have been written")
    _put(store, f"{base}/{MANIFEST}", json.dumps(sums, sort_keys=True).encode())
    return sums


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if line in (CRLF, b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:20]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline()) not in (CRLF, b"\n", b""):
            key, _, value = line.decode().partition(":")
            head[key.strip().lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]):
            raise ValueError("a record is cut short")
        yield head, block


def files_of(store: fs.FileSystem, base: str, shard: int) -> list[dict]:
    """name, bytes, records and sha256 of each file of a shard."""
    with store.open_input_stream(f"{base}/{shard_manifest(shard)}") as f:
        return json.loads(f.read())["files"]


def read_archives(spark: SparkSession, uri: str, *, id_type: T.DataType | None = None) -> DataFrame:
    """A row for each response and revisit record of the files in the manifests; block and payload digests are verified.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits), file.
    """
    import gzip

    id_type = id_type or T.LongType()
    store, base = _target(uri)
    with store.open_input_stream(f"{base}/{MANIFEST}") as f:
        shards = json.loads(f.read())["shards"]
    schema = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary, file string"
    id_of = re.compile(r"<urn:(?:page:([^:]*)|nopage)(?::\d+)?>")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()), ("file", pa.string())])
        store, base = _target(uri)
        named = lambda text: None if text is None or (v := id_of.fullmatch(text)[1]) is None else unquote(v)
        for batch in batches:
            for name in (x["name"] for k in batch.column(0).to_pylist() for x in files_of(store, base, k)):
                out, size = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.open(raw) as stream:
                    for head, block in parse_records(stream):
                        if head["warc-type"] not in ("response", "revisit"):
                            continue
                        if head["warc-block-digest"] != "sha1:" + digest32(block):
                            raise ValueError(f"{name}: the block of {head['warc-record-id']} has another digest")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        whole = head["warc-type"] == "response"
                        if whole and head["warc-payload-digest"] != "sha1:" + digest32(payload):
                            raise ValueError(f"{name}: the payload of {head['warc-record-id']} has another digest")
                        n = len(payload) if whole else int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1])
                        out.append((named(head["warc-record-id"]), head["warc-target-uri"], n, head["warc-payload-digest"][5:], head["warc-type"], named(head.get("warc-refers-to")), payload if whole else None, name))
                        size += len(payload)
                        if size > 8 << 20 or len(out) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=types)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=types)

    # A task a shard, a few shards where there are thousands.
    found = spark.range(0, shards, 1, min(shards, max(1000, -(-shards // 4)))).mapInArrow(rows, schema)
    return found.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))
