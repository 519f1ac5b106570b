"""Exact n-gram Jaccard join in the Jaccard metric.

Sets are the distinct 5-word shingles of a document as 64-bit hashes. Two documents link when 100 * |x & y| >= 75 * |x | y|,
which is a Jaccard distance of at most a quarter.

* Pivots. Nearly all pairs of documents are at distance 1, where whole documents make useless pivots: every document would
  be a boundary document of every region. The first pivots are therefore the sets of a single shingle. Such a pivot is at
  distance 1 - 1/|x| from the sets that hold it and at 1 from the rest; a document's region is the first of its shingles
  in one global order, and the window that a partner can be in replicates it to the regions of its first
  |x| - ceil(0.75 |x|) + 1 shingles: partners always meet in the region of a shingle of both windows. The order puts
  frequent shingles last, by a sketch that counts all shingles of the corpus, so passages that many documents share
  make no region. Any order gives exact results; the sketch only decides how large regions are.
* Region sizes are counted exactly. A region of at most SMALL sets is joined directly.
* Voronoi regions. A larger region gets a document as its pivot, that which lies in the most large regions, as it is likely
  to be central. Each set belongs to the Voronoi region of one pivot, that with which it shares the most of its regions, and
  is compared with it in full, so its distance from the pivot is exact. What links is closed into components.
* Recursion. What is left of a region is asked to join its largest component by another pivot out of that, where bit vectors
  let the two link, level by level, as long as many sets are asked and link.
* Boundary. A set that is not of a region's largest component can have partners in each Voronoi region that the region's
  sets belong to. It is replicated to those whose radius and its distance from the pivot allow a partner (the triangle
  inequality, with a lower bound of the distance), and meets there the sets whose distance from the pivot differs by no more
  than the threshold. Sizes and bit vectors decide which of these pairs may link: 1024 bits in the join, then LONG_EACH bits a
  shingle, which leave few pairs that do not link.
* Closing. What may link is compared a pair for each set and each two components a time; what links is closed, and pairs
  inside a component fall away. So comparisons follow the number of sets and not that of links.
* Comparison. Bit k of a set's parity vector tells whether an odd number of its shingles fall into bucket k, so two vectors
  differ in no more bits than the sets in shingles: a lower bound of their distance.

No pair is dropped, capped or sampled. Copies collapse before anything is shuffled and are one set throughout; pairs
inside a component that is already known are not compared, as they change no component.

Defined cases: null text, empty text and text of white space have no shingle and link with nothing; fewer than five words
are one shingle; rows that repeat an id or a text are joined like others; a null id is never a component's name unless
all its members lack one; ids may be of any type that has an order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umitally.llm.common import release, slices, small_batches, temporary_tables, unused, write_table
from umitally.llm.components import components, merged



@dataclass(frozen=True)
class Rule:
    """Sets of shingles of so many words link when DENOMINATOR * intersection >= numerator * union."""

    words: int = 5
    numerator: int = 75

    @property
    def linked(self) -> str:
        """The condition on columns common and total."""
        return f"{DENOMINATOR} * common >= {self.numerator} * total"

    def sizes(self, a: str, b: str) -> Column:
        return DENOMINATOR * F.least(a, b) >= self.numerator * F.greatest(a, b)

    def enough(self, common, total):
        """Whether sets whose sizes add up to total can link if they share at most so many shingles; numbers, arrays or columns."""
        return (DENOMINATOR + self.numerator) * common >= self.numerator * total


DENOMINATOR = 100
FIVE_WORDS = Rule()
#: Counters of the corpus sketch (16 MB whatever the corpus), and its blocks, which are summed apart.
COUNTERS, COUNTER_BLOCKS = 1 << 22, 64
#: Sketches of partitions that one task sums.
FAN_IN = 512
#: Classes under this are rare: chance alone may explain a counter. They tell counts in steps of a standard deviation.
FREQUENT = 8
#: Sets of a region that is joined directly, at most.
SMALL = 32
#: Bits of a set's parity vector for each shingle, at least (a power of two in all), of all sets and of those of large
#: regions; words of the short vectors of joins.
BITS_EACH, LONG_EACH, SHORT = 4, 16, 16
#: Another level of pivots follows while the sets that ask for one are at least one in so many of those of large regions,
#: and one in so many of those asked has linked; LEVELS bounds the levels, as the boundary join ends the recursion exactly.
#: Pairs that may link are compared one for each set a time while one in YIELD of them links; then all that are left.
FEW, YIELD, LEVELS = 64, 8, 12
#: Keys up to this number and so many bytes are broadcast to fetch their texts or shingles; more are joined by a shuffle.
BROADCAST_IDS, BROADCAST_BYTES = 1_000_000, 32 << 20
CACHE = 200_000
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_MIX, _HALF = np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, cached: _WordHash, words: int = FIVE_WORDS.words) -> np.ndarray:
    """Ascending distinct hashes. bytes.lower() folds A-Z alone and bytes.split() splits at [\\x20\\x09-\\x0D]+."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cached.__getitem__, tokens), np.uint64, len(tokens))
    n = min(words, len(h))
    span = len(h) - n + 1
    s = np.full(span, n, np.uint64)
    for j in range(n):
        s += h[j : j + span] * (_MULTIPLIERS[j % 5] + np.uint64(2 * (j // 5)))
    for _ in range(2):
        s = (s ^ (s >> _HALF)) * _MIX
    return np.unique(s ^ (s >> _HALF))


def set_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def window(n: int, rule: Rule = FIVE_WORDS) -> int:
    """How many first shingles a set of n is replicated by: n - ceil(0.75 n) + 1."""
    return n - -(-rule.numerator * n // DENOMINATOR) + 1


def _sketch_slots(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def frequency_sketch(docs: DataFrame, words: int = FIVE_WORDS.words) -> np.ndarray:
    """Counts of all shingles of all documents in COUNTERS slots.

    Blocks of slots are summed in parallel; the sketches of very many partitions are summed in groups of FAN_IN first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached, total = _WordHash(), np.zeros(COUNTERS, np.uint32)
        for batch in slices(batches, "text"):
            found = {}
            for t in batch.column(0).to_pylist():
                s = shingles(t, cached, words)
                found[set_id(s)] = s  # copies in a batch count once
            total += np.bincount(_sketch_slots(np.concatenate(list(found.values()))), minlength=COUNTERS).astype(np.uint32)
        parts = np.split(np.minimum(total, 65535).astype(np.uint16), COUNTER_BLOCKS)  # one task's count of 65535 is frequent in any case
        group = TaskContext.get().partitionId() // FAN_IN
        yield pa.RecordBatch.from_pydict({"block": pa.array(range(COUNTER_BLOCKS), pa.int32()), "counts": pa.array([p.tobytes() for p in parts], pa.binary()), "part": pa.array([group] * COUNTER_BLOCKS, pa.int32())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for b, c, part in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                short = len(c) * COUNTER_BLOCKS // COUNTERS == 2
                total[b, part] = total.get((b, part), 0) + np.frombuffer(c, np.uint16 if short else np.uint32).astype(np.uint64)
        yield pa.RecordBatch.from_pydict({"block": pa.array([b for b, _ in total], pa.int32()), "counts": pa.array([np.minimum(t, 2**32 - 1).astype(np.uint32).tobytes() for t in total.values()], pa.binary()), "part": pa.array([p for _, p in total], pa.int32())})

    kind = "block int, counts binary, part int"
    sketches = docs.select("text").mapInArrow(count, kind)
    if docs.rdd.getNumPartitions() > FAN_IN:
        sketches = sketches.repartition("block", "part").mapInArrow(add, kind).withColumn("part", F.lit(0))
    blocks = sketches.repartition("block").mapInArrow(add, kind).toArrow()
    out = np.zeros(COUNTERS, np.uint32)
    step = COUNTERS // COUNTER_BLOCKS
    for b, c in zip(blocks["block"].to_pylist(), blocks["counts"].to_pylist(), strict=True):
        out[b * step : (b + 1) * step] += np.frombuffer(c, np.uint32)
    return out


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """The place of each slot's shingles in the order: by steps of the count's deviation from the usual load, up to three
    (rare shingles); counts beyond what chance explains by their logarithm (frequent shingles)."""
    load = float(np.median(counts))
    sigma = max(1.0, np.sqrt(load))
    steps = np.clip(np.ceil((counts - load) / sigma) - 1, 0, FREQUENT - 1)
    rare = counts <= load + 3 * sigma + 4
    return np.where(rare, steps, np.log2(np.maximum(counts, 1)) + FREQUENT).astype(np.uint8)


def parities(s: np.ndarray, bits: int | None = None, each: int = BITS_EACH) -> bytes:
    """The parity vector, 2^k >= each * n bits; the vector of half its length is the exclusive or of its halves."""
    bits = bits or max(256, 1 << (each * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def windows(docs: DataFrame, classes: np.ndarray, rule: Rule = FIVE_WORDS) -> DataFrame:
    """key, n, sid of every row (docs: key, text); the first row of a set in a batch also has its parity vector and window."""
    kind = docs.schema["key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached, of = _WordHash(), shared.value
        for batch in slices(batches, "text", 2 << 20):
            seen, n, sid, parity, rare, frequent = set(), [], [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingles(t, cached, rule.words)
                n.append(len(s))
                key = set_id(s) if len(s) else None
                sid.append(key)
                if key is None or key in seen:
                    parity.append(None), rare.append(None), frequent.append(None)
                    continue
                seen.add(key)
                c = of[_sketch_slots(s)]
                # Shingles ascend, so a stable sort by class orders by class and hash; only the window is needed.
                order = np.argsort(c, kind="stable")[: window(len(s), rule)]
                first, k = s[order].view(np.int64), int((c[order] < FREQUENT).sum())
                rare.append(first[:k])
                frequent.append(first[k:] if k < len(first) else None)
                parity.append(parities(s))
            lists = lambda x: pa.array(x, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict({"key": batch.column(0), "n": pa.array(n, pa.int64()), "sid": pa.array(sid, pa.int64()), "parity": pa.array(parity, pa.binary()), "rare": lists(rare), "frequent": lists(frequent)})

    return docs.select("key", "text").mapInArrow(run, f"key {kind}, n bigint, sid bigint, parity binary, rare array<bigint>, frequent array<bigint>")


def _reachable(i, j, a, b, rule: Rule) -> np.ndarray:
    """Whether sets of sizes a and b can link if they share the shingle at places i and j of their orders."""
    return rule.enough(np.minimum(i, j) + np.minimum(a - i, b - j), a + b)


def regions(entries: DataFrame, rule: Rule, small: int = SMALL) -> DataFrame:
    """token, sid, n, other from entries (token, sid, n, place): the pairs of regions of at most `small` sets and the rows of
    larger ones.

    place is that of the token in the set's order, or 0 where tokens have no order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _regions(batches, rule, small)

    return entries.repartition("token").sortWithinPartitions("token", "sid").mapInArrow(run, "token bigint, sid bigint, n bigint, other bigint")


def _regions(batches: Iterator[pa.RecordBatch], rule: Rule = FIVE_WORDS, small: int = SMALL) -> Iterator[pa.RecordBatch]:
    """Rows (token, sid, n, place), sorted by token and sid, a run of equal tokens a region. Copies of a row count once.

    Of a region of at most `small` sets: the pairs sid < other whose sizes and places let them link, without token, distinct
    within about a million. Of a larger one: its rows, as they come, so that a region of any size takes no memory.
    """
    held: list[np.ndarray] = []
    names = ["token", "sid", "n", "other"]

    def rows(token, sid, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(sid), pa.array(n), pa.nulls(len(sid), pa.int64())], names)

    def drain() -> Iterator[pa.RecordBatch]:
        pairs = np.unique(np.concatenate(held), axis=0) if held else np.zeros((0, 2), np.int64)
        held.clear()
        if len(pairs):
            none = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(pairs[:, 0]), none, pa.array(pairs[:, 1])], names)

    def whole(token, sid, n, place) -> Iterator[pa.RecordBatch]:
        """Whole regions."""
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        size = np.repeat(np.diff(np.append(first, len(token))), np.diff(np.append(first, len(token))))
        large = size > small
        if large.any():
            yield rows(token[large], sid[large], n[large])
        few = (size > 1) & ~large
        token, sid, n, place = token[few], sid[few], n[few], place[few]
        for step in range(1, small):
            i = np.flatnonzero(token[step:] == token[:-step]) if len(token) > step else np.zeros(0, np.int64)
            j = i + step
            ok = (DENOMINATOR * np.minimum(n[i], n[j]) >= rule.numerator * np.maximum(n[i], n[j])) & _reachable(place[i], place[j], n[i], n[j], rule)
            if ok.any():
                held.append(np.stack([sid[i[ok]], sid[j[ok]]], axis=1))  # a region's sids ascend

    rest, hot, before = [np.zeros(0, np.int64)] * 4, None, None
    for batch in (b for b in batches if b.num_rows):
        cols = [np.concatenate((r, c.to_numpy(zero_copy_only=False).astype(np.int64))) for r, c in zip(rest, batch.columns, strict=True)]
        token, sid = cols[:2]
        fresh = np.append((token[0], sid[0]) != before, (token[1:] != token[:-1]) | (sid[1:] != sid[:-1]))
        before = None
        cols = [c[fresh] for c in cols]
        if hot is not None:  # the region that the rows before belong to is large already
            same = int(np.searchsorted(cols[0], hot, "right"))
            if same:
                yield rows(*(c[:same] for c in cols[:3]))
                before = (hot, int(cols[1][same - 1]))
            cols = [c[same:] for c in cols]
        if len(cols[0]):
            hot, before = None, None
            last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last region may go on
            yield from whole(*(c[:last] for c in cols))
            rest = [c[last:] for c in cols]
            if len(rest[0]) > small:
                yield rows(*rest[:3])
                hot, before = int(rest[0][-1]), (int(rest[0][-1]), int(rest[1][-1]))
                rest = [np.zeros(0, np.int64)] * 4
        else:
            rest = cols
            before = before or (token[-1], sid[-1])
        if sum(map(len, held)) > 1_000_000:
            yield from drain()
    yield from whole(*rest)
    yield from drain()
    release()


def _entries(found: DataFrame, column: str) -> DataFrame:
    return found.where(f"{column} IS NOT NULL").select("sid", "n", F.posexplode(column).alias("pos", "token")).select("token", "sid", "n", F.col("pos").cast("bigint").alias("place"))


def _most_common(n: str, other_n: str, v: str, other_v: str) -> Column:
    """The most shingles that sets of these sizes and parity vectors can have in common."""
    apart = sum(F.bit_count(F.get(v, F.lit(k)).bitwiseXOR(F.get(other_v, F.lit(k)))) for k in range(SHORT))
    return F.least((F.col(n) + F.col(other_n) - apart) / 2, F.col(n), F.col(other_n))


def _parities_fit(na: pd.Series, nb: pd.Series, a: pd.Series, b: pd.Series, rule: Rule = FIVE_WORDS) -> pd.Series:
    """Whether sets of these sizes that differ in at least as many shingles as their vectors do in bits can link."""
    apart = np.empty(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
        while len(x) != len(y):
            if len(x) < len(y):
                x, y = y, x
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        apart[i] = np.bitwise_count(x ^ y).sum()
    total = (na + nb).to_numpy()
    return pd.Series(rule.enough(total - apart, 2 * total))


def may_link(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """pairs (a, b) whose parity vectors let them link; sets has sid, n, parity."""

    @F.pandas_udf("boolean")
    def fits(na: pd.Series, nb: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return _parities_fit(na, nb, a, b, rule)

    of = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"v{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(fits("na", "nb", "va", "vb")).select("a", "b")


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, x, y = batch.columns
        common, na, nb = [], [], []
        for p, q in zip(x, y, strict=True):
            p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (p, q))
            if len(p) > len(q):
                p, q = q, p
            at = np.searchsorted(q, p)
            at[at == len(q)] = 0
            common.append(int((q[at] == p).sum()) if len(q) else 0)
            na.append(len(p)), nb.append(len(q))
        yield pa.RecordBatch.from_pydict({"a": a, "b": b, "common": pa.array(common, pa.int64()), "total": pa.array(np.array(na, np.int64) + np.array(nb, np.int64) - np.array(common, np.int64), pa.int64())})
    release()


def is_small(keys: DataFrame) -> bool:
    """Whether keys may be broadcast: at most BROADCAST_IDS rows, and BROADCAST_BYTES with 16 bytes a row besides its values."""
    width = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns)
    n, size = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(width + 16), F.lit(0))).first()
    return n <= BROADCAST_IDS and size <= BROADCAST_BYTES


def compare(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """a, b, common, total (sizes of intersection and union) of each pair; contents has sid and its shingles as bytes.

    Only the sets that take part are shuffled.
    """
    pairs = write_table(pairs)
    few = is_small(pairs)

    def side(of: str, shingles: str) -> DataFrame:
        ids = pairs.select(F.col(of).alias("sid")).distinct()
        return contents.join(F.broadcast(ids) if few else ids, "sid", "left_semi").select(F.col("sid").alias(of), F.col("shingles").alias(shingles))

    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(_overlaps, "a bigint, b bigint, common bigint, total bigint")


def _contents(docs: DataFrame, members: DataFrame, sids: DataFrame, rule: Rule) -> DataFrame:
    """sid, n, shingles, short and parity (vectors) of the given sets, from the text of one row of each; written, as several
    joins read it. sids: sid, long (whether its parity vector is needed)."""
    wanted = members.where("parity IS NOT NULL").join(sids, "sid").groupBy("sid").agg(F.min("key").alias("key"), F.max("long").alias("long"))
    keys = write_table(wanted.groupBy("key").agg(F.max("long").alias("long")))
    few = is_small(keys)
    rows = docs.select("key", "text")
    # Rows without a key cannot be named, so all of them are read.
    named = rows.where("key IS NOT NULL").join(F.broadcast(keys) if few else keys, "key")
    texts = named.select("text", "long").unionByName(rows.where("key IS NULL").select("text", F.lit(True).alias("long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = _WordHash()
        for batch in slices(batches, "text", 2 << 20):
            seen, out = set(), []
            for t, long in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingles(t, cached, rule.words)
                if len(s) and (k := set_id(s)) not in seen:
                    seen.add(k)
                    out.append((k, len(s), s.tobytes(), np.frombuffer(parities(s, 64 * SHORT), np.int64), parities(s, each=LONG_EACH) if long else None))
            if out:
                sid, n, data, bits, parity = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict({"sid": pa.array(sid, pa.int64()), "n": pa.array(n, pa.int64()), "shingles": pa.array(data, pa.binary()), "short": pa.array(bits, pa.list_(pa.int64())), "parity": pa.array(parity, pa.binary())})

    found = texts.mapInArrow(run, "sid bigint, n bigint, shingles binary, short array<bigint>, parity binary")
    # Only rows that repeat a key, or have none, can give one set twice.
    repeats = docs.groupBy("key").count().where("count > 1 OR key IS NULL").limit(1).count()
    return write_table(found.dropDuplicates(["sid"]) if repeats else found, compression="lz4")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """a, b, ra, rb: pairs that lie in different components, with the roots of these, ra < rb."""
    of = lambda x: labels.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
    joined = pairs.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))
    return joined.where("ra <> rb").select("a", "b", F.least("ra", "rb").alias("ra"), F.greatest("ra", "rb").alias("rb"))


def close(pairs: DataFrame, contents: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """labels with the links among pairs that may link.

    Each round compares one pair of each set, of those between the same two components only one, and closes what links;
    pairs inside a component are not compared. When few of a round's pairs link, all that are left are compared.
    """
    left = write_table(_across(pairs, labels))
    n = left.count()
    while n:
        one = left.groupBy("b").agg(F.min(F.struct(F.xxhash64("a", "b"), "a", "ra", "rb")).alias("p")).select("b", "p.a", "p.ra", "p.rb")
        asked = write_table(one.groupBy("ra", "rb").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b"))
        links = write_table(compare(asked, contents).where(rule.linked).select("a", "b"))
        labels = merged(labels, links)
        left = write_table(_across(left.join(asked, ["a", "b"], "left_anti"), labels))
        if links.count() * YIELD < asked.count():
            return merged(labels, compare(left.select("a", "b"), contents).where(rule.linked).select("a", "b"))
        n = left.count()
    return labels


def _rooted(large: DataFrame, labels: DataFrame) -> DataFrame:
    """large (token, sid, n) with the root of each set's component."""
    return large.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))


def _first_pivots(large: DataFrame) -> DataFrame:
    """sid, n, pivot: each set's Voronoi region. large: token, sid, n, met (how many large regions the set lies in).

    Regions are grouped with map-side minima and counts, and a region's pivot is joined back to it, so a region of very many
    sets is no hot task. A pivot may lie in another pivot's region.
    """
    pivots = write_table(large.groupBy("token").agg(F.max(F.struct("met", F.xxhash64("sid"), "sid"))["sid"].alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1").select("token", "pivot"))
    shared = large.join(pivots, "token").groupBy("sid", "n", "pivot").agg(F.count(F.lit(1)).alias("shared"))
    best = F.max(F.struct("shared", F.col("sid") == F.col("pivot"), F.xxhash64("pivot"), "pivot"))["pivot"]
    return write_table(shared.groupBy("sid", "n").agg(best.alias("pivot")))


def _largest(rooted: DataFrame) -> DataFrame:
    """token, largest: the root of the largest component of each region that holds several."""
    parts = rooted.groupBy("token", "root").agg(F.count(F.lit(1)).alias("size"))
    return parts.groupBy("token").agg(F.max_by("root", F.struct("size", "root")).alias("largest"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("token", "largest")


def _asked(large: DataFrame, labels: DataFrame, tried: DataFrame, level: int, rule: Rule) -> DataFrame:
    """(a, b): each set outside the largest component of a region, with the pivot out of such a component with which it
    shares the most regions, if sizes allow a link and the two have not met before."""
    rooted = write_table(_rooted(large, labels))
    members = F.struct(F.xxhash64("sid", F.lit(level)).alias("h"), "sid", "n")
    parts = rooted.groupBy("token", "root").agg(F.count(F.lit(1)).alias("size"), F.min(members).alias("at"))
    best = parts.groupBy("token").agg(F.max(F.struct("size", "root", "at")).alias("best"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    pivots = best.select("token", F.col("best.root").alias("largest"), F.col("best.at.sid").alias("pivot"), F.col("best.at.n").alias("pivot_n"))
    open_ = rooted.join(pivots, "token").where((F.col("root") != F.col("largest")) & rule.sizes("n", "pivot_n"))
    shared = open_.groupBy(F.col("sid").alias("a"), F.col("pivot").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    met = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return write_table(shared.join(met, ["a", "b"], "left_anti").groupBy("a").agg(F.max(F.struct("shared", F.xxhash64("b"), "b"))["b"].alias("b")))


def _boundary_pairs(large: DataFrame, homes: DataFrame, contents: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of large regions that may link and that components still tell apart; homes: sid, n, pivot, distance."""
    eps = 1 - rule.numerator / DENOMINATOR + 1e-9
    vector = contents.select("sid", "short")
    rooted = write_table(_rooted(large, labels))
    entries = write_table(rooted.join(_largest(rooted), "token"))
    minors = write_table(entries.where("root <> largest").select("token", "sid"))
    cells = homes.groupBy("pivot").agg(F.max("distance").alias("radius"), F.min("n").alias("least_n"), F.max("n").alias("most_n"))
    with_n = homes.select(F.col("sid").alias("pivot"), F.col("n").alias("pn")).join(vector.select(F.col("sid").alias("pivot"), F.col("short").alias("pv")), "pivot")
    about = write_table(cells.join(with_n, "pivot"))
    met = write_table(entries.select("token", "sid").join(homes.select("sid", "pivot"), "sid").select("token", "pivot").distinct())
    sides = homes.select("sid", "n").join(vector, "sid").join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    asking = sides.join(minors.select("sid").distinct(), "sid", "left_semi").withColumnRenamed("short", "v")
    common = _most_common("n", "pn", "v", "pv")
    # The least distance from the pivot that sizes and parity vectors allow.
    replicas = (
        minors.join(met, "token").select("sid", "pivot").distinct().join(asking, "sid").join(about, "pivot")
        .where((F.col("n") * DENOMINATOR >= F.col("least_n") * rule.numerator) & (F.col("most_n") * DENOMINATOR >= F.col("n") * rule.numerator))
        .withColumn("from", F.greatest(F.lit(0.0), 1 - common / (F.col("n") + F.col("pn") - common))).where(F.col("from") <= F.col("radius") + eps)
        .select("pivot", F.col("sid").alias("a"), F.col("n").alias("na"), F.col("v").alias("va"), F.col("root").alias("ra"), "from")
    )
    home = homes.select("sid", "pivot", "distance").join(sides, "sid").select("pivot", F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("short").alias("vb"), F.col("root").alias("rb"), "distance")
    fits = rule.enough(_most_common("na", "nb", "va", "vb"), F.col("na") + F.col("nb"))
    pairs = write_table(replicas).join(write_table(home), "pivot").where((F.col("ra") != F.col("rb")) & (F.col("distance") >= F.col("from") - eps) & rule.sizes("na", "nb") & fits)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_regions(docs: DataFrame, members: DataFrame, near: DataFrame, large: DataFrame, rule: Rule, screen: Callable[[DataFrame], DataFrame] = lambda pairs: pairs) -> DataFrame:
    """node, root of every set that links with another, from the pairs of small regions that may link and the sets (token,
    sid, n) of large regions; screen keeps the pairs that a test of the caller's own lets link.

    docs: key, text; members: key, sid, parity (not null for one row of each set at least).
    """
    large = write_table(large.join(large.groupBy("sid").agg(F.count(F.lit(1)).alias("met")), "sid"))
    homes = _first_pivots(large)
    sids = near.select(F.col("a").alias("sid")).unionByName(near.select(F.col("b").alias("sid"))).withColumn("long", F.lit(False)).unionByName(homes.select("sid", F.lit(True).alias("long")).unionByName(homes.select(F.col("pivot").alias("sid"), F.lit(True).alias("long"))))
    contents = _contents(docs, members, sids.groupBy("sid").agg(F.max("long").alias("long")), rule)
    stars = homes.where("sid <> pivot").select(F.col("sid").alias("a"), F.col("pivot").alias("b"))
    compared = write_table(compare(stars, contents))
    labels = components(compared.where(rule.linked).select("a", "b"))
    long = contents.where("parity IS NOT NULL").select("sid", "n", "parity")
    n_sets, tried = homes.count(), compared.select("a", "b")
    for level in range(LEVELS):
        asked = _asked(large, labels, tried, level, rule)
        n = asked.count()
        if not n or n * FEW < n_sets:
            break
        links = write_table(compare(screen(may_link(asked, long, rule)), contents).where(rule.linked).select("a", "b"))
        labels, tried = merged(labels, links), tried.unionByName(asked)
        if links.count() * YIELD < n:
            break
    distances = compared.select(F.col("a").alias("sid"), F.col("b").alias("pivot"), (1 - F.col("common") / F.col("total")).alias("distance"))
    placed = write_table(homes.join(distances, ["sid", "pivot"], "left").select("sid", "n", "pivot", F.coalesce("distance", F.lit(0.0)).alias("distance")))
    boundary = screen(may_link(_boundary_pairs(large, placed, contents, labels, rule), long, rule))
    return close(near.select("a", "b").unionByName(boundary).distinct(), contents, labels, rule)


def link_components(docs: DataFrame, rule: Rule = FIVE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(members, labels): key, n, sid of every row of docs (key, text); node, root of every set that links with another."""
    small_batches(docs.sparkSession)
    classes = frequency_classes(frequency_sketch(docs, rule.words))
    members = write_table(windows(docs, classes, rule))
    found = write_table(regions(_entries(members, "rare"), rule))
    sets = write_table(members.where("parity IS NOT NULL").select("sid", "n", "parity").dropDuplicates(["sid"]))
    near = write_table(may_link(found.where("token IS NULL").select(F.col("sid").alias("a"), F.col("other").alias("b")).distinct(), sets, rule))
    frequent = _entries(members, "frequent").select("token", "sid", "n").dropDuplicates(["token", "sid"])
    large = write_table(found.where("token IS NOT NULL").select("token", "sid", "n").unionByName(frequent))
    return members, link_regions(docs, members, near, large, rule)


def classes_of(members: DataFrame, labels: DataFrame, least: Column) -> DataFrame:
    """sid, component: of all rows (key, sid of members) that links connect, what `least`, an aggregate of key, gives of the
    set and, applied to these, of the component.

    The named sets are written, so that the join reads plain shuffles, of which AQE splits the one that holds a component of
    very many sets.
    """
    named = members.where("sid IS NOT NULL").groupBy("sid").agg(least.alias("key")).join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    named = write_table(named)
    of_root = write_table(named.groupBy("root").agg(least.alias("component")))
    return named.select("sid", "root").join(of_root, "root").select("sid", "component")


def jaccard_classes(docs: DataFrame, rule: Rule = FIVE_WORDS, link: Callable[[DataFrame, Rule], tuple[DataFrame, DataFrame]] = link_components) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach, itself included) of every row.

    The result is written; the tables on the way to it are deleted.
    """
    with temporary_tables(docs.sparkSession):
        members, labels = link(docs.select(F.col("doc_id").alias("key"), "text"), rule)
        rows = members.select("key", F.col("n").alias("n_shingles"), "sid")
        of_set = classes_of(members, labels, F.min("key"))
        component = F.when(F.col("sid").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id")
        return write_table(rows.join(of_set, "sid", "left").select(F.col("key").alias("doc_id"), "n_shingles", component), keep=True)


def dedup_rows(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns: of each component that with the smallest doc_id, null ids last; of rows
    that repeat this id, that whose text has the smallest MD5.

    Rows are told by id and MD5 of the text, which the JVM computes, so that texts do not move and an unrelated row that
    repeats an id that goes stays. Rows equal in both stay or go together, as exact deduplication comes before. Rows without
    shingles stay.
    """
    row_key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("md5"))
    with temporary_tables(docs.sparkSession):
        members, labels = link_components(docs.select(row_key.alias("key"), "text"))
        of_set = classes_of(members, labels, F.min("key"))
        gone = members.select("key", "sid").join(of_set, "sid").where("key <> component").select("key").distinct()
        gone = write_table(gone, keep=True)
    few = is_small(gone.select("key.id", F.hex("key.md5").alias("md5")))
    (key,) = unused(docs, "_key")
    gone = gone.withColumnRenamed("key", key)
    return docs.withColumn(key, row_key).join(F.broadcast(gone) if few else gone, key, "left_anti").drop(key)
