"""MinHash near-deduplication with SetSketch registers.

Sets are the distinct 2-word shingles of a document as 64-bit hashes. Two documents link when 100 * |x & y| >= 80 * |x | y|.

* Registers. Each shingle is a Poisson process: its hash gives arrival times, and to each of them one of REGISTERS registers.
  A register's time is the least of a set's arrivals in it, so it is the minimum of an exponential variable of each shingle,
  as if each had been drawn for each register. Times are kept on an exponential scale, floor(1 - log_BASE(time)), truncated to
  16 bits. The registers of a union are the larger of the registers of its parts (merge()), and a register of two sets is
  equal about as often as their similarity. Arrivals are made up to a time by which nearly every register has one, REGISTERS *
  (ln REGISTERS + 3) a set whatever its size; sets that miss a register are made again with later times, so no register
  depends on the batch it was made in.
* Bands. BAND registers make a key. Documents that share a key meet in its region; of a pair at similarity 0.8 no key of all
  BANDS agrees with a probability of (1 - 0.8^6)^42 = 3e-6, of pairs above with less. This is the only chance in the result
  besides the screen below.
* Estimate. Of pairs that meet, the similarity is estimated jointly by likelihood from the numbers of registers that are
  larger, smaller and equal, with both sizes known. Pairs whose estimate is SIGMAS standard deviations (of an estimate at the
  threshold) under the threshold are not compared; a true link falls there once in a billion pairs.
* Verification. Links are confirmed on the full sets of shingles. A region of two sets is joined directly. In a larger one
  each set is compared with one pivot, and components are closed as in the n-gram Jaccard join (jaccard.link_regions), so a
  group of thousands of near copies takes comparisons in proportion to its size, and no partner is capped.

Copies in a batch collapse before registers are made, and sets before keys are, so a group of copies is one set in all
regions.

Defined cases: null text, empty text and text of white space have no shingle and link with nothing; one word is one shingle;
rows that repeat an id or a text are joined like others; a null id is never a component's name unless all its members lack
one, and is kept only where it equals that name; ids may be of any type that has an order; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umitally.llm.common import slices, small_batches, write_table
from umitally.llm.jaccard import Rule, jaccard_classes, link_regions, regions, set_id, shingles
from umitally.llm.jaccard import _WordHash as WordHash

TWO_WORDS = Rule(words=2, numerator=80)
#: Registers of a sketch (a power of two), the base of their scale, the rate of a shingle in each, and their largest value.
REGISTERS, BASE, RATE, LARGEST = 256, 1.001, 20.0, (1 << 16) - 1
#: Registers of a band; how many bands there are.
BAND = 6
BANDS = REGISTERS // BAND
#: Standard deviations by which an estimate may miss the threshold.
SIGMAS = 6.0
#: Sets of a region that is joined directly, at most. Near copies meet in many bands, so larger regions have pivots.
SMALL = 2
#: Arrivals that one step makes, about.
STEP = 1 << 16
_GOLDEN, _MIX_1, _MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _MIX_1
    z = (z ^ (z >> np.uint64(27))) * _MIX_2
    return z ^ (z >> np.uint64(31))


def _times(sets: list[np.ndarray], until: np.ndarray) -> np.ndarray:
    """The least arrival in each register of each set, of arrivals up to the set's time; infinite where there is none."""
    least = np.full(len(sets) * REGISTERS, np.inf)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    h, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    t, k, scale = np.zeros(len(h)), np.uint64(0), 1 / (RATE * REGISTERS)
    while len(h):
        steps = min(256, max(1, STEP // len(h)))
        z = _mixed(h[:, None] + _GOLDEN * (k + np.arange(1, steps + 1, dtype=np.uint64)))
        arrivals = np.cumsum(np.log(((z >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52) * -scale, axis=1) + t[:, None]
        row, step = np.nonzero(arrivals <= until[of][:, None])
        np.minimum.at(least, of[row] * REGISTERS + (z[row, step] & np.uint64(REGISTERS - 1)).astype(np.int64), arrivals[row, step])
        t, k = arrivals[:, -1], k + np.uint64(steps)
        go_on = t <= until[of]
        h, of, t = h[go_on], of[go_on], t[go_on]
    return least.reshape(len(sets), REGISTERS)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of REGISTERS 16-bit registers for each set of hashes, none of which is empty."""
    if not sets:
        return np.zeros((0, REGISTERS), np.uint16)
    least, todo, more = np.empty((len(sets), REGISTERS)), np.arange(len(sets)), 1.0
    while len(todo):
        some = [sets[i] for i in todo]
        least[todo] = _times(some, more * (np.log(REGISTERS) + 3) / (RATE * np.fromiter(map(len, some), np.int64, len(some))))
        todo, more = todo[np.isinf(least[todo]).any(axis=1)], 2 * more
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, LARGEST).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def bands(found: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each row."""
    values = found[:, : BANDS * BAND].reshape(len(found), BANDS, BAND).astype(np.uint64)
    keys = np.zeros(values.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(BAND):
        keys = _mixed(keys * _GOLDEN + values[:, :, j])
    return keys.view(np.int64)


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def estimate(na: np.ndarray, nb: np.ndarray, larger: np.ndarray, smaller: np.ndarray, rounds: int = 40) -> np.ndarray:
    """The similarity that makes so many larger and smaller registers of a the likeliest, the sizes of both sets being known.

    The logarithm of the likelihood is concave, so its slope is bisected.
    """
    u, v = na / (na + nb), nb / (na + nb)
    equal = REGISTERS - larger - smaller

    def slope(j: np.ndarray) -> np.ndarray:
        a, b = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        up, down = _chance(a), _chance(b)
        per = (BASE - 1) / BASE / np.log(BASE)
        da, db = -v * per / (1 - a * (BASE - 1) / BASE), -u * per / (1 - b * (BASE - 1) / BASE)
        return larger * da / up + smaller * db / down - equal * (da + db) / np.maximum(1 - up - down, 1e-12)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(rounds):
        middle = (low + high) / 2
        rising = slope(middle) > 0
        low, high = np.where(rising, middle, low), np.where(rising, high, middle)
    return (low + high) / 2


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """key, n, sid, parity of every row of docs (key, text); parity has the registers, for the first row of a set in a batch."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = WordHash()
        for batch in slices(batches, "text", 2 << 20):
            first, n, sid, sets = {}, [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                s = shingles(t, cached, rule.words)
                n.append(len(s))
                sid.append(set_id(s) if len(s) else None)
                if len(s) and sid[-1] not in first:
                    first[sid[-1]] = i
                    sets.append(s)
            found: list[bytes | None] = [None] * len(n)
            for i, r in zip(first.values(), registers(sets), strict=True):
                found[i] = r.tobytes()
            yield pa.RecordBatch.from_pydict({"key": batch.column(0), "n": pa.array(n, pa.int64()), "sid": pa.array(sid, pa.int64()), "parity": pa.array(found, pa.binary())})

    return docs.select("key", "text").mapInArrow(run, f"key {kind}, n bigint, sid bigint, parity binary")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b for b in batches if b.num_rows):
        sid, n, found = batch.columns
        keys = bands(np.frombuffer(b"".join(found.to_pylist()), np.uint16).reshape(-1, REGISTERS))
        each = lambda c: pa.array(np.repeat(c.to_numpy(zero_copy_only=False), BANDS))
        yield pa.RecordBatch.from_pydict({"token": pa.array(keys.ravel()), "sid": each(sid), "n": each(n), "place": pa.array(np.zeros(keys.size, np.int64))})


def likely(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """pairs (a, b) whose estimated similarity is not far under the threshold; sets has sid, n, parity (registers)."""
    t = rule.numerator / 100
    least = t - SIGMAS * float(np.sqrt(t * (1 - t) / REGISTERS))

    @F.pandas_udf("boolean")
    def fits(na: pd.Series, nb: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(c), np.uint16).reshape(-1, REGISTERS) for c in (a, b))
        return pd.Series(estimate(na.to_numpy(float), nb.to_numpy(float), (x > y).sum(axis=1), (x < y).sum(axis=1)) >= least)

    of = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"r{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(fits("na", "nb", "ra", "rb")).select("a", "b")


def link_sketches(docs: DataFrame, rule: Rule = TWO_WORDS) -> tuple[DataFrame, DataFrame]:
    """(members, labels): key, n, sid of every row of docs (key, text); node, root of every set that links with another."""
    small_batches(docs.sparkSession)
    members = write_table(sketches(docs, rule))
    sets = write_table(members.where("parity IS NOT NULL").select("sid", "n", "parity").dropDuplicates(["sid"]))
    found = write_table(regions(sets.mapInArrow(_entries, "token bigint, sid bigint, n bigint, place bigint"), rule, SMALL))
    pairs = found.where("token IS NULL").select(F.col("sid").alias("a"), F.col("other").alias("b")).distinct()
    near = write_table(likely(pairs, sets, rule))
    large = write_table(found.where("token IS NOT NULL").select("token", "sid", "n"))
    return members, link_regions(docs, members, near, large, rule, lambda p: likely(p, sets, rule))


def near_classes(docs: DataFrame, rule: Rule = TWO_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach, itself included), kept of every row."""
    return jaccard_classes(docs, rule, link_sketches).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
