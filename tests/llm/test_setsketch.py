"""SetSketch registers against their definition, and near-deduplication against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_llm import EDGE, SF, as_counter, copies, docs_of, jaccard_by_hand, mutants, texts_of
from umitally.llm import jaccard, setsketch


def hashes(rng, n):
    return np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))


def plain_registers(s):
    """Arrival by arrival, far beyond the time at which the last register has one."""
    least = [np.inf] * setsketch.REGISTERS
    for h in s:
        t = 0.0
        k = 0
        while t < 40 / (setsketch.RATE * len(s)):
            k += 1
            z = int(setsketch._mixed(np.array([h + np.uint64(k) * setsketch._GOLDEN], np.uint64))[0])
            t -= np.log(((z >> 12) + 0.5) / 2**52) / (setsketch.RATE * setsketch.REGISTERS)
            at = z % setsketch.REGISTERS
            least[at] = min(least[at], t)
    return [min(max(int(np.floor(1 - np.log(x) / np.log(setsketch.BASE))), 0), 65535) for x in least]


@pytest.mark.filterwarnings("ignore:overflow")
def test_registers_by_definition():
    rng = np.random.default_rng(3)
    sets = [hashes(rng, n) for n in (1, 2, 9, 60)]
    got = setsketch.registers(sets)
    for s, r in zip(sets, got, strict=True):
        # Sums of the same terms in another order may differ in the last bit, and so may a rounded register.
        assert np.abs(r.astype(int) - plain_registers(s)).max() <= 1
    alone = np.concatenate([setsketch.registers([s]) for s in sets])
    assert (alone == got).all() and setsketch.registers([]).shape == (0, setsketch.REGISTERS)


def test_registers_merge():
    rng = np.random.default_rng(4)
    a, b = hashes(rng, 300), hashes(rng, 7)
    whole, x, y = setsketch.registers([np.union1d(a, b), a, b])
    assert np.abs(whole.astype(int) - setsketch.merge(x, y)).max() <= 1


@pytest.mark.parametrize(("na", "nb", "common"), [(200, 200, 178), (200, 200, 100), (220, 180, 178), (1000, 900, 840), (5, 5, 4)])
def test_estimates(na, nb, common):
    rng = np.random.default_rng(na + common)
    sets = [rng.integers(0, 2**63, na + nb - common, dtype=np.uint64) for _ in range(300)]
    a, b = (setsketch.registers(x) for x in ([s[:na] for s in sets], [s[na - common :] for s in sets]))
    true = common / (na + nb - common)
    found = setsketch.estimate(np.full(300, float(na)), np.full(300, float(nb)), (a > b).sum(axis=1), (a < b).sum(axis=1))
    # Registers of small sets depend on few arrivals, but still agree as often as the sets.
    assert abs(found.mean() - true) < 0.006 and found.std() < 1.2 * np.sqrt(true * (1 - true) / setsketch.REGISTERS)
    share = (setsketch.bands(a) == setsketch.bands(b)).any(axis=1).mean()
    assert abs(share - (1 - (1 - true**setsketch.BAND) ** setsketch.BANDS)) < 0.1 and (true < 0.8 or share == 1)


@pytest.mark.parametrize("rows", ["documents", "edge", "copies", "mutants"])
def test_near_classes(spark, rows):
    if rows == "documents":
        rows = list(texts_of(spark.read.parquet(f"{SF}/documents.parquet")).items())
    elif rows == "edge":
        rows = [(i, t) for i, t, _ in EDGE]
    elif rows == "copies":
        rows = copies(120, 6) + copies(3, 1)
    else:
        rows = mutants(5, 2, 90, 60, 0.03)
    docs = docs_of(spark, [(i, t, "en") for i, t in rows]).withColumns({"sid": F.lit("x"), "key": F.lit(1), "kept": F.lit("y")})
    got = setsketch.near_classes(docs)
    assert as_counter(got) == jaccard_by_hand(rows, 2, 80)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got.collect())


def test_near_classes_of_nothing(spark):
    assert setsketch.near_classes(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("kind", ["int", "string", "date", "decimal(20,0)"])
def test_near_ids_of_any_type(spark, kind):
    rows = [(1, "a b c d"), (2, "a b c d"), (3, None), (4, "x")]
    cast = F.date_add(F.lit("2020-01-01").cast("date"), F.col("doc_id").cast("int")) if kind == "date" else F.col("doc_id").cast(kind)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("doc_id", cast)
    got = setsketch.near_classes(docs)
    assert got.schema["component_id"].dataType == docs.schema["doc_id"].dataType and got.where("kept").count() == 3


def test_comparisons_of_a_hot_group(spark, monkeypatch):
    made, compare = [], jaccard.compare
    monkeypatch.setattr(jaccard, "compare", lambda pairs, contents: made.append(pairs.count()) or compare(pairs, contents))
    rows = copies(400, 8)
    assert as_counter(setsketch.near_classes(docs_of(spark, [(i, t, "en") for i, t in rows]))) == jaccard_by_hand(rows, 2, 80)
    assert sum(made) < 3 * 400
