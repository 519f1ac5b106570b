"""From reads to barcodes and UMIs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umitally.functions import match
from umitally.plans.layout import ReadLayout
from umitally.sources.workdir import stored


PLACES = ["umi5", "inner5", "barcode", "umi3", "end"]


def exact_places(seq: Column, layout: ReadLayout) -> Column | None:
    """The places of a read whose anchors all agree exactly, found in generated code; null for any other read. None where a
    layout's best match need not be the exact one.

    If the core agrees at the first occurrence of inner5, that is the leftmost exact match, which nothing is better than, and
    the first occurrence of an outer anchor is its best place. In edit mode outer anchors take the first acceptable match,
    and a barcode holds no line feed.
    """
    edit = layout.mode == "edit"
    if layout.regex_anchors or edit and (layout.outer5 or layout.outer3):
        return None
    a, gap, b = len(layout.inner5), layout.barcode_length, len(layout.inner3)
    start = F.instr(seq, layout.inner5) - 1
    core_end = start + (a + gap + b)
    ok = (start >= 0) & (F.substring(seq, start + (a + gap + 1), F.lit(b)) == layout.inner3)
    if edit:
        ok &= F.instr(F.substring(seq, start + (a + 1), F.lit(gap)), "\n") == 0
    begin, end = F.lit(0), F.char_length(seq)
    if layout.outer5:
        at = F.instr(F.substring(seq, F.lit(1), start), layout.outer5)
        ok, begin = ok & (at > 0), at - 1 + len(layout.outer5)
    if layout.outer3:
        at = F.locate(layout.outer3, F.substring(seq, core_end + 1, end))
        ok, end = ok & (at > 0), core_end + at - 1
    first, last = start - begin, end - core_end
    most = layout.most_umi
    inside = (first >= layout.min_umi) & (first <= most) & (last >= layout.min_umi) & (last <= most)
    return F.when(ok, F.struct(*(F.when(inside, x).otherwise(-1).cast("int").alias(c) for c, x in zip(PLACES, (begin, start, start + a, core_end, end), strict=True))))


def parse_reads(reads: DataFrame, layout: ReadLayout, *, seq_col: str = "seq") -> DataFrame:
    """reads with umi5, barcode, umi3, which are all null where a read is rejected.

    Reads that agree exactly with the anchors are placed in the JVM; the others go to one Arrow UDF, which gives five integers
    a read, and reach it as nulls otherwise. The strings are cut from the read in the JVM. A null read is rejected. The UDF is
    declared nondeterministic, as the optimizer would otherwise copy it into every filter on the result and search each read
    once more for each. Bytes of a read that are no UTF-8 count as one unknown character each.
    """

    @F.pandas_udf("struct<umi5:int,inner5:int,barcode:int,umi3:int,end:int>")
    def places(seqs: pd.Series) -> pd.DataFrame:
        rest = np.flatnonzero(seqs.notna().to_numpy())
        found = np.full((len(seqs), len(PLACES)), -1, np.int32)
        if len(rest):
            found[rest] = match.parse(seqs.iloc[rest].tolist(), layout)
        return pd.DataFrame(found, columns=PLACES)

    places = places.asNondeterministic()
    name, exact = unused(reads, "_at", "_exact")
    at, seq = F.col(name), F.make_valid_utf8(seq_col)
    ok = (at["umi5"] >= 0) & seq.isNotNull()
    cut = lambda a, b: F.when(ok, F.substring(seq, a + 1, b - a))
    known = exact_places(seq, layout)
    if known is None:
        placed = reads.withColumn(name, places(seq))
    else:
        placed = reads.withColumn(exact, known).withColumn(name, F.coalesce(F.col(exact), places(F.when(F.col(exact).isNull(), seq)))).drop(exact)
    return (
        placed.withColumn("umi5", cut(at["umi5"], at["inner5"]))
        .withColumn("barcode", cut(at["barcode"], at["barcode"] + layout.barcode_length))
        .withColumn("umi3", cut(at["umi3"], at["end"]))
        .drop(name)
    )


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before each as it takes that df has no column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def split_once(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of one parse: reads are scanned and searched once, and the outcome is kept in the work folder.

    Of an accepted read only read_id (if there is one), umi5, barcode and umi3 are kept, of a rejected one the columns that
    it came with.
    """
    found, ids = ["umi5", "barcode", "umi3"], [c for c in parsed.columns if c == "read_id"]
    rest = [c for c in parsed.columns if c not in (*found, *ids)]
    lost = F.col("barcode").isNull()
    kept = stored(parsed.select(*ids, *found, *(F.when(lost, F.col(c)).alias(c) for c in rest)))
    return accepted(kept).select(*ids, *found), rejected(kept)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("barcode IS NOT NULL")


def rejected(parsed: DataFrame) -> DataFrame:
    """The reads as they came in, without the empty result columns."""
    return parsed.where("barcode IS NULL").drop("umi5", "barcode", "umi3")


def bounded_hamming(texts: DataFrame, pattern: str, limit: int, *, text_col: str) -> DataFrame:
    """texts with `distance`: mismatches of pattern at the text's start, limit + 1 if more, null if the text is shorter."""

    @F.pandas_udf("long")
    def distance(s: pd.Series) -> pd.Series:
        return pd.Series(match.bounded_hamming([x or "" for x in s], pattern, limit))

    d = distance(text_col)
    return texts.withColumn("distance", d).withColumn("distance", F.when(F.col("distance") >= 0, F.col("distance")))


def core_search(texts: DataFrame, layout: ReadLayout, *, text_col: str = "seq") -> DataFrame:
    """texts with pos (0-based), e5 and e3 of the best joint match of both inner anchors; null where there is none."""

    @F.pandas_udf("struct<pos:int,e5:int,e3:int>")
    def search(s: pd.Series) -> pd.DataFrame:
        seqs = [x or "" for x in s]
        out = np.full((len(seqs), 3), -1, np.int32)
        for rows, chars in match.by_length(seqs):
            out[rows] = np.stack(match.find_core(chars, layout.inner5, layout.inner3, layout.barcode_length, layout.max_errors), axis=1)
        return pd.DataFrame(out, columns=["pos", "e5", "e3"])

    found = texts.select("*", search(text_col))
    at = found[found.columns[-1]]
    return found.select(*(found[c] for c in texts.columns), *(F.when(at["pos"] >= 0, at[c]).alias(c) for c in ("pos", "e5", "e3")))


def anchor_search(texts: DataFrame, anchor: str, limit: int, *, text_col: str = "seq") -> DataFrame:
    """texts with pos (0-based) of the best place of one anchor in the whole text; null where there is none."""

    @F.pandas_udf("int")
    def search(s: pd.Series) -> pd.Series:
        seqs = [x or "" for x in s]
        out = np.full(len(seqs), -1, np.int32)
        for rows, chars in match.by_length(seqs):
            n = len(rows)
            out[rows] = match.find_anchor(chars, anchor, limit, np.zeros(n, np.int64), np.full(n, chars.shape[1], np.int64))
        return pd.Series(out)

    return texts.withColumn("pos", search(text_col)).withColumn("pos", F.when(F.col("pos") >= 0, F.col("pos")))
