"""SimHash fingerprints and Hamming search, in DataFrame functions alone.

Terms are the distinct pairs of adjacent words (white-space separated, lower case), weighted by their length in steps, as
longer pairs are rarer. Two 64-bit hashes of a term vote with its weight on 128 signed bits; a bit is set where the votes
for it outweigh those against. The votes of two bits, 32 apart, share one 64-bit sum, so 64 sums serve 128 bits and run in
generated code.

Neighbours within a Hamming radius r are found by permuted block tables: a fingerprint is cut into b > r blocks of about
equal width, and two that differ in at most r bits agree in at least b - r of them. A table for each choice of so many
blocks, keyed by their bits, therefore holds every neighbour, and candidates are compared in full. b = r + 1 makes r + 1
tables keyed by 128 / (r + 1) bits; more blocks make more tables with longer keys, for corpora where such keys are crowded.
Where r + 1 blocks would be too short for keys, b <= r blocks are taken: two fingerprints then differ in at most r // b bits
of some block. There is a table for each block, and a query looks in it for its block's bits with every choice of so many
of them flipped. Both ways find every neighbour. Fewer blocks have longer keys, which hold fewer fingerprints, but take more
flips; the counted numbers of queries and fingerprints choose how many blocks are the least work, so keys grow with the
corpus: of RADIUS, 10 blocks of 13 bits and 2 flips below a million fingerprints, then 7 of 18 and 3, 6 of 21 and 4 from
some ten million on, and 4 of 32 and 6 from some thousand million on. A hundred times the corpus is twenty to forty times the
work of a query.

RADIUS is for near copies at Jaccard 0.75 of five-word shingles: of the 135 such pairs of different words on sf0.1 none lies
within 3 bits, 131 within 23 and all within 27, while few texts without a common passage lie within 38.

Defined cases: null text is empty; a text without words has the fingerprint 0; a text of one word has that word as its only
term; rows with one id and one text are one document; null ids come last in descending order; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from umitally.llm.common import write_table

BITS, LANES = 128, 32
#: Hamming radius of the search, and every how many ids one is a query of with_edits.
RADIUS, QUERY_EVERY = 27, 50
#: The most and the fewest blocks of a search whose radius would need more (a block has 32 bits at most).
BLOCKS, FEWEST = 10, 4
#: What it costs to shuffle and sort a probe, in comparisons of two fingerprints in generated code.
PROBE_COST = 10


def terms(text: Column) -> Column:
    """array<bigint>: the hash of each distinct term, its weight 1..7 in the lowest three bits."""
    words = F.filter(F.split(F.lower(text), "[\\x09-\\x0D\\x20]+"), lambda w: w != "")

    def of_pairs(ws: Column) -> Column:
        def term(i: Column) -> Column:
            a, b = F.get(ws, i - 1), F.get(ws, i)
            weight = F.least(F.lit(6), F.floor((F.octet_length(a) + F.coalesce(F.octet_length(b), F.lit(0))) / 4).cast("int")) + 1
            return F.xxhash64(a, b).bitwiseAND(F.lit(~7)).bitwiseOR(weight.cast("bigint"))

        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - 1, F.lit(1))), term))

    # A one-element transform names the words, so that they are split once and not at each use.
    return F.flatten(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, of_pairs(ws)).otherwise(F.array().cast("array<bigint>"))))


def _votes() -> list[Column]:
    lanes = F.lit(0x0000000100000001)
    return [F.sum("_weight").alias("_all")] + [F.sum(F.col("_weight") * F.shiftrightunsigned(F.col(h), i).bitwiseAND(lanes)).alias(f"{h}{i}") for h in ("_a", "_b") for i in range(LANES)]


def _word(h: str, shift: int) -> Column:
    """32 bits of a fingerprint as a bigint: bit i is set if its votes outweigh the rest."""
    total = F.lit(0).cast("bigint")
    for i in range(LANES):
        votes = F.shiftrightunsigned(F.col(f"{h}{i}"), shift).bitwiseAND(F.lit(0xFFFFFFFF))
        total = total + F.when(votes * 2 > F.col("_all"), F.lit(1 << i)).otherwise(F.lit(0))
    return total


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """keys with `_fp`, four 32-bit words as array<bigint>.

    Rows with equal keys must have equal texts: their votes add up without changing a sign. If texts is already partitioned
    by a part of keys, nothing is shuffled; else each document's votes, 520 bytes, are.
    """
    rows = texts.select(*keys, F.explode_outer(terms(F.col(text_col))).alias("_term"))
    rows = rows.withColumn("_weight", F.coalesce(F.col("_term").bitwiseAND(F.lit(7)), F.lit(0).cast("bigint")))
    rows = rows.withColumn("_a", F.coalesce(F.xxhash64("_term"), F.lit(0).cast("bigint"))).withColumn("_b", F.coalesce(F.xxhash64("_term", F.lit(1)), F.lit(0).cast("bigint")))
    votes = rows.groupBy(*keys).agg(*_votes())
    return votes.select(*keys, F.array(_word("_a", 0), _word("_a", 32), _word("_b", 0), _word("_b", 32)).alias("_fp"))


def as_hex(fp: Column) -> Column:
    return F.concat(*(F.lpad(F.lower(F.hex(fp[i])), 8, "0") for i in range(BITS // LANES)))


def likeness(a: Column, b: Column) -> Column:
    """1 - Hamming distance / BITS."""
    return 1 - sum(F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(BITS // LANES)) / F.lit(float(BITS))


def following(ids: DataFrame) -> DataFrame:
    """ids (_key, doc_id, _n) with `_next`, the key that follows in descending doc_id (after the last: the first).

    Ids alone are range-partitioned and sorted; only the first key of each range, one row a partition, meets in one task.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("_key")]
    placed = write_table(ids.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    w = W.partitionBy("_part").orderBy(*order)
    inside = placed.withColumn("_next", F.lead("_key").over(w)).withColumn("_rank", F.row_number().over(w))
    heads = inside.where("_rank = 1").select("_part", F.col("_key").alias("_head"))
    all_heads = W.orderBy("_part")
    after = heads.select("_part", F.coalesce(F.lead("_head").over(all_heads), F.first("_head").over(all_heads.rowsBetween(W.unboundedPreceding, W.currentRow))).alias("_after"))
    # The first head of the whole table closes the circle.
    return inside.join(F.broadcast(after), "_part").select("_key", "doc_id", "_n", F.coalesce("_next", "_after").alias("_next"))


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, in which the last third is the next document's beginning.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and, for ids that
    QUERY_EVERY divides (else null), n_near and nearest_id: how many other fingerprints of all documents lie within RADIUS,
    and the smallest doc_id with the nearest of them; n_copies: how many other documents have the same fingerprint; and
    neighbours: each of the n_near fingerprints, nearest first, with its distance, smallest doc_id and number of documents.
    Documents are told by id and text. A list is as long as its fingerprints are many, however often they are copied; the
    copies themselves are the rows that share a fingerprint. Whole texts are shuffled once, by key; the beginnings of the next
    documents, a third at most, once more. The votes need no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn("_key", F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5("text")))))
    order = write_table(following(keyed.select("_key", "doc_id", F.char_length("text").alias("_n")).distinct()))
    unique = keyed.groupBy("_key").agg(F.first("text").alias("text"))
    wanted = order.select(F.col("_next").alias("_key"), F.col("_key").alias("_for"), F.floor(F.col("_n") / 3).cast("int").alias("_take"))
    beginnings = unique.join(wanted, "_key").select(F.col("_for").alias("_key"), F.substring("text", F.lit(1), F.col("_take")).alias("_begin"))
    n = F.char_length("text")
    both = unique.join(beginnings, "_key").select("_key", F.array(F.col("text"), F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("_begin"))).alias("_two"))
    texts = both.select("_key", F.posexplode("_two").alias("_which", "text"))
    prints = fingerprints(texts.withColumn("_sha", F.sha2(F.col("text").cast("binary"), 256)), ["_key", "_which", "_sha"])
    pair = prints.groupBy("_key").agg(
        F.max(F.when(F.col("_which") == 1, F.col("_sha"))).alias("edited_sha256"),
        F.max(F.when(F.col("_which") == 0, F.col("_fp"))).alias("_fp"),
        F.max(F.when(F.col("_which") == 1, F.col("_fp"))).alias("_edited"),
    )
    found = write_table(pair)
    of_next = found.select(F.col("_key").alias("_next"), F.col("_fp").alias("_next_fp"))
    named = order.join(found, "_key").withColumn("fingerprint", as_hex(F.col("_fp")))
    asks = F.coalesce(F.col("doc_id").try_cast("bigint") % QUERY_EVERY == 0, F.lit(False))
    distinct = write_table(named.groupBy("fingerprint").agg(F.min("doc_id").alias("_least"), F.max(asks).alias("_asks"), F.count(F.lit(1)).alias("_docs")))
    n_queries, n_fps = distinct.agg(F.count_if("_asks"), F.count(F.lit(1))).first()
    near = neighbours(distinct.where("_asks"), distinct, RADIUS, choose_blocks(n_queries, n_fps)).join(distinct.select(F.col("fingerprint").alias("near"), "_least", "_docs"), "near")
    # Each asking fingerprint meets itself, too.
    other = F.col("fingerprint") != F.col("near")
    near = near.groupBy("fingerprint").agg(
        F.count_if(other).alias("_n_near"), F.min(F.when(other, F.struct("distance", "_least")))["_least"].alias("_nearest"), F.max(F.when(~other, F.col("_docs") - 1)).alias("_n_copies"),
        F.sort_array(F.collect_list(F.when(other, F.struct("distance", F.col("_least").alias("doc_id"), F.col("near").alias("fingerprint"), F.col("_docs").alias("n_docs"))))).alias("_neighbours"),
    )
    result = named.join(of_next, "_next").join(near, "fingerprint", "left").select(
        "_key", "doc_id", F.col("_n").cast("bigint").alias("n_chars"), "edited_sha256", "fingerprint", as_hex(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_fp"), F.col("_edited")).alias("near_edited"), likeness(F.col("_fp"), F.col("_next_fp")).alias("near_next"),
        F.when(asks, F.col("_n_near")).alias("n_near"), F.when(asks, F.col("_nearest")).alias("nearest_id"),
        F.when(asks, F.col("_n_copies")).alias("n_copies"), F.when(asks, F.col("_neighbours")).alias("neighbours"),
    )
    copies = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_copies"))
    return result.join(copies, "_key").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).drop("_key", "_copies", "_copy")


def block_tables(fps: DataFrame, radius: int, blocks: int, fp_col: str = "fingerprint") -> DataFrame:
    """fps with `_table` and `_bits`: a row for each choice of blocks - radius blocks of the hexadecimal fingerprint."""
    if not 0 <= radius < blocks <= BITS // 4:
        raise ValueError("radius must be less than the number of blocks")
    edges = [BITS // 4 * k // blocks for k in range(blocks + 1)]
    block = [F.substring(fp_col, edges[k] + 1, edges[k + 1] - edges[k]) for k in range(blocks)]
    keys = [F.concat(*(block[k] for k in chosen)) for chosen in combinations(range(blocks), blocks - radius)]
    return fps.select("*", F.posexplode(F.array(*keys)).alias("_table", "_bits"))


def _distance(a: str, b: str) -> Column:
    words = [F.conv(F.substring(c, 8 * i + 1, 8), 16, 10).cast("bigint") for c in (a, b) for i in range(BITS // LANES)]
    return sum(F.bit_count(x.bitwiseXOR(y)) for x, y in zip(words[:4], words[4:], strict=True))


def _places(blocks: int) -> list[tuple[int, int, int]]:
    """Half, lowest bit and width of each block."""
    places = []
    for h, n in enumerate(((blocks + 1) // 2, blocks // 2)):
        places += [(h, 64 * k // n, 64 * (k + 1) // n - 64 * k // n) for k in range(n)]
    return places


def _probes(blocks: int, radius: int) -> list[int]:
    """How many keys of each block a query looks up."""
    return [sum(comb(width, i) for i in range(radius // blocks + 1)) for _, _, width in _places(blocks)]


def expected_candidates(n_fps: int, blocks: int, radius: int = RADIUS) -> float:
    """Fingerprints that a query meets, if their bits are spread evenly."""
    return sum(n_fps * p / 2**width for p, (_, _, width) in zip(_probes(blocks, radius), _places(blocks), strict=True))


def expected_work(n_fps: int, blocks: int, radius: int = RADIUS) -> float:
    """The cost of a query in comparisons."""
    return PROBE_COST * sum(_probes(blocks, radius)) + expected_candidates(n_fps, blocks, radius)


def choose_blocks(n_queries: int, n_fps: int, radius: int = RADIUS) -> int:
    """The number of blocks that is the least work; the fingerprints are shuffled once for each block."""
    most = min(radius + 1, BLOCKS)
    if radius < most:
        return most
    return min(range(most, FEWEST - 1, -1), key=lambda b: n_queries * expected_work(n_fps, b, radius) + PROBE_COST * b * n_fps)


def _flipped(queries: DataFrame, fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """neighbours() by single blocks, of which queries look up all values with at most radius // blocks bits flipped.

    A pair meets in each table whose block differs in so few bits; the first of them alone gives it.
    """
    if not FEWEST <= blocks <= min(radius, BITS // 4):
        raise ValueError("four blocks or more, at most the radius")
    flips, word = radius // blocks, lambda c, i: F.conv(F.substring(c, 8 * i + 1, 8), 16, 10).cast("bigint")
    halves = lambda c, to: [F.shiftleft(word(c, 2 * h), 32).bitwiseOR(word(c, 2 * h + 1)).alias(f"{to}{h}") for h in (0, 1)]
    places = _places(blocks)
    bits = lambda of, k: F.shiftrightunsigned(of(places[k][0]), places[k][1]).bitwiseAND(F.lit((1 << places[k][2]) - 1))
    own, other = (lambda h: F.col(f"_q{h}")), (lambda h: F.col(f"_t{h}"))
    between = lambda h: own(h).bitwiseXOR(other(h))
    q = queries.select("fingerprint").distinct().select(*halves("fingerprint", "_q"))
    parts = F.array(*(F.struct(F.lit(k << 32).alias("of"), F.lit(places[k][2]).alias("width"), bits(own, k).alias("bits")) for k in range(blocks)))
    q = q.select("_q0", "_q1", F.explode(parts).alias("_part")).select("_q0", "_q1", "_part.*", F.lit(-1).alias("_bit"))
    for _ in range(flips):
        # Bits are flipped in ascending order; the bit after the last stands for no further flip.
        after = F.when(F.col("_bit") < F.col("width"), F.sequence(F.col("_bit") + 1, F.col("width"))).otherwise(F.array("width"))
        q = q.select("_q0", "_q1", "of", "width", "bits", F.explode(after).alias("_bit"))
        q = q.withColumn("bits", F.when(F.col("_bit") < F.col("width"), F.col("bits").bitwiseXOR(F.expr("shiftleft(1L, _bit)"))).otherwise(F.col("bits")))
    q = q.select("_q0", "_q1", F.col("of").bitwiseOR(F.col("bits")).alias("_block"))
    t = fps.select("fingerprint").distinct().select(*halves("fingerprint", "_t")).select("_t0", "_t1", F.explode(F.array(*(F.lit(k << 32).bitwiseOR(bits(other, k)) for k in range(blocks)))).alias("_block"))
    distance = F.bit_count(between(0)) + F.bit_count(between(1))
    first = F.coalesce(*(F.when(F.bit_count(bits(between, k)) <= flips, F.lit(k)) for k in range(blocks)))
    # Sizes are estimated before keys multiply the rows, by which either side would be broadcast.
    met = q.join(t.hint("merge"), "_block").where((distance <= radius) & (first == F.shiftright("_block", 32)))
    text = lambda of: F.concat(*(F.lpad(F.lower(F.hex(of(h))), 16, "0") for h in (0, 1)))
    return met.select(text(own).alias("fingerprint"), text(other).alias("near"), distance.cast("int").alias("distance"))


def neighbours(queries: DataFrame, fps: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """Distinct fingerprints of queries with every distinct fingerprint of fps within radius: fingerprint, near, distance.

    Copies collapse before the tables are joined, so a group of equal fingerprints is one row whatever its size.
    """
    blocks = blocks or min(radius + 1, BLOCKS)
    if blocks <= radius:
        return _flipped(queries, fps, radius, blocks)
    q = block_tables(queries.select("fingerprint").distinct(), radius, blocks)
    t = block_tables(fps.select(F.col("fingerprint").alias("near")).distinct(), radius, blocks, "near")
    met = q.join(t, ["_table", "_bits"]).where(_distance("fingerprint", "near") <= radius)
    return met.select("fingerprint", "near", _distance("fingerprint", "near").cast("int").alias("distance")).distinct()
