"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from umitally.llm import chat, exact_dedup, jaccard, language, merkle, packing, pieces, quality, setsketch, simhash, toxicity, warc
from umitally.llm.common import shared_dir, table


def vocabulary(name: str) -> str:
    """A file of the installed public tokenizers; every node has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), locate=True)


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_words(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_edits(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages of the table, and the tool use that TOOL_USE_SQL adds to them."""
    view = f"conversations_{uuid.uuid4().hex}"
    table(spark, sf_dir, "conversations").createOrReplaceTempView(view)
    quoted = r"regexp_replace(to_json(array(text)), '(?s)^\\[(.*)\\]$', '$1')"
    told = spark.sql(TOOL_USE_SQL.replace("CONVERSATIONS", view).replace("QUOTED", quoted))
    spark.catalog.dropTempView(view)  # the plan has the table
    return chat.messages(told)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


def op11_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_classes(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_pieces, op3_packing, op4_quality, op5_language, op6_warc, op7_simhash, op8_chat, op9_exact_dedup, op10_jaccard, op11_setsketch, op12_merkle)}


#: DuckDB has SHA-1 in hex; base32 reads its 160 bits five at a time.
OP6_SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
     b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i : lpad(bin(strpos('0123456789abcdef', h[i]) - 1), 4, '0')), 'string_agg', '') AS bits,
                  max(page_id) OVER (PARTITION BY h) AS holder FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k : substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', list_sum(list_transform(range(1, 6), lambda j : substr(bits, 5 * k + j, 1)::INT * (1 << (5 - j))))::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to
FROM b
"""

#: The tables hold no tool use, so calls and results are made of their messages, in SQL that Spark and DuckDB both run
#: (QUOTED is the text as a JSON string, CONVERSATIONS the table). Every message stays. Each assistant message makes a call at turn 100 + 10 * turn,
#: every third a second one in the same message; k, the sum of conversation and turn, decides the tool, whether arguments
#: are valid, and whether a result follows, comes before its call or is missing. Some user messages make a result of no call.
TOOL_USE_SQL = """
WITH base AS (SELECT conv_id, turn, role, text, conv_id + turn AS k, QUOTED AS q FROM CONVERSATIONS),
made AS (
  SELECT *, concat('{"id":"c', cast(turn AS string), CASE
    WHEN k % 5 = 0 THEN concat('", "name":"search","arguments":{"query":', q, ', "limit":', cast(turn AS string), '}}')
    WHEN k % 5 = 1 THEN '","name":"search","arguments":{"limit":"three"}}'
    WHEN k % 5 = 2 THEN '","name":"convert","arguments":{"value":2.5,"unit":"ft"}}'
    WHEN k % 5 = 3 THEN '","name":"calculate","arguments":{"extra":[1, {"b":null,"a":true}],"expression":"1 + 1"}}'
    ELSE '","name":"draw","arguments":{}}' END,
    CASE WHEN turn % 3 = 0 THEN concat(', {"id":"d', cast(turn AS string), '","name":"calculate","arguments":{"expression":"2 * 3"}}') ELSE '' END) AS calls
  FROM base WHERE role = 'assistant' AND text IS NOT NULL)
SELECT conv_id, turn, role, text FROM base
UNION ALL SELECT conv_id, 100 + 10 * turn, 'assistant', concat('{"tool_calls":[', calls, ']}') FROM made
UNION ALL SELECT conv_id, CASE WHEN k % 7 = 0 THEN 95 + 10 * turn ELSE 105 + 10 * turn END, 'tool', concat('{"content":', q, ',"tool_call_id":"c', cast(turn AS string), '"}') FROM made WHERE k % 3 <> 2
UNION ALL SELECT conv_id, 106 + 10 * turn, 'tool', concat(' {"tool_call_id":"d', cast(turn AS string), '"}') FROM made WHERE turn % 3 = 0 AND k % 2 = 0
UNION ALL SELECT conv_id, 107 + 10 * turn, 'tool', concat('{"tool_call_id":"none","content":', q, '}') FROM base WHERE role = 'user' AND k % 11 = 0 AND text IS NOT NULL
"""

#: What follows from the rule above, told message by message: no JSON is read, and calls meet results in a join.
OP8_SQL = r"""
WITH base AS (SELECT conv_id, turn, role, text, conv_id + turn AS k, to_json(text)::VARCHAR AS q FROM conversations),
calls AS (SELECT *, 'c' || turn AS id, 100 + 10 * turn AS call_turn FROM base WHERE role = 'assistant' AND text IS NOT NULL),
results AS (
  SELECT conv_id, CASE WHEN k % 7 = 0 THEN 95 ELSE 105 END + 10 * turn AS turn, 'c' || turn AS id, q FROM calls WHERE k % 3 <> 2
  UNION ALL SELECT conv_id, 106 + 10 * turn, 'd' || turn, NULL FROM calls WHERE turn % 3 = 0 AND k % 2 = 0
  UNION ALL SELECT conv_id, 107 + 10 * turn, 'none', q FROM base WHERE role = 'user' AND k % 11 = 0 AND text IS NOT NULL),
ids AS (SELECT conv_id, id, call_turn FROM calls UNION ALL SELECT conv_id, 'd' || turn, call_turn FROM calls WHERE turn % 3 = 0),
answers AS (SELECT conv_id, call_turn, count(DISTINCT id)::INT AS n FROM ids JOIN results USING (conv_id, id) GROUP BY ALL)
SELECT conv_id, turn, turn AS anchor_turn, 0 AS step, coalesce(role, 'unknown') AS role, 'message' AS kind, NULL::VARCHAR AS call_ids, 0 AS linked, NULL::VARCHAR AS problems,
       '{"role":' || to_json(coalesce(role, 'unknown')) || ',"content":' || to_json(coalesce(text, '')) || '}' AS json
FROM base
UNION ALL
SELECT conv_id, call_turn, call_turn, 0, 'assistant', 'call', id || CASE WHEN turn % 3 = 0 THEN ',d' || turn ELSE '' END, coalesce(n, 0),
       CASE WHEN k % 5 = 1 THEN 'missing query; limit is no integer' WHEN k % 5 = 2 THEN 'unit is not allowed' WHEN k % 5 = 3 THEN 'unexpected extra' WHEN k % 5 = 4 THEN 'unknown tool' ELSE '' END,
       '{"role":"assistant","content":null,"tool_calls":[{"id":"' || id || '","name":' || CASE
         WHEN k % 5 = 0 THEN '"search","arguments":{"limit":' || turn || ',"query":' || q || '}}' WHEN k % 5 = 1 THEN '"search","arguments":{"limit":"three"}}'
         WHEN k % 5 = 2 THEN '"convert","arguments":{"unit":"ft","value":2.5}}' WHEN k % 5 = 3 THEN '"calculate","arguments":{"expression":"1 + 1","extra":[1,{"a":true,"b":null}]}}'
         ELSE '"draw","arguments":{}}' END || CASE WHEN turn % 3 = 0 THEN ',{"id":"d' || turn || '","name":"calculate","arguments":{"expression":"2 * 3"}}' ELSE '' END || ']}'
FROM calls LEFT JOIN answers USING (conv_id, call_turn)
UNION ALL
SELECT r.conv_id, r.turn, CASE WHEN i.call_turn >= r.turn THEN i.call_turn ELSE r.turn END, CASE WHEN i.call_turn >= r.turn THEN 1 ELSE 0 END, 'tool', 'result', id, CASE WHEN i.call_turn IS NULL THEN 0 ELSE 1 END, NULL,
       '{"role":"tool","content":' || coalesce(q, 'null') || ',"tool_call_id":"' || id || '"' || CASE WHEN i.call_turn IS NULL THEN ',"orphan":true' ELSE '' END || '}'
FROM results r LEFT JOIN ids i USING (conv_id, id)
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""

#: Trees level by level: runs of three by position, proofs as the siblings of each level's ancestor, and folds of the tampered
#: leaf, one level a step. DuckDB lacks CRC-32, which is computed bit by bit; only its lowest bit counts.
OP12_SQL = r"""
WITH RECURSIVE h AS (
  SELECT doc_id, source, doc_id::VARCHAR AS d, coalesce('x' || source, '') AS tree, text,
         list_aggregate(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR], lambda v : CASE WHEN v IS NULL THEN '-' ELSE octet_length(encode(v)) || ':' || v END), 'string_agg', '') AS front FROM documents),
leaves AS (
  SELECT doc_id, tree, sha256(front || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END) AS leaf,
         CASE WHEN (list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(d) + 1), lambda i : ascii(d[i])::BIGINT)),
                lambda c, b : list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i : CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) & 1) = 1
              THEN sha256(front || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), '') END) END AS tampered FROM h),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS total FROM leaves),
low AS (
  SELECT tree, 0 AS lvl, pos, total, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (total + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM low WHERE total > 1 GROUP BY tree, lvl, pos // 3, total),
subroots AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS total FROM low WHERE total = 1),
high AS (
  SELECT 0 AS lvl, pos, total, subroot AS digest FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, (total + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM high WHERE total > 1 GROUP BY lvl, pos // 3, total),
walk AS (
  SELECT tree, pos AS leaf_pos, 0 AS lvl, pos, '' AS proof, coalesce(tampered, leaf) AS digest FROM placed
  UNION ALL
  SELECT w.tree, w.leaf_pos, w.lvl + 1, w.pos // 3, any_value(w.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos <> w.pos), ''),
         sha256(string_agg(CASE WHEN n.pos = w.pos THEN w.digest ELSE n.digest END, '' ORDER BY n.pos))
  FROM walk w JOIN low n ON n.tree = w.tree AND n.lvl = w.lvl AND n.pos // 3 = w.pos // 3 WHERE n.total > 1 GROUP BY w.tree, w.leaf_pos, w.lvl, w.pos),
through AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY tree, leaf_pos ORDER BY lvl DESC) = 1),
rise AS (
  SELECT t.tree, t.leaf_pos, 0 AS lvl, s.pos, t.proof, t.digest FROM through t JOIN subroots s USING (tree)
  UNION ALL
  SELECT w.tree, w.leaf_pos, w.lvl + 1, w.pos // 3, any_value(w.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos <> w.pos), ''),
         sha256(string_agg(CASE WHEN n.pos = w.pos THEN w.digest ELSE n.digest END, '' ORDER BY n.pos))
  FROM rise w JOIN high n ON n.lvl = w.lvl AND n.pos // 3 = w.pos // 3 WHERE n.total > 1 GROUP BY w.tree, w.leaf_pos, w.lvl, w.pos),
done AS (SELECT * FROM rise QUALIFY row_number() OVER (PARTITION BY tree, leaf_pos ORDER BY lvl DESC) = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, d.digest AS folded_root, d.digest = root AS verified
FROM placed p JOIN done d ON d.tree = p.tree AND d.leaf_pos = p.pos JOIN subroots s ON s.tree = p.tree, (SELECT digest AS root FROM high WHERE total = 1)
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_merkle": OP12_SQL, "op6_warc": OP6_SQL, "op8_chat": OP8_SQL, "op9_exact_dedup": OP9_SQL}
