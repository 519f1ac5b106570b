"""Chat formatting with tool calls, in DataFrame functions alone.

A message's text may carry tool use as JSON:

* assistant: {"content": ..., "tool_calls": [{"id", "name", "arguments": {...}}, ...]}
* tool: {"tool_call_id", "content"} - the result of a call of the same conversation

White space of JSON (space, tab, line feed, carriage return) around the object does not matter.

Calls and results are linked by a hash join on (conversation, call id). Of calls that repeat an id the earliest counts.
Messages are ordered topologically: a result stands after the message that made its call even where its turn is smaller.
The order is a key (anchor turn, step, turn), found by the join alone, so a conversation of any length needs no window
and is never gathered in one task. Arguments are validated against the schema of the call's tool at every depth: required names,
types, allowed values, unknown names, and the items of arrays. An integer may be written with a fraction of zero. Arguments
may be an object or a string that holds one. Each message becomes one line of canonical JSON: fixed member order, no
spaces, the least escapes, and the members of argument objects sorted by name at every depth, as variants keep them.

Defined cases: null text is empty content, a null role is "unknown"; text that is no JSON object of the kind above is plain
content; an object that repeats a member name is still tool use, of which the last such member counts, but arguments that repeat
one, hold a number that no double can, or are no object are a problem of the call and are written as a string of their
text; a result without a call is kept and marked orphan, a call without a result is open; rows with a null conv_id or
turn are kept and never linked; repeated rows stay repeated; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umitally.llm.common import write_table

CALLS = "array<struct<id:string,name:string,arguments:variant>>"
#: The same where a member name is repeated, which variants refuse.
LOOSE = "struct<content:string,tool_call_id:string,tool_calls:array<struct<id:string,name:string,arguments:string>>>"
#: JSON schemas (the part that is validated) of the tools known by default.
TOOLS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}, "required": ["query"]},
    "calculate": {"properties": {"expression": {"type": "string"}}, "required": ["expression"]},
    "convert": {"properties": {"value": {"type": "number"}, "unit": {"type": "string", "enum": ["m", "km", "mi"]}}, "required": ["value", "unit"]},
}
#: The names that Spark gives the types of variant values, as patterns, by JSON schema type.
_KINDS = {"string": "STRING", "integer": "BIGINT", "number": r"BIGINT|DOUBLE|DECIMAL\(.*", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*", "null": "VOID"}


def _none() -> Column:
    return F.array().cast("array<string>")


def _invalid(value: Column, schema: dict, path: str = "") -> Column:
    """array<string>: what is wrong with a variant by a schema, in the schema's order; path is empty or ends in a dot."""
    members = F.try_variant_get(value, "$", "map<string,variant>")
    found = [F.array(F.when(F.element_at(members, F.lit(x)).isNull(), F.lit(f"missing {path}{x}"))) for x in schema.get("required", [])]
    for name, spec in schema.get("properties", {}).items():
        of = F.element_at(members, F.lit(name))
        found.append(F.when(of.isNotNull(), _invalid_value(of, spec, path + name)).otherwise(_none()))
    if "properties" in schema:
        names = F.array(*(F.lit(x) for x in schema["properties"])) if schema["properties"] else _none()
        extra = F.transform(F.array_sort(F.array_except(F.map_keys(members), names)), lambda k: F.concat(F.lit(f"unexpected {path}"), k))
        found.append(F.coalesce(extra, _none()))
    return F.filter(F.concat(*found), lambda x: x.isNotNull()) if found else _none()


def _invalid_value(value: Column, spec: dict, name: str) -> Column:
    kind = F.schema_of_variant(value)
    checks = []
    if spec.get("type") in _KINDS:
        ok = kind.rlike(f"^({_KINDS[spec['type']]})$")
        if spec["type"] == "integer":
            number = F.try_variant_get(value, "$", "double")
            ok = F.when(kind.rlike(r"^(DOUBLE|DECIMAL\(.*)$"), number == F.floor(number)).otherwise(ok)
        checks.append(F.array(F.when(~ok, F.lit(f"{name} is no {spec['type']}"))))
    if "enum" in spec:
        checks.append(F.array(F.when(~F.to_json(value).isin(*(json.dumps(x, ensure_ascii=False) for x in spec["enum"])), F.lit(f"{name} is not allowed"))))
    if "properties" in spec or "required" in spec:
        checks.append(F.when(kind.startswith("OBJECT"), _invalid(value, spec, f"{name}.")).otherwise(_none()))
    if "items" in spec:
        items = F.try_variant_get(value, "$", "array<variant>")
        each = F.transform(items, lambda v: F.when(v.isNotNull(), _invalid_value(v, spec["items"], f"{name}[]")).otherwise(_none()))
        checks.append(F.when(kind.startswith("ARRAY"), F.coalesce(F.array_distinct(F.flatten(each)), _none())).otherwise(_none()))
    return F.filter(F.concat(*checks), lambda x: x.isNotNull()) if checks else _none()


def _problems(call: Column, tools: dict) -> Column:
    """array<string>: what is wrong with a call; empty if nothing is."""
    unreadable = F.when(call["raw"].isNotNull(), F.array(F.lit("arguments are no valid object")))
    out = F.when(call["name"].isNull() | ~call["name"].isin(*tools) if tools else F.lit(True), F.concat(F.array(F.lit("unknown tool")), F.coalesce(unreadable, _none())))
    for tool, schema in tools.items():
        out = out.when(call["name"] == tool, F.coalesce(unreadable, _invalid(call["arguments"], {"properties": {}} | schema)))
    return out.otherwise(_none())


def _readable(call: Column, text: Column) -> Column:
    """A call with its arguments as a variant object, or as raw text where they are none; text: of the arguments, if known."""
    given = call["arguments"]
    as_text = F.try_variant_get(given, "$", "string")
    inner = F.when(F.schema_of_variant(given) == "STRING", F.try_parse_json(as_text)).otherwise(given)
    written = F.to_json(inner)
    # Doubles that overflow are written as a string that the message does not hold.
    endless = written.rlike('"-?Infinity"') & ~F.col("text").contains("Infinity")
    ok = inner.isNotNull() & F.schema_of_variant(inner).startswith("OBJECT") & ~endless
    absent = given.isNull() & text.isNull()
    return F.struct(
        call["id"].alias("id"), call["name"].alias("name"), F.when(ok, inner).alias("arguments"),
        F.when(~F.coalesce(ok, F.lit(False)) & ~absent, F.coalesce(text, as_text, F.to_json(given))).alias("raw"),
    )


def _quoted(text: Column) -> Column:
    """A JSON string: to_json of an array of one string without its brackets."""
    return F.regexp_replace(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", "$1")


def _strict_calls() -> Column:
    """The calls of an object that variants can hold; the texts of their arguments are found by place."""
    texts = F.col("_loose.tool_calls")
    return F.transform(F.try_variant_get("_json", "$.tool_calls", CALLS), lambda c, i: _readable(c, F.get(texts, i)["arguments"]))


def _loose_calls() -> Column:
    parsed = lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name"), F.try_parse_json(c["arguments"]).alias("arguments"))
    return F.transform(F.col("_loose.tool_calls"), lambda c: _readable(parsed(c), c["arguments"]))


def _tool_use(candidates: DataFrame, tools: dict) -> DataFrame:
    """conv_id, turn, role, kind, ids (of a message's calls), result_of, problems, and json but for what links decide: its end."""
    bare = F.trim(F.col("text"), F.lit(" \t\r\n"))
    parsed = (
        candidates.withColumns({"_json": F.try_parse_json(bare), "_loose": F.from_json(bare, LOOSE)})
        .withColumn("_calls", F.when(F.col("role") == "assistant", F.coalesce(_strict_calls(), _loose_calls())))
        .withColumns({
            "calls": F.when(F.size("_calls") > 0, F.col("_calls")),
            "result_of": F.when(F.col("role") == "tool", F.when(F.col("_json").isNotNull(), F.try_variant_get("_json", "$.tool_call_id", "string")).otherwise(F.col("_loose.tool_call_id"))),
        })
        .withColumn("kind", F.when(F.col("calls").isNotNull(), "call").when(F.col("result_of").isNotNull(), "result").otherwise("message"))
        .withColumn("content", F.when(F.col("kind") == "message", F.col("text")).when(F.col("_json").isNotNull(), F.try_variant_get("_json", "$.content", "string")).otherwise(F.col("_loose.content")))
    )
    one_call = lambda c: F.concat(F.lit('{"id":'), F.coalesce(_quoted(c["id"]), F.lit("null")), F.lit(',"name":'), F.coalesce(_quoted(c["name"]), F.lit("null")), F.lit(',"arguments":'), F.when(c["raw"].isNotNull(), _quoted(c["raw"])).otherwise(F.coalesce(F.to_json(c["arguments"]), F.lit("{}"))), F.lit("}"))
    used = F.when(F.col("kind") == "call", F.concat(F.lit(',"tool_calls":['), F.array_join(F.transform("calls", one_call), ","), F.lit("]"))).when(F.col("kind") == "result", F.concat(F.lit(',"tool_call_id":'), _quoted(F.col("result_of")))).otherwise("")
    return parsed.select(
        "conv_id", "turn", "role", "kind",
        F.when(F.col("kind") == "call", F.col("calls.id")).alias("ids"), "result_of",
        F.when(F.col("kind") == "call", F.array_join(F.flatten(F.transform("calls", lambda c: _problems(c, tools))), "; ")).alias("problems"),
        F.concat(_opened(F.col("role"), F.col("content")), used).alias("json"),
    )


def _opened(role: Column, content: Column) -> Column:
    return F.concat(F.lit('{"role":'), _quoted(role), F.lit(',"content":'), F.coalesce(_quoted(content), F.lit("null")))


def messages(conversations: DataFrame, tools: dict | None = None) -> DataFrame:
    """A row for each message: conv_id, turn, anchor_turn, step, role, kind, call_ids, linked, problems, json.

    kind is message, call or result; anchor_turn, step (and turn) give the topological order within conv_id; linked is the
    number of the message's calls that have a result, or 1 for a result that has its call.

    Messages that can be tool use, by their role and first sign, are parsed once when this is called, into a work table that
    stays; links are joined from it, so that no plan holds the parsing more than once. All others are a narrow map.
    """
    tools = TOOLS if tools is None else tools
    base = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    possible = F.ltrim(F.col("text"), F.lit(" \t\r\n")).startswith("{") & F.col("role").isin("assistant", "tool")
    parsed = write_table(_tool_use(base.where(possible), tools))
    turn = base.schema["turn"].dataType
    blank, none = _none(), lambda kind: F.lit(None).cast(kind)
    calls, results = parsed.where("kind = 'call'"), parsed.where("kind = 'result'")
    call_ids = calls.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.explode("ids").alias("id")).where("id IS NOT NULL")
    first_calls = call_ids.groupBy("conv_id", "id").agg(F.min("turn").alias("call_turn"))
    answered = results.where("conv_id IS NOT NULL").select("conv_id", F.col("result_of").alias("id")).distinct()
    # One link a (conversation, call id) for results; the links of a message's own calls are summed by its turn.
    per_turn = first_calls.join(answered, ["conv_id", "id"], "left_semi").groupBy("conv_id", F.col("call_turn").alias("turn")).agg(F.collect_set("id").alias("_answered"))
    columns = ["conv_id", "turn", "role", "kind", "ids", "result_of", "problems", "json", "call_turn", "_answered"]
    unlinked = {"call_turn": none(turn), "_answered": blank}
    rows = (
        base.where(~possible).select("conv_id", "turn", "role", F.lit("message").alias("kind"), none("array<string>").alias("ids"), none("string").alias("result_of"), none("string").alias("problems"), _opened(F.col("role"), F.col("text")).alias("json"))
        .unionByName(parsed.where("kind = 'message'")).withColumns(unlinked).select(*columns)
        .unionByName(calls.join(per_turn, ["conv_id", "turn"], "left").withColumns({"call_turn": none(turn), "_answered": F.coalesce("_answered", blank)}).select(*columns))
        .unionByName(results.join(first_calls.withColumnRenamed("id", "result_of"), ["conv_id", "result_of"], "left").withColumn("_answered", blank).select(*columns))
    )
    late = (F.col("kind") == "result") & (F.col("call_turn") >= F.col("turn"))
    linked = F.when(F.col("kind") == "call", F.size(F.array_intersect("ids", "_answered"))).when(F.col("kind") == "result", F.col("call_turn").isNotNull().cast("int")).otherwise(0)
    orphan = F.when((F.col("kind") == "result") & F.col("call_turn").isNull(), ',"orphan":true').otherwise("")
    return rows.select(
        "conv_id", "turn",
        F.when(late, F.col("call_turn")).otherwise(F.col("turn")).alias("anchor_turn"), F.coalesce(late, F.lit(False)).cast("int").alias("step"),
        "role", "kind",
        F.when(F.col("kind") == "call", F.array_join("ids", ",")).when(F.col("kind") == "result", F.col("result_of")).alias("call_ids"),
        linked.alias("linked"), "problems",
        F.concat("json", orphan, F.lit("}")).alias("json"),
    )
