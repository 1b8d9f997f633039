"""Chat formatting: links tool calls with their results, orders them, checks arguments and writes canonical JSON."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.common import stored

#: A tool's arguments: property -> {"type", "required", "least", "most", "enum"}; lengths of strings, values of numbers.
Schema = Mapping[str, Mapping[str, Any]]

KEY = ["conv_id", "call_id"]
FIELDS = ["conv_id", "turn", "role", "kind", "call_id", "parent_id", "name", "arguments", "content"]

#: How the type of a parsed JSON value begins, by the type of a schema.
_TYPES = {
    "string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"],
    "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"],
}


def quoted(text: Column) -> Column:
    """A JSON string, or null."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def canonical(json: Column) -> Column:
    """The same value without white space and with sorted keys; null if it is no JSON."""
    return F.to_json(F.try_parse_json(json))


def _wrong(arguments: Column, name: str, rule: Mapping[str, Any]) -> Column:
    """What is wrong with one property, or null."""
    path = "$[" + '"' + name + '"' + "]"
    value = F.variant_get(arguments, path, "variant")
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    missing = kind == "VOID"
    checks = [(missing, "missing")] if rule.get("required") else []
    fits = reduce(Column.__or__, (kind.startswith(t) for t in _TYPES[rule["type"]]))
    checks.append((~missing & ~fits, f"not {rule['type']}"))
    text = F.try_variant_get(arguments, path, "string")
    size = F.length(text) if rule["type"] == "string" else text.cast("double")
    if "least" in rule:
        checks.append((~missing & (size < rule["least"]), f"below {rule['least']}"))
    if "most" in rule:
        checks.append((~missing & (size > rule["most"]), f"above {rule['most']}"))
    if "enum" in rule:
        checks.append((~missing & ~text.isin(*rule["enum"]), "not allowed"))
    out = F.lit(None).cast("string")
    for test, message in reversed(checks):
        out = F.when(test, F.lit(f"{name}: {message}")).otherwise(out)
    return out


def problems(name: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """All that is wrong with a call, joined by ``; ``; empty if nothing is."""
    parsed = F.try_parse_json(arguments)
    by_tool = F.array(F.lit("unknown tool"))
    for tool, schema in schemas.items():
        each = F.array(*(_wrong(parsed, p, r) for p, r in sorted(schema.items()))) if schema else F.array().cast("array<string>")
        extra = F.array_except(F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>")), F.array(*map(F.lit, schema)))
        extra = F.transform(F.array_sort(extra), lambda p: F.concat(p, F.lit(": unknown")))
        by_tool = F.when(name == tool, F.concat(F.filter(each, lambda x: x.isNotNull()), extra)).otherwise(by_tool)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.array_join(F.when(is_object, by_tool).otherwise(F.array(F.lit("arguments: no object"))), "; ")


def depths(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, depth`` from distinct ``conv_id, call_id`` with ``parent_id``: 1 without a parent in the same conversation, one
    more than the parent otherwise; null on and behind a cycle. Null ids have no place here.

    Pointers double: each round every open call jumps to the pointer of what it points at, so the rounds are the logarithm of
    the longest chain and no conversation is gathered in one place. Calls that have reached the beginning of their chain are not shuffled again.
    """
    known = calls.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("there"))
    started = calls.where("parent_id IS NOT NULL").join(known, ["conv_id", "parent_id"], "left")
    started = started.select(*KEY, F.when(F.col("there"), F.col("parent_id")).alias("next"))
    started = started.unionByName(calls.where("parent_id IS NULL").select(*KEY, F.lit(None).cast("string").alias("next")))
    now = stored(started.withColumn("depth", F.lit(1)), "call-depths")
    rounds, most = 0, now.count().bit_length() + 1
    while rounds < most and not now.where("next IS NOT NULL").isEmpty():
        onto = now.select("conv_id", F.col("call_id").alias("next"), F.col("next").alias("then"), F.col("depth").alias("more"))
        moved = now.where("next IS NOT NULL").join(onto, ["conv_id", "next"])
        moved = moved.select(*KEY, F.col("then").alias("next"), (F.col("depth") + F.col("more")).alias("depth"))
        now = stored(now.where("next IS NULL").unionByName(moved), "call-depths")
        rounds += 1
    return now.select(*KEY, F.when(F.col("next").isNull(), F.col("depth")).alias("depth"))


def linked(messages: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """Links, orders, checks and serialises the messages of conversations.

    ``messages``: conv_id, turn, role, kind (``call``, ``result`` or anything else), call_id, parent_id (a call of the same conversation whose
    result this call uses), name, arguments (JSON) and content. Calls and results meet in hash joins by conversation and call_id.

    Returns one row per message: conv_id, turn, role, call_id, ``level`` (sorting by level, then turn, puts every call before its result and behind
    the results that it uses: 0 for plain messages, 2 * depth - 1 for calls, 2 * depth for results; null on a cycle
    and for results without a call), ``linked`` (a call with a result or a result with a call; null for plain messages), ``problems`` (of a call's arguments) and ``json`` (canonical:
    sorted keys, no white space).

    Null conversations and call ids link with nothing: such a call has level 1, such a result none. A call id that several rows of a conversation
    have (ties, repeated rows) is one call, that of the smallest parent id; all its rows get
    the same level, and repeated rows stay. Any number of results may answer a call. Arguments that are no JSON object, or name a key twice, are a problem;
    what is no JSON is serialised as text. Null texts: null; empty and very long texts are texts like any other. Empty table: no rows. Extra
    columns of any name are left behind.
    """
    rows = messages.select(*(F.col(f"`{c}`") for c in FIELDS))
    has_key = F.coalesce(F.col("kind").isin("call", "result"), F.lit(False)) & F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    keyed, apart = rows.where(has_key), rows.where(~has_key)
    calls = keyed.where("kind = 'call'").groupBy(*KEY).agg(F.min("parent_id").alias("parent_id"))
    results = keyed.where("kind = 'result'").select(*KEY).distinct().withColumn("has_result", F.lit(True))
    known = depths(stored(calls, "calls")).withColumn("has_call", F.lit(True)).join(results, KEY, "full")
    # rows without a key never enter a shuffle
    nothing = {"depth": F.when(F.col("kind") == "call", 1), "has_call": F.lit(False), "has_result": F.lit(False)}
    rows = keyed.join(known, KEY, "left").unionByName(apart.withColumns(nothing))
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    level = F.when(call, F.col("depth") * 2 - 1).when(result, F.col("depth") * 2).otherwise(0)
    shown = F.coalesce(canonical(F.col("arguments")), quoted(F.col("arguments")))
    as_call = F.concat(
        F.lit('{"arguments":'), shown, F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), quoted(F.col("name")), F.lit(',"role":'), quoted(F.col("role")), F.lit("}")
    )
    as_result = F.concat(F.lit('{"content":'), quoted(F.col("content")), F.lit(',"role":'), quoted(F.col("role")), F.lit(',"tool_call_id":'), quoted(F.col("call_id")), F.lit("}"))
    plain = F.concat(F.lit('{"content":'), quoted(F.col("content")), F.lit(',"role":'), quoted(F.col("role")), F.lit("}"))
    return rows.select(
        "conv_id", "turn", "role", "call_id",
        level.cast("long").alias("level"),
        F.when(call, F.coalesce("has_result", F.lit(False))).when(result, F.coalesce("has_call", F.lit(False))).alias("linked"),
        F.when(call, problems(F.col("name"), F.col("arguments"), schemas)).alias("problems"),
        F.when(call, as_call).when(result, as_result).otherwise(plain).alias("json"),
    )


def from_turns(conversations: DataFrame, tool: str = "reply") -> DataFrame:
    """Turns of conversations as messages: a user's turn calls ``tool``, the assistant's turn right after it is the result, and a
    call uses the result of the call two turns before. All other turns are plain messages."""
    turn, user, assistant = F.col("turn").cast("long"), F.col("role") == "user", F.col("role") == "assistant"
    named = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit(":"), t.cast("string"))
    arguments = F.concat(F.lit('{"turn": '), turn.cast("string"), F.lit(', "text": '), quoted(F.col("text")), F.lit("}"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), "role",
        F.when(user, "call").when(assistant, "result").alias("kind"),
        F.when(user, named(turn)).when(assistant, named(turn - 1)).alias("call_id"),
        F.when(user, named(turn - 2)).alias("parent_id"),
        F.when(user, F.lit(tool)).alias("name"),
        F.when(user, arguments).alias("arguments"),
        F.when(~F.coalesce(user, F.lit(False)), F.col("text")).alias("content"),
    )
