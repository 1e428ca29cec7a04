"""Chat formatting: tool calls are linked to their results, ordered, checked and serialised.

``link`` takes messages with the columns conv_id, turn, kind (call, result or another), id, after,
name and body.  Calls and results meet by (conv_id, id) in a hash join with one summary row per
identifier, so repeated identifiers multiply nothing: they are ambiguous and linked with nothing.
A call may name in after the call that it follows.  Depths along these references are found by
doubling (each round a call's pointer skips as far again), so a chain of n calls takes log n
rounds; calls on a cycle or behind one have no depth.  A call stands at 2 * depth - 1, its result
right behind it; other messages have depth and position 0, and only calls can be invalid.

Arguments are checked against the call's schema (type, required, properties, additionalProperties,
enum, minimum, maximum, minLength, maxLength, items); a call of unknown name is invalid.  JSON is
canonical: keys sorted by code point, no blanks, no escapes but those that JSON requires.

``from_turns`` reads plain conversations: a user's turn calls the function ``reply`` with id
conv:turn after the one two turns before, an assistant's turn is the result for the turn before
it, others are messages.  Null texts become null prompts or contents.  Rows with a null conv_id
or turn have no identifier.  Repeated (conv_id, turn) rows share an identifier, so they are
ambiguous.  A very long body is one row's matter and is read whole.  Extra columns, whatever their
names, are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import attach, cut, map_slices

REPLY = {
    "reply": {
        "type": "object",
        "required": ["prompt", "turn"],
        "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
        "additionalProperties": False,
    }
}
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def checked(body: str | None, name: str | None, ident: str | None, schemas: dict[str, dict]) -> tuple[bool, str]:
    """Whether a call's body is JSON that conforms to its schema, and the call in canonical JSON.

    A body that is null, no JSON, nested too deeply, or holds what canonical JSON cannot say
    (numbers that are not finite, lone surrogates) makes the call invalid, with null arguments.
    """
    line = lambda arguments: canonical({"arguments": arguments, "id": ident, "name": name, "type": "call"})
    try:
        arguments = json.loads(body, parse_constant=_no_number)
        out = line(arguments)
        out.encode()
        return name in schemas and conforms(arguments, schemas[name]), out
    except (TypeError, ValueError, RecursionError):
        return False, line(None)


def _no_number(name: str) -> None:
    raise ValueError(name)


def conforms(value: Any, schema: dict) -> bool:
    kind = schema.get("type")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind in _TYPES and not isinstance(value, _TYPES[kind]):
        return False
    if kind == "number" and not number or kind == "integer" and not (number and (isinstance(value, int) or value.is_integer())):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if number and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return False
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return False
    if isinstance(value, list) and "items" in schema:
        return all(conforms(x, schema["items"]) for x in value)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", ())) or schema.get("additionalProperties") is False and any(k not in known for k in value):
            return False
        return all(conforms(v, known[k]) for k, v in value.items() if k in known)
    return True


def from_turns(turns: DataFrame) -> DataFrame:
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    name = lambda t: F.concat(conv.cast("string"), F.lit(":"), t.cast("string"))
    kind = F.when(F.col("role") == "user", "call").when(F.col("role") == "assistant", "result").otherwise("message")
    out = turns.select(conv.alias("conv_id"), turn.alias("turn"), "role", "text", kind.alias("kind"), name(turn).alias("own"), name(turn - 1).alias("before"), name(turn - 2).alias("earlier"))
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    return out.select(
        "conv_id", "turn", "kind", F.when(call, F.col("own")).when(result, F.col("before")).alias("id"), F.when(call, F.col("earlier")).alias("after"),
        F.when(call, F.lit("reply")).otherwise(F.col("role")).alias("name"), F.when(call, F.to_json(F.struct(F.col("text").alias("prompt"), "turn"), {"ignoreNullFields": "false"})).otherwise(F.col("text")).alias("body"),
    )


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, id and depth (1: follows no known call) of calls with unique identifiers (conv_id, id, after)."""
    known = calls.select("conv_id", F.col("id").alias("after"), F.lit(1).alias("there"))
    now = calls.join(known, ["conv_id", "after"], "left").select("conv_id", "id", F.when(F.col("there") == 1, F.col("after")).alias("to"), F.lit(1).cast("long").alias("depth"))
    now = cut(now)
    total = now.count()
    for k in itertools.count():
        if now.where(F.col("to").isNotNull()).isEmpty():
            break
        if 2**k > total:  # whoever still points somewhere is on a cycle or behind one
            now = now.withColumn("depth", F.when(F.col("to").isNull(), F.col("depth")))
            break
        up = now.select("conv_id", F.col("id").alias("to"), F.col("to").alias("further"), F.col("depth").alias("more"))
        now = cut(now.join(up, ["conv_id", "to"], "left").select("conv_id", "id", F.col("further").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
    return now.select("conv_id", "id", "depth")


def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, turn, kind, status, depth, position, valid and canonical JSON of every message; a call's body is its arguments in JSON."""
    messages = messages.select("conv_id", "turn", "kind", "id", "after", "name", "body")
    tagged = messages.where(F.col("id").isNotNull() & F.col("conv_id").isNotNull() & F.col("kind").isin("call", "result"))
    per_id = tagged.groupBy("conv_id", "id").agg(
        F.sum(F.when(F.col("kind") == "call", 1).otherwise(0)).alias("calls"), F.sum(F.when(F.col("kind") == "result", 1).otherwise(0)).alias("results"), F.max("after").alias("after"),
        F.count(F.lit(1)).alias("many"),
    )
    per_id = cut(per_id)
    total = per_id.agg(F.sum("many")).first()[0] or 0
    deep = depths(per_id.where("calls = 1").select("conv_id", "id", "after"))
    summary = per_id.drop("after").join(deep, ["conv_id", "id"], "left")
    # An identifier may be repeated any number of times; ids that are null have no row in the summary.
    rows = attach(messages, summary, ["conv_id", "id"], "many", total, "left")
    status = (
        F.when(~F.col("kind").isin("call", "result"), F.lit("message"))
        .when(F.col("calls").isNull(), F.lit("unidentified"))
        .when((F.col("calls") > 1) | (F.col("results") > 1), F.lit("ambiguous"))
        .when(F.col("results") == 0, F.lit("pending"))
        .when(F.col("calls") == 0, F.lit("orphan"))
        .otherwise(F.lit("linked"))
    )
    depth = F.when(F.col("status").isin("linked", "pending"), F.col("depth"))
    position = F.when(F.col("kind") == "call", 2 * depth - 1).when(F.col("kind") == "result", 2 * depth)
    rows = rows.withColumn("status", status).select("conv_id", "turn", "kind", "id", "name", "body", "status", F.coalesce(depth, F.lit(0)).cast("long").alias("depth"), F.coalesce(position, F.lit(0)).cast("long").alias("position"))

    def step(batch):
        valid, lines = [], []
        for kind, name, ident, body in zip(*(batch.column(c).to_pylist() for c in ("kind", "name", "id", "body")), strict=True):
            if kind == "call":
                ok, line = checked(body, name, ident, schemas)
                valid.append(ok)
                lines.append(line)
            elif kind == "result":
                valid.append(True)
                lines.append(canonical({"content": body, "id": ident, "type": "result"}))
            else:
                valid.append(True)
                lines.append(canonical({"content": body, "role": name, "type": "message"}))
        return {c: batch.column(c) for c in ("conv_id", "turn", "kind", "status", "depth", "position")} | {"valid": valid, "json": lines}

    return map_slices(rows, "conv_id long, turn long, kind string, status string, depth long, position long, valid boolean, json string", step)


def report(turns: DataFrame) -> DataFrame:
    return link(from_turns(turns), REPLY)
