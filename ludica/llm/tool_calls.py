"""Operator 3: tool-call linking.

Calls (group_id, call_id, position, name, arguments, after) and results
(call_id, position, content) are joined by identifier, both reduced to one
row per identifier first, so that a repeated identifier can't multiply rows.
Arguments are validated against the JSON schema of the named tool, and each
linked call is serialised as canonical JSON (sorted keys, no white space,
non-ASCII characters as they are).

Order. A call comes after the calls named in its ``after``. In a group where
every such call stands earlier by position, the position is already a
topological order and the level is 0 throughout; the dependencies are checked
by an identifier join, without gathering the group. Only groups with a
dependency that points forward are peeled: level k holds the calls whose
dependencies all have lower levels. ``(group_id, level, position, call_id)``
is a topological order in either case. Peeling takes a round per level.

Defined cases: rows with a null identifier can't be linked and are left out;
of several calls (results) with one identifier the one that sorts first by
position and content holds, and n_calls (n_results) tells; a result without a
call is a row with null name (status ``orphan``); a call without a result has
status ``open``; a dependency that names no call of the group is counted in
n_missing and otherwise passed over; calls on a cycle, or after one, have a
null level; a tool without a schema, or arguments that are no JSON object, are
invalid with the reason in ``error``; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import materialize

_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or isinstance(value, float) and (kind == "number" or value.is_integer())
        return whole and not isinstance(value, bool)
    return isinstance(value, _KINDS[kind])


def violation(value, schema: dict, at: str = "$") -> str | None:
    """The first way in which a value breaks a schema, or None. Known: type,
    enum, minimum, maximum, minLength, maxLength, pattern, required, properties,
    additionalProperties (false), items."""
    kinds = schema.get("type")
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return f"{at}: not of type {kinds}"
    if "enum" in schema and not any(v == value and isinstance(v, bool) == isinstance(value, bool) for v in schema["enum"]):
        return f"{at}: not one of the values"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return f"{at}: length {len(value)}"
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        return f"{at}: does not match the pattern"
    if _is(value, "number") and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return f"{at}: out of range"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for key in sorted(schema.get("required", [])):
            if key not in value:
                return f"{at}.{key}: missing"
        for key in sorted(value):
            if key in known:
                if found := violation(value[key], known[key], f"{at}.{key}"):
                    return found
            elif schema.get("additionalProperties") is False:
                return f"{at}.{key}: not allowed"
    if isinstance(value, list) and "items" in schema:
        return next((f for i, v in enumerate(value) if (f := violation(v, schema["items"], f"{at}[{i}]"))), None)
    return None


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _no_json(constant: str):
    raise ValueError(f"{constant} is no JSON")


def _checked(schemas: dict[str, dict], own: str | None, tool: str | None, given: str | None, content: str | None) -> tuple:
    """(valid, error, canonical json) of one call. Arguments that are no JSON
    (NaN and Infinity are none, nor are halves of surrogate pairs, which no
    UTF-8 can hold) or nested too deeply stand in the json as the text they are."""
    def row(value, error: str | None) -> tuple:
        return error is None, error, canonical({"arguments": value, "id": own, "name": tool, "result": content})
    try:
        value = json.loads(given, parse_constant=_no_json) if given is not None else None
        error = (violation(value, {"type": "object", **schemas[tool]}) if tool in schemas
                 else "no schema" if tool is not None else "no call")
        out = row(value, error)
        out[2].encode()
        return out
    except RecursionError:
        return row(given, "$: nested too deeply")
    except ValueError:
        return row(given, "$: no JSON")


def serialised(schemas: dict[str, dict], call_id: Column, name: Column, arguments: Column, result: Column) -> Column:
    """valid, error and canonical json of linked calls."""
    @F.arrow_udf("valid boolean, error string, json string")
    def check(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            out = [_checked(schemas, *row) for row in zip(*(c.to_pylist() for c in columns))]
            yield pa.StructArray.from_arrays(
                [pa.array([o[0] for o in out], pa.bool_()), pa.array([o[1] for o in out], pa.string()),
                 pa.array([o[2] for o in out], pa.string())], ["valid", "error", "json"])
    return check(call_id, name, arguments, result)


def _levels(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(call_id, n_missing) of calls with missing dependencies, and (call_id,
    level) of the calls of groups whose positions are no topological order."""
    wants = calls.select("group_id", "call_id", "position", F.explode(F.array_distinct("after")).alias("dep"))
    targets = calls.select(F.col("call_id").alias("dep"), F.col("group_id").alias("dep_group"),
                           F.col("position").alias("dep_position"))
    edges = materialize(wants.join(targets, "dep", "left")
                        .withColumn("found", F.coalesce(F.col("dep_group").eqNullSafe(F.col("group_id"))
                                                        & F.col("dep_position").isNotNull(), F.lit(False))), "tool-edges")
    missing = edges.where("not found").groupBy("call_id").agg(F.count("*").alias("n_missing"))
    forward = materialize(edges.where("found and dep_position >= position").select("group_id").distinct(), "tool-groups")
    todo = calls.select("call_id").limit(0)
    level = todo.withColumn("level", F.lit(0))
    if forward.isEmpty():
        return missing, level
    todo = materialize(calls.join(forward, "group_id", "left_semi").select("call_id"), "tool-todo")
    left = materialize(edges.where("found").join(forward, "group_id", "left_semi").select("call_id", "dep"), "tool-left")
    k = 0
    while True:
        ready = materialize(todo.join(left.select("call_id").distinct(), "call_id", "left_anti"), "tool-ready")
        if ready.isEmpty():
            break
        level = level.unionByName(ready.withColumn("level", F.lit(k)))
        todo = materialize(todo.join(ready, "call_id", "left_anti"), "tool-todo")
        left = materialize(left.join(ready.withColumnRenamed("call_id", "dep"), "dep", "left_anti"), "tool-left")
        k += 1
    return missing, level.unionByName(todo.withColumn("level", F.lit(None).cast("int")))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per identifier: group_id, call_id, position, level, name,
    n_calls, n_results, n_missing, status, valid, error, json."""
    first = F.min(F.struct("position", "group_id", "name", "arguments", "after")).alias("c")
    one = materialize(calls.where("call_id is not null").groupBy("call_id").agg(first, F.count("*").alias("n_calls"))
                      .select("call_id", "c.*", "n_calls"), "tool-calls")
    answers = (results.where("call_id is not null").groupBy("call_id")
               .agg(F.min(F.struct("position", "content")).alias("r"), F.count("*").alias("n_results"))
               .select("call_id", F.col("r.content").alias("content"), "n_results"))
    missing, level = _levels(one)
    forced = level.withColumn("peeled", F.lit(True))
    linked = (one.withColumn("is_call", F.lit(True)).join(missing, "call_id", "left").join(forced, "call_id", "left")
              .join(answers, "call_id", "full_outer"))
    status = (F.when(F.col("is_call").isNull(), "orphan").when(F.col("n_results").isNull(), "open").otherwise("linked"))
    at = F.when(F.col("is_call") & F.col("peeled").isNull(), F.lit(0)).otherwise(F.col("level"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (linked.select("group_id", "call_id", "position", at.cast("int").alias("level"), "name", zero("n_calls"), zero("n_results"),
                          zero("n_missing"), status.alias("status"),
                          serialised(schemas, F.col("call_id"), F.col("name"), F.col("arguments"), F.col("content")).alias("_s"))
            .select("group_id", "call_id", "position", "level", "name", "n_calls", "n_results", "n_missing", "status", "_s.*"))


_TURN = {"properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
         "required": ["text", "turn"], "additionalProperties": False}
#: The tools that a conversation's turns call: a system turn instructs, and only at the start; a user turn asks for a reply.
TURN_SCHEMAS = {"reply": _TURN, "instruct": {**_TURN, "properties": {**_TURN["properties"], "turn": {"enum": [0]}}}}


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of (conv_id, turn, role, text), each turn one or the
    other: an assistant turn is the result of the turn before it, any other
    turn is a call under the identifier conv_id:turn. User turns call
    ``reply``, system turns ``instruct``, others a tool of their role's name
    (``unknown`` for null), which has no schema.

    In conversations of odd (or null) id a call comes after the one two turns
    before. In those of even id calls are nested: the turns of each parity are
    listed as a heap, parents first, and a call waits for its two sub-calls,
    which stand later. Sub-calls beyond the end, or those that are results,
    are missing dependencies. Rows without a turn have no identifier.
    """
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    name = lambda at: F.concat(F.coalesce(conv.cast("string"), F.lit("")), F.lit(":"), at.cast("string"))
    back = lambda by: F.try_subtract(turn, F.lit(by).cast("long"))
    # number k of a parity waits for 2k + 1 and 2k + 2, which are the turns 2 * turn - parity + 2 and two later
    sub = lambda by: F.try_add(F.try_multiply(F.lit(2).cast("long"), turn), F.lit(by).cast("long") - turn % 2)
    text, role = F.col("text").cast("string"), F.col("role").cast("string")
    nested = F.coalesce(conv % 2 == 0, F.lit(False)) & (turn >= 0)
    after = (F.when(nested, F.array(name(sub(2)), name(sub(4)))).when(turn >= 2, F.array(name(back(2))))
             .otherwise(F.array().cast("array<string>")))
    tool = F.when(role == "user", "reply").when(role == "system", "instruct").otherwise(F.coalesce(role, F.lit("unknown")))
    is_result = role.eqNullSafe("assistant")
    calls = turns.where(~is_result).select(
        conv.alias("group_id"), name(turn).alias("call_id"), turn.alias("position"), tool.alias("name"),
        F.to_json(F.struct(text.alias("text"), turn.alias("turn"))).alias("arguments"), F.array_compact(after).alias("after"))
    results = turns.where(is_result).select(name(back(1)).alias("call_id"), turn.alias("position"), text.alias("content"))
    return calls, results
