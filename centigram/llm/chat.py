"""Chat formatting: tool calls linked to their results, ordered, checked and written canonically.

A message is (conv_id, turn, role, text).  Its text is plain, or a JSON object:
an assistant's may hold `tool_calls`, a list of {id, name, arguments}; a tool's names the
`tool_call_id` that it answers; a system's may hold `tools`, a list of {name, parameters} whose
parameters are a JSON schema.  An argument {"$result": id} uses the result of another call.
Name, arguments and parameters may also lie in an entry's `function`.  All other keys, and
entries that are no objects, pass through to the canonical JSON.  Text that is no strict JSON,
or that UTF-8 or JSON cannot hold again (a lone half of a surrogate pair, a number out of
range, nesting deeper than the parser goes), is plain.

Of a schema these keywords count: type, enum, required, properties, additionalProperties (if
false) and items; all others are ignored.  true and false are schemas.  A schema in which one of
these has a value of the wrong kind is malformed and decides nothing.

Calls and results meet by a hash join on conversation and identifier.  A result comes after
its call and a call after the results that it uses: a message's place is the latest turn among
its own and those it depends on, then its depth among them, found by relaxing all
dependencies until none moves.  Every step works on rows; no conversation is gathered, however
long it is.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centigram.llm.common import cut, prepare

CALL = "struct<id:string,name:string,arguments:string>"
PARSED = f"json string, calls array<{CALL}>, tools array<struct<name:string,parameters:string>>, answers string, uses array<string>"
#: Names of JSON schema types.
TYPES = {
    "string": (str,),
    "integer": (int,),
    "number": (int, float),
    "boolean": (bool,),
    "array": (list,),
    "object": (dict,),
    "null": (type(None),),
}


def canonical(value: Any) -> str:
    """Keys sorted, no white space, characters unescaped where JSON lets them be."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def strict_number(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError("a number out of range")
    return value


def refuse(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def loaded(text: str | None) -> dict | None:
    """The object that a text writes, if it can be written again; else None."""
    if not text or not text.lstrip().startswith("{"):
        return None
    try:
        value = json.loads(text, parse_constant=refuse, parse_float=strict_number)
        canonical(value).encode()
    except (ValueError, RecursionError):  # also what UTF-8 cannot hold
        return None
    return value if isinstance(value, dict) else None


def entries(value: Any) -> list[dict]:
    return [x for x in value if isinstance(x, dict)] if isinstance(value, list) else []


def used(value: Any) -> Iterator[str]:
    """Identifiers of the results that arguments refer to."""
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if set(x) == {"$result"}:
                yield str(x["$result"])
            else:
                todo += x.values()
        elif isinstance(x, list):
            todo += x


def text_of(value: Any) -> str | None:
    return None if value is None else str(value)


def lifted(entry: dict, names: tuple[str, ...]) -> dict:
    """The entry with these names taken out of its `function` where it has none itself."""
    inner = entry.get("function")
    found = {k: inner[k] for k in names if k in inner and k not in entry} if isinstance(inner, dict) else {}
    if not found:
        return entry
    rest = {k: v for k, v in inner.items() if k not in found}
    return {k: v for k, v in entry.items() if k != "function"} | ({"function": rest} if rest else {}) | found


def call_of(entry: dict) -> dict:
    """A call with its id, name and arguments, null if missing, arguments in text as the object that they write."""
    entry = {"id": None, "name": None, "arguments": None} | lifted(entry, ("name", "arguments"))
    if isinstance(entry["arguments"], str):
        inside = loaded(entry["arguments"])
        entry["arguments"] = entry["arguments"] if inside is None else inside
    return entry


def linked(role: str, value: dict) -> dict:
    """The message's object under the role of its row; another role of its own is kept beside."""
    body = {"content": None} | value | {"role": role}
    if value.get("role", role) != role:
        name = "text_role"
        while name in value:
            name += "_"
        body[name] = value["role"]
    return body


def parsed(role: str | None, text: str | None) -> tuple:
    """(canonical JSON, calls, tools, answered identifier, used identifiers)."""
    value = loaded(text)
    calls, tools, answers, uses = [], [], None, []
    body: dict[str, Any] = {"content": text, "role": role}
    if value is not None and role == "assistant" and "tool_calls" in value:
        body = linked(role, value)
        if isinstance(value["tool_calls"], list):
            body["tool_calls"] = [call_of(x) if isinstance(x, dict) else x for x in value["tool_calls"]]
        for x in entries(body["tool_calls"]):
            uses += used(x["arguments"])
            calls.append({"id": text_of(x["id"]), "name": text_of(x["name"]), "arguments": canonical(x["arguments"])})
    elif value is not None and role == "tool" and "tool_call_id" in value:
        answers = text_of(value["tool_call_id"])
        body = linked(role, value)
    elif value is not None and role == "system" and "tools" in value:
        found = (lifted(x, ("name", "parameters")) for x in entries(value["tools"]))
        tools = [{"name": text_of(x.get("name")), "parameters": canonical(x.get("parameters"))} for x in found]
        body = linked(role, value)
    return canonical(body), calls, tools, answers, sorted(set(uses))


def malformed(schema: Any) -> bool:
    """Whether a keyword that counts has a value of the wrong kind, at any depth."""
    todo = [schema]
    while todo:
        x = todo.pop()
        if isinstance(x, bool):
            continue
        if not isinstance(x, dict):
            return True
        kind = x.get("type", [])
        kinds = [kind] if isinstance(kind, str) else kind
        if not isinstance(kinds, list) or any(not isinstance(k, str) or k not in TYPES for k in kinds):
            return True
        required = x.get("required", [])
        if not isinstance(required, list) or any(not isinstance(k, str) for k in required):
            return True
        if not isinstance(x.get("enum", []), list) or not isinstance(x.get("properties", {}), dict):
            return True
        todo += x.get("properties", {}).values()
        if "items" in x:
            todo.append(x["items"])
    return False


def is_kind(value: Any, kind: str) -> bool:
    """A truth value is no number; a number without a fraction is an integer."""
    if isinstance(value, bool):
        return kind == "boolean"
    return isinstance(value, TYPES[kind]) or (kind == "integer" and isinstance(value, float) and value.is_integer())


def same(a: Any, b: Any) -> bool:
    """Equality as JSON has it: 1 is 1.0 and not true."""
    numbers = [isinstance(x, (int, float)) and not isinstance(x, bool) for x in (a, b)]
    return a == b if all(numbers) else canonical(a) == canonical(b)


def conforms(value: Any, schema: Any) -> bool | None:
    """Whether a value keeps to a schema; None if the schema is malformed.

    A property whose value is a reference to another call's result keeps to any schema.
    """
    if malformed(schema):
        return None
    todo = [(value, schema)]
    while todo:
        x, rule = todo.pop()
        if isinstance(rule, bool):
            if not rule:
                return False
            continue
        kinds = [rule["type"]] if isinstance(rule.get("type"), str) else rule.get("type", [])
        if kinds and not any(is_kind(x, k) for k in kinds):
            return False
        if "enum" in rule and not any(same(x, y) for y in rule["enum"]):
            return False
        if isinstance(x, dict):
            known = rule.get("properties", {})
            if any(k not in x for k in rule.get("required", [])):
                return False
            if rule.get("additionalProperties") is False and any(k not in known for k in x):
                return False
            todo += ((v, known[k]) for k, v in x.items() if k in known and not (isinstance(v, dict) and set(v) == {"$result"}))
        elif isinstance(x, list) and "items" in rule:
            todo += ((v, rule["items"]) for v in x)
    return True


def read(messages: DataFrame) -> DataFrame:
    """The parsed messages; row tells them apart once they are stored."""
    kinds = {c: messages.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    call = pa.struct([("id", pa.string()), ("name", pa.string()), ("arguments", pa.string())])
    tool = pa.struct([("name", pa.string()), ("parameters", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parsed(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            written, calls, tools, answers, uses = zip(*rows, strict=True) if rows else ((),) * 5
            arrays = [pa.array(written, pa.string()), pa.array(calls, pa.list_(call)), pa.array(tools, pa.list_(tool)), pa.array(answers, pa.string()), pa.array(uses, pa.list_(pa.string()))]
            yield pa.record_batch(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), *arrays],
                ["conv_id", "turn", "role", "json", "calls", "tools", "answers", "uses"],
            )

    columns = messages.select("conv_id", "turn", "role", "text")
    rows = columns.mapInArrow(each, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, {PARSED}")
    return rows.withColumn("row", F.monotonically_increasing_id())


def checked(calls: DataFrame) -> DataFrame:
    """Adds valid: null without a schema or with a malformed one, else whether the arguments keep to it."""
    schema = calls.schema
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid = [
                None if p in (None, "null") else conforms(json.loads(a), json.loads(p))
                for a, p in zip(batch.column("arguments").to_pylist(), batch.column("parameters").to_pylist(), strict=True)
            ]
            yield pa.record_batch([*batch.columns, pa.array(valid, pa.bool_())], [*batch.schema.names, "valid"])

    return calls.mapInArrow(each, f"{out}, valid boolean")


def places(needs: DataFrame) -> DataFrame:
    """(row, place_turn, place_depth, cyclic) of the messages that depend on others.

    A depth above the conversation's number of dependencies proves a cycle; such messages stop
    moving and say so.
    """
    most = needs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("most"))
    now = cut(
        needs.select("conv_id", "row", "turn").union(needs.select("conv_id", F.col("after").alias("row"), F.col("after_turn").alias("turn"))).distinct()
        .join(most, "conv_id")
        .select("row", "most", F.col("turn").alias("place_turn"), F.lit(0).cast("long").alias("place_depth"))
    )
    while True:
        before = now.select(F.col("row").alias("after"), F.struct("place_turn", (F.col("place_depth") + 1).alias("d")).alias("p"))
        pushed = needs.join(before, "after").groupBy("row").agg(F.max("p").alias("p"))
        own = F.struct("place_turn", F.col("place_depth").alias("d"))
        moved = cut(
            now.join(pushed, "row", "left")
            .withColumn("q", F.when(F.col("place_depth") > F.col("most"), own).otherwise(F.greatest(own, F.coalesce("p", own))))
            .select("row", "most", F.col("q.place_turn").alias("place_turn"), F.col("q.d").alias("place_depth"), (F.col("q") > own).alias("moved"))
        )
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now.select("row", "place_turn", "place_depth", (F.col("place_depth") > F.col("most")).alias("cyclic"))


def link(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, place, counts and the canonical json.

    place_turn and place_depth order a conversation topologically; n_calls, n_answered and
    n_invalid count the message's calls; orphan marks a result without its call.  Text that is
    no such JSON is content as it is, also null or empty; a null role or identifier links with
    nothing; a null turn links without ordering.  If an identifier or a tool's name repeats in a
    conversation the earliest stands, a null turn last; repeated rows give repeated results.  An empty table gives an empty result.
    """
    prepare(messages.sparkSession)
    rows = cut(read(messages))
    key = ["row", "conv_id", "turn"]
    earliest = F.struct(F.col("turn").isNull().alias("none"), "turn", F.xxhash64("json").alias("h"), "row")
    calls = rows.select(*key, "json", F.explode("calls").alias("call")).select(*key, "json", "call.*")
    tools = (
        rows.select("conv_id", F.explode("tools").alias("t"), "turn")
        .groupBy("conv_id", F.col("t.name").alias("name"))
        .agg(F.min_by("t.parameters", F.struct(F.col("turn").isNull().alias("none"), "turn", "t.parameters")).alias("parameters"))
    )
    first = lambda df, name: df.groupBy("conv_id", "id").agg(F.min(earliest).alias(name))
    answered = first(rows.where("answers IS NOT NULL").withColumn("id", F.col("answers")), "answer")
    called = first(calls.where("id IS NOT NULL"), "called")
    full = checked(calls.drop("json").join(tools, ["conv_id", "name"], "left").join(answered, ["conv_id", "id"], "left"))
    per = full.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.count("answer").alias("n_answered"),
        F.count(F.when(~F.col("valid"), 1)).alias("n_invalid"),
    )
    told = (
        rows.select(*key, "role", "json", F.col("answers").alias("id"))
        .join(per, "row", "left")
        .join(called, ["conv_id", "id"], "left")
    )
    answering = told.where("called IS NOT NULL").select(*key, F.col("called.row").alias("after"), F.col("called.turn").alias("after_turn"))
    using = rows.select(*key, F.explode("uses").alias("id")).join(answered, ["conv_id", "id"]).select(*key, F.col("answer.row").alias("after"), F.col("answer.turn").alias("after_turn"))
    needs = cut(answering.union(using).where("turn IS NOT NULL AND after_turn IS NOT NULL").distinct())
    if not needs.isEmpty():
        told = told.join(places(needs), "row", "left")
    else:
        told = told.withColumns({"place_turn": F.col("turn"), "place_depth": F.lit(0).cast("long"), "cyclic": F.lit(False)})
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return told.select(
        "conv_id",
        "turn",
        "role",
        F.coalesce("place_turn", "turn").alias("place_turn"),
        F.coalesce("place_depth", F.lit(0).cast("long")).alias("place_depth"),
        zero("n_calls"),
        zero("n_answered"),
        zero("n_invalid"),
        (F.col("id").isNotNull() & F.col("called").isNull()).alias("orphan"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        "json",
    )
