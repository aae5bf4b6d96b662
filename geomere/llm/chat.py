"""Tool-call linking for chat data.

Calls and results are joined by conversation and identifier, as identifiers are used anew in other conversations; of
several with one identifier the first (by turn and content) counts. Calls are put in topological order of what they
depend on. The calls of a conversation with at most ``IN_TASK`` calls and dependencies are ordered in one task; those of
larger ones by Spark jobs, chains by doubling pointers, the rest level by level, with joins and grouped counts, to the same
result. A call's arguments are checked against its tool's schema, and the linked pair is written as
canonical JSON: keys sorted, no spaces, the shortest numbers, only what must be escaped
escaped.

Defined results: a null or empty arguments text is not valid JSON; an unknown tool is not valid;
dependencies on identifiers without a call are met; calls in a cycle, or behind one, have no
level; a null identifier links to nothing, a null conversation is one like any other; rows repeated in full count
once; long texts are read some hundred rows at a time; a table without rows gives none; other columns are not read, whatever
their names.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .arrow import small

#: Calls and dependencies of a conversation that are ordered in one task; more of them take Spark jobs.
IN_TASK = 10_000

_KINDS = {"string": str, "boolean": bool, "object": dict, "array": list}


def canonical(value) -> str:
    """A JSON value in its one canonical form."""
    if isinstance(value, dict):
        # in the order of UTF-16 code units
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("JSON has no such number")
        if value == int(value) and abs(value) < 1e21:
            return str(int(value))
        digits, _, power = repr(value).partition("e")
        if not power:
            return digits
        if -7 < int(power) < 0:
            return f"{value:.{max(0, len(digits.replace('.', '').lstrip('-')) - 1 - int(power))}f}"
        return f"{digits.removesuffix('.0')}e{int(power):+d}"
    return json.dumps(value, ensure_ascii=False)


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Where a JSON value breaks a schema (type, enum, bounds, lengths, properties, required, additionalProperties, items)."""
    kind, out = schema.get("type"), []
    number = isinstance(value, int | float) and not isinstance(value, bool)
    whole = number and value == int(value) if number and math.isfinite(value) else False
    fits = {"number": number, "integer": whole, "null": value is None}.get(kind, kind is None or isinstance(value, _KINDS.get(kind, object)))
    if not fits:
        return [f"{at}: not of type {kind}"]
    if "enum" in schema and not any(canonical(value) == canonical(x) for x in schema["enum"]):
        out.append(f"{at}: not among the values")
    if number and (value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf)):
        out.append(f"{at}: out of bounds")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        out.append(f"{at}: length")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in sorted(value) if k not in known]
        for k, x in value.items():
            if k in known:
                out += violations(x, known[k], f"{at}.{k}")
    return out


def _chains(single: DataFrame) -> DataFrame:
    """head and distance of every call with one dependency. ``single``: call_id, head (what it depends on).

    A chain's head is its first call that is not in ``single``. Pointers double their reach with each join, so a
    chain of any length takes as many joins as its length has bits. What has no head then runs in circles.
    """
    reach = written(single.withColumn("distance", F.lit(1)), "chains")
    for _ in range(max(reach.count(), 1).bit_length()):
        further = reach.select(F.col("call_id").alias("head"), F.col("head").alias("_head"), F.col("distance").alias("_distance"))
        met = written(reach.join(further, "head", "left"), "chains")
        if met.where("_head is not null").isEmpty():
            break
        reach = met.select("call_id", F.coalesce("_head", "head").alias("head"), (F.col("distance") + F.coalesce("_distance", F.lit(0))).alias("distance"))
    return reach.join(single.select(F.col("call_id").alias("head")), "head", "left_anti").select("call_id", "head", "distance")


def _by_rounds(calls: DataFrame) -> DataFrame:
    """call_id and level of every call whose dependencies can be met. ``calls``: call_id (unique, of any type), after (array of call_id).

    Calls with one dependency are followed along their chains at once; rounds are only
    needed for calls with several.
    """
    needs = calls.select("call_id", F.explode("after").alias("need")).where("need is not null").distinct()
    needs = written(needs.join(calls.select(F.col("call_id").alias("need")), "need", "left_semi"), "needs")
    counted = written(needs.groupBy("call_id").agg(F.count("*").alias("n"), F.min("need").alias("head")), "counted")
    free = calls.select("call_id").join(counted, "call_id", "left_anti")
    many = counted.where("n > 1").select("call_id")
    chained = _chains(counted.where("n = 1").select("call_id", "head"))
    placed = written(free.unionByName(many).select("call_id", F.col("call_id").alias("head"), F.lit(0).alias("distance")).unionByName(chained), "placed")
    open_ = needs.join(many, "call_id", "left_semi").join(placed.select(F.col("call_id").alias("need"), "head", "distance"), "need", "left")
    open_ = written(open_.select("call_id", "head", "distance"), "open")
    known = written(free.select(F.col("call_id").alias("head"), F.lit(0).alias("level")), "levels")
    while not open_.isEmpty():
        met = open_.join(known, "head", "left").withColumn("level", F.col("level") + F.col("distance"))
        ready = met.groupBy("call_id").agg(F.count("*").alias("n"), F.count("level").alias("met"), F.max("level").alias("top")).where("n = met")
        ready = written(ready.select(F.col("call_id").alias("head"), (F.col("top") + 1).alias("level")), "levels")
        if ready.isEmpty():
            break
        known = written(known.unionByName(ready), "levels")
        open_ = written(open_.join(ready.select(F.col("head").alias("call_id")), "call_id", "left_anti"), "open")
    return placed.join(known, "head").select("call_id", (F.col("level") + F.col("distance")).alias("level"))


def topological(calls: list[tuple[str, list]]) -> dict[str, int]:
    """The level of every call of a conversation that is not in or behind a cycle: (call_id, after)."""
    known = {c for c, _ in calls}
    open_ = {c: {a for a in after or () if a in known} for c, after in calls}
    behind, level = defaultdict(list), dict.fromkeys((c for c, needs in open_.items() if not needs), 0)
    for c, needs in open_.items():
        for a in needs:
            behind[a].append(c)
    ready = list(level)
    for c in ready:  # grows while it is read
        for d in behind[c]:
            open_[d].discard(c)
            if not open_[d]:
                level[d] = level[c] + 1  # the last one met is the deepest, as calls come in order of their levels
                ready.append(d)
    return level


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id and level of every call whose dependencies can be met. ``calls``: conv_id, call_id (unique in it), after (array of call_id)."""
    calls = written(calls.where("call_id IS NOT NULL").select("conv_id", "call_id", F.filter(F.coalesce("after", F.array().cast("array<string>")), lambda a: a.isNotNull()).alias("after")), "to_order")
    weight = calls.groupBy("conv_id").agg(F.sum(F.size("after") + 1).alias("n")).where(F.col("n") > IN_TASK)
    large = written(weight.select(F.col("conv_id").alias("_conv")), "large")
    of_large = F.col("conv_id").eqNullSafe(F.col("_conv"))
    kind = calls.schema["conv_id"].dataType.simpleString()

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 16):
            at, ids, level = [], [], []
            for i, own in enumerate(b.column(1).to_pylist()):
                found = topological([(c["call_id"], c["after"]) for c in own])
                at += [i] * len(found)
                ids += found.keys()
                level += found.values()
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(ids, pa.string()), pa.array(level, pa.int32())], ["conv_id", "call_id", "level"])

    grouped = calls.join(large, of_large, "left_anti").groupBy("conv_id").agg(F.collect_list(F.struct("call_id", "after")).alias("own"))
    found = grouped.select("conv_id", "own").mapInArrow(order, f"conv_id {kind}, call_id string, level int")
    if large.isEmpty():
        return found
    named = lambda c: F.struct(F.col("conv_id").alias("conv"), c.alias("call"))
    big = calls.join(large, of_large, "left_semi").select(named(F.col("call_id")).alias("call_id"), F.transform("after", named).alias("after"))
    return found.unionByName(_by_rounds(big).select(F.col("call_id.conv").alias("conv_id"), F.col("call_id.call").alias("call_id"), F.col("level").cast("int").alias("level")))


def _named() -> Column:
    """What a call or result is known by; null, and so equal to nothing, without an identifier."""
    return F.when(F.col("call_id").isNotNull(), F.struct("conv_id", "call_id"))


def _first(rows: DataFrame, content: str) -> DataFrame:
    """The rows with _id, and ``first``: whether each is the first by that name."""
    rows = rows.distinct().withColumn("_id", _named()).withColumn("_order", F.struct("turn", F.xxhash64(content), content))
    least = rows.where("_id IS NOT NULL").groupBy("_id").agg(F.min("_order").alias("_least"))
    return rows.join(least, "_id", "left").withColumn("first", F.col("_id").isNotNull() & F.col("_order").eqNullSafe(F.col("_least"))).drop("_order", "_least")


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """A row for each call and for each result that no call gets.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), after (array of call_id of the same conversation).
    ``results``: conv_id, turn, call_id, content. The result has conv_id, turn, call_id, status
    (linked, unanswered, orphan or duplicate), level, valid and json.
    """
    calls = written(_first(calls.select("conv_id", "turn", "call_id", "name", "arguments", "after"), "arguments"), "calls")
    results = written(_first(results.select("conv_id", "turn", "call_id", "content"), "content"), "results")
    # rows that differ in other columns only may be first together: one of them counts
    counted = calls.where("first").dropDuplicates(["_id"])
    other_calls = calls.where("NOT first")
    answers = results.where("first").select("_id", "content", F.lit(True).alias("answered"))
    pairs = counted.join(answers.hint("shuffle_hash"), "_id", "left")
    placed = levels(counted.select("conv_id", "call_id", "after")).withColumn("_id", _named()).select("_id", "level")
    pairs = pairs.join(placed, "_id", "left")
    none = lambda kind: F.lit(None).cast(kind)
    columns = ["conv_id", "turn", "call_id", "status", "level", "name", "arguments", "content"]
    rows = pairs.withColumn("status", F.when(F.col("answered"), "linked").otherwise("unanswered")).select(columns)
    rows = rows.unionByName(other_calls.withColumns({"status": F.when(F.col("call_id").isNull(), "unanswered").otherwise("duplicate"), "level": none("int"), "content": none("string")}).select(columns))
    bare = {"level": none("int"), "name": none("string"), "arguments": none("string")}
    lost = results.where("first").join(counted, "_id", "left_anti").withColumns({"status": F.lit("orphan"), **bare})
    later = results.where("not first").withColumns({"status": F.when(F.col("call_id").isNull(), "orphan").otherwise("duplicate"), **bare})
    rows = rows.unionByName(lost.select(columns)).unionByName(later.select(columns))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            valid, texts = [], []
            for call, name, given, content in zip(*(b.column(i).to_pylist() for i in (2, 5, 6, 7)), strict=True):
                out = {"id": call, "name": name, "result": content}
                ok = None
                if name is not None or given is not None:
                    try:
                        out["arguments"] = json.loads(given or "")
                        ok = name in schemas and not violations(out["arguments"], schemas[name])
                        canonical(out["arguments"])
                    except (ValueError, RecursionError):
                        out["arguments"], ok = given, False
                valid.append(ok)
                texts.append(canonical({k: v for k, v in out.items() if v is not None}))
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(valid, pa.bool_()), pa.array(texts, pa.string())], ["conv_id", "turn", "call_id", "status", "level", "valid", "json"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(write, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, call_id string, status string, level int, valid boolean, json string")


#: What a user's turn asks of the assistant, as a tool.
REPLY = {
    "type": "object",
    "properties": {"turn": {"type": "integer", "minimum": 0}, "text": {"type": "string", "minLength": 1, "maxLength": 250}},
    "required": ["turn", "text"],
    "additionalProperties": False,
}


def replies(conversations: DataFrame) -> DataFrame:
    """Conversations as tool calls: each user turn calls ``reply``, after the conversation's call two turns before; the turn after it is its result. Turns of other roles are not read; see :func:`turns`."""
    name = lambda turn: F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), turn.cast("string"))
    turn = F.col("turn")
    user = conversations.where("role = 'user'")
    arguments = F.to_json(F.struct(F.col("text"), turn.alias("turn")))
    calls = user.select("conv_id", "turn", name(turn).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), F.array(name(turn - 2)).alias("after"))
    results = conversations.where("role = 'assistant'").select("conv_id", "turn", name(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return linked(calls, results, {"reply": REPLY})


def turns(conversations: DataFrame) -> DataFrame:
    """:func:`replies`, and a row for each turn of another role: its status is system, or other (null roles too), its json has role, text and turn."""
    rest = conversations.where("NOT (role <=> 'user' OR role <=> 'assistant')").select("conv_id", "turn", "role", "text").distinct()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            rows = zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            texts = [canonical({k: v for k, v in {"turn": turn, "role": role, "text": text}.items() if v is not None}) for turn, role, text in rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], ["conv_id", "turn", "role", "text", "json"])

    kinds = dict(rest.dtypes)
    rest = rest.mapInArrow(write, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, json string")
    status = F.when(F.col("role") == "system", "system").otherwise("other")
    return replies(conversations).unionByName(rest.select("conv_id", "turn", status.alias("status"), "json"), allowMissingColumns=True)


#: What :func:`turns` gives, in SQL.
TURNS_SQL = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, text, 'c-' || conv_id || '-' || turn AS call_id FROM conversations WHERE role = 'user'
), depth AS (
  SELECT c.conv_id, c.turn, 0 AS level FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, d.level + 1 FROM calls c JOIN depth d ON c.conv_id = d.conv_id AND c.turn = d.turn + 2
), results AS (
  SELECT conv_id, turn, text, 'c-' || conv_id || '-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'
)
SELECT c.conv_id, c.turn, c.call_id, CASE WHEN r.text IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
  CAST(d.level AS INTEGER) AS level, length(c.text) BETWEEN 1 AND 250 AS valid,
  '{"arguments":{"text":' || to_json(c.text) || ',"turn":' || c.turn || '},"id":"' || c.call_id || '","name":"reply"'
    || CASE WHEN r.text IS NULL THEN '' ELSE ',"result":' || to_json(r.text) END || '}' AS json
FROM calls c JOIN depth d ON c.conv_id = d.conv_id AND c.turn = d.turn LEFT JOIN results r ON r.call_id = c.call_id
UNION ALL
SELECT r.conv_id, r.turn, r.call_id, 'orphan', NULL, NULL, '{"id":"' || r.call_id || '","result":' || to_json(r.text) || '}'
FROM results r WHERE r.call_id NOT IN (SELECT call_id FROM calls)
UNION ALL
SELECT conv_id, turn, NULL, CASE WHEN role = 'system' THEN 'system' ELSE 'other' END, NULL, NULL,
  '{' || CASE WHEN role IS NULL THEN '' ELSE '"role":' || to_json(role) || ',' END || CASE WHEN text IS NULL THEN '' ELSE '"text":' || to_json(text) || ',' END || '"turn":' || turn || '}'
FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant'))
"""
