"""Chat formatting: tool calls and results linked, ordered, validated and written as JSON.

``messages`` holds one row per part of a conversation: a plain message, a tool call (with
``call_id``, tool ``name``, ``arguments`` as JSON text and ``after``, the calls whose results
it uses) or a tool result (with the ``call_id`` it answers).

Calls and results are hash-joined by conversation and identifier. Of several calls or results
with one identifier the first by turn counts, and the others are reported. The order is
topological: a result comes after its call, and a call after the results that it uses. A part
stands at the turn where it was said, or, where something it depends on was said later, right
after that: every part gets the largest (turn, steps) over what it depends on, by joins that
are repeated while any late result moves something, which is seldom more than once. A call
can only use calls before it, so there are no circles; other uses are reported and dropped.
Arguments are checked against the tool's schema. Each part is written as canonical JSON: keys
sorted, no blanks, letters as they are.

No step brings a conversation together in one task: places are numbered by spans of turns.

Rows: a null text, name or argument is written as null; a null or empty identifier links
nothing; a null conversation is one conversation; repeated rows are repeated parts; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wordloom.llm.common import stored

SPAN = 64
TYPES = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "integer": int,
    "number": (int, float),
    "null": type(None),
}


def canonical(value: object) -> str:
    """Sorted keys, no blanks; half of a surrogate pair, which no text can hold, stays escaped."""
    return escaped(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def escaped(text: str) -> str:
    return LONE.sub(lambda c: f"\\u{ord(c[0]):04x}", text)


LONE = re.compile("[\ud800-\udfff]")
#: The words of JSON Schema that ``problem`` knows, and those that only describe.
WORDS = {"type", "enum", "const", "properties", "required", "additionalProperties", "items"}
WORDS |= {"minimum", "maximum", "minLength", "maxLength", "minItems", "maxItems", "pattern"}
WORDS |= {"title", "description", "default", "examples", "$schema", "$id", "$comment"}


def check_schema(schema: object, at: str = "$") -> None:
    """Refuse a schema with words or types that ``problem`` does not know."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: not a schema")
    unknown = set(schema) - WORDS
    if unknown:
        raise ValueError(f"{at}: unknown words {sorted(unknown)}")
    kinds = schema.get("type", [])
    unknown = set([kinds] if isinstance(kinds, str) else kinds) - set(TYPES)
    if unknown:
        raise ValueError(f"{at}: unknown types {sorted(unknown)}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{at}: additionalProperties is true or false")
    for name, part in schema.get("properties", {}).items():
        check_schema(part, f"{at}.{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")


def _constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def parse(text: str | None) -> object:
    """JSON as the standard has it: no NaN, no infinities."""
    return json.loads(text or "", parse_constant=_constant)


def same(a: object, b: object) -> bool:
    """Equality of JSON values: 1 is 1.0, and neither is true."""
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    return isinstance(a, bool) == isinstance(b, bool) and a == b


def problem(value: object, schema: dict, at: str = "$") -> str | None:
    """The first way in which ``value`` breaks ``schema``, by the words of ``WORDS``."""
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        number = not isinstance(value, bool)  # to Python a boolean is an integer
        whole = isinstance(value, float) and value.is_integer()
        fits = any(
            (isinstance(value, TYPES[k]) or k == "integer" and whole)
            and (number or k not in ("integer", "number"))
            for k in kinds
        )
        if not fits:
            return f"{at}: not {' or '.join(kinds)}"
    if "const" in schema and not same(value, schema["const"]):
        return f"{at}: not the value"
    if "enum" in schema and not any(same(value, x) for x in schema["enum"]):
        return f"{at}: not among the values"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                return f"{at}: {name} is missing"
        if schema.get("additionalProperties") is False:
            for name in sorted(value):
                if name not in known:
                    return f"{at}: {name} is unknown"
        for name in sorted(known):
            if name in value and (found := problem(value[name], known[name], f"{at}.{name}")):
                return found
    sizes = {list: ("minItems", "maxItems"), str: ("minLength", "maxLength")}.get(type(value))
    if sizes:
        if len(value) < schema.get(sizes[0], 0):
            return f"{at}: too short"
        if len(value) > schema.get(sizes[1], len(value)):
            return f"{at}: too long"
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            if found := problem(item, schema["items"], f"{at}[{i}]"):
                return found
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        return f"{at}: does not match the pattern"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"{at}: out of range"
    return None


def check(name: str | None, arguments: str | None, schemas: dict) -> tuple[object, str]:
    """The parsed arguments (or their text where they are not JSON) and what is wrong."""
    if name not in schemas:
        return arguments, "unknown tool"
    try:
        value = parse(arguments)
    except (ValueError, RecursionError):
        return arguments, "not JSON"
    return value, problem(value, schemas[name]) or ""


def _linked(messages: DataFrame) -> DataFrame:
    """Every part with its ``row``, its ``status`` and, for results, the row of their call."""
    parts = messages.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        "conv_id",
        F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
        F.coalesce("part", F.lit(0)).cast("long").alias("part"),
        "kind",
        "role",
        "text",
        F.coalesce("call_id", F.lit("")).alias("call_id"),
        "name",
        "arguments",
        F.coalesce("after", F.array().cast("array<string>")).alias("after"),
        F.monotonically_increasing_id().alias("row"),
    )
    parts = stored(parts, "parts")  # the row numbers hold from here on
    named = parts.where("call_id <> ''")
    first = named.groupBy("conv", "call_id").agg(
        *(
            F.min(F.when(F.col("kind") == kind, F.struct("turn", "part", "row"))).alias(kind)
            for kind in ("call", "result")
        )
    )
    first = first.select(
        "conv",
        "call_id",
        F.col("call.row").alias("call_row"),
        F.col("call.turn").alias("call_turn"),
        F.col("call.part").alias("call_part"),
        F.col("result.row").alias("result_row"),
    )
    # Parts without an identifier meet no key, which so many would make hot.
    joined = named.join(first, ["conv", "call_id"], "left").unionByName(
        parts.where("call_id = ''"), allowMissingColumns=True
    )
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    status = (
        F.when(~call & ~result, "message")
        .when(F.col("call_id") == "", "no identifier")
        .when(call & (F.col("call_row") != F.col("row")), "repeated call")
        .when(result & F.col("call_row").isNull(), "no call")
        .when(result & (F.col("result_row") != F.col("row")), "repeated result")
        .when(call & F.col("result_row").isNull(), "no result")
        .otherwise("linked")
    )
    return stored(joined.withColumn("status", status), "linked")


def _needs(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``row, on``: which row must come before which; ``row, bad_uses``: calls named in vain."""
    call = F.col("kind") == "call"
    answered = parts.where((F.col("kind") == "result") & F.col("call_row").isNotNull())
    by_call = answered.select("row", F.col("call_row").alias("on"))
    uses = parts.where(call & (F.size("after") > 0)).select(
        "conv", "row", "turn", "part", F.explode("after").alias("call_id")
    )
    # A used call, with its result where there is one.
    made = parts.where(call & (F.col("call_row") == F.col("row"))).select(
        "conv",
        "call_id",
        F.coalesce("result_row", "row").alias("on"),
        F.struct("turn", "part", "row").alias("made"),
    )
    own = F.struct("turn", "part", "row")
    met = uses.join(made, ["conv", "call_id"], "left").withColumn(
        "fit", F.col("made").isNotNull() & (F.col("made") < own)
    )
    by_use = met.where("fit").select("row", "on")
    wrong = met.where(~F.col("fit")).groupBy("row").agg(F.count(F.lit(1)).alias("bad_uses"))
    return by_call.unionByName(by_use), wrong


def _ordered(parts: DataFrame, needs: DataFrame) -> DataFrame:
    """``row, at`` with ``at`` = (turn, steps), larger than that of all that a row needs."""
    needs = stored(needs.distinct(), "needs")
    start = F.struct(F.col("turn"), F.lit(0).cast("long").alias("steps"))
    places = stored(parts.select("row", start.alias("at")), "places")
    while True:
        before = places.select(F.col("row").alias("on"), F.col("at").alias("needed"))
        late = needs.join(before, "on").groupBy("row").agg(F.max("needed").alias("needed"))
        after = F.struct(
            F.col("needed.turn").alias("turn"), (F.col("needed.steps") + 1).alias("steps")
        )
        moved = places.join(late, "row", "left").select(
            "row",
            F.when(F.col("needed").isNotNull() & (after > F.col("at")), after)
            .otherwise(F.col("at"))
            .alias("new"),
            "at",
        )
        moved = stored(moved, "places")
        changed = moved.where(F.col("new") != F.col("at")).limit(1).count()
        places = moved.select("row", F.col("new").alias("at"))
        if not changed:
            return places


def _numbered(parts: DataFrame) -> DataFrame:
    """``position`` within the conversation, counted by spans of turns."""
    span = F.floor(F.col("at.turn") / SPAN).alias("span")
    parts = parts.withColumn("span", span)
    before = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("conv", "span").count().select(
        "conv", "span", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("conv", "span").orderBy("at", "turn", "part", "row")
    placed = parts.withColumn("nth", F.row_number().over(within) - 1)
    return placed.join(starts, ["conv", "span"]).withColumn(
        "position", (F.col("before") + F.col("nth")).cast("long")
    )


def format_conversations(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``conv_id, turn, part, position, kind, call_id, status, problem, json`` for every part
    of every conversation; in ``position`` order the ``json`` lines are the conversation. A
    schema with a word that is not in ``WORDS`` is refused before the job."""

    for name, schema in schemas.items():
        check_schema(schema, name)

    @F.arrow_udf("problem string, json string")
    def write(
        kind: pa.Array, role: pa.Array, text: pa.Array, call_id: pa.Array, name: pa.Array,
        arguments: pa.Array,
    ) -> pa.Array:
        problems, lines = [], []
        for k, r, t, i, n, a in zip(
            *(c.to_pylist() for c in (kind, role, text, call_id, name, arguments))
        ):
            wrong, body = "", {"role": r, "content": t}
            if k == "call":
                value, wrong = check(n, a, schemas)
                function = {"name": n, "arguments": value}
                call = {"id": i, "type": "function", "function": function}
                body = {"role": r, "tool_calls": [call]}
            elif k == "result":
                body = {"role": "tool", "tool_call_id": i, "content": t}
            problems.append(escaped(wrong))
            lines.append(canonical(body))
        return pa.StructArray.from_arrays(
            [pa.array(problems, pa.string()), pa.array(lines, pa.string())], ["problem", "json"]
        )

    parts = _linked(messages)
    needs, wrong = _needs(parts)
    places = _ordered(parts, needs)
    whole = _numbered(parts.join(places, "row")).join(wrong, "row", "left")
    written = whole.withColumn(
        "w", write("kind", "role", "text", "call_id", "name", "arguments")
    )
    return written.select(
        "conv_id",
        "turn",
        "part",
        "position",
        "kind",
        "call_id",
        "status",
        F.coalesce("bad_uses", F.lit(0)).cast("long").alias("bad_uses"),
        F.col("w.problem").alias("problem"),
        F.col("w.json").alias("json"),
    )


#: The tool that plain question-and-answer turns are read as calls of.
ANSWER_TOOL = {
    "answer": {
        "type": "object",
        "required": ["prompt", "turn"],
        "additionalProperties": False,
        "properties": {
            "prompt": {"type": "string", "minLength": 20, "maxLength": 400},
            "turn": {"type": "integer", "minimum": 0},
        },
    }
}


def exchanges(conversations: DataFrame) -> DataFrame:
    """Plain conversations (``conv_id, turn, role, text``) as tool calls: the user's turn is
    a call of ``answer`` with the text as its prompt, the assistant's next turn its result,
    and a call uses the result of the call two turns before. Other turns are messages."""
    identifier = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn)
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    # Compact JSON with sorted keys, as a log would hold it.
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn").alias("turn")))
    earlier = F.when(F.col("turn") >= 2, F.array(identifier(F.col("turn") - 2)))
    return conversations.select(
        "conv_id",
        "turn",
        F.lit(0).alias("part"),
        F.when(user, "call").when(assistant, "result").otherwise("message").alias("kind"),
        F.when(user, "assistant").otherwise(F.col("role")).alias("role"),
        F.when(~user | user.isNull(), F.col("text")).alias("text"),
        F.when(user, identifier(F.col("turn")))
        .when(assistant, identifier(F.col("turn") - 1))
        .alias("call_id"),
        F.when(user, "answer").alias("name"),
        F.when(user, arguments).alias("arguments"),
        F.when(user, earlier).alias("after"),
    )


#: ``format_conversations(exchanges(conversations))`` in DuckDB SQL.
ORACLE = r"""
WITH p AS (
  SELECT conv_id, turn, role, text,
    CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
    CASE role WHEN 'user' THEN conv_id || '-' || turn
      WHEN 'assistant' THEN conv_id || '-' || (turn - 1) ELSE '' END AS call_id
  FROM conversations
), c AS (SELECT conv_id, call_id, turn FROM p WHERE kind = 'call'),
r AS (SELECT conv_id, call_id FROM p WHERE kind = 'result')
SELECT p.conv_id, p.turn, 0::BIGINT AS part,
  row_number() OVER (PARTITION BY p.conv_id ORDER BY p.turn) - 1 AS position,
  kind, p.call_id,
  CASE WHEN kind = 'message' THEN 'message'
    WHEN kind = 'call' AND r.call_id IS NULL THEN 'no result'
    WHEN kind = 'result' AND c.call_id IS NULL THEN 'no call' ELSE 'linked' END AS status,
  CASE WHEN kind = 'call' AND p.turn >= 2 AND u.call_id IS NULL THEN 1 ELSE 0 END::BIGINT AS bad_uses,
  CASE WHEN kind <> 'call' THEN '' WHEN length(text) < 20 THEN '$.prompt: too short'
    WHEN length(text) > 400 THEN '$.prompt: too long' ELSE '' END AS problem,
  CASE kind
    WHEN 'call' THEN '{"role":"assistant","tool_calls":[{"function":{"arguments":{"prompt":'
      || to_json(text) || ',"turn":' || p.turn || '},"name":"answer"},"id":"' || p.call_id
      || '","type":"function"}]}'
    WHEN 'result' THEN '{"content":' || to_json(text) || ',"role":"tool","tool_call_id":"'
      || p.call_id || '"}'
    ELSE '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' END AS json
FROM p LEFT JOIN c ON kind = 'result' AND c.conv_id = p.conv_id AND c.call_id = p.call_id
  LEFT JOIN r ON kind = 'call' AND r.conv_id = p.conv_id AND r.call_id = p.call_id
  LEFT JOIN c u ON kind = 'call' AND u.conv_id = p.conv_id
    AND u.call_id = p.conv_id || '-' || (p.turn - 2)
"""
