"""Linking, order, validation and canonical form of tool calls."""

import json

import pytest

from wordloom.llm import tool_calls
from wordloom.llm.tool_calls import canonical, check, format_conversations, problem

SCHEMAS = {
    "find": {
        "type": "object",
        "required": ["q"],
        "additionalProperties": False,
        "properties": {
            "q": {"type": "string", "minLength": 1, "pattern": "^[a-z ]*$"},
            "n": {"type": "integer", "minimum": 1, "maximum": 9},
            "tags": {"type": "array", "items": {"enum": ["x", "y"]}, "maxItems": 2},
        },
    }
}
COLUMNS = (
    "conv_id long, turn long, part int, kind string, role string, text string, call_id string,"
    " name string, arguments string, after array<string>"
)


@pytest.mark.parametrize(
    "arguments,wrong",
    [
        ('{"q": "a b", "n": 3, "tags": ["x"]}', ""),
        ('{"n": 3}', "$: q is missing"),
        ('{"q": "a", "z": 1}', "$: z is unknown"),
        ('{"q": ""}', "$.q: too short"),
        ('{"q": "A"}', "$.q: does not match the pattern"),
        ('{"q": "a", "n": 10}', "$.n: out of range"),
        ('{"q": "a", "n": true}', "$.n: not integer"),
        ('{"q": "a", "tags": ["x", "z"]}', "$.tags[1]: not among the values"),
        ('{"q": "a", "tags": ["x", "x", "x"]}', "$.tags: too long"),
        ("[1]", "$: not object"),
        ("{", "not JSON"),
        ('{"q": NaN}', "not JSON"),
        (None, "not JSON"),
    ],
)
def test_check(arguments, wrong):
    assert check("find", arguments, SCHEMAS)[1] == wrong


def test_other_schemas():
    assert check("none", "{}", SCHEMAS)[1] == "unknown tool"
    assert problem(None, {"type": ["string", "null"]}) is None
    assert problem(1.5, {"type": "number"}) is None
    assert canonical({"b": [1, {"z": "é", "a": None}], "a": True}) == '{"a":true,"b":[1,{"a":null,"z":"é"}]}'


def test_conversations(spark, frame):
    call = lambda c, t, i, after=None, args='{"q":"a"}': (
        c, t, 0, "call", "assistant", None, i, "find", args, after
    )
    result = lambda c, t, i: (c, t, 0, "result", "tool", f"r{t}", i, None, None, None)
    said = lambda c, t, x: (c, t, 0, "message", "user", x, None, None, None, None)
    rows = [
        said(1, 0, "hi"),
        call(1, 1, "a"),
        call(1, 2, "b", ["a"]),
        result(1, 3, "b"),
        result(1, 9, "a"),  # late: the call that uses it, and its result, move behind it
        said(1, 5, None),
        call(1, 6, "a"),
        result(1, 10, "a"),
        result(1, 11, "zz"),
        call(1, 12, "c", ["d", "b"]),
        call(1, 13, "d"),
        call(2, 0, "a", None, '{"q":"A"}'),
        result(2, -1, "a"),  # before its call
        call(None, 0, "n"),
        result(None, 1, "n"),
        call(3, 0, None),
        call(3, 0, ""),
    ]
    got = format_conversations(spark.createDataFrame(rows, COLUMNS).repartition(3), SCHEMAS)
    got = sorted(got.collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.position))
    one = [r for r in got if r.conv_id == 1]
    assert [r.turn for r in one] == [0, 1, 5, 6, 9, 2, 3, 10, 11, 12, 13]
    assert [r.position for r in one] == list(range(11))
    assert {r.turn: r.status for r in one} == {
        0: "message", 1: "linked", 2: "linked", 3: "linked", 5: "message", 6: "repeated call",
        9: "linked", 10: "repeated result", 11: "no call", 12: "no result", 13: "no result",
    }
    assert {r.turn: r.bad_uses for r in one if r.bad_uses} == {12: 1}
    two = [r for r in got if r.conv_id == 2]
    assert [(r.kind, r.problem) for r in two] == [
        ("call", "$.q: does not match the pattern"), ("result", "")
    ]
    assert [r.status for r in got if r.conv_id is None] == ["linked", "linked"]
    assert [r.status for r in got if r.conv_id == 3] == ["no identifier"] * 2
    assert one[5].json == (
        '{"role":"assistant","tool_calls":[{"function":{"arguments":{"q":"a"},"name":"find"},'
        '"id":"b","type":"function"}]}'
    )
    assert json.loads(one[2].json) == {"role": "user", "content": None}


def test_spans_of_turns(spark, frame):
    rows = [(7, t, 0, "message", "user", str(t), None, None, None, None) for t in range(300)]
    rows += [(8, 5, p, "message", "user", "x", None, None, None, None) for p in range(40)]
    got = format_conversations(spark.createDataFrame(rows, COLUMNS), {}).collect()
    assert all(r.position == r.turn for r in got if r.conv_id == 7)
    assert sorted(r.position for r in got if r.conv_id == 8) == list(range(40))


def test_empty(spark, frame):
    assert format_conversations(spark.createDataFrame([], COLUMNS), SCHEMAS).collect() == []


@pytest.mark.parametrize(
    "value, schema, fine",
    [
        (1.0, {"type": "integer"}, True),
        (1.5, {"type": "integer"}, False),
        (True, {"enum": [1]}, False),
        (1, {"enum": [True, 1.0]}, True),
        ({"a": [1]}, {"const": {"a": [1.0]}}, True),
        (None, {"const": 0}, False),
    ],
)
def test_schema_values(value, schema, fine):
    assert (tool_calls.problem(value, schema) is None) == fine


def test_unknown_schema_words_are_refused():
    for schema in ({"anyOf": []}, {"type": "date"}, {"items": {"not": {}}}, {"properties": {"x": 3}}):
        with pytest.raises(ValueError):
            tool_calls.check_schema(schema)


def test_half_surrogates_stay_escaped():
    value = tool_calls.parse('{"b": "\\ud800", "a": "\\ud83d\\ude00"}')
    text = tool_calls.canonical(value)
    assert text == '{"a":"😀","b":"\\ud800"}' and text.encode()
    assert tool_calls.parse(text) == value
