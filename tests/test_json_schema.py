"""Nested contracts, keyword by keyword."""

from __future__ import annotations

import json

import pytest

from martloom.functions.contract import Contract, backtest, check_messages
from martloom.functions.json_schema import NestedContract, UnsupportedSchema

ITEM = {"type": "object", "required": ["sku"], "properties": {"sku": {"type": "string"}}}
CASES = [
    # schema, then texts with their verdicts
    (
        {"type": "object", "properties": {"a": {"properties": {"b": {"type": ["integer", "null"]}}}}},
        {
            '{"a":{"b":1}}': "ok", '{"a":{"b":null}}': "ok", '{"a":{}}': "ok", "{}": "ok",
            '{"a":7}': "ok", '{"a":{"b":"x"}}': "type:a.b", '{"a":{"b":1.5}}': "type:a.b",
            '{"a":{"b":1e3}}': "ok", "[1]": "type:$", "{oops": "not_json", "": "not_json",
        },
    ),
    (
        {"required": ["items"], "properties": {"items": {"type": "array", "items": ITEM}}},
        {
            '{"items":[]}': "ok", '{"items":[{"sku":"a"},{"sku":"b"}]}': "ok",
            '{"items":[{"sku":"a"},{"sku":2}]}': "type:items[1].sku",
            '{"items":[{"sku":"a"},{},{"sku":1}]}': "missing:items[1].sku",
            '{"items":[null]}': "type:items[0]", '{"items":{}}': "type:items",
            "{}": "missing:items", "7": "ok", '{"items":null}': "type:items",
        },
    ),
    (
        {"items": {"items": {"minimum": 2, "maximum": 5}}},
        {
            "[[2,5],[]]": "ok", '[["a",true,null]]': "ok", "[[3],[4,1]]": "minimum:$[1][1]",
            "[[5.01]]": "maximum:$[0][0]", "[1,2]": "ok", '{"a":1}': "ok",
        },
    ),
    (
        {"exclusiveMinimum": 0, "exclusiveMaximum": 10},
        {"0": "exclusiveMinimum:$", "10": "exclusiveMaximum:$", "0.5": "ok", '"x"': "ok",
         "99999999999999999999999999999999999999999": "exclusiveMaximum:$"},
    ),
    (
        {"enum": ["a", 1, None, True]},
        {'"a"': "ok", "1": "ok", "1.0": "ok", "null": "ok", "true": "ok", "false": "enum:$",
         '"1"': "enum:$", "2": "enum:$", "[1]": "enum:$"},
    ),
    ({"const": "x"}, {'"x"': "ok", '"y"': "const:$", "null": "const:$"}),
    (
        {"minLength": 2, "maxLength": 3, "pattern": "^[a-zé]+$"},
        {'"ab"': "ok", '"a"': "minLength:$", '"abcd"': "maxLength:$", '"éé"': "ok",
         '"a1"': "pattern:$", "7": "ok"},
    ),
    (
        {"minItems": 1, "maxItems": 2},
        {"[]": "minItems:$", "[1]": "ok", "[1,2,3]": "maxItems:$", '"x"': "ok", "{}": "ok"},
    ),
    (
        {"properties": {"o": {"properties": {"a": True}, "additionalProperties": False}}},
        {'{"o":{"a":1}}': "ok", '{"o":{"a":1,"b":2}}': "extra:o", '{"o":[1]}': "ok"},
    ),
    (
        {"properties": {"a": {}}, "additionalProperties": {"type": "integer"}},
        {'{"a":"x","b":1}': "ok", '{"b":"x"}': "type:b", '{"b":1,"c":null}': "type:c", "[]": "ok"},
    ),
    (
        {"properties": {"m": {"additionalProperties": {"items": {"type": "string"}}}}},
        {'{"m":{"k":["a"],"l":["b",3]}}': "type:m.l[1]", '{"m":{"k":"not a list"}}': "ok"},
    ),
    (
        {"properties": {"gone": False, "any": True}},
        {'{"any":1}': "ok", '{"gone":null}': "forbidden:gone"},
    ),
    (
        {"allOf": [{"required": ["a"]}, {"required": ["b"]}]},
        {'{"a":1,"b":2}': "ok", '{"a":1}': "missing:b", '{"b":1}': "missing:a"},
    ),
    (
        {"properties": {"x": {"anyOf": [{"type": "string"}, {"minimum": 5, "type": "number"}]}}},
        {'{"x":"a"}': "ok", '{"x":6}': "ok", '{"x":4}': "anyOf:x", "{}": "ok"},
    ),
    (
        {"$defs": {"id": {"type": "integer"}}, "properties": {"a": {"$ref": "#/$defs/id"},
         "b": {"items": {"$ref": "#/$defs/id"}}}},
        {'{"a":1,"b":[2]}': "ok", '{"a":"1"}': "type:a", '{"b":[1,"2"]}': "type:b[1]"},
    ),
    (True, {"7": "ok", "{": "not_json"}),
    (False, {"7": "forbidden:$"}),
    (
        {"properties": {"dots.and spaces": {"type": "string"}, "größe": {"type": "string"}}},
        {'{"dots.and spaces":1}': "type:dots.and spaces", '{"größe":1}': "type:größe"},
    ),
]


@pytest.mark.parametrize("number", range(len(CASES)))
def test_verdicts(spark, number):
    schema, texts = CASES[number]
    contract = NestedContract.from_json_schema(json.dumps(schema))
    messages = spark.createDataFrame([(text,) for text in texts], "value string")
    found = {row.value: row.verdict for row in check_messages(messages, contract).collect()}
    assert found == texts
    nothing = spark.createDataFrame([(None,)], "value string")
    assert check_messages(nothing, contract).first().verdict == "not_json"


@pytest.mark.parametrize(
    "schema, message",
    [
        ({"uniqueItems": True}, "unsupported in a contract: uniqueItems"),
        ({"properties": {"a": {"format": "date"}}}, "unsupported in a contract: format"),
        ({"items": {"not": {}}}, "unsupported in a contract: not"),
        ({"type": "text"}, "unknown JSON type"),
        ({"type": []}, "unknown JSON type"),
        ({"enum": [[1]]}, "only plain values"),
        ({"enum": []}, "enum must list values"),
        ({"minimum": "1"}, "minimum must be a number"),
        ({"required": "a"}, "required must list"),
        ({"anyOf": []}, "anyOf must list"),
        ({"$ref": "#/$defs/x"}, "there is no"),
        ({"$ref": "other.json#/x"}, "another document"),
        ({"$defs": {"x": {"items": {"$ref": "#/$defs/x"}}}, "$ref": "#/$defs/x"}, "back to itself"),
        ({"properties": {"it's": True and {"type": "string"}}}, "quotes and backslashes"),
        ({"items": [1]}, "not a schema"),
    ],
)
def test_refused_schemas(spark, schema, message):
    with pytest.raises(UnsupportedSchema, match=message):
        NestedContract.from_json_schema(json.dumps(schema))


def test_a_flat_contract_and_its_schema_agree(spark):
    schema = {
        "$schema": "x", "title": "y", "type": "object", "required": ["id"],
        "properties": {"id": {"type": "integer"}, "msg": {"type": "string"}},
    }
    texts = ['{"id":1}', '{"id":1,"msg":2}', '{"msg":"a"}', '{"id":"1"}', "{", '{"id":2,"x":[]}']
    messages = spark.createDataFrame([(text,) for text in texts], "value string")
    flat = Contract.from_json_schema(json.dumps(schema))
    nested = NestedContract.from_json_schema(json.dumps(schema))
    found = [check_messages(messages, c).collect() for c in (flat, nested)]
    assert found[0] == found[1]
    stricter = NestedContract({**schema, "additionalProperties": False})
    assert backtest(messages, flat, stricter).first() == (6, 1)


def test_deep_schemas_plan_in_time(spark):
    schema: dict = {"type": "integer"}
    text = "1.5"
    for _ in range(12):
        schema = {"type": "object", "required": ["a"], "properties": {"a": schema}}
        text = '{"a":' + text + "}"
    messages = spark.createDataFrame([(text,)], "value string")
    found = check_messages(messages, NestedContract(schema)).first()
    assert found.verdict == "type:" + ".".join("a" * 12)
