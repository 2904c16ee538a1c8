"""Histories of contracts against comparisons of all pairs."""

from __future__ import annotations

import json
import random

import pytest

from martloom.functions.contract import SPARK_TYPES, Contract, newly_refused, value_subject
from martloom.operators.contract_history import contract_history, topic_history

VERSIONS = "subject string, version long, schema string"


def drawn(rng):
    """A schema of a few properties."""
    kinds = list(SPARK_TYPES)
    properties = {}
    for name in rng.sample(["a", "b", "c d", "e"], rng.randint(0, 3)):
        types = rng.sample(kinds[:3], rng.randint(1, 2))
        properties[name] = rng.choice([{}, {"type": types}, {"type": types[0]}, {"type": types}])
    schema = {"type": "object", "properties": properties}
    if rng.random() < 0.5:
        schema["required"] = rng.sample(["a", "b", "z"], rng.randint(1, 2))
    if rng.random() < 0.5:
        schema["additionalProperties"] = rng.random() < 0.3
    return schema


def expected(schemas):
    """(version, backward, forward, full) from all pairs."""
    contracts = [Contract.from_json_schema(json.dumps(schema)) for schema in schemas]
    rows = []
    for at, new in enumerate(contracts):
        backward = not any(newly_refused(old, new) for old in contracts[:at])
        forward = not any(newly_refused(new, old) for old in contracts[:at])
        rows.append((at, backward, forward, backward and forward))
    return rows


def test_histories_equal_all_pairs(spark):
    rng = random.Random(12)
    subjects = {f"s{n}": [drawn(rng) for _ in range(rng.randint(1, 4))] for n in range(150)}
    # Long histories of contracts that widen, narrow or stay.
    for n, steps in enumerate(([1, 2, 3, 4], [4, 3, 2, 1], [2, 2, 2])):
        names = ["a", "b", "c d", "e"]
        subjects[f"long{n}"] = [
            {"type": "object", "properties": {k: {"type": "string"} for k in names[:s]},
             "additionalProperties": n != 0} for s in steps
        ]
    rows = [(s, at, json.dumps(x)) for s, found in subjects.items() for at, x in enumerate(found)]
    rng.shuffle(rows)
    found = {}
    for row in contract_history(spark.createDataFrame(rows, VERSIONS)).collect():
        found.setdefault(row.subject, []).append((row.version, row.backward, row.forward, row.full))
    assert {s: sorted(x) for s, x in found.items()} == {s: expected(x) for s, x in subjects.items()}
    flags = [row[1:3] for x in found.values() for row in x if row[0]]
    assert {(True, True), (True, False), (False, True), (False, False)} <= set(flags)


def test_one_topic(spark):
    whole = '{"type":"object","properties":{"id":{"type":"integer"}},"required":["id"]}'
    wider = '{"type":"object","properties":{"id":{"type":"number"}},"required":["id"]}'
    rows = [(value_subject("t"), 1, whole), (value_subject("t"), 2, wider), ("other", 1, "{}")]
    found = topic_history(spark.createDataFrame(rows, VERSIONS), "t")
    assert sorted(map(tuple, found.collect())) == [(1, True, True, True), (2, True, False, False)]
    assert topic_history(spark.createDataFrame(rows, VERSIONS), "none").isEmpty()


def test_unreadable_schemas_are_errors(spark):
    for text, message in (("{oops", "MALFORMED_RECORD"), ('{"properties":{"a":{"type":"text"}}}', "unknown JSON type text")):
        with pytest.raises(Exception, match=message):
            contract_history(spark.createDataFrame([("s", 1, text)], VERSIONS)).collect()
