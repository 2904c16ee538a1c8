"""Sources and rules from plain mappings, as configuration files give them."""

from __future__ import annotations

import pytest

from martloom.operators.quality import Expectations
from martloom.sources.tables import TableSource, sources_from_mapping


def test_sources():
    found = sources_from_mapping(
        {"sales": {"table": "s.sales", "renames": {"a": "b"}}, "shops": {"table": "shops"},
         "none": {"table": "t", "renames": None}}
    )
    assert found == {
        "sales": TableSource("s.sales", {"a": "b"}), "shops": TableSource("shops"),
        "none": TableSource("t"),
    }
    assert sources_from_mapping({}) == {}


@pytest.mark.parametrize(
    "section, message",
    [
        ({}, "source x: table must be a name"),
        ({"table": 7}, "table must be a name"),
        ({"table": "t", "rename": {}}, "source x: unknown rename"),
        ({"table": "t", "renames": ["a"]}, "renames: expected a mapping"),
        ({"table": "t", "renames": {"a": None}}, "from name to name"),
        ("t", "source x: expected a mapping, not 't'"),
    ],
)
def test_sources_that_would_be_misread(section, message):
    with pytest.raises(ValueError, match=message):
        sources_from_mapping({"x": section})


def test_rules():
    section = {"not_null": ["a", "b"], "unique": ["a"], "row_count": {"min": 1, "max": None}}
    assert Expectations.from_mapping(section) == Expectations(("a", "b"), ("a",), 1, None)
    assert Expectations.from_mapping({"not_null": None}) == Expectations()


@pytest.mark.parametrize(
    "section, message",
    [
        ({"notnull": ["a"]}, "unknown notnull"),
        ({"not_null": "a"}, "not_null must be a list of names"),
        ({"unique": [["a"]]}, "unique must be a list of names"),
        ({"row_count": {"minimum": 1}}, "row_count: unknown minimum"),
        ({"row_count": {"min": "1"}}, "row_count min must be a whole number"),
        ({"row_count": {"min": True}}, "whole number"),
        ([], "expectations: expected a mapping"),
    ],
)
def test_rules_that_would_be_misread(section, message):
    with pytest.raises(ValueError, match=message):
        Expectations.from_mapping(section)
