"""Nested message contracts: a JSON Schema compiled to column expressions over ``VARIANT``.

Every keyword becomes an expression that is NULL where a value keeps to it and otherwise names the
fault and the path where it is: ``type:user.id``, ``missing:items[2].sku``, ``minimum:items[0].n``. A
value's verdict is its first fault, in the order below, depth first; ``not_json`` for text that is no
JSON, ``ok`` if there is none. Arrays of any length and objects of any keys are gone through inside
the expression; no row is exploded and no Python runs.

Understood: ``type`` (one or several), ``enum``, ``const``, ``minimum``, ``maximum``,
``exclusiveMinimum``, ``exclusiveMaximum``, ``minLength``, ``maxLength``, ``pattern`` (as a Java regular
expression), ``minItems``, ``maxItems``, ``items``, ``required``, ``properties``,
``additionalProperties`` (true, false or a schema), ``allOf``, ``anyOf``, ``$ref`` into ``$defs`` or
``definitions`` unless it leads back to itself, and ``true`` and ``false`` as schemas. As in JSON Schema, a
keyword for one kind of value says nothing about others: ``minimum`` lets a text pass. Any other
keyword that would restrict values is refused. Bounds and numbers in ``enum`` are compared as doubles.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.contract import REMARKS, SPARK_TYPES

# Keywords of JSON Schema that this module compiles.
COMPILED = (
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
    "minLength", "maxLength", "pattern", "minItems", "maxItems", "items", "required",
    "properties", "additionalProperties", "allOf", "anyOf", "$ref", "$defs", "definitions",
)

# How a number offends against each bound.
BOUNDS: Mapping[str, Callable[[Column, float], Column]] = {
    "minimum": lambda number, bound: number < bound,
    "maximum": lambda number, bound: number > bound,
    "exclusiveMinimum": lambda number, bound: number <= bound,
    "exclusiveMaximum": lambda number, bound: number >= bound,
}


class UnsupportedSchema(ValueError):
    """A schema says something that would be passed over in silence."""


@dataclass(frozen=True)
class Place:
    """A value inside a message: ``path`` below ``base``, a ``VARIANT`` column, and its ``name``."""

    base: Column
    name: Column
    path: str = "$"

    def value(self) -> Column:
        """NULL if there is no such value; a JSON null is a value."""
        return self.base if self.path == "$" else self.read("variant")

    def read(self, kind: str) -> Column:
        """The value as another type, NULL if it has no such form."""
        return F.try_variant_get(self.base, self.path, kind)

    def member(self, key: str) -> Place:
        name = F.when(self.name == "$", F.lit(key)).otherwise(F.concat(self.name, F.lit(f".{key}")))
        return Place(self.base, name, f"{self.path}['{key}']")

    def fault(self, kind: str) -> Column:
        return F.concat(F.lit(f"{kind}:"), self.name)


@dataclass(frozen=True)
class NestedContract:
    """A JSON Schema that ``check_messages`` and ``publish`` take like a flat ``Contract``."""

    schema: Mapping | bool

    def __post_init__(self) -> None:
        self.fault(F.lit(None).cast("variant"))  # refuses what it cannot compile

    @classmethod
    def from_json_schema(cls, text: str) -> NestedContract:
        schema = json.loads(text)
        if not isinstance(schema, (dict, bool)):
            raise UnsupportedSchema("a schema is an object or a boolean")
        return cls(schema)

    def fault(self, parsed: Column) -> Column:
        """The first fault of a parsed value, NULL if it has none."""
        return _Compiler(self.schema).fault(self.schema, Place(parsed, F.lit("$")), ())

    def verdict(self, parsed: Column) -> Column:
        checked = F.when(parsed.isNull(), "not_json").otherwise(self.fault(parsed))
        return F.coalesce(checked, F.lit("ok"))


class _Compiler:
    def __init__(self, root: Mapping | bool):
        self.root = root

    def fault(self, schema: Mapping | bool, at: Place, within: tuple[str, ...]) -> Column:
        """The first fault at a place, if a value is there. ``within``: references being followed."""
        if schema is True or schema == {}:
            return F.lit(None).cast("string")
        there = at.value().isNotNull()
        if schema is False:
            return F.when(there, at.fault("forbidden"))
        if not isinstance(schema, Mapping):
            raise UnsupportedSchema(f"not a schema: {schema!r}")
        unknown = sorted(set(schema) - {*COMPILED, *REMARKS})
        if unknown:
            raise UnsupportedSchema(f"unsupported in a contract: {', '.join(unknown)}")
        steps = [
            self._type, self._values, self._number, self._text, self._required, self._properties,
            self._others, self._array, self._combined, self._reference,
        ]
        faults = [fault for step in steps for fault in step(schema, at, within)]
        return F.when(there, F.coalesce(F.lit(None).cast("string"), *faults))

    def _type(self, schema, at, within):
        if "type" not in schema:
            return
        kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        if not kinds or any(kind not in SPARK_TYPES for kind in kinds):
            raise UnsupportedSchema(f"unknown JSON type in {schema['type']!r}")
        yield F.when(~reduce(or_, [_is(at, kind) for kind in kinds]), at.fault("type"))

    def _values(self, schema, at, within):
        for keyword in ("enum", "const"):
            if keyword in schema:
                values = schema[keyword] if keyword == "enum" else [schema[keyword]]
                if not isinstance(values, list) or not values:
                    raise UnsupportedSchema("enum must list values")
                same = reduce(or_, [_equals(at, value) for value in values])
                yield F.when(~same, at.fault(keyword))

    def _number(self, schema, at, within):
        for keyword, offends in BOUNDS.items():
            if keyword in schema:
                bound = float(_a_number(schema, keyword))
                broken = _sure(schema, at, "number") & offends(at.read("double"), bound)
                yield F.when(broken, at.fault(keyword))

    def _text(self, schema, at, within):
        for keyword, low in (("minLength", True), ("maxLength", False)):
            if keyword in schema:
                length, bound = F.char_length(at.read("string")), _a_number(schema, keyword)
                broken = length < bound if low else length > bound
                yield F.when(_sure(schema, at, "string") & broken, at.fault(keyword))
        if "pattern" in schema:
            fits = at.read("string").rlike(str(schema["pattern"]))
            yield F.when(_sure(schema, at, "string") & ~fits, at.fault("pattern"))

    def _required(self, schema, at, within):
        names = schema.get("required", [])
        if not isinstance(names, list) or not all(isinstance(name, str) for name in names):
            raise UnsupportedSchema("required must list property names")
        members = [at.member(_plain(name)) for name in names]
        if members:
            absent = [F.when(one.value().isNull(), one.fault("missing")) for one in members]
            yield F.when(_sure(schema, at, "object"), F.coalesce(*absent))

    def _properties(self, schema, at, within):
        for name, inner in schema.get("properties", {}).items():
            yield self.fault(inner, at.member(_plain(name)), within)

    def _others(self, schema, at, within):
        inner = schema.get("additionalProperties", True)
        if inner is True:
            return
        named = F.array(*map(F.lit, schema.get("properties", {}))).cast("array<string>")
        if inner is False:
            keys = F.json_object_keys(F.to_json(at.value()))
            extra = F.size(F.array_except(keys, named)) > 0
            yield F.when(_sure(schema, at, "object") & extra, at.fault("extra"))
            return
        members = F.map_entries(at.read("map<string, variant>"))
        others = F.filter(members, lambda one: ~F.array_contains(named, one["key"]))

        def check(one: Column) -> Column:
            prefix = F.when(at.name == "$", F.lit("")).otherwise(F.concat(at.name, F.lit(".")))
            return self.fault(inner, Place(one["value"], F.concat(prefix, one["key"])), within)

        yield F.when(_sure(schema, at, "object"), _first(F.transform(others, check)))

    def _array(self, schema, at, within):
        elements = at.read("array<variant>")
        for keyword, low in (("minItems", True), ("maxItems", False)):
            if keyword in schema:
                bound = _a_number(schema, keyword)
                broken = F.size(elements) < bound if low else F.size(elements) > bound
                yield F.when(_sure(schema, at, "array") & broken, at.fault(keyword))
        if "items" in schema:

            def check(one: Column, number: Column) -> Column:
                name = F.concat(at.name, F.lit("["), number.cast("string"), F.lit("]"))
                return self.fault(schema["items"], Place(one, name), within)

            yield F.when(_sure(schema, at, "array"), _first(F.transform(elements, check)))

    def _combined(self, schema, at, within):
        for inner in schema.get("allOf", []):
            yield self.fault(inner, at, within)
        if "anyOf" in schema:
            fits = [self.fault(inner, at, within).isNull() for inner in schema["anyOf"]]
            if not fits:
                raise UnsupportedSchema("anyOf must list schemas")
            yield F.when(~reduce(or_, fits), at.fault("anyOf"))

    def _reference(self, schema, at, within):
        if "$ref" not in schema:
            return
        target = schema["$ref"]
        if target in within:
            raise UnsupportedSchema(f"{target} leads back to itself")
        found = self.root
        steps = str(target).split("/")
        if steps[0] != "#":
            raise UnsupportedSchema(f"{target} is in another document")
        for step in steps[1:]:
            if not isinstance(found, Mapping) or step not in found:
                raise UnsupportedSchema(f"there is no {target}")
            found = found[step]
        yield self.fault(found, at, (*within, target))


def _first(faults: Column) -> Column:
    return F.get(F.filter(faults, lambda fault: fault.isNotNull()), F.lit(0))


def _sure(schema: Mapping, at: Place, kind: str) -> Column:
    """Whether the value is of a type; not asked again where the schema's own ``type`` says so, as
    that is checked before."""
    said = schema.get("type")
    said = said if isinstance(said, list) else [said]
    if all(one == kind or (one, kind) == ("integer", "number") for one in said):
        return F.lit(True)
    return _is(at, kind)


def _is(at: Place, kind: str) -> Column:
    """Whether the value is of a JSON type. A whole number in exponent form, or of over 38 digits,
    parses as DOUBLE and is an integer all the same."""
    name = F.schema_of_variant(at.value())
    fits = name.rlike(SPARK_TYPES[kind])
    if kind == "integer":
        number = at.read("double")
        fits = fits | ((name == "DOUBLE") & (number == F.rint(number)))
    return F.coalesce(fits, F.lit(False))


def _equals(at: Place, value: object) -> Column:
    if value is None:
        return _is(at, "null")
    if isinstance(value, bool):
        same = _is(at, "boolean") & (at.read("boolean") == F.lit(value))
    elif isinstance(value, (int, float)):
        same = _is(at, "number") & (at.read("double") == F.lit(float(value)))
    elif isinstance(value, str):
        same = _is(at, "string") & (at.read("string") == F.lit(value))
    else:
        raise UnsupportedSchema(f"only plain values can be listed, not {value!r}")
    return F.coalesce(same, F.lit(False))


def _a_number(schema: Mapping, keyword: str) -> float:
    bound = schema[keyword]
    if isinstance(bound, bool) or not isinstance(bound, (int, float)):
        raise UnsupportedSchema(f"{keyword} must be a number")
    return bound


def _plain(name: str) -> str:
    if "'" in name or "\\" in name:
        raise UnsupportedSchema(f"property {name}: quotes and backslashes are not supported")
    return name
