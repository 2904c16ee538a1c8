"""Message contracts: which properties a JSON value must or may have, and of which JSON types.

A contract is checked as column expressions over a whole table. Values are parsed once into
``VARIANT``, which keeps apart what ``from_json`` merges: a missing property and a JSON null, the
number 7 and the string "7", 1.0 (an integer by JSON Schema) and 1.5.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.names import quoted

# JSON Schema type names, and the Spark type of a parsed value of each type.
SPARK_TYPES = {
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$",
    "number": r"^(BIGINT|DECIMAL\(\d+,\d+\)|FLOAT|DOUBLE)$",
    "string": r"^STRING$",
    "boolean": r"^BOOLEAN$",
    "object": r"^OBJECT<",
    "array": r"^ARRAY<",
    "null": r"^VOID$",
}

# JSON Schema keywords that restrict nothing.
REMARKS = ("$schema", "$id", "$comment", "title", "description", "examples", "default")


@dataclass(frozen=True)
class Contract:
    """Types of properties, required properties, and whether others are refused.

    A property's types are a JSON type, several, or None for any.
    """

    properties: Mapping[str, str | tuple[str, ...] | None]
    required: tuple[str, ...] = field(default=())
    closed: bool = False

    def __post_init__(self) -> None:
        for name in (*self.properties, *self.required):
            for kind in self.types(name) or ():
                if kind not in SPARK_TYPES:
                    raise ValueError(f"property {name}: unknown JSON type {kind!r}")
            if "'" in name or "\\" in name:
                raise ValueError(f"property {name}: quotes and backslashes are not supported")

    def types(self, name: str) -> tuple[str, ...] | None:
        """The types a property may have; None if any."""
        kinds = self.properties.get(name)
        return (kinds,) if isinstance(kinds, str) else kinds

    @classmethod
    def from_json_schema(cls, text: str) -> Contract:
        """Read a JSON Schema of an object that says which types its properties have.

        A keyword that would restrict values in another way is refused, not passed over.
        """
        schema = json.loads(text)
        if not isinstance(schema, dict) or schema.get("type") != "object":
            raise ValueError("the schema must describe an object")
        others = schema.get("additionalProperties", True)
        if not isinstance(others, bool):
            raise ValueError("unsupported in a contract: a schema for additionalProperties")
        known = {"type", "properties", "required", "additionalProperties", *REMARKS}
        unknown = set(schema) - known
        properties: dict[str, str | tuple[str, ...] | None] = {}
        for name, details in schema.get("properties", {}).items():
            if details is True:
                details = {}
            if not isinstance(details, dict):
                raise ValueError(f"property {name}: {details!r} is not supported")
            unknown |= set(details) - {"type", *REMARKS}
            kinds = details.get("type")
            if not (kinds is None or isinstance(kinds, str) or _texts(kinds)):
                raise ValueError(f"property {name}: unknown JSON type {kinds!r}")
            properties[name] = tuple(kinds) if isinstance(kinds, list) else kinds
        if unknown:
            raise ValueError(f"unsupported in a contract: {', '.join(sorted(unknown))}")
        required = schema.get("required", [])
        if required and not _texts(required):
            raise ValueError("required must list property names")
        return cls(properties, tuple(required), closed=not others)


def _texts(values: object) -> bool:
    return isinstance(values, list) and bool(values) and all(isinstance(v, str) for v in values)


def newly_refused(current: Contract, candidate: Contract) -> list[str]:
    """Faults that the candidate may find in messages the current contract accepts.

    Told from the contracts alone, so it also answers for topics without messages. The faults are
    those of ``verdict``.
    """
    faults = [f"missing:{name}" for name in candidate.required if name not in current.required]
    every = tuple(SPARK_TYPES)
    for name in candidate.properties:
        allowed = candidate.types(name)
        if allowed is None or (current.closed and name not in current.properties):
            continue
        accepted = set(allowed) | ({"integer"} if "number" in allowed else set())
        if not set(current.types(name) or every) <= accepted:
            faults.append(f"type:{name}")
    if candidate.closed and not (
        current.closed and set(current.properties) <= set(candidate.properties)
    ):
        faults.append("extra")
    return faults


def value_subject(topic: str) -> str:
    """The name under which a topic's value contract is kept."""
    return f"{topic}-value"


def verdict(parsed: Column, contract: Contract) -> Column:
    """First fault of a parsed value: ``not_json``, ``not_object``, ``missing:<p>``,
    ``type:<p>``, ``extra`` (a property that a closed contract does not name), or ``ok``.
    ``parsed`` is NULL for text that is no JSON."""
    result = F.when(parsed.isNull(), "not_json")
    result = result.when(~_has_type(parsed, "object"), "not_object")
    for name in contract.required:
        result = result.when(_property(parsed, name).isNull(), f"missing:{name}")
    for name in contract.properties:
        kinds = contract.types(name)
        if kinds is None:
            continue
        found = _property(parsed, name)
        fits = reduce(or_, [_has_type(found, kind) for kind in kinds])
        if "integer" in kinds:
            # A number in exponent form, or of over 38 digits, parses as DOUBLE; it is an integer
            # if it is whole. Compared as doubles, as it may be past the range of a long.
            number = F.try_variant_get(parsed, _path(name), "double")
            fits = fits | ((F.schema_of_variant(found) == "DOUBLE") & (number == F.rint(number)))
        result = result.when(found.isNotNull() & ~fits, f"type:{name}")
    if contract.closed:
        names = F.array(*map(F.lit, contract.properties)).cast("array<string>")
        others = F.array_except(F.json_object_keys(F.to_json(parsed)), names)
        result = result.when(F.size(others) > 0, "extra")
    return result.otherwise("ok")


class AnyContract(Protocol):
    """What else can be checked: see ``json_schema.NestedContract``."""

    def verdict(self, parsed: Column) -> Column: ...


def _verdict(parsed: Column, contract: Contract | AnyContract) -> Column:
    return verdict(parsed, contract) if isinstance(contract, Contract) else contract.verdict(parsed)


def check_messages(
    messages: DataFrame, contract: Contract | AnyContract, value: str = "value", into: str = "verdict"
) -> DataFrame:
    """Add the verdict of each message."""
    return check_contracts(messages, {into: contract}, value)


def check_contracts(
    messages: DataFrame, contracts: Mapping[str, Contract | AnyContract], value: str = "value"
) -> DataFrame:
    """Add one verdict column per contract; each message is parsed once for all of them."""
    parsed = messages.withColumn("__parsed", F.try_parse_json(quoted(value)))
    verdicts = {into: _verdict(F.col("__parsed"), c) for into, c in contracts.items()}
    return parsed.withColumns(verdicts).drop("__parsed")


def backtest(
    messages: DataFrame,
    current: Contract | AnyContract,
    candidate: Contract | AnyContract,
    value: str = "value",
) -> DataFrame:
    """One row: stored messages, and those the current contract accepts but the candidate not."""
    checked = check_contracts(messages, {"__now": current, "__next": candidate}, value)
    broken = (F.col("__now") == "ok") & (F.col("__next") != "ok")
    return checked.agg(
        F.count(F.lit(1)).alias("n_messages"), F.count_if(broken).alias("n_newly_broken")
    )


def _path(name: str) -> str:
    return f"$['{name}']"


def _property(parsed: Column, name: str) -> Column:
    return F.try_variant_get(parsed, _path(name), "variant")


def _has_type(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).rlike(SPARK_TYPES[kind])
