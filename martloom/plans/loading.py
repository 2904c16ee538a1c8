"""One load of a mart: build, check, then upsert."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martloom.functions.contract import AnyContract, Contract
from martloom.operators.fanout import FanoutJoin
from martloom.operators.projection import select_columns
from martloom.operators.quality import Expectations, enforce
from martloom.operators.upsert import conform, require_no_conflicts
from martloom.sinks.messages import publish, table_messages
from martloom.sinks.scratch import staged
from martloom.sinks.tables import MartTable, RowLevelMart


def load_mart(
    data: DataFrame | FanoutJoin,
    mart: MartTable | RowLevelMart,
    schema: T.StructType,
    key: str,
    rules: Expectations,
    max_rows: int | None = None,
) -> DataFrame:
    """Project ``data`` to ``schema``, check it, and upsert it into ``mart`` by ``key``; the rows
    that were loaded, as they are staged.

    The target is neither created nor changed before all rules hold. A fan-out is checked from
    its counts, also for merge conflicts, before any of its rows exist. The joins run once: their
    rows are staged, and the checks and the writes read the columns they need from there.
    """
    label = f"mart {mart.name}"
    if isinstance(data, FanoutJoin):
        absent = [name for name in schema.names if name not in data.columns]
        if absent:
            raise ValueError(f"{label}: no column {', '.join(absent)}")
        data = data.counted([name for name in rules.not_null if name in data.columns])
        enforce(data, rules)
        if mart.exists():
            require_no_conflicts(mart.read(), data, key)
        data = data.pruned(schema.names).frame(max_rows=max_rows)
        rules = Expectations()
    rows = conform(select_columns(data, schema.names, label), schema)
    batch = staged(rows, "mart-batch")
    enforce(batch, rules)
    if mart.exists():
        mart.merge(batch, key)
    else:
        mart.create(batch)
    return batch


def load_and_publish(
    data: DataFrame | FanoutJoin,
    mart: MartTable | RowLevelMart,
    schema: T.StructType,
    key: str,
    rules: Expectations,
    contract: Contract | AnyContract,
    send: Callable[[DataFrame], None],
    folder: str,
    max_rows: int | None = None,
) -> DataFrame:
    """Load a batch, then publish its rows as messages keyed by ``key``; the report of ``publish``.

    Nothing is published of a batch that was not loaded. Messages that break the contract are kept
    below ``folder``, and the rows they are of stay in the mart.
    """
    loaded = load_mart(data, mart, schema, key, rules, max_rows)
    return publish(table_messages(loaded, key), contract, send, folder)
