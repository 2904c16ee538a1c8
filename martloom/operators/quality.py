"""Data-quality rules, evaluated as aggregates that give a report.

Rules run on a ``DataFrame`` or, without building it, on a ``FanoutJoin``. All not-null and
row-count rules share one aggregation; each uniqueness rule adds one group count, which is
combined before its shuffle and so does not mind a hot value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.names import quoted, require_keys, texts_in
from martloom.operators.fanout import FanoutJoin

REPORT_SCHEMA = "rule string, column_name string, violations bigint, passed boolean"
FAILURES_SHOWN = 20


class ExpectationsFailed(RuntimeError):
    """At least one data-quality rule does not hold."""


@dataclass(frozen=True)
class Expectations:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    min_rows: int | None = None
    max_rows: int | None = None

    @classmethod
    def from_mapping(cls, section: Mapping) -> Expectations:
        """Rules as a configuration file gives them: ``not_null`` and ``unique`` list columns,
        ``row_count`` has bounds ``min`` and ``max``. What would not be checked is an error."""
        require_keys(section, ("not_null", "unique", "row_count"), "expectations")
        bounds = section.get("row_count") or {}
        require_keys(bounds, ("min", "max"), "expectations: row_count")
        for name, bound in bounds.items():
            if bound is not None and (isinstance(bound, bool) or not isinstance(bound, int)):
                raise ValueError(f"expectations: row_count {name} must be a whole number")
        return cls(
            texts_in(section, "not_null", "expectations"),
            texts_in(section, "unique", "expectations"),
            bounds.get("min"),
            bounds.get("max"),
        )

    @property
    def has_row_bounds(self) -> bool:
        return self.min_rows is not None or self.max_rows is not None

    def __bool__(self) -> bool:
        return bool(self.not_null or self.unique or self.has_row_bounds)


def null_counts(data: DataFrame | FanoutJoin, columns: Sequence[str] = ()) -> DataFrame:
    """One row: ``rows`` and, per column, ``nulls_j``."""
    if isinstance(data, FanoutJoin):
        return data.null_counts(columns)
    nulls = [F.count_if(quoted(c).isNull()).alias(f"nulls_{j}") for j, c in enumerate(columns)]
    return data.agg(F.count(F.lit(1)).alias("rows"), *nulls)


def group_counts(data: DataFrame | FanoutJoin, column: str) -> DataFrame:
    """``(column, n)`` per value; NULLs form one group."""
    if isinstance(data, FanoutJoin):
        return data.group_counts(column)
    # Positional names, so that a column called like the count cannot be mistaken for it.
    counted = data.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.toDF(column, "n")


def duplicate_groups(data: DataFrame | FanoutJoin, column: str) -> DataFrame:
    """The values that occur more than once, with how often; two NULLs are a duplicate."""
    counted = group_counts(data, column).toDF("value", "n_rows")
    return counted.where(F.col("n_rows") > 1).toDF(column, "n")


def not_null_report(data: DataFrame | FanoutJoin, columns: Sequence[str]) -> DataFrame:
    """``(column_name, violations, passed)`` per column, from one pass."""
    return report(data, Expectations(not_null=tuple(columns))).drop("rule")


def row_count_report(
    data: DataFrame | FanoutJoin, min_rows: int | None = None, max_rows: int | None = None
) -> DataFrame:
    """One row: the count and whether it respects each inclusive bound (NULL: no such bound)."""
    rows = F.col("rows")
    within = {"min_ok": (min_rows, rows.__ge__), "max_ok": (max_rows, rows.__le__)}
    flags = [
        (F.lit(None).cast("boolean") if bound is None else holds(F.lit(bound))).alias(name)
        for name, (bound, holds) in within.items()
    ]
    return null_counts(data).select(rows.alias("row_count"), *flags)


def report(data: DataFrame | FanoutJoin, rules: Expectations) -> DataFrame:
    """``(rule, column_name, violations, passed)``, one row per rule.

    ``violations`` counts NULLs, duplicated values, or 1 for a row-count bound that is broken. It
    is NULL where the column does not exist; such a rule fails and the others still run.
    """
    present = set(data.columns)
    spark = (data.core if isinstance(data, FanoutJoin) else data).sparkSession
    checked = [c for c in rules.not_null if c in present]
    # Each entry is (rule, column, violations) over the single row of null_counts().
    entries: list[tuple[str, str, Column]] = [
        ("not_null", column, F.col(f"nulls_{j}")) for j, column in enumerate(checked)
    ]
    if rules.min_rows is not None:
        broken = F.col("rows") < rules.min_rows
        entries.append(("row_count_min", "*", F.when(broken, 1).otherwise(0)))
    if rules.max_rows is not None:
        broken = F.col("rows") > rules.max_rows
        entries.append(("row_count_max", "*", F.when(broken, 1).otherwise(0)))

    parts = []
    if entries:
        outcomes = F.array(*[_outcome(*entry) for entry in entries])
        parts.append(null_counts(data, checked).select(F.inline(outcomes)))
    for column in rules.unique:
        if column in present:
            duplicates = duplicate_groups(data, column).agg(F.count(F.lit(1)).alias("groups"))
            outcome = _outcome("unique", column, F.col("groups"))
            parts.append(duplicates.select(F.inline(F.array(outcome))))
    missing = [("not_null", c, None, False) for c in rules.not_null if c not in present]
    missing += [("unique", c, None, False) for c in rules.unique if c not in present]
    if missing or not parts:
        parts.append(spark.createDataFrame(missing, REPORT_SCHEMA))
    return reduce(DataFrame.unionAll, parts)


def _outcome(rule: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        violations.cast("long").alias("violations"),
        (violations == 0).alias("passed"),
    )


def enforce(data: DataFrame | FanoutJoin, rules: Expectations) -> None:
    """Raise ``ExpectationsFailed`` naming the broken rules; without rules no job runs."""
    if not rules:
        return
    # One row per configured rule, so the driver sees no data.
    failed = report(data, rules).where(~F.col("passed")).collect()
    if failed:
        lines = [
            f"{row.rule}({row.column_name}): "
            + ("no such column" if row.violations is None else f"{row.violations} violation(s)")
            for row in failed[:FAILURES_SHOWN]
        ]
        raise ExpectationsFailed(f"{len(failed)} expectation(s) failed: " + "; ".join(lines))
