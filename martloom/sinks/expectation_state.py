"""Expectations of a growing mart, from what each of its partitions counted.

A full run of the rules reads the whole mart after every batch, though a batch changes few partitions.
Here each partition keeps what its rows gave: their number, the NULLs of every column that must have
none, and for every column that must be unique how often each value occurs. All of these add up, so
the report of the mart is a sum over partitions, and after a batch only the partitions it touched are
read and counted anew.

The state is a parquet table by partition, replaced by dynamic partition overwrite like the mart. It
holds one narrow row for each value of a unique column, so it is worth keeping where a mart is much
wider than these columns or batches touch few partitions. One writer at a time; a refresh that breaks
off is repeated.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import quoted, require_columns
from martloom.operators.quality import Expectations

STATE = "kind string, column_name string, value string, n bigint, at date"


@dataclass(frozen=True)
class ExpectationState:
    """``folder``: of the state; ``partition``: the date column by which rows are partitioned."""

    spark: SparkSession
    folder: str
    rules: Expectations
    partition: str

    def refresh(self, rows: DataFrame, partitions: Iterable[date | None] | None = None) -> None:
        """Count ``rows``, all rows of their partitions, in the place of what was counted before.

        ``partitions``: those that were touched, so that one which has no rows left is counted as
        empty; None if ``rows`` is the whole mart and nothing has been counted.
        """
        columns = {*self.rules.not_null, *self.rules.unique}
        require_columns(rows, [self.partition, *sorted(columns)], "expectations")
        at = quoted(self.partition).alias("at")
        nulls = list(dict.fromkeys(self.rules.not_null))
        totals = rows.groupBy(at).agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(quoted(name).isNull()).alias(f"nulls_{j}") for j, name in enumerate(nulls)],
        )
        entries = [_entry("rows", "*", F.col("rows"))]
        entries += [_entry("nulls", name, F.col(f"nulls_{j}")) for j, name in enumerate(nulls)]
        parts = [totals.select("at", F.inline(F.array(*entries)))]
        for name in dict.fromkeys(self.rules.unique):
            value = _text(quoted(name), rows.schema[name].dataType).alias("value")
            counts = rows.groupBy(at, value).agg(F.count(F.lit(1)).alias("n"))
            kind, column = F.lit("value").alias("kind"), F.lit(name).alias("column_name")
            parts.append(counts.select("at", kind, column, "value", "n"))
        if partitions is not None:
            # A marker for each touched partition, so that emptied ones are overwritten too.
            touched = self.spark.createDataFrame([(value,) for value in partitions], "at date")
            parts.append(touched.select("at", F.inline(F.array(_entry("touched", "*", F.lit(0))))))
        names = [field.name for field in T.StructType.fromDDL(STATE)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        balanced = whole.select(*names).hint("rebalance", F.col("at"))
        writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("at").parquet(self.folder)

    def report(self) -> DataFrame:
        """``(rule, column_name, violations, passed)`` of the whole mart, as ``quality.report`` gives
        it, without reading the mart."""
        state = self.spark.read.schema(STATE).parquet(self.folder)
        sums = state.where("kind IN ('rows', 'nulls')").groupBy("kind", "column_name")
        sums = sums.agg(F.sum("n").alias("n"))
        values = state.where("kind = 'value'").groupBy("column_name", "value")
        repeated = values.agg(F.sum("n").alias("n")).where("n > 1")
        repeated = repeated.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
        found = sums.unionByName(repeated.withColumn("kind", F.lit("value")))
        rows = F.coalesce(F.max(F.when(F.col("kind") == "rows", F.col("n"))), F.lit(0))
        by_name = F.map_from_entries(
            F.collect_list(F.struct(F.concat_ws(":", "kind", "column_name"), "n"))
        )
        one = found.agg(rows.alias("rows"), by_name.alias("n"))
        held = lambda kind, name: F.coalesce(
            F.try_element_at("n", F.lit(f"{kind}:{name}")), F.lit(0)
        )
        outcomes = [("not_null", name, held("nulls", name)) for name in self.rules.not_null]
        if self.rules.min_rows is not None:
            broken = F.col("rows") < self.rules.min_rows
            outcomes.append(("row_count_min", "*", broken.cast("long")))
        if self.rules.max_rows is not None:
            broken = F.col("rows") > self.rules.max_rows
            outcomes.append(("row_count_max", "*", broken.cast("long")))
        outcomes += [("unique", name, held("value", name)) for name in self.rules.unique]
        if not outcomes:
            return self.spark.createDataFrame(
                [], "rule string, column_name string, violations bigint, passed boolean"
            )
        listed = [
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(name).alias("column_name"),
                n.cast("long").alias("violations"),
                (n == 0).alias("passed"),
            )
            for rule, name, n in outcomes
        ]
        return one.select(F.inline(F.array(*listed)))


def _entry(kind: str, name: str, n: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(name).alias("column_name"),
        F.lit(None).cast("string").alias("value"),
        n.cast("long").alias("n"),
    )


def _text(value: Column, kind: T.DataType) -> Column:
    """A text that is equal for equal values of a type; NULL for NULL."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")  # the two zeros are equal
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")
