"""A mart whose files are bucketed by its merge key, so that merges never shuffle it.

Spark reads a bucketed table as already partitioned by the bucket column. The joins of an upsert then
shuffle the batch into the table's buckets and read each bucket's files where they lie: for a batch
too large to broadcast, the target's rows, usually far more, do not move. What is written back is
bucketed already, so writing does not shuffle either. Merges rewrite the whole mart; where a batch
touches few partitions of many, ``MartTable`` writes less.

The result of a merge is written to a table beside the mart, which then takes its place under its name.
If a merge breaks off, the mart is as before or, between dropping the old and renaming the new table,
under the second name alone; the next use finishes the exchange. One writer at a time.

A bucket goes whole to one task. Where a key holds more than ``spread.CELL_ROWS`` rows of the mart, a
merge therefore reads the mart as if it were not bucketed, and adaptive execution can split the key.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import quoted
from martloom.operators.spread import CELL_ROWS
from martloom.operators.upsert import conform, merge_frame


@dataclass(frozen=True)
class BucketedMart:
    """``name``: a managed parquet table, one or two dot-separated parts; ``key``: the merge key.

    Take so many ``buckets`` that each is about a task's worth of rows, 100 to 200 MB.
    """

    spark: SparkSession
    name: str
    key: str
    buckets: int

    def exists(self) -> bool:
        self._finish()
        return bool(self.spark.catalog.tableExists(self._qualified()))

    def ensure(self, schema: T.StructType) -> bool:
        if self.exists():
            return False
        self.create(self.spark.createDataFrame([], schema))
        return True

    def create(self, rows: DataFrame) -> None:
        """Write the first rows, shuffled once into their buckets."""
        if self.exists():
            raise ValueError(f"table {self.name} is there already")
        self._save(rows.repartition(self.buckets, quoted(self.key)), self._qualified())

    def read(self) -> DataFrame:
        self._finish()
        return self.spark.table(self._qualified())

    def merged(self, source: DataFrame) -> DataFrame:
        """The mart as it is after the upsert; plan it and run it under ``settings``."""
        target = self.read()
        return merge_frame(target, conform(source, target.schema), self.key)

    def merge(self, source: DataFrame) -> None:
        """Upsert by the key; a conflict raises and changes nothing. ``source`` is read by several
        jobs, see ``staged``."""
        with self.settings(bucketed=not self._has_hot_key()):
            self._save(self.merged(source), self._next())
        self.spark.sql(f"DROP TABLE {self._qualified()}")
        self._finish()

    @contextmanager
    def settings(self, bucketed: bool = True) -> Iterator[None]:
        """As many shuffle partitions as there are buckets: with more of them, Spark would rather
        shuffle both sides of a join than be left with the table's fewer."""
        wanted = {
            "spark.sql.sources.bucketing.enabled": str(bucketed).lower(),
            "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
        }
        if bucketed:
            wanted["spark.sql.shuffle.partitions"] = str(self.buckets)
        before = {name: self.spark.conf.get(name) for name in wanted}
        for name, value in wanted.items():
            self.spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)

    def _has_hot_key(self) -> bool:
        """Reads the key column, without a shuffle: a key's rows are in one bucket."""
        with self.settings():
            rows = self.read()
            if rows.count() <= CELL_ROWS:
                return False
            counts = rows.groupBy(quoted(self.key)).agg(F.count(F.lit(1)).alias("n"))
            return not counts.where(F.col("n") > CELL_ROWS).isEmpty()

    def _save(self, rows: DataFrame, name: str) -> None:
        writer = rows.write.format("parquet").mode("overwrite")
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(name)

    def _finish(self) -> None:
        """Give the result of a merge its name, if the old table is gone."""
        catalog = self.spark.catalog
        if not catalog.tableExists(self._qualified()) and catalog.tableExists(self._next()):
            self.spark.sql(f"ALTER TABLE {self._next()} RENAME TO {self._qualified()}")

    def _qualified(self) -> str:
        if "." in self.name:
            return self.name
        return f"{self.spark.catalog.currentDatabase()}.{self.name}"

    def _next(self) -> str:
        return f"{self._qualified()}__next"
