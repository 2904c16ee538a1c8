"""Mart tables: a folder of parquet partitions, or a catalog with row-level MERGE.

Parquet files cannot be changed in place, so an upsert rewrites the partitions that it touches: those
the batch writes to and those its keys are found in, as a row whose date changed must also leave its
old partition. The merged partitions are staged, since Spark refuses to overwrite what it reads, and
then take the place of the old ones by Spark's dynamic partition overwrite. The files of all other
partitions stay as they are.

What lies under a mart's root is the mart. Its name in the catalog is a table over that folder which
lists no partitions of its own, so a catalog that lost the name, a new one, or a second name show the
same rows. One writer at a time: nothing guards two merges of one mart against each other, and a
reader may see some partitions replaced and others not yet. A merge that fails while it replaces
partitions says where the merged rows lie; ``MartTable.replace`` with these may be repeated.

A catalog with row-level operations need not rewrite partitions and has transactions. Prefer one,
through ``RowLevelMart``, where several writers or many small batches are expected.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from urllib.parse import urlparse
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import quoted, quoted_name
from martloom.functions.sizes import fits_broadcast
from martloom.operators.upsert import conform, matched_distinct, merge_frame
from martloom.sinks.key_summary import KeySummary
from martloom.sinks.scratch import scratch_folder

# Fixed value: how Spark names the folder of a NULL partition.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Folder of the key summary below a mart's root; Spark reads no folder whose name begins so.
KEYS = "_keys"

# How Spark says that a folder holds no table yet.
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

# Partitions that one batch may touch: the driver lists them, and every one of them is a folder.
PARTITIONS_IN_A_BATCH = 100_000


@dataclass(frozen=True)
class DatePartition:
    """Partition by the start of the day, month or year of a timestamp column.

    One folder per instant, which partitioning by the timestamp itself would give, means tiny
    files. Take the smallest unit that still holds a few files' worth of rows.
    """

    timestamp: str
    name: str
    unit: str = "day"

    def column(self) -> Column:
        start = F.date_trunc(self.unit, quoted(self.timestamp))
        return F.to_date(start).alias(self.name)


def write_partitioned(
    df: DataFrame, folder: str, partition: DatePartition | None = None, mode: str = "error"
) -> None:
    """Write parquet, with files of about the advisory partition size. Mode ``overwrite`` replaces
    the partitions that ``df`` has rows of, and no others.

    The rebalance lets adaptive execution put small partitions together and split a hot one over
    several tasks; plain ``partitionBy`` would write a file per task and partition.
    """
    if partition is None:
        df.write.mode(mode).parquet(folder)
        return
    dated = df.select(*map(quoted, df.columns), partition.column())
    balanced = dated.hint("rebalance", quoted(partition.name))
    writer = balanced.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition.name).parquet(folder)


class HalfWritten(RuntimeError):
    """A merge failed while it replaced partitions. ``MartTable.replace`` with the rows in ``folder``
    completes it."""

    def __init__(self, mart: str, folder: str, dates: list[date | None]):
        super().__init__(f"mart {mart}: complete the merge with the rows in {folder}")
        self.folder, self.dates = folder, dates


@dataclass(frozen=True)
class MartTable:
    """``name``: one to three dot-separated parts. ``root``: the folder of its files, which no other
    mart shares. ``key``: the column whose values are summarised per partition, so that merges by it
    read the keys of only those partitions that may hold some of the batch."""

    spark: SparkSession
    name: str
    root: str
    partition: DatePartition | None = None
    key: str | None = None

    def exists(self) -> bool:
        """Whether there are files under the root, or the catalog has the table, still empty."""
        return self._in_catalog() or self._stored() is not None

    def ensure(self, schema: T.StructType) -> bool:
        """Create the table empty if it is missing; True if this call created it. A mart of which
        the catalog has lost the name gets it back."""
        if self.exists():
            self._register(self._schema())
            return False
        self.create(self.spark.createDataFrame([], schema))
        return True

    def create(self, rows: DataFrame) -> None:
        """Write the first files and show them as the table. Rows of one key may be several."""
        if self._stored() is not None or self._in_catalog():
            raise ValueError(f"mart {self.name}: {self.root} holds a table already")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        write_partitioned(rows, self._folder(), self.partition, mode="append")
        self._register(schema)
        if not self.exists():
            raise ValueError(f"table {self.name} is missing after its creation")
        if self._summary() is not None and self.partition is not None:
            self._summary().store(self._dated(schema))

    def read(self) -> DataFrame:
        """The mart's columns, without the derived partition column."""
        rows = self._dated(self._schema())
        return rows.drop(self.partition.name) if self.partition else rows

    def rows_of(self, dates: list[date | None]) -> DataFrame:
        """The rows of some partitions, with the partition column; no other files are read."""
        if self.partition is None:
            raise ValueError(f"mart {self.name} has no partitions")
        return self._dated(self._schema()).where(_among(quoted(self.partition.name), dates))

    def merge(self, source: DataFrame, key: str) -> list[date | None] | None:
        """Upsert by ``key``; a conflict raises and changes nothing. Returns the partitions that it
        touched, of a mart that has some.

        ``source`` is read by several jobs: pass one that is cheap to read, see ``staged``. If it
        proves small it is broadcast, so that the mart's rows meet it where they are read.
        """
        schema = self._schema()
        if not self._in_catalog():
            self._register(schema)
        small = fits_broadcast(source)
        batch = conform(source, schema)
        batch = F.broadcast(batch) if small else batch
        target = self._dated(schema)
        dates = None
        if self.partition is not None:
            dates = self._touched(target, batch, key, self.partition)
            target = target.where(_among(quoted(self.partition.name), dates))
            target = target.drop(self.partition.name)
        folder = scratch_folder(self.spark, "mart-merged")
        merge_frame(target, batch, key).write.parquet(folder)
        try:
            self.replace(self.spark.read.schema(schema).parquet(folder), dates)
        except Exception as error:
            raise HalfWritten(self.name, folder, dates or []) from error
        return dates

    def replace(self, rows: DataFrame, dates: list[date | None] | None = None) -> None:
        """Put ``rows`` in the place of the partitions ``dates``, which hold all of them; of the whole
        mart if it has no partitions. Done twice, it gives the same."""
        if self.partition is None:
            rows.write.mode("overwrite").parquet(self._folder())
            self._refresh()
            return
        summary = self._summary()
        if summary is not None:
            summary.forget(dates or [], rows.schema[self.key].dataType)
        write_partitioned(rows, self._folder(), self.partition, mode="overwrite")
        given = rows.select(self.partition.column().alias("at")).distinct().collect()
        left = set(dates or []) - {row[0] for row in given}
        for value in left:  # nothing is written to these, so nothing was overwritten
            nothing = self.spark.createDataFrame([], rows.schema)
            nothing.write.mode("overwrite").parquet(self._partition_folder(value))
        self._refresh()
        if summary is not None:
            summary.store(rows.withColumn(self.partition.name, self.partition.column()), left)

    def found(self, batch: DataFrame, key: str) -> DataFrame:
        """``(<partition>, n_keys)``: how many keys of a batch each partition holds.

        Reads the key column, of only those partitions that the summary cannot rule out.
        """
        if self.partition is None:
            raise ValueError(f"mart {self.name} has no partitions")
        held = self._held(self._dated(self._schema()), batch, key, self.partition)
        name = quoted(self.partition.name)
        return held.groupBy(name).agg(F.count(F.lit(1)).alias("n_keys"))

    # -- the catalog ----------------------------------------------------------------------

    def _qualified(self) -> str:
        if "." in self.name:
            return self.name
        return f"{self.spark.catalog.currentDatabase()}.{self.name}"

    def _in_catalog(self) -> bool:
        """Whether the catalog has the name; a temporary view of it does not count, and a table of
        another folder is an error."""
        if not self.spark.catalog.tableExists(self._qualified()):
            return False
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {_listed(self._qualified())}")
        (*_, place) = ["", *(r.data_type for r in described.collect() if r.col_name == "Location")]
        if _path(place) != _path(self._folder()):
            raise ValueError(f"{self.name} is not a table of {self.root}, but of {place or 'a view'}")
        return True

    def _stored(self) -> T.StructType | None:
        """The schema of the files under the root, if there are any."""
        try:
            return self.spark.read.parquet(self._folder()).schema
        except AnalysisException as error:
            if error.getCondition() in NOTHING_THERE:
                return None
            raise

    def _schema(self) -> T.StructType:
        """The mart's columns without the derived one; of an empty mart, as the catalog has them."""
        known = self._stored()
        if known is None:
            if not self._in_catalog():
                raise ValueError(f"mart {self.name} does not exist below {self.root}")
            known = self.spark.table(self._qualified()).schema
        own = self.partition.name if self.partition else None
        return T.StructType([T.StructField(f.name, f.dataType) for f in known if f.name != own])

    def _register(self, schema: T.StructType) -> None:
        """Give the folder its name in the catalog, if it has none there.

        The catalog is not to list the partitions, or a second name would miss those that merges
        through the first one add.
        """
        columns = [f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in schema]
        by = ""
        if self.partition is not None:
            columns.append(f"{quoted_name(self.partition.name)} DATE")
            by = f"PARTITIONED BY ({quoted_name(self.partition.name)})"
        setting = "spark.sql.hive.manageFilesourcePartitions"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "false")
        try:
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {_listed(self._qualified())} ({', '.join(columns)}) "
                f"USING parquet {by} LOCATION {_text(self._folder())}"
            )
        finally:
            self.spark.conf.set(setting, before)

    def _refresh(self) -> None:
        """Other frames of this session over the mart list its files anew."""
        self.spark.catalog.refreshByPath(self._folder())
        if self.spark.catalog.tableExists(self._qualified()):
            self.spark.catalog.refreshTable(self._qualified())

    # -- files ----------------------------------------------------------------------------

    def _folder(self) -> str:
        return self.root.rstrip("/")

    def _partition_folder(self, value: date | None) -> str:
        return f"{self._folder()}/{self.partition.name}={value.isoformat() if value else NO_VALUE}"

    def _dated(self, schema: T.StructType) -> DataFrame:
        """The mart's rows as they lie, with the partition column."""
        if self.partition is not None:
            schema = T.StructType([*schema, T.StructField(self.partition.name, T.DateType())])
        return self.spark.read.schema(schema).parquet(self._folder())

    def _summary(self) -> KeySummary | None:
        if self.key is None or self.partition is None:
            return None
        return KeySummary(self.spark, f"{self._folder()}/{KEYS}", self.key, self.partition.name)

    def _held(
        self, dated: DataFrame, source: DataFrame, key: str, partition: DatePartition
    ) -> DataFrame:
        """The distinct keys of the source in the mart, as ``__known``, with their partitions."""
        summary = self._summary()
        if summary is not None and key == self.key:
            calm = summary.without(source.select(quoted(key).alias("key")))
            dated = dated.where(~_among(quoted(partition.name), calm)) if calm else dated
        keys = dated.select(quoted(key).alias("__known"), quoted(partition.name))
        return matched_distinct(keys, source, key)

    def _touched(
        self, dated: DataFrame, source: DataFrame, key: str, partition: DatePartition
    ) -> list[date | None]:
        """Partitions that the batch writes to or has a key in. Each is a folder of the mart."""
        found = self._held(dated, source, key, partition).select(quoted(partition.name).alias("at"))
        given = source.select(partition.column().alias("at"))
        dates = found.unionAll(given).distinct().limit(PARTITIONS_IN_A_BATCH + 1).collect()
        if len(dates) > PARTITIONS_IN_A_BATCH:
            raise ValueError(
                f"mart {self.name}: the batch touches over {PARTITIONS_IN_A_BATCH} partitions; "
                f"merge it in parts, or partition by more than a {partition.unit}"
            )
        return [row[0] for row in dates]


def _among(column: Column, values: list[date | None]) -> Column:
    """Whether a column is one of the values, of which NULL is one like others; never NULL."""
    listed = F.coalesce(column.isin([v for v in values if v is not None]), F.lit(False))
    return listed | column.isNull() if None in values else listed


def _path(place: str) -> str:
    return urlparse(place).path.rstrip("/")


def _listed(name: str) -> str:
    return ".".join(map(quoted_name, name.split(".")))


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class RowLevelMart:
    """A table whose provider (say ``delta`` or ``iceberg``) runs MERGE itself.

    ``partitioning`` holds column names, or transforms like ``partitioning.days("ts")`` where the
    provider has them. The provider also refuses several source rows for one target row.
    """

    spark: SparkSession
    name: str
    provider: str
    partitioning: tuple[Column | str, ...] = ()

    def exists(self) -> bool:
        return bool(self.spark.catalog.tableExists(self.name))

    def ensure(self, schema: T.StructType) -> bool:
        if self.exists():
            return False
        self.create(self.spark.createDataFrame([], schema))
        return True

    def create(self, rows: DataFrame) -> None:
        writer = rows.writeTo(self.name).using(self.provider)
        if self.partitioning:
            first, *more = [quoted(p) if isinstance(p, str) else p for p in self.partitioning]
            writer = writer.partitionedBy(first, *more)
        writer.create()
        if not self.exists():
            raise ValueError(f"table {self.name} is missing after its creation")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merge(self, source: DataFrame, key: str) -> None:
        """Update all columns of matched rows, insert the other source rows."""
        table = self.name.split(".")[-1]
        matches = F.col(f"{quoted_name(table)}.{quoted_name(key)}") == F.col(
            f"batch.{quoted_name(key)}"
        )
        (
            conform(source, self.read().schema)
            .alias("batch")
            .mergeInto(self.name, matches)
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )


@contextmanager
def sql_view(df: DataFrame, prefix: str = "batch") -> Iterator[str]:
    """Make ``df`` visible to SQL under a name no other run uses; dropped at the end."""
    name = f"{prefix}_{uuid4().hex}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)
