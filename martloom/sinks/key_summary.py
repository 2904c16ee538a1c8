"""Which keys the partitions of a mart may hold: a range and a Bloom filter for each, beside the mart.

A small batch has keys in few partitions, but to learn in which, a merge has to read the key column
of all. The summary rules most of them out beforehand. It may name a partition that holds no key of
the batch, it never leaves one out: a partition without a valid summary counts as one that may hold
anything.

A filter has words of 64 bits (see ``functions/key_filter.py``), 16 bits for each distinct key, but
at most ``MOST_WORDS``; beyond that it lets more through. All of it are aggregates that Spark combines
before they are shuffled.

The summary is a parquet table by partition: a head row (``word`` NULL) with range and number of
words, and a row for each word that is not empty. A partition's summary is struck out before its rows
change and written after, so a merge that breaks off in between leaves it unknown, not wrong.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.key_filter import HASHED, mask, word, words_for
from martloom.functions.names import quoted

MOST_WORDS = 1 << 16
# Looking a batch up costs keys times partitions; beyond so many keys the mart is read instead.
MOST_KEYS = 1_000_000



@dataclass(frozen=True)
class KeySummary:
    """``folder``: of the summary; ``key`` and ``partition``: columns of the mart."""

    spark: SparkSession
    folder: str
    key: str
    partition: str

    def store(self, rows: DataFrame, emptied: Iterable[date | None] = ()) -> None:
        """Summarise all rows of the partitions they are in; those in ``emptied`` hold none."""
        kind = rows.schema[self.key].dataType
        if not isinstance(kind, HASHED):
            raise ValueError(f"keys of type {kind.simpleString()} cannot be summarised")
        keys = rows.select(quoted(self.partition).alias("at"), quoted(self.key).alias("key"))
        # Repeated keys are told apart roughly: a filter that is larger than needed is no worse.
        sizes = keys.groupBy("at").agg(
            F.min("key").alias("low"),
            F.max("key").alias("high"),
            F.approx_count_distinct("key").alias("n"),
        )
        power = F.least(words_for(F.col("n")), F.lit(float(MOST_WORDS))).cast("int")
        counted = F.when(F.col("high").isNull(), 0).otherwise(power)
        heads = sizes.select("at", "low", "high", counted.alias("words")).persist()
        try:
            held = keys.where("key IS NOT NULL").join(
                F.broadcast(heads.select(F.col("at").alias("__at"), "words")),
                F.col("at").eqNullSafe(F.col("__at")),
            )
            words = held.groupBy("at", word(F.col("key"), F.col("words")).alias("word"))
            words = words.agg(F.bit_or(mask(F.col("key"))).alias("bits"))
            empty = self._heads([(value, 0) for value in emptied], kind)
            everything = heads.unionByName(empty).unionByName(words, allowMissingColumns=True)
            self._write(everything.select(*self._schema(kind).names))
        finally:
            heads.unpersist()

    def forget(self, partitions: Iterable[date | None], kind: T.DataType) -> None:
        """Strike out the summaries of partitions that are about to change."""
        struck = self._heads([(value, None) for value in partitions], kind)
        unfilled = struck.select("*", F.lit(None).cast("long").alias("word"))
        unfilled = unfilled.withColumn("bits", F.lit(None).cast("long"))
        self._write(unfilled.select(*self._schema(kind).names))

    def without(self, keys: DataFrame) -> list[date | None]:
        """Partitions that hold none of the keys (one column ``key``) for certain."""
        keys = keys.where("key IS NOT NULL").distinct()
        kind = keys.schema["key"].dataType
        try:
            stored = self.spark.read.schema(self._schema(kind)).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        heads = stored.where("word IS NULL AND words IS NOT NULL").select("at", "low", "high", "words")
        held = {row.at: row.words for row in heads.select("at", "words").collect()}
        known = set(held)
        if not known or keys.limit(MOST_KEYS + 1).count() > MOST_KEYS:
            return []
        # One look-up for each size that a filter has: these are powers of two.
        sizes = sorted(set(held.values()) - {0})
        if not sizes:
            return list(known)
        size = F.explode(F.array(*map(F.lit, sizes))).alias("words")
        asked = keys.select("key", size).select(
            "key", "words", word(F.col("key"), F.col("words")).alias("word"),
            mask(F.col("key")).alias("mask"),
        )
        at = F.col("at").eqNullSafe(F.col("__at"))
        named = heads.select(F.col("at").alias("__at"), "low", "high", "words")
        filters = stored.where("word IS NOT NULL").select("at", "word", "bits")
        filters = filters.join(F.broadcast(named), at)
        inside = F.col("key").between(F.col("low"), F.col("high"))
        hit = F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")
        same = (F.col("a.words") == F.col("f.words")) & (F.col("a.word") == F.col("f.word"))
        found = asked.alias("a").join(filters.alias("f"), same & inside & hit)
        return list(known - {row[0] for row in found.select("f.at").distinct().collect()})

    def _heads(self, values: list[tuple], kind: T.DataType) -> DataFrame:
        rows = self.spark.createDataFrame(values, "at date, words int")
        none = F.lit(None).cast(kind)
        return rows.select("at", none.alias("low"), none.alias("high"), "words")

    def _schema(self, kind: T.DataType) -> T.StructType:
        return (
            T.StructType()
            .add("low", kind)
            .add("high", kind)
            .add("words", T.IntegerType())
            .add("word", T.LongType())
            .add("bits", T.LongType())
            .add("at", T.DateType())
        )

    def _write(self, rows: DataFrame) -> None:
        balanced = rows.hint("rebalance", F.col("at"))
        writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("at").parquet(self.folder)
