"""Publish what arrives in a folder, batch by batch, each batch once.

A load leaves its messages as files; a stream picks up the files that it has not seen, checks them
against the contract, sends what satisfies it and reports what was acknowledged. Structured Streaming
numbers the batches and, after a failure, repeats the last one with the same number and the same
files. The number therefore names the folder of a batch's outcome: a batch whose outcome is there was
delivered to its end and is not sent again. Only a batch that broke off in the middle is sent from its
beginning, as delivery is at least once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.contract import AnyContract, Contract, check_messages
from martloom.sinks.acknowledged import Connect, deliver_acknowledged, dealt_by

MESSAGES = "key string, value string"
OUTCOME = "part bigint, n_due bigint, n_acknowledged bigint, n_failed bigint, n_refused bigint"
# Fixed value: the part under which messages that break the contract are reported.
REFUSED = -1


@dataclass(frozen=True)
class Publishing:
    """A topic that is fed from a folder of parquet messages (key, value).

    ``state``: a folder of its own for the stream's checkpoint and the outcomes of its batches.
    ``parts``: of the topic; ``at_once``: files that a batch takes at most.
    """

    spark: SparkSession
    messages: str
    state: str
    contract: Contract | AnyContract
    connect: Connect
    parts: int
    at_once: int = 1000

    def run(self) -> None:
        """Publish everything that has arrived and was not published, then stop."""
        arrived = (
            self.spark.readStream.schema(MESSAGES)
            .option("maxFilesPerTrigger", self.at_once)
            .parquet(self.messages)
        )
        query = (
            arrived.writeStream.option("checkpointLocation", f"{self.state}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(self.publish)
            .start()
        )
        query.awaitTermination()

    def publish(self, batch: DataFrame, number: int) -> None:
        """Send one batch, unless it was sent; refused messages are kept with their verdict."""
        spark = batch.sparkSession
        own = f"{self.state}/batches/{number}"
        if self._is_there(spark, f"{own}/outcome"):
            return
        checked = check_messages(batch, self.contract)
        checked = checked.withColumn("accepted", F.col("verdict") == "ok")
        checked.write.mode("overwrite").partitionBy("accepted").parquet(f"{own}/messages")
        stored = spark.read.schema(checked.schema).parquet(f"{own}/messages")
        due = stored.where("accepted").select("key", "value")
        sent = deliver_acknowledged(due, self._part(), self.connect, f"{own}/delivery")
        refused = stored.where("NOT accepted").agg(F.count(F.lit(1)).alias("n_refused"))
        none = F.lit(0).cast("long")
        rest = refused.where("n_refused > 0").select(
            F.lit(REFUSED).cast("long").alias("part"), none.alias("n_due"),
            none.alias("n_acknowledged"), none.alias("n_failed"), "n_refused",
        )
        counts = sent.counts.withColumn("n_refused", none).unionByName(rest)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{own}/outcome")

    def outcomes(self) -> DataFrame:
        """``part, n_due, n_acknowledged, n_failed, n_refused`` of all batches so far."""
        sums = [F.sum(name).alias(name) for name in ("n_due", "n_acknowledged", "n_failed", "n_refused")]
        if not self._is_there(self.spark, f"{self.state}/batches/0/outcome"):
            return self.spark.createDataFrame([], OUTCOME)
        every = self.spark.read.schema(OUTCOME).parquet(f"{self.state}/batches/*/outcome")
        return every.groupBy("part").agg(*sums)

    def _part(self) -> Column:
        return F.coalesce(dealt_by(F.col("key"), self.parts), F.lit(0).cast("long"))

    @staticmethod
    def _is_there(spark: SparkSession, folder: str) -> bool:
        """Whether an outcome was written: it is one file, which is there whole or not at all."""
        try:
            return bool(spark.read.parquet(folder).columns)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
