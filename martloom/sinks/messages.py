"""Publish a table as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martloom.functions.contract import Contract, check_messages
from martloom.functions.names import quoted


class ContractBroken(RuntimeError):
    """Messages do not satisfy their contract."""


def message_frame(df: DataFrame, key: Column, fields: Sequence[Column]) -> DataFrame:
    """``(key, value)``: the key as text, the fields as a JSON object that keeps its nulls."""
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(key.cast("string").alias("key"), value.alias("value"))


def table_messages(df: DataFrame, key: str) -> DataFrame:
    """One message per row of a table, with all its columns."""
    return message_frame(df, quoted(key), [quoted(name) for name in df.columns])


def require_contract(messages: DataFrame, contract: Contract) -> None:
    """Raise with the number of messages per fault; a contract has few possible faults."""
    faults = (
        check_messages(messages, contract)
        .where("verdict <> 'ok'")
        .groupBy("verdict")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("verdict")
        .collect()
    )
    if faults:
        raise ContractBroken(", ".join(f"{row.verdict}: {row.n}" for row in faults))


def to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Write from all partitions at once; needs the Kafka connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def to_folder(folder: str) -> Callable[[DataFrame], None]:
    """A sink that stores messages as files, for replay and checks."""
    return lambda messages: messages.write.parquet(folder)


def publish(
    messages: DataFrame, contract: Contract, send: Callable[[DataFrame], None], folder: str
) -> DataFrame:
    """Send what satisfies the contract and report ``(n_due, n_sent, n_rejected, n_null_keys)``.

    The messages are made and checked once, and stored below ``folder`` by outcome: sending reads
    the accepted ones, and ``<folder>/accepted=false`` keeps the others with their verdict.
    """
    checked = check_messages(messages, contract)
    checked = checked.withColumn("accepted", F.col("verdict") == "ok")
    checked.write.partitionBy("accepted").parquet(folder)
    stored = messages.sparkSession.read.schema(checked.schema).parquet(folder)
    sent = deliver(stored.where("accepted").select("key", "value"), send).first()
    return stored.agg(
        F.count(F.lit(1)).alias("n_due"),
        F.lit(sent.n_sent).cast("long").alias("n_sent"),
        F.count_if(~F.col("accepted")).alias("n_rejected"),
        F.count_if(F.col("key").isNull()).alias("n_null_keys"),
    )


def deliver(messages: DataFrame, send: Callable[[DataFrame], None]) -> DataFrame:
    """Send the messages and report ``(n_sent, n_null_keys)`` as one row.

    Counted inside the write itself. A narrow frame is counted by the tasks that write it, of
    which Spark merges one success per partition, so lost executors do not inflate the counts.
    """
    counts = Observation()
    send(
        messages.observe(
            counts,
            F.count(F.lit(1)).alias("n_sent"),
            F.count_if(F.col("key").isNull()).alias("n_null_keys"),
        )
    )
    report = counts.get
    return messages.sparkSession.createDataFrame(
        [(report["n_sent"], report["n_null_keys"])], "n_sent bigint, n_null_keys bigint"
    )
