"""The sink that knows what was acknowledged."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.sinks.acknowledged import (
    FolderTopic,
    Undelivered,
    _Writer,
    dealt_by,
    deliver_acknowledged,
    deliveries,
)


@pytest.fixture
def messages(spark):
    rows = [(None if n % 10 == 9 else f"k{n}", "x" * (n % 7)) for n in range(100)]
    return spark.createDataFrame([*rows, ("none", None)], "key string, value string").repartition(5)


def sent(folder):
    """Part and message of everything in a folder topic."""
    return sorted(
        (int(file.parent.name.split("=")[1]), str(row["key"]), str(row["value"]))
        for file in Path(folder).rglob("*.jsonl")
        for row in map(json.loads, file.read_text().splitlines())
    )


def by_part(counts):
    return {row.part: (row.n_due, row.n_acknowledged, row.n_failed) for row in counts.collect()}


def test_everything_arrives(spark, messages, tmp_path):
    part = F.char_length("key") % 2
    part = F.coalesce(part, F.lit(7))
    done = deliver_acknowledged(messages, part, FolderTopic(f"{tmp_path}/t"), f"{tmp_path}/r")
    expected = messages.withColumn("part", part)
    due = {row.part: (row["count"], row["count"], 0) for row in expected.groupBy("part").count().collect()}
    assert by_part(done.counts) == due and done.failed.isEmpty()
    rows = expected.select("part", "key", "value").collect()
    assert sent(f"{tmp_path}/t") == sorted((p, str(k), str(v)) for p, k, v in rows)


def test_failures_are_reported_and_can_be_sent_again(spark, messages, tmp_path):
    part = F.coalesce(dealt_by(F.col("key"), 4), F.lit(0))
    topic = FolderTopic(f"{tmp_path}/t", largest=5, offline=(2,))
    done = deliver_acknowledged(messages, part, topic, f"{tmp_path}/r")
    dealt = messages.withColumn("part", part).collect()
    failed = [r for r in dealt if r.part == 2 or len(r.value or "") > 5]
    counts = by_part(done.counts)
    assert sum(c[2] for c in counts.values()) == len(failed) > 0
    assert counts[2][1] == 0 and counts[2][0] == counts[2][2]
    assert {(r.part, r.key, r.value) for r in done.failed.collect()} == {
        (r.part, r.key, r.value) for r in failed
    }
    reasons = {r.reason for r in done.failed.collect()}
    assert reasons == {"ConnectionError: part 2 is offline", "ValueError: message of 6 bytes is too large"}
    again = deliver_acknowledged(
        done.failed, F.col("part"), FolderTopic(f"{tmp_path}/t"), f"{tmp_path}/again"
    )
    assert again.failed.isEmpty() and len(sent(f"{tmp_path}/t")) == messages.count()


class Flaky:
    """Acknowledges late; loses what a later message asks for, and everything if flushing fails."""

    def __init__(self, fails=False):
        self.fails, self.fate = fails, {}

    def __call__(self, part):
        return self

    def send(self, key, value):
        if key == "refused":
            raise ValueError("refused at once")
        return lambda: self.fate.get(key, "never asked")

    def flush(self):
        if self.fails:
            raise TimeoutError("no answer in time")
        self.fate = {"good": None, "bad": "rejected by the leader"}


@pytest.mark.parametrize("at_once", [1, 2, 10])
def test_outcomes_are_asked_for_after_the_flush(tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(_Writer, "AT_ONCE", at_once)
    rows = [(1, "good", "v"), (1, "bad", "v"), (1, "refused", "v"), (4, "good", None)]
    writer = _Writer(Flaky(), str(tmp_path))
    report = writer.write(iter(rows))
    assert {part: tuple(vars(c).values()) for part, c in report.counts.items()} == {
        1: (3, 1, 2), 4: (1, 1, 0),
    }
    lines = (tmp_path / report.failed_file).read_text().splitlines()
    assert [json.loads(line)["reason"] for line in lines] == [
        "rejected by the leader", "ValueError: refused at once",
    ]
    writer = _Writer(Flaky(fails=True), str(tmp_path))
    assert vars(writer.write(iter(rows[:1])).counts[1]) == {
        "n_due": 1, "n_acknowledged": 0, "n_failed": 1,
    }
    assert writer.write(iter([])).counts == {}


def test_a_job_that_is_given_up_says_what_had_been_sent(spark, tmp_path):
    rows = spark.range(0, 8, 1, 4).select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("id") < 7, "v").otherwise(F.raise_error(F.lit("broken row"))).alias("value"),
    )
    with pytest.raises(Undelivered, match="finished tasks are reported in"):
        deliver_acknowledged(rows, F.lit(1), FolderTopic(f"{tmp_path}/t"), f"{tmp_path}/r")
    counts = by_part(deliveries(spark, f"{tmp_path}/r").counts)
    assert not counts or counts[1][0] == counts[1][1] <= 6


def test_nothing_to_send(spark, messages, tmp_path):
    topic = FolderTopic(f"{tmp_path}/t")
    done = deliver_acknowledged(messages.limit(0), F.lit(1), topic, f"{tmp_path}/r")
    assert done.counts.isEmpty() and done.failed.isEmpty()


def test_a_hot_part_is_sent_by_all_tasks_without_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 900, 1, 6).selectExpr("string(id) AS key", "'v' AS value")
    done = deliver_acknowledged(
        rows, (F.col("key").cast("long") % 3 > 0).cast("int"), FolderTopic(f"{tmp_path}/t"), f"{tmp_path}/r"
    )
    assert by_part(done.counts) == {0: (300, 300, 0), 1: (600, 600, 0)}
    assert len(list((tmp_path / "t" / "part=1").iterdir())) == 6
