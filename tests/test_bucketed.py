"""Marts bucketed by their merge key."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from martloom.operators.upsert import MergeConflict, merge_frame
from martloom.sinks import bucketed
from martloom.sinks.bucketed import BucketedMart
from tests.frames import plan_text, same_rows, settings

KV = "k bigint, v string"
NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def mart(spark):
    yield BucketedMart(spark, "bucketed_mart", "k", 4)
    for name in ("bucketed_mart", "bucketed_mart__next"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, *data):
    return spark.createDataFrame(list(data), KV)


def test_merges_equal_merge_frame(spark, mart):
    rng = random.Random(5)
    held = [(rng.choice([None, rng.randrange(90)]), f"t{n}") for n in range(300)]
    mart.create(frame(spark, *held))
    expected = frame(spark, *held)
    for turn in range(3):
        keys = [k for k in range(150) if rng.random() < 0.3]
        batch = frame(spark, *[(k, f"s{turn}") for k in keys], (None, "sn"), (None, "sn"))
        expected = spark.createDataFrame(merge_frame(expected, batch, "k").collect(), KV)
        with settings(spark, **(NO_BROADCAST if turn else {})):
            mart.merge(batch)
        same_rows(mart.read(), expected)
    names = [table.name for table in spark.catalog.listTables()]
    assert names.count("bucketed_mart") == 1 and "bucketed_mart__next" not in names


@pytest.mark.parametrize("partitions", ["2", "64"])
def test_a_large_batch_leaves_the_target_where_it_is(spark, mart, partitions):
    mart.create(spark.range(1000).selectExpr("id AS k", "'t' AS v"))
    batch = spark.range(500, 1500).selectExpr("id AS k", "'s' AS v")
    with settings(spark, spark__sql__shuffle__partitions=partitions, **NO_BROADCAST):
        with mart.settings():
            plan = plan_text(mart.merged(batch))
        mart.merge(batch)
    scans = [part for part in plan.split("\n") if "FileScan" in part and "Bucketed: true" in part]
    assert len(scans) == 2 and "BroadcastHashJoin" not in plan
    lines = plan.split("\n")
    for at, line in enumerate(lines):
        if "Bucketed: true" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        for above in reversed(lines[:at]):  # up to the join that the scan feeds
            outer = len(above) - len(above.lstrip(" :+-"))
            if outer < depth:
                assert "Exchange" not in above
                depth = outer
            if "Join" in above and outer <= depth:
                break
    assert mart.read().count() == 1500
    again = plan_text(mart.read().groupBy("k").count())
    assert "Exchange" not in again or partitions == "64"


def test_a_conflict_changes_nothing(spark, mart):
    mart.create(frame(spark, (1, "a"), (2, "b")))
    with pytest.raises(MergeConflict):
        mart.merge(frame(spark, (1, "x"), (1, "y")))
    same_rows(mart.read(), frame(spark, (1, "a"), (2, "b")))


def test_a_merge_that_breaks_off_between_drop_and_rename(spark, mart, monkeypatch):
    mart.create(frame(spark, (1, "a")))
    monkeypatch.setattr(BucketedMart, "_finish", lambda self: None)
    mart.merge(frame(spark, (2, "b")))
    assert not spark.catalog.tableExists("bucketed_mart")
    monkeypatch.undo()
    assert mart.exists()
    same_rows(mart.read(), frame(spark, (1, "a"), (2, "b")))


def test_a_hot_key_is_not_read_by_bucket(spark, mart, monkeypatch):
    monkeypatch.setattr(bucketed, "CELL_ROWS", 50)
    mart.create(spark.range(100).selectExpr("if(id < 60, 7, id) AS k", "'t' AS v"))
    assert mart._has_hot_key()
    mart.merge(frame(spark, (7, "s"), (99, "s"), (1000, "s")))
    assert mart.read().where("v = 's'").count() == 62
    monkeypatch.setattr(bucketed, "CELL_ROWS", 61)
    assert not mart._has_hot_key()


def test_ensure_and_create(spark, mart):
    schema = T.StructType.fromDDL(KV)
    assert not mart.exists() and mart.ensure(schema) and not mart.ensure(schema)
    assert mart.read().schema == schema and mart.read().isEmpty()
    with pytest.raises(ValueError, match="is there already"):
        mart.create(frame(spark, (1, "a")))
    mart.merge(frame(spark, (1, "a"), (None, "b")))
    assert mart.read().count() == 2
