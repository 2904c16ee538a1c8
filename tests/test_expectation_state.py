"""Expectations kept per partition against full runs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martloom.operators.quality import Expectations, report
from martloom.sinks.expectation_state import ExpectationState
from martloom.sinks.tables import DatePartition, MartTable
from tests.frames import same_rows

RULES = Expectations(not_null=("k", "v"), unique=("k", "v"), min_rows=3, max_rows=60)


@pytest.fixture
def mart(spark, tmp_path):
    yield MartTable(spark, "mart_with_rules", f"{tmp_path}/mart", DatePartition("at", "day"))
    spark.sql("DROP TABLE IF EXISTS mart_with_rules")


def day(spark, *data):
    rows = spark.createDataFrame(list(data), "k bigint, v string, at string")
    return rows.withColumn("at", F.col("at").cast("timestamp_ntz"))


def test_reports_equal_full_runs_batch_after_batch(spark, mart, tmp_path):
    rng = random.Random(8)
    dates = [None, *[f"2024-01-0{n} 10:00:00" for n in range(1, 8)]]
    state = ExpectationState(spark, f"{tmp_path}/state", RULES, "day")
    held = [(rng.choice([None, rng.randrange(40)]), rng.choice([None, "a", f"v{n}"]), rng.choice(dates))
            for n in range(50)]
    mart.create(day(spark, *held))
    state.refresh(spark.table(mart.name))
    same_rows(state.report(), report(mart.read(), RULES))
    for turn in range(4):
        keys = rng.sample(range(60), 3)
        batch = [(k, rng.choice([None, f"w{turn}", "a"]), rng.choice(dates)) for k in keys]
        touched = mart.merge(day(spark, *batch), "k")
        state.refresh(mart.rows_of(touched), touched)
        same_rows(state.report(), report(mart.read(), RULES))


def test_only_touched_partitions_are_read(spark, mart, tmp_path):
    state = ExpectationState(spark, f"{tmp_path}/state", RULES, "day")
    mart.create(day(spark, *[(n, f"v{n}", f"2024-01-{n:02d} 10:00:00") for n in range(1, 21)]))
    state.refresh(spark.table(mart.name))
    touched = mart.merge(day(spark, (4, "new", "2024-01-09 10:00:00")), "k")
    assert sorted(map(str, touched)) == ["2024-01-04", "2024-01-09"]
    rows = mart.rows_of(touched)
    files = {row[0].split("/")[-2] for row in rows.select(F.input_file_name()).distinct().collect()}
    assert files == {"day=2024-01-09"}  # nothing is left of the other
    kept = {file: file.stat().st_mtime_ns for file in (tmp_path / "state").rglob("*.parquet")}
    state.refresh(rows, touched)
    after = {file: file.stat().st_mtime_ns for file in (tmp_path / "state").rglob("*.parquet")}
    same = {file.parent.name for file in kept if after.get(file) == kept[file]}
    assert len(same) == 18 and not {"at=2024-01-04", "at=2024-01-09"} & same
    same_rows(state.report(), report(mart.read(), RULES))


@pytest.mark.parametrize("kind", ["double", "decimal(9,2)", "binary", "array<int>", "timestamp"])
def test_values_of_any_type(spark, tmp_path, kind):
    values = {
        "double": "0.0D, -0.0D, double('NaN'), double('NaN'), 1.5D, NULL, NULL",
        "decimal(9,2)": "1.50, 1.5, 2, NULL",
        "binary": "x'00ff', x'00ff', x'01', NULL",
        "array<int>": "array(1, 2), array(1, 2), array(2, 1), NULL, NULL",
        "timestamp": "TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-01 00:00:00', NULL",
    }[kind]
    rows = spark.sql(
        f"SELECT CAST(v AS {kind}) AS v, date_add(DATE'2024-01-01', n % 2) AS day "
        f"FROM (SELECT posexplode(array({values})) AS (n, v))"
    )
    rules = Expectations(not_null=("v",), unique=("v",))
    state = ExpectationState(spark, f"{tmp_path}/state", rules, "day")
    state.refresh(rows)
    same_rows(state.report(), report(rows, rules))


def test_an_empty_mart_and_no_rules(spark, tmp_path):
    empty = day(spark).withColumn("day", F.to_date("at"))
    state = ExpectationState(spark, f"{tmp_path}/state", RULES, "day")
    state.refresh(empty)
    same_rows(state.report(), report(empty, RULES))
    free = ExpectationState(spark, f"{tmp_path}/free", Expectations(), "day")
    free.refresh(empty)
    assert free.report().isEmpty()
    with pytest.raises(ValueError, match="no column v"):
        state.refresh(empty.drop("v"))
