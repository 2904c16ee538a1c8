from __future__ import annotations

from math import prod

import pytest
from pyspark.sql import functions as F

from martloom.operators.spread import (
    MAX_CELLS,
    heaviest,
    heavy_keys,
    join_keyed,
    with_part,
    with_parts,
)
from tests.frames import plan_text, same_rows, settings


@pytest.fixture(scope="module")
def hot_rows(spark):
    """A third of the rows has key 7, another third NULL."""
    return spark.range(0, 3000, 1, 30).selectExpr(
        "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN NULL ELSE id END AS k", "id % 50 AS v"
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("cell_rows", [1, 100, 10_000])
def test_join_keyed(spark, hot_rows, how, cell_rows):
    keyed = spark.range(0, 3000, 4).selectExpr("id + 3 AS kk", "id AS w")
    expected = hot_rows.join(keyed, F.col("k") == F.col("kk"), how)
    heavy = heavy_keys(hot_rows, "k", cell_rows)
    same_rows(join_keyed(hot_rows, "k", keyed, "kk", how, heavy), expected)


@pytest.mark.parametrize("key", [7, None])
def test_heavy_key_reaches_every_task(spark, hot_rows, key):
    keyed = spark.range(100).selectExpr("id AS kk")
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        heavy = heavy_keys(hot_rows, "k", cell_rows=20)
        joined = join_keyed(hot_rows, "k", keyed, "kk", "left", heavy)
        counted = joined.groupBy("k", F.spark_partition_id()).count().collect()
    sizes = [n for k, _, n in counted if k == key]
    assert sum(sizes) == 1000 and len(sizes) == 8 and max(sizes) < 300


def test_light_keys_are_joined_plainly(spark, hot_rows):
    heavy = heavy_keys(hot_rows, "k")
    assert heavy is None
    plan = plan_text(join_keyed(hot_rows, "k", spark.range(9).toDF("kk"), "kk", "inner", heavy))
    assert "explode" not in plan and "xxhash64" not in plan


def test_every_heavy_key_is_listed(spark):
    counted = spark.range(30_000).selectExpr("id AS heavy_key", "id AS n")
    assert heaviest(counted, F.col("n"), 5_000).count() == 24_999
    assert heaviest(counted, F.col("n"), 30_000) is None
    keyed = spark.range(0, 12_000, 2).selectExpr("id AS kk")
    rows = spark.range(36_000).selectExpr("id % 12000 AS k", "id AS v")
    expected = rows.join(keyed, F.col("k") == F.col("kk"), "left")
    heavy = heavy_keys(rows, "k", cell_rows=2)
    assert heavy.count() == 12_000
    same_rows(join_keyed(rows, "k", keyed, "kk", "left", heavy), expected)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):  # a list that is too long
        joined = join_keyed(rows, "k", keyed, "kk", "left", heavy)
        assert "BroadcastHashJoin" not in plan_text(joined)
        same_rows(joined, expected)


@pytest.mark.parametrize(
    "counts, parts",
    [
        ([3_000_000], [3]),
        ([10, 1000, 200], [1, 2, 1]),
        ([3000, 1, 3000], [3, 1, 3]),
        ([10**6, 2, 1], [2, 1, 1]),
        ([10**12, 1, 1], [65_536, 1, 1]),
        ([1, 10**9, 10**9], [1, 256, 256]),
    ],
)
def test_parts(spark, counts, parts):
    rows = [f"{n}L AS rows_{at}" for at, n in enumerate(counts)]
    found = with_parts(spark.range(1).selectExpr(*rows), len(counts), 1_000_000).first()
    found = [found[f"parts_{at}"] for at in range(len(counts))]
    assert found == parts
    assert prod(found) <= 2 * MAX_CELLS
    cell = prod(n / p for n, p in zip(counts, found))
    assert cell <= max(1_000_000, 1.01 * prod(counts) / MAX_CELLS)


def test_parts_do_not_depend_on_row_order(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1}, [{"b": 2}], "x"), (2, {}, [], "y")],
        "k int, m map<string,int>, ms array<map<string,int>>, s string",
    ).coalesce(1)
    parts = with_part(df, df.columns, F.lit(1000)).select("k", "__part")
    again = df.orderBy(F.desc("k")).coalesce(1)
    again = with_part(again, again.columns, F.lit(1000)).select("k", "__part")
    assert set(parts.collect()) == set(again.collect())


def test_equal_rows_of_a_partition_are_dealt_apart(spark):
    rows = spark.range(0, 400_000, 1, 4).selectExpr("7 AS k", "'same' AS v")
    found = with_part(rows, rows.columns, F.lit(40)).groupBy("__part").count().collect()
    assert len(found) == 40
    assert max(row["count"] for row in found) <= 2 * 400_000 / 40
    light = with_part(rows, rows.columns, F.lit(1)).select("__part").distinct().collect()
    assert [row[0] for row in light] == [0]
