"""Star and fan-out joins: edge cases, counts without rows, and heavy keys cut into cells."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martloom.functions.key_filter import KeyFilter
from martloom.functions.sizes import fits_broadcast
from martloom.operators.fanout import FanoutJoin, FanoutTooLarge
from martloom.operators.star import Dimension, star_join
from tests.frames import plan_text, rows, same_rows, settings


@pytest.fixture(scope="module")
def shop(spark):
    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    return {
        "tx": frame(
            [(1, 10, 100), (2, 11, None), (3, None, 101)],
            "transactionID int, customerID int, franchiseID int",
        ),
        "customers": frame([(10, "a"), (11, "b")], "customerID int, customer_first_name string"),
        "franchises": frame(
            [(100, "f", 7), (101, None, 8), (None, "nullkey", 9)],
            "franchiseID int, franchise_name string, supplierID int",
        ),
        "suppliers": frame([(7, "s")], "supplierID int, supplier_name string"),
        "chunks": frame([(100, "c1"), (100, "c2")], "franchiseID int, chunked_text string"),
        "reviews": frame(
            [(100, "r1"), (100, "r2"), (100, "r3")], "franchiseID int, review string"
        ),
    }


def star_of(shop, how="left"):
    suppliers = Dimension(shop["suppliers"], "supplierID")
    franchises = Dimension(shop["franchises"], "franchiseID", (suppliers,))
    return star_join(shop["tx"], [Dimension(shop["customers"], "customerID"), franchises], how)


def test_star_keeps_every_fact_row(shop):
    star = star_of(shop).select(
        "supplierID", "franchiseID", "customerID", "transactionID", "customer_first_name",
        "franchise_name", "supplier_name",
    )
    assert set(rows(star)) == {
        (7, 100, 10, 1, "a", "f", "s"),
        (None, None, 11, 2, "b", None, None),
        (8, 101, None, 3, None, None, None),
    }


def test_snowflake_equals_joining_along_the_fact(shop):
    along = (
        shop["tx"]
        .join(shop["customers"], "customerID", "left")
        .join(shop["franchises"], "franchiseID", "left")
        .join(shop["suppliers"], "supplierID", "left")
    )
    star = star_of(shop)
    same_rows(star.select(*along.columns), along)


def test_star_needs_keys_and_distinct_names(shop):
    with pytest.raises(ValueError, match="no column customerID"):
        star_join(shop["franchises"], [Dimension(shop["customers"], "customerID")])
    with pytest.raises(ValueError, match="both sides hold customer_first_name"):
        named = shop["tx"].withColumn("Customer_First_Name", F.lit("x"))
        star_join(named, [Dimension(shop["customers"], "customerID")])


def test_not_null_filter_turns_the_join_inner(spark, shop):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        filtered = star_of(shop).where("franchise_name IS NOT NULL")
        assert "Inner" in plan_text(filtered)
        assert filtered.count() == 1


def wide_of(shop, how="left"):
    sides = (shop["franchises"], shop["chunks"], shop["reviews"])
    return FanoutJoin(shop["tx"], "franchiseID", sides, how)


@pytest.mark.parametrize("cell_rows", [1, 2, 1000])
def test_wide_rows(shop, cell_rows):
    wide = wide_of(shop).frame(cell_rows=cell_rows)
    assert dict(wide.groupBy("transactionID").count().collect()) == {1: 6, 2: 1, 3: 1}
    inner = wide_of(shop, "inner").frame(cell_rows=cell_rows)
    assert inner.count() == 6
    assert wide.columns == inner.columns == wide_of(shop).columns


def test_wide_counts(shop):
    assert wide_of(shop).summary().first() == (3, 8, 6)
    assert wide_of(shop).null_counts(["franchise_name", "review"]).first() == (8, 2, 2)
    assert wide_of(shop).count_present("franchise_name").first() == (6,)


def test_wide_limit(shop):
    assert wide_of(shop).frame(max_rows=8).count() == 8
    with pytest.raises(FanoutTooLarge, match="8 rows, allowed are 7"):
        wide_of(shop).frame(max_rows=7)


def test_empty_inputs(spark, shop):
    empty = shop["tx"].limit(0)
    join = FanoutJoin(empty, "franchiseID", (shop["chunks"],))
    assert join.summary().first() == (0, 0, None)
    assert join.null_counts(["chunked_text"]).first() == (0, 0)
    assert join.frame(max_rows=0).count() == 0
    unmatched = FanoutJoin(shop["tx"], "franchiseID", (shop["chunks"].limit(0),))
    assert unmatched.frame(cell_rows=1).count() == 3


def test_columns_are_checked(shop):
    with pytest.raises(ValueError, match="both sides hold review"):
        FanoutJoin(shop["tx"], "franchiseID", (shop["reviews"], shop["reviews"]))
    with pytest.raises(ValueError, match="no column franchiseID"):
        FanoutJoin(shop["tx"], "franchiseID", (shop["suppliers"],))
    with pytest.raises(ValueError, match="no column nothing"):
        wide_of(shop).group_counts("nothing")
    with pytest.raises(ValueError, match="how must be"):
        FanoutJoin(shop["tx"], "franchiseID", (shop["chunks"],), "full")


# -- random frames in which one key, or NULL, holds a third of the rows --------------------


def hot_frame(spark, seed, n, names, hot):
    rng = random.Random(seed)
    keys = [None, *range(12)]
    data = [
        (
            hot if rng.random() < 0.34 else rng.choice(keys),
            rng.choice([None, 1, 2, 3]),
            i % (n // 2),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(data, "k int, {} int, {} int".format(*names))


def hot_join(spark, seed, how):
    hot = [3, None, 40][seed % 3]  # 40 occurs in the core only
    return FanoutJoin(
        hot_frame(spark, seed, 60, ("a", "id"), hot),
        "k",
        (
            hot_frame(spark, seed + 10, 50, ("b", "b_id"), 3),
            hot_frame(spark, seed + 20, 40, ("c", "key"), 3 if seed % 2 else 5),
        ),
        how,
    )


def plain(join):
    joined = join.core
    for side in join.sides:
        joined = joined.join(side, join.key, join.how)
    return joined.select(*join.columns)


@pytest.mark.parametrize("seed, how", [(0, "left"), (1, "left"), (2, "left"), (0, "inner")])
def test_cells_give_the_plain_join(spark, seed, how):
    join = hot_join(spark, seed, how)
    assert join.heavy_keys(30).count() > 0
    expected = plain(join)
    for cell_rows in (1, 30, 500):
        same_rows(join.frame(cell_rows=cell_rows), expected)
        if heavy := join.heavy_keys(cell_rows):
            same_rows(join._join_in_cells(heavy), expected)


@pytest.mark.parametrize("seed, how", [(0, "left"), (1, "left"), (2, "left"), (0, "inner")])
def test_counts_equal_those_of_the_rows(spark, seed, how):
    join = hot_join(spark, seed, how)
    wide = plain(join).cache()
    columns = join.columns
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{j}") for j, c in enumerate(columns)]
    same_rows(join.null_counts(columns), wide.agg(F.count(F.lit(1)).alias("rows"), *nulls))
    for column in columns:
        if column in ("k", "a", "id", "c"):
            same_rows(
                join.group_counts(column, cell_rows=5),
                wide.groupBy(column).agg(F.count("*").alias("n")),
            )
        same_rows(join.group_counts(column), wide.groupBy(column).agg(F.count("*").alias("n")))
    per_row = wide.groupBy("k", "a", "id").agg(F.count("*").alias("n"))
    summary = join.summary().first()
    assert summary.joined_rows == wide.count()
    assert summary.max_fanout <= per_row.agg(F.max("n")).first()[0]
    wide.unpersist()


def test_heavy_key_is_spread_evenly(spark):
    core = spark.range(9000).selectExpr("if(id < 3000, 0, id) AS k", "id AS core_id")
    side = spark.range(300).selectExpr("if(id < 100, 0, id) AS k", "id AS side_id")
    join = FanoutJoin(core, "k", (side,))
    assert join.heavy_keys(10_000).collect() == [(0, 30, 1)]
    spread = join.frame(cell_rows=10_000).where("k = 0")
    assert spread.count() == 300_000
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        tasks = join.frame(cell_rows=10_000).groupBy(F.spark_partition_id()).count()
        sizes = [n for _, n in tasks.collect()]
    assert len(sizes) == 8 and max(sizes) < 0.35 * sum(sizes)


def test_copies_of_one_row_are_spread(spark):
    """The rows of the hot key are all the same, so only where they are read tells them apart."""
    core = spark.range(0, 8000, 1, 80).selectExpr("if(id % 2 = 0, 0, id) AS k")
    join = FanoutJoin(core, "k", (spark.range(4).selectExpr("0 AS k", "id AS side_id"),))
    (heavy,) = join.heavy_keys(100).collect()
    assert heavy == (0, 160, 1)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        hot = join.frame(cell_rows=100).where("k = 0").groupBy(F.spark_partition_id())
        sizes = [n for _, n in hot.count().collect()]
    assert sum(sizes) == 16_000 and len(sizes) == 8 and max(sizes) < 0.35 * sum(sizes)


def test_pruned_join_reads_only_what_it_needs(spark, tmp_path):
    for name in ("core", "side"):
        spark.range(100).selectExpr(
            "id % 3 AS k", f"id AS {name}_id", f"'long' AS {name}_text"
        ).write.parquet(f"{tmp_path}/{name}")
    core, side = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("core", "side"))
    join = FanoutJoin(core, "k", (side,)).pruned(["core_id", "side_id"])
    assert join.columns == ["k", "core_id", "side_id"]
    for cell_rows in (10, 10_000_000):
        plan = plan_text(join.frame(cell_rows=cell_rows))
        assert "text" not in plan and "ReadSchema: struct<k:bigint,side_id:bigint>" in plan
    with pytest.raises(ValueError, match="no column other"):
        join.pruned(["other"])


def shuffles(df):
    return plan_text(df).count("Exchange hashpartitioning")


def test_one_shuffle_per_table(spark):
    join = hot_join(spark, 1, "left")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert shuffles(join.frame()) == 3
        cells = join.frame(cell_rows=30)
        assert shuffles(cells) == 3
        assert plan_text(cells).count("hashpartitioning(k") == 1  # the joined rows stay in place


def test_small_sides_move_no_core_row(spark, tmp_path):
    spark.range(20_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS core_id").write.parquet(
        f"{tmp_path}/core"
    )
    core = spark.read.parquet(f"{tmp_path}/core")
    one, few, many = [
        spark.range(n).selectExpr(f"id div {copies} AS k", f"id AS {name}")
        for name, n, copies in (("one", 500, 1), ("few", 60, 6), ("many", 9000, 300))
    ]
    join = FanoutJoin(core, "k", (one, few))
    plan = plan_text(join.frame(cell_rows=1000))  # its fan-out is about one
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan
    same_rows(join.frame(cell_rows=1000), plain(join))
    join = FanoutJoin(core, "k", (one, many, few))
    spread = join.frame(cell_rows=50_000)
    plan = plan_text(spread)
    assert plan.count("SortMergeJoin") == 1 and shuffles(spread) == 2
    assert spread.count() == plain(join).count()
    assert spread.agg(F.sum(F.xxhash64(*join.columns).cast("decimal(38,0)"))).first() == (
        plain(join).agg(F.sum(F.xxhash64(*join.columns).cast("decimal(38,0)"))).first()
    )


def test_small_core_with_many_joined_rows_is_spread(spark, tmp_path):
    spark.range(1000).coalesce(1).selectExpr("id AS k", "id AS core_id").write.parquet(
        f"{tmp_path}/core"
    )
    core = spark.read.parquet(f"{tmp_path}/core")
    for copies, expected in ((200, 8), (5, 1)):
        side = spark.range(1000 * copies).selectExpr("id % 1000 AS k", "id AS side_id")
        joined = FanoutJoin(core, "k", (side.hint("broadcast"),)).frame(cell_rows=25_000)
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) == expected and sum(n for _, n in tasks) == 1000 * copies
        assert max(n for _, n in tasks) <= 1.5 * 1000 * copies / expected


def test_dealt_sides_are_never_broadcast(spark):
    join = hot_join(spark, 1, "left")
    cells = join._join_in_cells(join.heavy_keys(30))
    plan = plan_text(cells)
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("BroadcastHashJoin") == 3  # the list of heavy keys, once per table


def test_measured_size_decides(spark):
    small = spark.range(100).selectExpr(
        "id", "repeat('x', 100) AS text", "array(id) AS list", "map('a', id) AS kv",
        "named_struct('a', id) AS pair", "X'00' AS raw", "current_date() AS day",
    )
    assert fits_broadcast(small)
    assert fits_broadcast(small, limit=100 * (7 * 16 + 100 + 5 + 8 + 8 + 1))
    assert not fits_broadcast(small, limit=100 * (7 * 16 + 100))
    assert not fits_broadcast(small, limit=100)
    assert fits_broadcast(small.limit(0), limit=0)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert not fits_broadcast(small)


def test_small_snowflake_is_broadcast(spark, shop, tmp_path):
    tables = {}
    for name, frame in shop.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = plan_text(star_of(tables))
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_dimension_joins_split_a_hot_key(spark):
    """Adaptive execution cuts a hot or NULL fact key in each step of a star."""
    fact = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 7, id) AS a", "if(id % 3 = 1, NULL, id) AS b", "repeat('x', 50) AS pad"
    )
    dims = [
        Dimension(spark.range(60_000).selectExpr(f"id AS {k}", f"id AS {k}_v"), k) for k in "ab"
    ]
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    ):
        star = star_join(fact, dims)
        assert len(star.collect()) == 60_000
        final = plan_text(star).split("Initial Plan")[0]
        assert final.count("skew=true") >= 2


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_that_only_one_table_has(spark, tmp_path, how):
    """Nine tenths of a side lie on a key the core lacks, and, for the inner join, the reverse."""
    spark.range(0, 2000, 1, 4).selectExpr(
        "if(id % 2 = 0, -2, id) AS k", "id AS core_id"
    ).write.parquet(f"{tmp_path}/core")
    spark.range(0, 40_000, 1, 8).selectExpr(
        "if(id % 10 > 0, -1, id) AS k", "id AS side_id"
    ).write.parquet(f"{tmp_path}/side")
    core, side = spark.read.parquet(f"{tmp_path}/core"), spark.read.parquet(f"{tmp_path}/side")
    join = FanoutJoin(core, "k", (side,), how)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = join.frame(cell_rows=500)
        same_rows(found, core.join(side, "k", how))
    kept = join.without_idle_keys(500)
    assert kept.sides[0].where("k = -1").count() == 0 and kept.sides[0].count() == 4000
    assert kept.core.where("k = -2").count() == (1000 if how == "left" else 0)
    assert join.without_idle_keys(50_000).sides[0].count() == 40_000


def test_tables_are_counted_once(spark, tmp_path):
    spark.range(100).selectExpr("id AS k", "id AS a").write.parquet(f"{tmp_path}/core")
    spark.range(300).selectExpr("id % 100 AS k", "id AS b").write.parquet(f"{tmp_path}/side")
    core, side = spark.read.parquet(f"{tmp_path}/core"), spark.read.parquet(f"{tmp_path}/side")
    join = FanoutJoin(core, "k", (side,)).counted(["b"])
    for report in (join.summary(), join.null_counts(["b"]), join.pruned(["a"]).per_key()):
        assert f"{tmp_path}" not in plan_text(report)
    assert join.null_counts(["b"]).first() == (300, 0)
    assert f"{tmp_path}/side" in plan_text(join.null_counts(["a"])) or join.counted(["b"]) is join


# -- filters of the joined keys --------------------------------------------------------------


def mostly_idle(spark, rows=20_000):
    """A core of few keys and sides whose keys are idle in nine of ten rows, each key a light one."""
    core = spark.range(rows // 10).selectExpr("int(id) AS k", "id AS c")
    one = spark.range(rows).selectExpr("id AS k", "sha2(string(id), 256) AS v")
    two = spark.range(rows).selectExpr("if(id % 50 = 0, NULL, id) AS k", "id AS w")
    return core, one, two


@pytest.mark.parametrize("how", ["left", "inner"])
def test_light_idle_keys_are_stopped_where_they_are_read(spark, how):
    core, one, two = mostly_idle(spark)
    join = FanoutJoin(core, "k", (one, two), how)
    reduced = join.reduced(rows=1000)
    for side, before in zip(reduced.sides, join.sides, strict=True):
        assert side.count() <= 0.115 * before.count()
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        found = join.reduced(rows=1000)
        assert all(side.count() == 20_000 for side in found.sides)  # nothing may be broadcast
    same_rows(reduced.frame(), join.frame())
    plan = plan_text(FanoutJoin(core, "k", reduced.sides, how)._join_whole())
    assert plan.count("LeftSemi") == 2


def test_shuffled_bytes_fall_by_the_idle_share(spark, tmp_path):
    core, one, _ = mostly_idle(spark, 200_000)
    for name, table in (("core", core), ("one", one)):
        table.write.parquet(f"{tmp_path}/{name}")
    core, one = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("core", "one")]
    reduced = FanoutJoin(core, "k", (one,)).reduced(rows=1000)
    plan = plan_text(reduced.sides[0].repartition("k"))
    assert plan.index("Exchange") < plan.index("BroadcastHashJoin")  # filtered below the shuffle
    assert reduced.sides[0].count() <= 0.11 * 200_000


def test_the_join_filters_by_itself_where_it_pays(spark, monkeypatch):
    core, one, two = mostly_idle(spark)
    join = FanoutJoin(core, "k", (one, two))
    expected = join.frame()
    asked = []
    whole = FanoutJoin.reduced
    monkeypatch.setattr(FanoutJoin, "reduced", lambda self: asked.append(1) or whole(self, 1000))
    join.frame()
    assert not asked
    monkeypatch.setattr("martloom.operators.fanout.FILTER_ROWS", 1000)
    same_rows(join.frame(), expected)
    assert asked
    busy = FanoutJoin(core, "k", (one.where("k < 2500"),))
    asked.clear()
    busy.frame()
    assert not asked


def test_no_filter_for_types_whose_equal_values_may_differ_in_hash(spark):
    core, one, _ = mostly_idle(spark, 2000)
    doubles = [table.withColumn("k", F.col("k").cast("double")) for table in (core, one)]
    join = FanoutJoin(doubles[0], "k", (doubles[1],))
    assert join.reduced(rows=100).sides[0].count() == 2000


def test_filters_never_stop_a_key_that_was_put_in(spark):
    for kind in ("int", "string", "decimal(12,3)", "date"):
        value = "date_add(DATE'1990-01-01', int(id))" if kind == "date" else f"cast(id AS {kind})"
        keys = spark.range(3000).selectExpr(f"{value} AS k")
        found = KeyFilter.of(keys, "test-keys")
        assert found.passed(keys, "k").count() == 3000
        others = spark.range(10**6, 10**6 + 3000).selectExpr(f"{value} AS k")
        assert found.passed(others, "k").count() <= 90
        assert KeyFilter.of(keys.limit(0), "test-keys").passed(keys, "k").isEmpty()


# -- bounds ----------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_bound_is_never_below_the_rows(spark, how):
    rng = random.Random(how)
    for _ in range(4):
        frames = [
            spark.createDataFrame(
                [(rng.choice([None, 7, rng.randrange(40)]), at) for at in range(60)],
                f"k {kind}, c{n} int",
            )
            for n, kind in enumerate(("int", "bigint", "int"))
        ]
        join = FanoutJoin(frames[0], "k", tuple(frames[1:]), how)
        rows_held = join.summary().first().joined_rows
        bounds = [join.row_bound(*size).first().row_bound for size in ((1 << 16, 3), (8, 2), (1, 1))]
        assert rows_held <= bounds[0] <= bounds[1] <= bounds[2]
        assert bounds[0] <= 1.01 * rows_held  # hardly a bucket is shared
        assert join.stays_within(rows_held) and not join.stays_within(rows_held - 1)
    nothing = FanoutJoin(frames[0].limit(0), "k", tuple(frames[1:]), how)
    assert nothing.row_bound().first().row_bound == 0


def test_keys_are_counted_only_if_the_bound_does_not_tell(spark, monkeypatch):
    core, one, _ = mostly_idle(spark, 2000)
    join = FanoutJoin(core, "k", (one,))
    monkeypatch.setattr(FanoutJoin, "summary", None)
    assert join.stays_within(10_000)
    plan = plan_text(join.row_bound())
    assert "hashpartitioning(hash" in plan and "hashpartitioning(key" not in plan
