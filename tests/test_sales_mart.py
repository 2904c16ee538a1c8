"""The sales mart end to end, from catalog tables to the upserted target."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martloom.functions.contract import Contract
from martloom.operators.fanout import FanoutTooLarge
from martloom.operators.quality import Expectations, ExpectationsFailed
from martloom.operators.upsert import MergeConflict
from martloom.plans.loading import load_and_publish
from martloom.plans.sales_mart import (
    EXPECTATIONS,
    MERGE_KEY,
    PARTITION,
    SOURCES,
    core_mart,
    load_sales_mart,
    mart_schema,
    preview,
    wide_mart,
)
from martloom.sinks.messages import to_folder
from martloom.sinks.tables import MartTable
from martloom.sources.tables import TableSource, catalog_reader
from tests.frames import plan_text, rows, settings

PERSON = """first_name string, last_name string, address string, city string, state string,
    postal_zip_code string, country string, continent string, email_address string,
    phone_number string, gender string"""
TABLES = {
    "sales_transactions": (
        "transactionID bigint, customerID bigint, franchiseID bigint, dateTime timestamp, "
        "product string, quantity bigint, unitPrice bigint, totalPrice bigint, "
        "paymentMethod string, cardNumber bigint",
        [
            "1, 10, 100, TIMESTAMP'2024-05-01 10:00:00', 'bun', 2, 3, 6, 'card', 4111",
            "2, 11, 101, TIMESTAMP'2024-05-01 18:30:00', 'pie', 1, 5, 5, 'cash', NULL",
            "3, 10, 999, TIMESTAMP'2024-05-02 00:00:00', 'bun', 1, 3, 3, 'card', 4111",
        ],
    ),
    "sales_customers": (
        f"customerID bigint, {PERSON}",
        [
            f"{n}, 'f{n}', 'l', 'street', 'town', 'st', 'zip', 'land', 'cont', 'mail', 'phone', 'x'"
            for n in (10, 11)
        ],
    ),
    "sales_franchises": (
        "franchiseID bigint, name string, city string, district string, zipcode string, "
        "country string, size string, longitude double, latitude double, supplierID bigint",
        [
            "100, 'North', 'c', 'd', 'z', 'land', 'L', 1.5D, 2.5D, 7",
            "101, 'South', 'c', 'd', 'z', 'land', 'S', 3.5D, 4.5D, 8",
        ],
    ),
    "sales_suppliers": (
        "supplierID bigint, name string, ingredient string, continent string, city string, "
        "district string, size string, longitude double, latitude double, approved boolean",
        ["7, 'Mill', 'flour', 'cont', 'c', 'd', 'M', 5.5D, 6.5D, true"],
    ),
    "media_gold_reviews_chunked": (
        "franchiseID bigint, review_date timestamp, review_uri string, chunk_id string, "
        "chunked_text string",
        [f"100, TIMESTAMP'2024-04-01 00:00:00', 'uri', 'c{n}', 'text {n}'" for n in (1, 2)],
    ),
    "media_customer_reviews": (
        "franchiseID bigint, new_id int, review string, review_date timestamp",
        [f"100, {n}, 'review {n}', TIMESTAMP'2024-04-02 00:00:00'" for n in (1, 2, 3)],
    ),
}


@pytest.fixture(scope="module")
def read(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for name, (schema, values) in TABLES.items():
        names = [column.split()[0] for column in schema.replace("\n", " ").split(",")]
        table = spark.sql(f"SELECT * FROM VALUES {', '.join(f'({v})' for v in values)}")
        table.toDF(*names).to(spark.createDataFrame([], schema).schema).write.mode(
            "overwrite"
        ).saveAsTable(f"shop.{name}")
    yield catalog_reader(spark, "spark_catalog.shop")
    spark.sql("DROP DATABASE shop CASCADE")


@pytest.fixture
def mart(spark, tmp_path):
    yield MartTable(spark, "sales_mart_under_test", f"{tmp_path}/mart", PARTITION)
    spark.sql("DROP TABLE IF EXISTS sales_mart_under_test")


def test_schemas(spark):
    assert len(mart_schema("core")) == 39
    assert len(mart_schema("wide")) == len(set(mart_schema("wide").names)) == 46
    assert sum(len(source.renames) for source in SOURCES.values()) == 33


def test_core_has_one_row_per_transaction(read):
    core = core_mart(read)
    assert set(mart_schema("core").names) == set(core.columns)
    found = core.select(MERGE_KEY, "customer_first_name", "franchise_name", "supplier_name")
    assert set(rows(found)) == {
        (1, "f10", "North", "Mill"),
        (2, "f11", "South", None),
        (3, "f10", None, None),
    }


def test_wide_repeats_transactions(read):
    wide = wide_mart(read)
    assert set(mart_schema("wide").names) == set(wide.columns)
    assert rows(wide.group_counts(MERGE_KEY)) == {(1, 6): 1, (2, 1): 1, (3, 1): 1}
    assert wide.frame().count() == 8
    assert wide.count_present("franchise_name").first() == (7,)
    first = preview(wide, 7)
    assert [r[MERGE_KEY] for r in first.collect()] == [1] * 6 + [2]
    assert first.columns == wide.columns and preview(wide, 100).count() == wide.frame().count()


def test_core_load_then_upsert(spark, read, mart):
    load_sales_mart(read, mart)
    assert mart.read().schema == mart_schema("core")
    assert mart.read().count() == 3
    later = {**SOURCES, "transactions": TableSource("sales_new", {"dateTime": "trans_timestamp"})}
    old = read("sales_transactions")
    changed = old.where("transactionID = 1").withColumn("paymentMethod", F.lit(None).cast("string"))
    added = old.where("transactionID = 2").withColumn("transactionID", F.lit(4).cast("bigint"))
    changed.union(added).write.saveAsTable("shop.sales_new")
    load_sales_mart(read, mart, sources=later)
    found = rows(mart.read().select(MERGE_KEY, "paymentMethod", "product"))
    assert set(found) == {
        (1, None, "bun"),
        (2, "cash", "pie"),
        (3, "card", "bun"),
        (4, "cash", "pie"),
    }
    dates = spark.table(mart.name).select("trans_date").distinct().collect()
    assert {str(row.trans_date) for row in dates} == {"2024-05-01", "2024-05-02"}


def test_second_wide_load_is_a_conflict(read, mart):
    load_sales_mart(read, mart, grain="wide")
    assert mart.read().count() == 8
    with pytest.raises(MergeConflict, match=r"1 \(6 rows\)"):
        load_sales_mart(read, mart, grain="wide")
    assert mart.read().count() == 8


@pytest.mark.parametrize("grain", ["core", "wide"])
def test_failed_rules_leave_no_table(read, mart, grain):
    rules = Expectations(not_null=("supplierID",), max_rows=2)
    with pytest.raises(ExpectationsFailed, match=r"row_count_max.*|not_null\(supplierID\): 1"):
        load_sales_mart(read, mart, grain, rules)
    assert not mart.exists()


def test_wide_load_refuses_too_many_rows(read, mart):
    with pytest.raises(FanoutTooLarge):
        load_sales_mart(read, mart, grain="wide", max_rows=7)
    assert not mart.exists()


def test_what_was_loaded_is_published(spark, read, mart, tmp_path):
    contract = Contract({"transactionID": "integer", "cardNumber": "integer"}, ("transactionID",))
    core = core_mart(read)
    rest = (mart_schema(), MERGE_KEY, EXPECTATIONS, contract, to_folder(f"{tmp_path}/topic"))
    report = load_and_publish(core, mart, *rest, f"{tmp_path}/checked")
    assert report.first().asDict() == {
        "n_due": 3, "n_sent": 2, "n_rejected": 1, "n_null_keys": 0,
    }
    sent = spark.read.parquet(f"{tmp_path}/topic")
    assert sorted(row.key for row in sent.collect()) == ["1", "3"]  # 2 has no card number
    assert mart.read().count() == 3
    refused = Expectations(max_rows=1)
    with pytest.raises(ExpectationsFailed):
        load_and_publish(
            core, mart, *rest[:2], refused, contract, to_folder(f"{tmp_path}/no"), f"{tmp_path}/no2"
        )
    assert not (tmp_path / "no").exists()


def test_unknown_grain(read, mart):
    with pytest.raises(ValueError, match="grain must be one of core, wide"):
        load_sales_mart(read, mart, grain="daily")


def test_missing_section_and_column(read, mart):
    with pytest.raises(KeyError, match="review_chunks"):
        wide_mart(read, {name: s for name, s in SOURCES.items() if name != "review_chunks"})
    unnamed = {**SOURCES, "customers": TableSource("sales_customers")}
    with pytest.raises(ValueError, match="both sides hold"):
        core_mart(read, {**unnamed, "franchises": TableSource("sales_franchises")})
    with pytest.raises(ValueError, match="no column customer_first_name"):
        load_sales_mart(read, mart, sources=unnamed)


def test_transactions_are_shuffled_once_per_key(spark, read):
    """Franchise, supplier and both review tables join in the shuffle on the franchise."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        plan = plan_text(wide_mart(read).frame())
    # Two for sales (customer, franchise), one each for customers, chunks and reviews; two for
    # franchises (supplier, franchise) and one for suppliers.
    assert plan.count("Exchange hashpartitioning") == 8
