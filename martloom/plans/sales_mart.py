"""The denormalised sales mart: transactions with customer, franchise, supplier and reviews.

Two grains. *Core* has one row per transaction, given unique dimension keys, and is the one to
upsert by transaction. *Wide* adds every combination of a franchise's review chunks and customer
reviews; it repeats transactions, so a second load of it into the same table is a merge conflict.
"""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martloom.operators.fanout import FanoutJoin
from martloom.operators.quality import Expectations
from martloom.operators.star import Dimension, star_join
from martloom.plans.loading import load_mart
from martloom.sinks.tables import DatePartition, MartTable, RowLevelMart
from martloom.sources.tables import Reader, TableSource, load_sources

# Source tables with their column renames.
SOURCES: Mapping[str, TableSource] = MappingProxyType(
    {
        "transactions": TableSource("sales_transactions", {"dateTime": "trans_timestamp"}),
        "customers": TableSource(
            "sales_customers",
            {
                "first_name": "customer_first_name",
                "last_name": "customer_last_name",
                "address": "customer_address",
                "city": "customer_city",
                "state": "customer_state",
                "postal_zip_code": "customer_postal_zip_code",
                "country": "customer_country",
                "continent": "customer_continent",
                "email_address": "customer_email_address",
                "phone_number": "customer_phone_number",
                "gender": "customer_gender",
            },
        ),
        "franchises": TableSource(
            "sales_franchises",
            {
                "name": "franchise_name",
                "city": "franchise_city",
                "district": "franchise_district",
                "zipcode": "franchise_zipcode",
                "country": "franchise_country",
                "size": "franchise_size",
                "longitude": "franchise_longitude",
                "latitude": "franchise_latitude",
            },
        ),
        "suppliers": TableSource(
            "sales_suppliers",
            {
                "name": "supplier_name",
                "ingredient": "supplier_ingredient",
                "continent": "supplier_continent",
                "city": "supplier_city",
                "district": "supplier_district",
                "size": "supplier_size",
                "longitude": "supplier_longitude",
                "latitude": "supplier_latitude",
                "approved": "supplier_approved",
            },
        ),
        "review_chunks": TableSource(
            "media_gold_reviews_chunked",
            {
                "review_date": "chunked_review_date",
                "review_uri": "chunked_review_uri",
                "chunk_id": "chunked_id",
            },
        ),
        "customer_reviews": TableSource("media_customer_reviews", {"new_id": "review_new_id"}),
    }
)

# Columns and types of the core mart, then those the wide mart adds.
CORE_COLUMNS = """
    transactionID BIGINT, customerID BIGINT, franchiseID BIGINT, supplierID BIGINT,
    trans_timestamp TIMESTAMP, product STRING, quantity BIGINT, unitPrice BIGINT,
    totalPrice BIGINT, paymentMethod STRING, cardNumber BIGINT,
    customer_first_name STRING, customer_last_name STRING, customer_address STRING,
    customer_city STRING, customer_state STRING, customer_postal_zip_code STRING,
    customer_country STRING, customer_continent STRING, customer_email_address STRING,
    customer_phone_number STRING, customer_gender STRING,
    franchise_name STRING, franchise_city STRING, franchise_district STRING,
    franchise_zipcode STRING, franchise_country STRING, franchise_size STRING,
    franchise_longitude DOUBLE, franchise_latitude DOUBLE,
    supplier_name STRING, supplier_ingredient STRING, supplier_continent STRING,
    supplier_city STRING, supplier_district STRING, supplier_size STRING,
    supplier_longitude DOUBLE, supplier_latitude DOUBLE, supplier_approved BOOLEAN
"""
REVIEW_COLUMNS = """
    chunked_review_date TIMESTAMP, chunked_text STRING, chunked_id STRING,
    chunked_review_uri STRING, review STRING, review_date TIMESTAMP, review_new_id INT
"""

# The upsert key and the rules a batch has to satisfy.
MERGE_KEY = "transactionID"
EXPECTATIONS = Expectations(not_null=("transactionID", "customerID", "franchiseID"), min_rows=1)

PARTITION = DatePartition("trans_timestamp", "trans_date")
GRAINS = ("core", "wide")
CORE_TABLES = ("transactions", "customers", "franchises", "suppliers")


def mart_schema(grain: str = "core") -> T.StructType:
    """Needs a running session, as Spark parses the column list."""
    columns = f"{CORE_COLUMNS}, {REVIEW_COLUMNS}" if grain == "wide" else CORE_COLUMNS
    return T.StructType.fromDDL(columns)


def core_mart(read: Reader, sources: Mapping[str, TableSource] = SOURCES) -> DataFrame:
    tables = load_sources(read, sources, CORE_TABLES)
    return star_join(
        tables["transactions"],
        [Dimension(tables["customers"], "customerID"), _franchises(tables)],
    )


def wide_mart(read: Reader, sources: Mapping[str, TableSource] = SOURCES) -> FanoutJoin:
    """Everything that hangs off the franchise joins in one fan-out, hence in one shuffle."""
    tables = load_sources(read, sources, (*CORE_TABLES, "review_chunks", "customer_reviews"))
    sales = star_join(tables["transactions"], [Dimension(tables["customers"], "customerID")])
    sides = (_franchises(tables).flattened(), tables["review_chunks"], tables["customer_reviews"])
    return FanoutJoin(sales, "franchiseID", sides)


def _franchises(tables: Mapping[str, DataFrame]) -> Dimension:
    suppliers = Dimension(tables["suppliers"], "supplierID")
    return Dimension(tables["franchises"], "franchiseID", (suppliers,))


def load_sales_mart(
    read: Reader,
    mart: MartTable | RowLevelMart,
    grain: str = "core",
    rules: Expectations = EXPECTATIONS,
    sources: Mapping[str, TableSource] = SOURCES,
    max_rows: int | None = None,
) -> None:
    """Build the mart from its sources, check it, and upsert it into ``mart``."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {', '.join(GRAINS)}, not {grain!r}")
    data = wide_mart(read, sources) if grain == "wide" else core_mart(read, sources)
    load_mart(data, mart, mart_schema(grain), MERGE_KEY, rules, max_rows)


def preview(wide: FanoutJoin, rows: int = 10) -> DataFrame:
    """The first rows of the wide mart by transaction, without building it."""
    return wide.first_rows(MERGE_KEY, rows)
