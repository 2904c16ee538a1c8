"""The same marts, checks, upserts and messages over the retail tables of a data folder.

Every function takes ``(spark, folder)`` and works on whole tables. Shapes: for the star,
``lineitem`` is the fact, ``orders`` and ``supplier`` its dimensions, ``nation`` the snowflake of
``supplier``. For the fan-out, ``orders`` is the fact, and ``events`` and ``conversations`` hold
many rows per customer.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.contract import Contract, backtest, check_messages, value_subject
from martloom.functions.json_schema import NestedContract
from martloom.operators.contract_history import contract_history
from martloom.operators.fanout import FanoutJoin
from martloom.operators.projection import select_columns
from martloom.operators.quality import (
    Expectations,
    duplicate_groups,
    not_null_report,
    report,
    row_count_report,
)
from martloom.operators.star import Dimension, star_join
from martloom.operators.upsert import action_counts, change_rows, conflicts, merge_frame
from martloom.plans.loading import load_mart
from martloom.sinks.acknowledged import FolderTopic, deliver_acknowledged
from martloom.sinks.bucketed import BucketedMart
from martloom.sinks.expectation_state import ExpectationState
from martloom.sinks.messages import deliver, message_frame, publish, to_folder
from martloom.sinks.scratch import scratch_folder, staged
from martloom.sinks.tables import DatePartition, MartTable, sql_view, write_partitioned
from martloom.sources.tables import TableSource, folder_reader, load_sources
from martloom.streaming.publishing import Publishing

CUSTOMERS = TableSource(
    "customer",
    {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "customer_segment"},
)
STAR = {
    "lines": TableSource(
        "lineitem", {"l_orderkey": "order_id", "l_linenumber": "line_no", "l_suppkey": "supp_id"}
    ),
    "orders": TableSource(
        "orders",
        {"o_orderkey": "order_id", "o_custkey": "order_cust_id", "o_orderdate": "order_ts"},
    ),
    "suppliers": TableSource(
        "supplier", {"s_suppkey": "supp_id", "s_name": "supp_name", "s_nationkey": "nation_id"}
    ),
    "nations": TableSource("nation", {"n_nationkey": "nation_id", "n_name": "nation_name"}),
}
STAR_COLUMNS = [
    "order_id", "line_no", "order_cust_id", "order_ts", "supp_id", "supp_name", "nation_id",
    "nation_name", "l_quantity", "l_extendedprice",
]
WIDE = {
    "orders": TableSource("orders", {"o_orderkey": "order_id", "o_custkey": "cust_id"}),
    "customers": TableSource(
        "customer",
        {"c_custkey": "cust_id", "c_name": "customer_name", "c_nationkey": "nation_id"},
    ),
    "nations": STAR["nations"],
    "events": TableSource("events", {"user_id": "cust_id"}),
    "turns": TableSource("conversations", {"conv_id": "cust_id"}),
}
LABELLED = Contract({"id": "integer"}, required=("id",))
LABELLED_WITH_QUALITY = Contract(
    {"id": "integer", "quality": "integer"}, required=("id", "quality")
)
EVENT = Contract({"id": "integer", "msg": "string"}, required=("id", "msg"))
ORDER_BUCKETS = 8
# Bytes; some events of the test tables are longer as messages.
LARGEST_MESSAGE = 26
CLOSED_EVENT = Contract({"id": ("integer", "null"), "msg": None}, required=("id",), closed=True)


# -- sources, projections, joins ----------------------------------------------------------


def scan_row_count(spark: SparkSession, folder: str) -> DataFrame:
    orders = folder_reader(spark, folder)("orders")
    return orders.agg(F.count(F.lit(1)).alias("row_count"))


def rename_project(spark: SparkSession, folder: str) -> DataFrame:
    customers = CUSTOMERS.load(folder_reader(spark, folder))
    return select_columns(customers, ["customer_id", "customer_name", "customer_segment"])


def core_star_left(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_sources(folder_reader(spark, folder), STAR, STAR)
    suppliers = Dimension(
        tables["suppliers"], "supp_id", (Dimension(tables["nations"], "nation_id"),)
    )
    star = star_join(tables["lines"], [Dimension(tables["orders"], "order_id"), suppliers])
    return select_columns(star, STAR_COLUMNS)


def left_join_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    read = folder_reader(spark, folder)
    joined = star_join(read("documents"), [Dimension(read("labels"), "doc_id")])
    return select_columns(joined, ["doc_id", "lang", "quality", "toxic"])


def _wide(spark: SparkSession, folder: str, how: str = "left", star: bool = False) -> FanoutJoin:
    """Orders with their customer's events and conversation turns, and the customer if ``star``."""
    names = ["orders", "events", "turns"] + (["customers", "nations"] if star else [])
    tables = load_sources(folder_reader(spark, folder), WIDE, names)
    sides = (tables["events"], tables["turns"])
    if star:
        nations = Dimension(tables["nations"], "nation_id")
        sides = (Dimension(tables["customers"], "cust_id", (nations,)).flattened(how), *sides)
    return FanoutJoin(tables["orders"], "cust_id", sides, how)


def wide_mart_left(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["order_id", "cust_id", "event_id", "event_type", "turn", "role"]
    return select_columns(_wide(spark, folder).pruned(columns).frame(), columns)


def wide_mart_star(spark: SparkSession, folder: str) -> DataFrame:
    columns = [
        "order_id", "cust_id", "customer_name", "nation_id", "nation_name", "event_id",
        "event_type", "turn", "role",
    ]
    return select_columns(_wide(spark, folder, star=True).pruned(columns).frame(), columns)


def wide_mart_reduced(spark: SparkSession, folder: str) -> DataFrame:
    """The wide mart of events, each side first filtered by the keys that have joined rows."""
    columns = ["order_id", "cust_id", "event_id", "event_type", "turn", "role"]
    join = _wide(spark, folder).pruned(columns).reduced(rows=1, share=0.0)
    return select_columns(join.frame(), columns)


def inner_join_five_way(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["order_id", "cust_id", "nation_name", "event_id", "turn"]
    joined = _wide(spark, folder, how="inner", star=True).pruned(columns).frame()
    names = ["o_orderkey", "c_custkey", "n_name", "event_id", "turn"]
    return select_columns(joined, columns).toDF(*names)


def fanout_report(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(spark, folder).summary().toDF("fact_rows", "wide_rows", "max_fanout")


def fanout_bound(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the wide mart, and whether the bound from hashed counts holds, also a rough one."""
    wide = _wide(spark, folder)
    fine = wide.row_bound().first().row_bound
    rough = wide.row_bound(buckets=64, hashes=2).first().row_bound
    holds = (F.lit(fine) >= F.col("joined_rows")) & F.lit(rough >= fine)
    return wide.summary().select(F.col("joined_rows").alias("wide_rows"), holds.alias("bound_holds"))


def filter_not_null_count(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(spark, folder).count_present("event_type")


def preview_limit(spark: SparkSession, folder: str) -> DataFrame:
    orders = folder_reader(spark, folder)("orders")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    return select_columns(orders, columns).orderBy("o_orderkey").limit(10)


def preview_wide(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["order_id", "cust_id", "event_id", "event_type", "turn", "role"]
    first = _wide(spark, folder).pruned(columns).first_rows("order_id", 10)
    return select_columns(first, columns)


def sql_view_join(spark: SparkSession, folder: str) -> DataFrame:
    """Events per kind of customer, by SQL over views that only this call knows."""
    read = folder_reader(spark, folder)
    with sql_view(read("customer")) as customers, sql_view(read("events")) as events:
        return spark.sql(
            f"""SELECT c_mktsegment, event_type, count(*) AS n_events
            FROM {events} JOIN {customers} ON user_id = c_custkey
            GROUP BY c_mktsegment, event_type"""
        )


# -- data quality -------------------------------------------------------------------------


def expect_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return not_null_report(_wide(spark, folder), ["order_id", "cust_id", "event_id", "turn"])


def expect_unique_groups(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_groups(_wide(spark, folder), "event_id")


def expect_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return row_count_report(_wide(spark, folder), min_rows=1, max_rows=50_000_000)


def expectation_report(spark: SparkSession, folder: str) -> DataFrame:
    tables = load_sources(folder_reader(spark, folder), WIDE, ["orders", "events"])
    wide = FanoutJoin(tables["orders"], "cust_id", (tables["events"],))
    rules = Expectations(not_null=("order_id", "event_id"), unique=("order_id",), min_rows=1)
    return report(wide, rules)


def expectation_delta(spark: SparkSession, folder: str) -> DataFrame:
    """The rules of a mart after a batch, of which only the touched partitions were counted anew."""
    mart = _status_mart(spark)
    rules = Expectations(
        not_null=("order_id", "amount"), unique=("order_id",), min_rows=1, max_rows=50_000_000
    )
    state = ExpectationState(spark, scratch_folder(spark, "expectations"), rules, "changed_in")
    mart.create(_order_status(spark, folder))
    state.refresh(spark.table(mart.name))
    touched = mart.merge(_status_changes(spark, folder), "order_id")
    state.refresh(mart.rows_of(touched), touched)
    spark.sql(f"DROP TABLE {mart.name}")
    return state.report()


# -- upsert -------------------------------------------------------------------------------


def _order_status(spark: SparkSession, folder: str) -> DataFrame:
    """Merge target: the status of each order line; an order has several."""
    lines = folder_reader(spark, folder)("lineitem")
    columns = ["l_orderkey", "l_linestatus", "l_extendedprice", "l_shipdate"]
    return select_columns(lines, columns).toDF("order_id", "status", "amount", "changed_at")


def _status_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Merge source: one change per order; an error carries no amount."""
    events = folder_reader(spark, folder)("events")
    amount = F.when(F.col("event_type") != "error", F.col("value"))
    columns = ["event_id", "event_type", amount, "ts"]
    return events.select(columns).toDF("order_id", "status", "amount", "changed_at")


def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return merge_frame(_order_status(spark, folder), _status_changes(spark, folder), "order_id")


def merge_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same upsert into a mart that is bucketed by order."""
    mart = BucketedMart(spark, f"order_buckets_{uuid4().hex}", "order_id", ORDER_BUCKETS)
    mart.create(_order_status(spark, folder))
    mart.merge(_status_changes(spark, folder))
    loaded = staged(mart.read(), "order-buckets")
    spark.sql(f"DROP TABLE {mart.name}")  # its name and files are of this run only
    return loaded


def merge_action_counts(spark: SparkSession, folder: str) -> DataFrame:
    return action_counts(_order_status(spark, folder), _status_changes(spark, folder), "order_id")


def merge_changes(spark: SparkSession, folder: str) -> DataFrame:
    return change_rows(_order_status(spark, folder), _status_changes(spark, folder), "order_id")


def merge_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    found = conflicts(_order_status(spark, folder), _wide(spark, folder), "order_id")
    return found.toDF("order_id", "n_source_rows")


def mart_write_read(spark: SparkSession, folder: str) -> DataFrame:
    orders = folder_reader(spark, folder)("orders")
    dated = orders.withColumn("order_date", F.to_date("o_orderdate"))
    rows = select_columns(dated, ["o_orderkey", "o_custkey", "o_totalprice", "order_date"])
    out = scratch_folder(spark, "orders-by-month")
    write_partitioned(rows, out, DatePartition("order_date", "order_month", "month"))
    return spark.read.parquet(out).drop("order_month")


ORDER_STATUS = "order_id BIGINT, status STRING, amount DOUBLE, changed_at TIMESTAMP_NTZ"


def _status_mart(spark: SparkSession, key: str | None = None) -> MartTable:
    """A mart of this run only, by month; ``key``: to be summarised."""
    return MartTable(
        spark,
        f"order_status_{uuid4().hex}",
        scratch_folder(spark, "order-status"),
        DatePartition("changed_at", "changed_in", "month"),
        key,
    )


def mart_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two checked loads into a new mart table: the order lines, then the changes."""
    mart = _status_mart(spark)
    schema = T.StructType.fromDDL(ORDER_STATUS)
    rules = Expectations(not_null=("order_id",), min_rows=1)
    load_mart(_order_status(spark, folder), mart, schema, "order_id", rules)
    load_mart(_status_changes(spark, folder), mart, schema, "order_id", rules)
    spark.sql(f"DROP TABLE {mart.name}")  # its name is of this run only; the files stay
    return mart.read()


def mart_keys_found(spark: SparkSession, folder: str) -> DataFrame:
    """Which partitions of the order lines' mart a batch of changes has keys in, and how many."""
    mart = _status_mart(spark, "order_id")
    mart.create(_order_status(spark, folder))
    spark.sql(f"DROP TABLE {mart.name}")
    return mart.found(_status_changes(spark, folder), "order_id")


# -- messages -----------------------------------------------------------------------------


def message_table(spark: SparkSession, folder: str) -> DataFrame:
    events = folder_reader(spark, folder)("events")
    fields = [F.col("event_id").alias("id"), F.col("event_type").alias("msg")]
    return message_frame(events, F.col("event_id"), fields)


def _label_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their quality label as JSON; unlabelled ones lack the property."""
    read = folder_reader(spark, folder)
    labelled = star_join(read("documents"), [Dimension(read("labels"), "doc_id")])
    value = F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("quality")))
    return labelled.select("doc_id", value.alias("value"))


def contract_check(spark: SparkSession, folder: str) -> DataFrame:
    return check_messages(_label_messages(spark, folder), LABELLED_WITH_QUALITY).drop("value")


def contract_backtest(spark: SparkSession, folder: str) -> DataFrame:
    return backtest(_label_messages(spark, folder), LABELLED, LABELLED_WITH_QUALITY)


def _event_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a message, one kind of fault or none by turns."""
    number, name = F.col("event_id").cast("string"), F.col("event_type")
    texts = [
        F.concat(F.lit('{"id":'), number, F.lit(',"msg":"'), name, F.lit('"}')),
        F.concat(F.lit('{"id":"'), number, F.lit('","msg":"'), name, F.lit('"}')),
        F.concat(F.lit("["), number, F.lit("]")),
        F.concat(F.lit('{"id":'), number, F.lit(',"msg":"'), name),
        F.concat(F.lit('{"msg":"'), name, F.lit('"}')),
        F.lit("null"),
        F.concat(F.lit('{"id":'), number, F.lit('e19,"msg":"'), name, F.lit('"}')),
        F.concat(F.lit('{"id":'), number, F.lit(',"msg":'), number, F.lit("}")),
        F.concat(F.lit('{"id":null,"msg":"'), name, F.lit('"}')),
        F.concat(F.lit('{"id":'), number, F.lit('.5,"msg":"'), name, F.lit('"}')),
        F.concat(F.lit('{"id":'), number, F.lit(',"msg":"'), name, F.lit('","more":[1]}')),
    ]
    turn = (F.col("event_id") % len(texts) + 1).cast("int")
    events = folder_reader(spark, folder)("events")
    return events.select("event_id", F.element_at(F.array(*texts), turn).alias("value"))


def contract_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return check_messages(_event_texts(spark, folder), EVENT)


def contract_closed(spark: SparkSession, folder: str) -> DataFrame:
    return check_messages(_event_texts(spark, folder), CLOSED_EVENT).drop("value")


def _user_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a version of its user's contract: what a message about it would hold."""
    events = folder_reader(spark, folder)("events")
    kind, size = F.col("event_type"), F.floor(F.abs("value")).cast("long")
    types = F.array(*map(F.lit, VERSION_TYPES))
    of = F.concat(F.lit('"'), kind, F.lit('":{'), F.get(types, (size % 4).cast("int")), F.lit("}"))
    also = F.when(size % 3 == 0, F.concat(F.lit(',"'), kind, F.lit('"'))).otherwise("")
    schema = F.concat(
        F.lit('{"type":"object","properties":{"id":{"type":"integer"},'), of,
        F.lit('},"required":["id"'), also,
        F.lit('],"additionalProperties":'), (kind != "error").cast("string"), F.lit("}"),
    )
    user = F.col("user_id").cast("string")
    return events.select(
        F.concat(user, F.lit(value_subject(""))).alias("subject"),
        F.col("event_id").alias("version"),
        schema.alias("schema"),
    )


VERSION_TYPES = ('"type":"integer"', '"type":"number"', '"type":["integer","null"]', "")


def contract_versions(spark: SparkSession, folder: str) -> DataFrame:
    return contract_history(_user_contracts(spark, folder))


def publish_report(spark: SparkSession, folder: str) -> DataFrame:
    messages = _label_messages(spark, folder)
    keyed = messages.select(F.col("doc_id").cast("string").alias("key"), "value")
    sent, stored = scratch_folder(spark, "published"), scratch_folder(spark, "checked")
    return publish(keyed, LABELLED_WITH_QUALITY, to_folder(sent), stored)


def publish_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a message that arrives in one of several files, published as a stream."""
    arrived = scratch_folder(spark, "arrived")
    keyed = _event_texts(spark, folder).select(F.col("event_id").cast("string").alias("key"), "value")
    keyed.repartition(4).write.parquet(arrived)
    topic, state = FolderTopic(scratch_folder(spark, "topic")), scratch_folder(spark, "stream")
    publishing = Publishing(spark, arrived, state, EVENT, topic, parts=4, at_once=2)
    publishing.run()
    names = ("n_due", "n_acknowledged", "n_failed", "n_refused")
    return publishing.outcomes().agg(*[F.sum(name).alias(name) for name in names])


def delivery_report(spark: SparkSession, folder: str) -> DataFrame:
    return deliver(message_table(spark, folder), to_folder(scratch_folder(spark, "messages")))


def delivery_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Every event sent to a topic of four parts, of which one is offline; long messages are refused."""
    events = folder_reader(spark, folder)("events")
    fields = [F.col("event_id").alias("id"), F.col("event_type").alias("msg")]
    messages = message_frame(events, F.col("event_id"), fields)
    topic = FolderTopic(scratch_folder(spark, "topic"), largest=LARGEST_MESSAGE, offline=(3,))
    report = scratch_folder(spark, "deliveries")
    part = F.col("key").cast("long") % 4
    return deliver_acknowledged(messages, part, topic, report).counts


# Faults that the nested messages have by turns; the eleventh kind has none.
ORDER_SCHEMA = """{
    "type": "object", "required": ["id", "user"],
    "properties": {
        "id": {"type": "integer", "minimum": 0},
        "user": {"$ref": "#/$defs/user"},
        "kind": {"enum": ["click", "view", "purchase", "error", "signup", null]},
        "props": {"type": "object"},
        "items": {
            "type": "array", "maxItems": 3,
            "items": {
                "type": "object", "required": ["n"], "additionalProperties": false,
                "properties": {"n": {"type": "number", "exclusiveMaximum": 10}}}}},
    "$defs": {
        "user": {
            "type": "object", "required": ["id"],
            "properties": {"id": {"type": "integer"}, "mail": {"type": "string", "pattern": "@"}}}}
}"""


def _nested_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a nested message with its own properties, one kind of fault or none by turns."""
    good = '{"id":#,"user":{"id":#,"mail":"a@b"},"kind":null,"props":%,"items":[{"n":1},{"n":2.5}]}'
    texts = [good]
    for old, new in NESTED_FAULTS:
        texts.append(good.replace(old, new, 1))
    events = folder_reader(spark, folder)("events")
    number = F.col("event_id").cast("string")
    turn = (F.col("event_id") % len(texts) + 1).cast("int")
    text = F.element_at(F.array(*map(F.lit, texts)), turn)
    value = F.replace(F.replace(text, F.lit("#"), number), F.lit("%"), F.col("props"))
    return events.select("event_id", value.alias("value"))


NESTED_FAULTS = (
    ('"id":#,"user"', '"id":-#,"user"'),
    ('"user":{"id":#', '"user":{"id":"#"'),
    ('"id":#,"mail"', '"mail"'),
    ('"a@b"', '"ab"'),
    ('"kind":null', '"kind":"none"'),
    ('"props":%', '"props":[%]'),
    ('{"n":2.5}', '{"n":10}'),
    ('{"n":2.5}', '{"m":2.5}'),
    ('{"n":2.5}', '{"n":2.5,"m":1}'),
    ('{"n":2.5}', '{"n":2},{"n":3},{"n":4}'),
    ('"items":[', '"items":'),
)


def contract_nested(spark: SparkSession, folder: str) -> DataFrame:
    contract = NestedContract.from_json_schema(ORDER_SCHEMA)
    return check_messages(_nested_texts(spark, folder), contract).drop("value")
