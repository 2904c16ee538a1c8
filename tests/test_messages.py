from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from martloom.functions.contract import (
    Contract,
    backtest,
    check_contracts,
    check_messages,
    newly_refused,
    value_subject,
)
from martloom.sinks.messages import (
    ContractBroken,
    deliver,
    message_frame,
    publish,
    require_contract,
    table_messages,
    to_folder,
    to_kafka,
)

CONTRACT = Contract({"id": "integer", "msg": "string"}, required=("id", "msg"))

# Message texts and their verdicts.
VERDICTS = {
    '{"id":1,"msg":"a"}': "ok",
    '{"id":1.0,"msg":"a"}': "ok",
    '{"id":99999999999999999999,"msg":"a"}': "ok",
    '{"id":1,"msg":"a","x":[1]}': "ok",
    '{"id":1e2,"msg":"a"}': "ok",
    '{"id":1.5,"msg":"a"}': "type:id",
    '{"id":15e-1,"msg":"a"}': "type:id",
    '{"id":"5","msg":"a"}': "type:id",
    '{"id":true,"msg":"a"}': "type:id",
    '{"id":null,"msg":"a"}': "type:id",
    '{"id":1,"msg":null}': "type:msg",
    '{"id":1,"msg":7}': "type:msg",
    '{"msg":"a"}': "missing:id",
    '{"id":"5"}': "missing:msg",
    "{}": "missing:id",
    "[1]": "not_object",
    "7": "not_object",
    "null": "not_object",
    "{bad": "not_json",
    "": "not_json",
    '{"id":1,"id":2}': "not_json",
    None: "not_json",
}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(text,) for text in VERDICTS], "value string")


def test_verdicts(texts):
    found = {row.value: row.verdict for row in check_messages(texts, CONTRACT).collect()}
    assert found == VERDICTS


@pytest.mark.parametrize(
    "kind, fitting",
    [
        ("number", {"1", "1.5", "1e300", "1e19", "-1e20", "1" * 41}),
        ("integer", {"1", "1e300", "1e19", "-1e20", "1" * 41}),
        ("boolean", {"true"}),
        ("array", {"[]", "[1]"}),
        ("object", {"{}", '{"a":1}'}),
        ("null", {"null"}),
        ("string", {'"s"'}),
    ],
)
def test_json_types(spark, kind, fitting):
    literals = ["1", "1.5", "1e300", "true", "[]", "[1]", "{}", '{"a":1}', "null", '"s"']
    literals += ["1e19", "-1e20", "1" * 41]
    data = [(text, f'{{"odd name.x":{text}}}') for text in literals]
    messages = spark.createDataFrame(data, "text string, value string")
    checked = check_messages(messages, Contract({"odd name.x": kind}))
    found = {row.text for row in checked.where("verdict = 'ok'").collect()}
    assert found == fitting


def test_optional_property_may_be_absent(spark):
    messages = spark.createDataFrame([("{}",), ('{"n":1}',), ('{"n":"1"}',)], "value string")
    checked = check_messages(messages, Contract({"n": "integer"}))
    assert [row.verdict for row in checked.collect()] == ["ok", "ok", "type:n"]


def test_contract_is_checked_when_made():
    with pytest.raises(ValueError, match="unknown JSON type 'text'"):
        Contract({"a": "text"})
    with pytest.raises(ValueError, match="quotes"):
        Contract({"a'b": "string"})


def test_contract_from_json_schema():
    schema = {
        "$schema": "https://json-schema.org/draft/2020-12/schema",
        "title": "Reading",
        "type": "object",
        "properties": {
            "sensor": {"type": "integer", "title": "number of the sensor"},
            "note": {"type": ["string", "null"]},
            "raw": {},
            "any": True,
        },
        "required": ["sensor"],
        "additionalProperties": False,
    }
    expected = Contract(
        {"sensor": "integer", "note": ("string", "null"), "raw": None, "any": None},
        required=("sensor",),
        closed=True,
    )
    assert Contract.from_json_schema(json.dumps(schema)) == expected
    for change, message in (
        ({"additionalProperties": {"type": "string"}}, "additionalProperties"),
        ({"type": "array"}, "describe an object"),
        ({"minProperties": 1}, "minProperties"),
        ({"properties": {"sensor": {"type": "integer", "minimum": 0}}}, "minimum"),
        ({"properties": {"sensor": {"type": "int"}}}, "unknown JSON type"),
        ({"properties": {"sensor": {"type": ["integer", 5]}}}, "unknown JSON type"),
        ({"properties": {"sensor": {"type": {"a": 1}}}}, "unknown JSON type"),
        ({"properties": {"sensor": False}}, "not supported"),
        ({"required": "sensor"}, "list property names"),
    ):
        with pytest.raises(ValueError, match=message):
            Contract.from_json_schema(json.dumps({**schema, **change}))
    with pytest.raises(ValueError, match="describe an object"):
        Contract.from_json_schema("[]")


def test_type_lists_and_closed_objects(spark):
    contract = Contract({"a": ("integer", "null"), "b": None}, closed=True)
    expected = {
        '{"a":1}': "ok",
        '{"a":null,"b":[1]}': "ok",
        '{"a":1e2,"b":"x"}': "ok",
        '{"a":"1"}': "type:a",
        '{"c":1}': "extra",
        "{}": "ok",
    }
    texts = spark.createDataFrame([(text,) for text in expected], "value string")
    found = {row.value: row.verdict for row in check_messages(texts, contract).collect()}
    assert found == expected


def test_two_contracts_compared():
    free, number = Contract({}), Contract({"a": "number"})
    whole, both = Contract({"a": "integer"}), Contract({"a": ("number", "null")}, closed=True)
    assert newly_refused(free, free) == newly_refused(whole, number) == []
    assert newly_refused(number, whole) == newly_refused(free, number) == ["type:a"]
    assert newly_refused(both, free) == [] and newly_refused(number, both) == ["extra"]
    assert newly_refused(both, number) == ["type:a"]
    assert newly_refused(free, Contract({}, ("b",))) == ["missing:b"]
    assert newly_refused(both, Contract({"b": "string"})) == []


def test_backtest_counts_only_new_faults(texts):
    candidate = Contract({**CONTRACT.properties, "x": "array"}, required=("id", "msg", "x"))
    assert backtest(texts, CONTRACT, candidate).first() == (len(VERDICTS), 4)
    assert backtest(texts, CONTRACT, CONTRACT).first() == (len(VERDICTS), 0)


def test_messages_are_parsed_once(texts):
    checked = check_contracts(texts, {"one": CONTRACT, "two": CONTRACT})
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_subject():
    assert value_subject("orders") == "orders-value"


def test_message_keeps_nulls_and_key_is_text(spark):
    df = spark.createDataFrame([(1, None), (None, 'say "hi"')], "id int, msg string")
    fields = [F.col("id"), F.col("msg")]
    found = message_frame(df, F.col("id"), fields).collect()
    assert [row.key for row in found] == ["1", None]
    assert json.loads(found[0].value) == {"id": 1, "msg": None}
    assert json.loads(found[1].value) == {"id": None, "msg": 'say "hi"'}
    assert table_messages(df, "id").collect() == found


def test_require_contract(spark, texts):
    good = spark.createDataFrame([("1", '{"id":1,"msg":"a"}')], "key string, value string")
    require_contract(good, CONTRACT)
    with pytest.raises(ContractBroken, match="missing:id: 2, .*type:msg: 2"):
        require_contract(texts, CONTRACT)


def test_delivery_is_counted_by_the_write(spark, tmp_path):
    messages = spark.range(1000).selectExpr(
        "if(id < 10, NULL, string(id)) AS key", "'{}' AS value"
    )
    report = deliver(messages, to_folder(f"{tmp_path}/topic"))
    assert report.first().asDict() == {"n_sent": 1000, "n_null_keys": 10}
    assert spark.read.parquet(f"{tmp_path}/topic").count() == 1000


def test_publish_sends_only_what_the_contract_accepts(spark, texts, tmp_path):
    messages = texts.select(F.lit(None).cast("string").alias("key"), "value")
    report = publish(messages, CONTRACT, to_folder(f"{tmp_path}/sent"), f"{tmp_path}/checked")
    good = {text for text, found in VERDICTS.items() if found == "ok"}
    n = len(VERDICTS)
    assert report.first() == (n, len(good), n - len(good), n)
    sent = spark.read.parquet(f"{tmp_path}/sent")
    assert {row.value for row in sent.collect()} == good and sent.columns == ["key", "value"]
    rejected = spark.read.parquet(f"{tmp_path}/checked/accepted=false")
    assert {row.value: row.verdict for row in rejected.collect()} == {
        text: found for text, found in VERDICTS.items() if found != "ok"
    }
    none = publish(messages.limit(0), CONTRACT, to_folder(f"{tmp_path}/no"), f"{tmp_path}/none")
    assert none.first() == (0, 0, 0, 0)


def test_kafka_needs_its_connector(spark):
    messages = spark.createDataFrame([("1", "{}")], "key string, value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        deliver(messages, lambda df: to_kafka(df, "broker:9092", "orders"))
