"""Field rules against the conversions of Python itself."""

import json

import pytest
from pyspark.sql import functions as F

from stocktide import contracts as C
from stocktide.functions.payload import Field, with_fields
from stocktide.operators import contract_check as K
from stocktide.operators import validate as V

PAYLOADS = [
    '{"q":3}', '{"q":"3"}', '{"q":3.7}', '{"q":-3.7}', '{"q":"3.7"}', '{"q":"0"}', '{"q":0}', '{"q":0.0}', '{"q":""}',
    '{"q":null}', "{}", '{"q":true}', '{"q":false}', '{"q":" 7 "}', '{"q":"+5"}', '{"q":"3d"}', '{"q":"1e3"}',
    '{"q":1e3}', '{"q":0.05}', '{"q":"x"}', '{"q":"false"}', '{"q":"NaN"}', '{"q":"inf"}', '{"q":".5"}', '{"q":"5."}',
    '{"q":"2147483648"}', '{"q":-1}', '{"q":"a\\nb"}', '{"q":"\\n"}', ' {"q":3}', '{"other":1}',
]
REJECTED = ["[1]", "null", "bad", '{"q":NaN}', "", '{"q":', "3", '"q"', '[{"q":3}]']


def tried(function, value):
    try:
        return function(value)
    except (TypeError, ValueError):
        return None


@pytest.fixture(scope="module")
def read(spark):
    rows = [(p,) for p in PAYLOADS + REJECTED]
    q = Field("q")
    df = with_fields(spark.createDataFrame(rows, "m string").withColumn("value", F.col("m").cast("binary")), "value", ["q"], ["q"])
    out = df.select(
        "m", "_object", q.truthy().alias("truthy"), q.as_long().alias("long"), q.as_double().alias("double"),
        q.as_text().alias("text"), q.absent.alias("absent"), q.null.alias("null"),
        q.text_or("D").alias("or_default"), q.text_or("D", literal_null=True).alias("or_none"),
    )
    return {r["m"]: r for r in out.collect()}


@pytest.mark.parametrize("payload", PAYLOADS)
def test_like_python(read, payload):
    row, data = read[payload], json.loads(payload)
    value = data.get("q")
    assert row["_object"]
    assert row["truthy"] == bool(value)
    assert row["long"] == tried(int, value)
    double = tried(float, value)
    assert row["double"] == double or (row["double"] != row["double"] and double != double)
    assert row["absent"] == ("q" not in data)
    assert row["null"] == ("q" in data and value is None)
    assert row["or_none"] == (str(data.get("q", "D")) if value != 1000.0 else row["text"]) or value == 0.0
    if value is not None and not isinstance(value, float):
        assert row["text"] == str(value)
    if value is None:
        assert row["or_default"] == "D"


@pytest.mark.parametrize("payload", REJECTED)
def test_not_an_object(read, payload):
    assert not read[payload]["_object"]
    assert not read[payload]["truthy"]


def test_invalid_bytes_reject_one_message(spark):
    df = spark.createDataFrame([(bytearray(b'{"store_id":"\xff\xfe"'),), (bytearray(b"\xff"),)], "value binary")
    assert {r["outcome"]: r["messages"] for r in V.outcome_counts(V.tag_inventory(df)).collect()} == {"MALFORMED": 2}


def messages(spark, *documents):
    rows = [(bytearray(json.dumps(d).encode() if not isinstance(d, str) else d.encode()),) for d in documents]
    return spark.createDataFrame(rows, "value binary")


ORDER = {
    "order_id": "o1", "store_id": "s", "product_id": "p", "quantity": 2, "price": 1.5, "event_time": "2026-01-01T00:00:00Z",
}


def test_defaults_and_none(spark):
    df = messages(spark, ORDER, {**ORDER, "customer_id": None, "status": None})
    plain = V.valid(V.tag_orders(df)).select("customer_id", "status").collect()
    assert [tuple(r) for r in plain] == [("ANONYMOUS", "COMPLETED")] * 2
    compat = V.valid(V.tag_orders(df, compat=True)).select("customer_id", "status").collect()
    assert sorted(tuple(r) for r in compat) == [("ANONYMOUS", "COMPLETED"), ("None", "None")]


def test_zero_stock(spark):
    df = messages(spark, {"store_id": "s", "product_id": "p", "quantity_on_hand": 0, "event_time": "t"})
    assert V.valid(V.tag_inventory(df)).count() == 0
    kept = V.valid(V.tag_inventory(df, keep_zero=True)).collect()
    assert kept[0]["quantity_on_hand"] == 0 and kept[0]["last_restocked"] == "t" and kept[0]["supplier_id"] == "UNKNOWN"


def test_valid_plus_rejected_is_input(spark):
    df = messages(spark, ORDER, "bad", {**ORDER, "quantity": "x"}, {**ORDER, "price": 0}, {**ORDER, "order_id": ""}, "[]")
    tagged = V.tag_orders(df)
    assert V.valid(tagged).count() == 1
    reasons = sorted(r["reason"] for r in V.rejected(tagged).collect())
    assert reasons == ["MALFORMED", "MALFORMED", "MISSING_REQUIRED", "MISSING_REQUIRED", "UNUSABLE_VALUE"]


def test_telemetry_rules(spark):
    good = {"device_id": 7, "temperature": "21.5", "humidity": 40, "status": "OK"}
    df = messages(
        spark, good, {**good, "status": "ERROR"}, {**good, "status": None}, {**good, "temperature": None},
        {**good, "device_id": 0}, {**good, "humidity": "wet"},
    )
    rows = V.valid(V.tag_telemetry(df, compat=True)).collect()
    assert [tuple(r) for r in rows] == [("7", 21.5, 40.0, "OK", "None")]
    assert V.rejected(V.tag_telemetry(df)).count() == 5


@pytest.mark.parametrize(
    ("change", "codes"),
    [
        ({}, []),
        ({"quantity": 0}, ["quantity:minimum"]),
        ({"quantity": 2.0}, []),
        ({"quantity": 2.5}, ["quantity:type"]),
        ({"quantity": "2"}, ["quantity:type"]),
        ({"price": 0.001}, ["price:minimum"]),
        ({"status": "LOST"}, ["status:enum"]),
        ({"status": None}, ["status:type", "status:enum"]),
        ({"event_time": "2026-01-01"}, ["event_time:format"]),
        ({"event_time": "2026-13-01T00:00:00Z"}, ["event_time:format"]),
        ({"order_id": 5}, ["order_id:type"]),
    ],
)
def test_contract(spark, change, codes):
    df = K.with_violations(messages(spark, {**ORDER, **change}), C.ORDER_CONTRACT)
    assert df.first()["violations"] == codes


def test_contract_required_and_shape(spark):
    found = [r["violations"] for r in K.with_violations(messages(spark, {}, "x"), C.CUSTOMER_CONTRACT).collect()]
    assert ["document:type"] in found
    assert ["customer_id:required", "email:required", "loyalty_tier:required", "event_time:required"] in found


def test_parsing_is_not_repeated_by_a_filter(spark):
    plan = V.valid(V.tag_orders(messages(spark, ORDER)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_only_asked_values_of_fields_are_made(spark):
    tagged = V.tag_orders(messages(spark, ORDER))
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "_long_quantity" in plan and "_double_price" in plan
    assert "_long_price" not in plan and "_double_quantity" not in plan and plan.count("initcap") == 6
