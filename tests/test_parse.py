import pytest
from pyspark.sql import functions as F

from ordermetrics.functions import event_time
from ordermetrics.operators import dead_letter_reasons, dead_letters, parse_orders, valid_orders

GOOD = '{"order_id":"a","customer_id":"CUST-7","sku":"s","quantity":2,"price":19.99,"timestamp":1700000040000}'

# payload, order_id, quantity, price, timestamp
CASES = {
    "good": (GOOD, "a", 2, 19.99, 1700000040000),
    "truncated": ('{"order_id":"a","customer_id":"CUST-7","sku":"s",BROKEN_JSON', None, None, None, None),
    "no id": ('{"sku":"s","quantity":1,"price":2.0,"timestamp":5}', None, 1, 2.0, 5),
    "bad quantity": ('{"order_id":"a","sku":"s","quantity":"x","price":1.5,"timestamp":5}', "a", None, 1.5, 5),
    "fractional quantity": ('{"order_id":"a","quantity":2.5,"price":1.5,"timestamp":5}', "a", None, 1.5, 5),
    "price as text": ('{"order_id":"a","quantity":2,"price":"12.5","timestamp":5}', "a", 2, None, 5),
    "numeric id": ('{"order_id":7}', "7", None, None, None),
    "iso time": ('{"order_id":"a","sku":"s","quantity":1,"price":1.0,"timestamp":"2026-08-15T10:15:30Z"}', "a", 1, 1.0, None),
    "int overflow": ('{"order_id":"a","quantity":99999999999,"price":1.0,"timestamp":5}', "a", None, 1.0, 5),
    "trailing junk": ('{"order_id":"a"} junk', "a", None, None, None),
    "duplicate key": ('{"order_id":"a","order_id":"b"}', "b", None, None, None),
    "key case": ('{"ORDER_ID":"a"}', None, None, None, None),
    "far future": ('{"order_id":"a","sku":"s","quantity":1,"price":1.0,"timestamp":9223372036854775807}', "a", 1, 1.0, 9223372036854775807),
    "array": ('[{"order_id":"a"}]', None, None, None, None),
    "null": (None, None, None, None, None),
    "empty": ("", None, None, None, None),
}


@pytest.fixture
def raw(spark):
    rows = [(name, case[0]) for name, case in CASES.items()]
    return spark.createDataFrame(rows, "name string, json_str string")


def test_each_payload(raw):
    got = {
        r.name: (r.order_id, r.quantity, r.price, r.timestamp)
        for r in parse_orders(raw).collect()
    }
    assert got == {name: case[1:] for name, case in CASES.items()}


def test_split_is_complete(raw):
    parsed = parse_orders(raw)
    for strict in (False, True):
        good = {r.name for r in valid_orders(parsed, strict).collect()}
        dead = {r.name for r in dead_letters(parsed, strict).collect()}
        assert good | dead == set(CASES)
        assert not good & dead
        if strict:
            assert good == {"good"}
        else:
            assert good == {name for name, case in CASES.items() if case[1] is not None}


def test_reasons(raw):
    got = {r.name: r.reason for r in dead_letter_reasons(parse_orders(raw)).collect()}
    assert got == {
        "truncated": "malformed_json", "no id": "missing_order_id", "key case": "missing_order_id",
        "array": "not_an_object", "null": "null_payload", "empty": "empty_payload",
    }
    strict = {r.name: r.reason for r in dead_letter_reasons(parse_orders(raw), strict=True).collect()}
    assert strict["bad quantity"] == "missing_quantity"
    assert strict["iso time"] == "missing_timestamp"
    assert strict["far future"] == "time_out_of_range"


def test_text_is_parsed_once(raw):
    plan = valid_orders(parse_orders(raw)).groupBy(F.window("event_time", "1 minute")).agg(F.sum("revenue"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_event_time_is_exact_and_never_overflows(spark):
    rows = [(1700000040123,), (-1,), (0,), (9223372036854775807,), (-9223372036854775808,), (None,)]
    df = spark.createDataFrame(rows, "ms bigint").select(event_time(F.col("ms")).alias("t"))
    got = [r.t and str(r.t) for r in df.collect()]
    assert got == ["2023-11-14 22:14:00.123000", "1969-12-31 23:59:59.999000",
                   "1970-01-01 00:00:00", None, None, None]


def test_revenue_of_missing_factor_is_null(raw):
    got = {r.name: r.revenue for r in valid_orders(parse_orders(raw)).collect()}
    assert got["good"] == pytest.approx(39.98)
    assert got["bad quantity"] is None


@pytest.mark.parametrize("text", ["7", '"abc"', "true", "null", "[1]"])
def test_values_that_are_no_objects(spark, text):
    parsed = parse_orders(spark.createDataFrame([(text,)], "json_str string"))
    assert [r.reason for r in dead_letter_reasons(parsed).collect()] == ["not_an_object"]
