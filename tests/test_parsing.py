import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from shoplake.functions.binary import decode_decimal, encode_decimal
from shoplake.operators import parsing, validation, working
from shoplake.sources.messages import change_messages


def one(rows):
    return rows.collect()[0]


def test_json_event_is_typed(messages):
    text = json.dumps({
        "event_time": "2019-11-01 00:00:05 UTC", "event_type": "cart", "product_id": "12",
        "category_id": "3", "price": "10.5", "user_id": "8", "user_session": "x",
    })
    row = one(parsing.parse_events(messages(text)))
    assert row.event_time == datetime(2019, 11, 1, 0, 0, 5)
    assert (row.product_id, row.category_id, row.price, row.user_id) == (12, 3, 10.5, 8)
    assert row.brand is None


def test_time_without_zone_suffix_and_other_zone(messages):
    text = json.dumps({"event_time": "2019-11-01 09:00:00"})
    assert one(parsing.parse_events(messages(text))).event_time == datetime(2019, 11, 1, 9)
    tokyo = one(parsing.parse_events(messages(text), timezone="Asia/Tokyo"))
    assert tokyo.event_time == datetime(2019, 11, 1, 0)


def test_unreadable_fields_become_null(messages):
    bad = [
        None, "not json", "{}",
        json.dumps({"event_time": "soon", "product_id": "abc", "price": "cheap", "user_id": "1e99x"}),
    ]
    parsed = parsing.parse_events(messages(*bad))
    assert all(all(v is None for v in row) for row in parsed.collect())
    assert validation.valid(parsed).count() == 0


def test_cdc_round_trip(events):
    rows = events({"price": "0.01"}, {"price": "1234.56"}, {"price": "-2.00"}, {"price": None},
                  {"price": "99999999.99"}, {"price": "1.28"}, {"price": "327.68"})
    numbered = rows.withColumn("n", F.monotonically_increasing_id())
    parsed = parsing.parse_cdc(change_messages(numbered, offset="n"))
    assert sorted(map(str, parsed.collect())) == sorted(map(str, rows.collect()))


def test_cdc_edge_messages(messages):
    texts = ['{"payload": null}', '{"id": 1, "event_type": "view"}', None]
    parsed = parsing.parse_cdc(messages(*texts))
    assert all(all(v is None for v in row) for row in parsed.collect())


def test_decimal_bytes_are_signed(spark):
    hexes = {"FF": "-0.01", "00FF": "2.55", "3039": "123.45", "8000": "-327.68",
             "00FFFFFFFF": "42949672.95", "": None, "7FFFFFFFFFFFFFFF": None, "00" * 9: None}
    rows = spark.createDataFrame([(h,) for h in hexes], "h string")
    found = rows.select("h", decode_decimal(F.unhex("h")).alias("d")).collect()
    assert {r.h: None if r.d is None else str(r.d) for r in found} == hexes


def test_encoding_inverts_decoding(spark):
    prices = [Decimal(n) / 100 for n in (*range(-300, 301), 2**31, -(2**31), 32768, -32769)]
    rows = spark.createDataFrame([(p,) for p in prices], "p decimal(12,2)")
    wrong = rows.where(decode_decimal(encode_decimal(F.col("p")), 12) != F.col("p"))
    assert wrong.count() == 0


def test_raw_and_working_rows(events):
    rows = events({}, {"event_type": "purchase"}).withColumn("n", F.monotonically_increasing_id())
    raw = parsing.to_raw(change_messages(rows, "d", offset="n"), "2024-03-01 12:00:00")
    assert {str(r.ingestion_date) for r in raw.collect()} == {"2024-03-01"}
    flat = parsing.flatten_raw(raw, apply_deletes=True)
    assert flat.where("is_deleted").count() == 2
    assert "is_deleted" not in parsing.flatten_raw(raw).columns


def test_event_key_format(events):
    key = one(working.prepare(events({}))).event_key
    assert key == "2024-01-01 10:00:00.000000|7|1|view"


def test_event_times_with_and_without_fraction(messages):
    texts = ["2024-01-01 10:00:00 UTC", "2024-01-01 10:00:00.5 UTC", "2024-01-01 10:00:00.123456", "2024-01-01 10:00:00."]
    rows = parsing.parse_events(messages(*[json.dumps({"event_time": t}) for t in texts])).collect()
    assert [r.event_time and r.event_time.microsecond for r in rows] == [0, 500000, 123456, None]
