from datetime import datetime

import pytest

from shoplake.operators import validation


@pytest.mark.parametrize("change, reasons", [
    ({}, ""),
    ({"price": "0.01"}, ""),
    ({"price": "1000000.00"}, ""),
    ({"price": "0.00"}, "invalid_price"),
    ({"price": "1000000.01"}, "invalid_price"),
    ({"price": None}, "invalid_price"),
    ({"event_type": None}, "invalid_event_type"),
    ({"event_type": "error"}, "invalid_event_type"),
    ({"product_id": 0}, "invalid_product_id"),
    ({"user_id": -1}, "invalid_user_id"),
    ({"user_id": None}, "invalid_user_id"),
    ({"event_time": None}, "invalid_event_time"),
    ({"category_id": None}, "invalid_category_id"),
    ({"price": None, "user_id": 0, "event_time": None}, "invalid_price, invalid_user_id, invalid_event_time"),
])
def test_rules(events, change, reasons):
    row = validation.flag(events(change)).collect()[0]
    assert row.invalid_reasons == reasons
    assert row.is_valid_record == (reasons == "")


def test_price_bounds_hold_for_doubles(events):
    rows = events({"price": "0.01"}, {"price": "0.02"})
    doubles = rows.withColumn("price", rows.price.cast("double"))
    assert validation.valid(doubles).count() == 2


def test_split_is_complete(events):
    rows = events({}, {"price": None}, {"event_type": "x", "user_id": None}, {"brand": ""})
    counts = validation.quality_counts(rows).first()
    assert (counts.total_records, counts.valid_records, counts.invalid_records) == (4, 2, 2)
    assert validation.valid(rows).count() + validation.invalid(rows).count() == 4
    histogram = {r.reason: r.record_count for r in validation.failure_histogram(rows).collect()}
    assert histogram == {"invalid_price": 1, "invalid_event_type": 1, "invalid_user_id": 1}


def test_defaults(events):
    rows = validation.valid(events({"brand": "", "category_code": None}, {}))
    assert {(r.brand, r.category_code) for r in rows.collect()} == {("unknown", "unknown"), ("acme", "toys")}


def test_no_rows(events):
    rows = events({}).where("false")
    assert validation.quality_totals(rows).first().total_records == 0
    assert validation.failure_histogram(rows).count() == 0


def test_invalid_keeps_time_of_processing(events):
    row = validation.invalid(events({"price": None}), "2024-05-01 00:00:00").collect()[0]
    assert row.processing_timestamp == datetime(2024, 5, 1)
