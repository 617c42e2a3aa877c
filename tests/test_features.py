from datetime import datetime, timedelta

from pyspark.sql import Window, functions as F

from shoplake.operators import features


def test_previous_time_equals_a_plain_lag(spark):
    rows = spark.range(6000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 40).cast("string"))).alias("user_session"),
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64("id"), F.lit(90000))).alias("event_time"))
    plain = rows.withColumn("expected", F.lag("event_time").over(
        Window.partitionBy("user_session").orderBy("event_time", "id")))
    for seconds in (1, 600, 10**9):
        found = features.with_previous_time(rows, bucket_seconds=seconds, ties=("id",))
        joined = plain.join(found.select("id", "prev_event_time"), "id")
        assert joined.count() == 6000
        assert joined.where(~F.col("expected").eqNullSafe(F.col("prev_event_time"))).count() == 0


def test_session_features(events):
    start = datetime(2024, 1, 7, 23, 59, 50)  # a Sunday
    rows = events({"event_time": start}, {"event_time": start + timedelta(seconds=20, microseconds=5)},
                  {"event_time": start + timedelta(hours=3)}, {"user_session": "other", "event_time": start})
    found = features.session_features(rows).orderBy("user_session", "event_time").collect()
    assert [(r.hour, r.week_day, r.secs_since_last) for r in found] == [
        (23, 1, 0), (23, 1, 0), (0, 2, 20), (2, 2, 10780)]


def test_labels_and_weights(events):
    day = datetime(2024, 1, 1)
    rows = events({"event_time": day}, {"event_type": "purchase", "event_time": day + timedelta(days=400)},
                  {"event_type": "cart", "event_time": day + timedelta(days=400)},
                  {"event_type": "other", "event_time": day + timedelta(days=400)})
    found = {r.event_type: (r.label, round(r.weight, 6)) for r in features.with_label_and_weight(rows).collect()}
    assert found == {"view": (0.0, 0.01), "purchase": (2.0, 15.0), "cart": (1.0, 7.0), "other": (0.0, 0.01)}


def test_top_n_bucketing(events):
    rows = events(*[{"brand": "a"}] * 3, *[{"brand": "b"}] * 2, {"brand": "c"}, {"brand": "d"}, {"brand": None})
    found = features.bucket_top_n(rows, "brand", "bucketed", 3)
    assert sorted(r.bucketed for r in found.collect()) == ["a", "a", "a", "b", "b", "c", "other", "other"]


def test_cardinality_counts_null_as_a_value(events):
    rows = events({"brand": "a"}, {"brand": None}, {"brand": "b"})
    assert features.cardinality(rows).first().asDict() == {"brand_count": 3, "category_count": 1, "max_bins": 13}
