import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shoplake.operators import rollups
from shoplake.operators.parsing import parse_events
from shoplake.operators.validation import valid
from shoplake.registry import streams
from shoplake.sources.kafka import file_stream
from shoplake.sources.messages import event_messages
from shoplake.streaming import ingest, replay, routing, views
from shoplake.streaming.dedup import deduplicated
from shoplake.streaming.jobs import start_batches, start_parquet

START = datetime(2024, 1, 1)


def event(minute, **change):
    at = None if minute is None else f"{START + timedelta(minutes=minute):%Y-%m-%d %H:%M:%S} UTC"
    fields = {
        "event_time": at, "event_type": "view", "product_id": "1", "category_id": "2", "category_code": "toys",
        "brand": "", "price": "5.00", "user_id": "3", "user_session": "s", **change,
    }
    return json.dumps({k: v for k, v in fields.items() if v is not None})


class Topic:
    """A folder of message files, one delivery at a time."""

    def __init__(self, spark, messages, folder):
        self.spark, self.messages, self.folder, self.sent = spark, messages, str(folder), 0

    def send(self, *values):
        self.messages(*values, start=self.sent).coalesce(1).write.mode("append").parquet(self.folder)
        self.sent += len(values)

    def stream(self):
        return file_stream(self.spark, self.folder)


def run(query):
    query.awaitTermination()
    return query


def dropped_late(query):
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def test_late_rows_and_copies_across_batches(spark, messages, tmp_path):
    for salt in (0, 4):
        base = tmp_path / f"salt{salt}"
        topic, out = Topic(spark, messages, base / "in"), str(base / "out")

        def go():
            events = deduplicated(parse_events(topic.stream(), keep=routing.POSITION), salt_buckets=salt)
            return run(start_parquet(events, str(base / "checkpoint"), out, state_partitions=2))

        topic.send(event(0), event(0), event(0, user_id="4"), event(None), event(None))
        go()
        topic.send(event(60), event(0))
        go()
        topic.send(event(58, user_id="9"))
        topic.send(event(120), event(60))
        go()
        topic.send(event(1, user_id="8"), event(118, user_id="7"), event(120))
        last = go()
        users = sorted((r.event_time.hour * 60 + r.event_time.minute, r.user_id) for r in spark.read.parquet(out).collect())
        assert users == [(0, 3), (0, 4), (58, 9), (60, 3), (118, 7), (120, 3)]
        assert dropped_late(last) >= 1


def test_hot_copies_collapse(spark, messages, tmp_path):
    topic, out = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "out")
    topic.send(*[event(0)] * 300, *[event(n) for n in range(1, 31)])
    events = deduplicated(parse_events(topic.stream(), keep=routing.POSITION))
    run(start_parquet(events, str(tmp_path / "checkpoint"), out, state_partitions=2))
    assert spark.read.parquet(out).count() == 31


def test_routing_restarts_and_keeps_every_bad_row(spark, messages, tmp_path):
    topic, good, bad = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "good"), str(tmp_path / "bad")

    def go():
        return run(routing.route(
            topic.stream(), str(tmp_path / "checkpoint"), routing.serve_files(good),
            routing.dead_letter_files(bad), state_partitions=2))

    topic.send(event(0), event(0), event(None), event(None), event(1, price="0"), "junk")
    go()
    go()
    topic.send(event(0), event(2))
    go()
    served = spark.read.parquet(good)
    assert served.count() == 2
    assert {r.brand for r in served.collect()} == {"unknown"}
    letters = [json.loads(r.value) for r in spark.read.parquet(bad).collect()]
    assert len(letters) == 4
    assert {letter["dlq_reason"] for letter in letters} == {"validation_failed"}
    assert sum("invalid_event_time" in letter["invalid_reasons"] for letter in letters) == 3
    assert all("dlq_timestamp" in letter and "dlq_batch_id" in letter for letter in letters)


def test_failed_serving_write_goes_to_dead_letters(spark, messages, tmp_path):
    topic, bad = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "bad")

    def broken(rows, batch_id):
        raise OSError("disk full")

    topic.send(event(0), event(1, price="0"))
    run(routing.route(topic.stream(), str(tmp_path / "checkpoint"), broken,
                      routing.dead_letter_files(bad), state_partitions=2))
    reasons = {r.kind: json.loads(r.value)["dlq_reason"] for r in spark.read.parquet(bad).collect()}
    assert reasons == {"validation_failed": "validation_failed", "serving_write_failed": "serving_write_failed: disk full"}


def test_unreadable_messages_come_back_byte_for_byte(spark, messages, tmp_path):
    topic, good, bad = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "good"), str(tmp_path / "bad")
    again, mended = str(tmp_path / "again"), str(tmp_path / "mended")

    def go():
        run(routing.route(topic.stream(), str(tmp_path / "checkpoint"), routing.serve_files(good),
                          routing.dead_letter_files(bad), state_partitions=2))

    def resend(path, **options):
        return run(replay.replay(spark, bad, f"{path}-checkpoint", replay.send_files(path), **options))

    cut = event(3, brand="é☃")[:-1]
    topic.send(cut, "junk\x00", "", None, event(1))
    go()
    resend(again)
    resend(again)
    rows = sorted(spark.read.parquet(again).collect(), key=lambda r: r.offset)
    assert [(r.offset, None if r.value is None else bytes(r.value).decode()) for r in rows] == [(0, cut), (1, "junk\x00"), (2, ""), (3, None)]
    assert {(r.key, r.topic, r.partition, r.timestamp) for r in rows} == {(None, "t", 0, START)}
    topic.send(event(20, price="0"))
    go()
    resend(again)
    assert spark.read.parquet(again).count() == 5

    close = F.concat(F.col("value").cast("string"), F.lit("}")).cast("binary")
    resend(mended, mend=lambda rows: rows.withColumn("value", close))
    run(routing.route(file_stream(spark, mended), str(tmp_path / "second"), routing.serve_files(f"{good}2"),
                      routing.dead_letter_files(f"{bad}2"), state_partitions=2))
    served = spark.read.parquet(f"{good}2").collect()
    assert [(r.brand, r.event_time.minute) for r in served] == [("é☃", 3)]
    assert not [c for c in spark.read.parquet(good).columns if c.startswith("message_")]


def test_raw_ingest_reads_each_message_once(spark, messages, tmp_path):
    topic, raw = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "raw")
    for batch in (['{"payload": {"id": 1}}', "junk"], ['{"payload": {"id": 2}}'], []):
        if batch:
            topic.send(*batch)
        run(ingest.raw_ingest(topic.stream(), raw, str(tmp_path / "checkpoint"), "2024-02-01 00:00:00"))
    rows = spark.read.parquet(raw)
    assert sorted(r.raw_payload for r in rows.collect()) == ["junk", '{"payload": {"id": 1}}', '{"payload": {"id": 2}}']
    assert {str(r.ingestion_date) for r in rows.collect()} == {"2024-02-01"}


def test_new_checkpoint_does_not_replace_old_batches(spark, messages, tmp_path):
    topic, raw = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "raw")
    topic.send("first")
    for name in ("a", "a", "b"):
        run(ingest.raw_ingest(topic.stream(), raw, str(tmp_path / name)))
    assert spark.read.parquet(raw).count() == 2


def test_maintained_rollups_equal_batch_rollups(spark, messages, tmp_path):
    topic, path = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "views")
    sent = []
    for first in (0, 50, 100):
        part = [event(n, user_id=str(n % 5 + 1), event_type=("view", "cart", "purchase")[n % 3], user_session=str(n % 7))
                for n in range(first, first + 50)]
        sent += part
        topic.send(*part)
        run(views.maintain(topic.stream(), str(tmp_path / "checkpoint"), path))
    events = valid(parse_events(messages(*sent)))
    for name, rollup in rollups.ROLLUPS.items():
        expected = rollups.estimate_sketches(rollups.merge_states(rollup(events), name))
        found = rollups.estimate_sketches(views.current(spark, path, name)).select(*expected.columns)
        assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0, name


def test_windows_are_written_once_closed(spark, messages, tmp_path):
    topic, path = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "windows")
    for minutes in ((0, 1, 16), (20, 35), (300,)):
        topic.send(*[event(m, user_id=str(m + 1)) for m in minutes])
        run(views.closed_windows(topic.stream(), str(tmp_path / "checkpoint"), path, state_partitions=2))
    rows = rollups.estimate_sketches(spark.read.parquet(path)).orderBy("metric_time").collect()
    assert [(r.metric_time.minute, r.total_events, r.active_users) for r in rows] == [(0, 2, 2), (15, 2, 2), (30, 1, 1)]


def test_salted_and_plain_dedup_agree(spark, messages, tmp_path):
    rows = parse_events(messages(*[event(n % 20, user_id=str(n % 3 + 1)) for n in range(200)]), keep=routing.POSITION)
    expected = rows.select("event_time", "user_id").distinct().count()
    assert deduplicated(rows).count() == deduplicated(rows, salt_buckets=8).count() == expected
    assert rows.select(F.col("offset")).count() == 200


def test_delivered_messages_lie_in_files_that_many_tasks_can_read(spark, events, monkeypatch):
    monkeypatch.setattr(streams, "MESSAGES_PER_FILE", 2)
    messages = event_messages(events(*[{"user_id": n} for n in range(1, 8)]).coalesce(1), offset="user_id")
    sizes = []

    def start(stream, checkpoint):
        def count(batch, batch_id):
            files = batch.groupBy(F.input_file_name()).count().collect()
            sizes.extend(row["count"] for row in files)

        return start_batches(stream, checkpoint, count)

    streams.run(spark, [messages], start)
    assert sum(sizes) == 7 and max(sizes) <= 2
