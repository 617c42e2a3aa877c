"""Streaming queries: the test events arrive as messages in two deliveries.

Each delivery is one run of the stream, restarted from its checkpoint.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.operators import parsing, rollups
from shoplake.operators.validation import invalid, valid
from shoplake.plans import medallion
from shoplake.registry.base import DAILY_SQL, query, sql_time
from shoplake.registry.batch import FLAGGED_SQL
from shoplake.registry.serving import (
    BUCKET_COLUMNS, BUCKET_SQL, DASHBOARD_SQL, DASHBOARD_SUMS, KPI_SQL, KPI_SUMS,
    PERFORMANCE_COLUMNS, PERFORMANCE_SQL, SESSION_COLUMNS, SESSION_SQL,
)
from shoplake.sinks.messages import dead_letters
from shoplake.sources.adapter import click_events
from shoplake.sources.kafka import file_stream
from shoplake.sources.messages import change_messages, event_messages
from shoplake.sources.tables import scan
from shoplake.streaming import ingest, replay, routing, views
from shoplake.streaming.dedup import deduplicated
from shoplake.streaming.jobs import start_batches, start_parquet
from shoplake.workspace import new_folder

DELIVERIES = 2
# Messages pack so well that a file of them is one row group, which only one task can read.
MESSAGES_PER_FILE = 50_000
INGESTED = "2024-02-01 00:00:00"


def deliveries(messages: DataFrame, count: int = DELIVERIES, again: bool = False) -> list[DataFrame]:
    """The messages in consecutive time ranges.

    With ``again`` every message comes twice, and a delivery repeats the one
    before it, as an at-least-once producer may do.
    """
    at = F.unix_micros("timestamp")
    first, last = messages.agg(F.min(at), F.max(at)).first()
    number = F.coalesce(F.floor((at - F.lit(first)) * count / F.lit(last - first + 1)), F.lit(0))
    parts = [messages.where(number == n) for n in range(count)]
    if not again:
        return parts
    doubled = [part.unionByName(part.withColumn("offset", -F.col("offset") - 1)) for part in parts]
    return [
        part if n == 0 else part.unionByName(doubled[n - 1]) for n, part in enumerate(doubled)
    ]


def run(spark: SparkSession, parts: list[DataFrame], start: Callable) -> None:
    """Delivers the parts one by one; ``start(stream, checkpoint)`` handles each to the end."""
    inbox, checkpoint = new_folder(spark, "inbox"), new_folder(spark, "checkpoint")
    for part in parts:
        part.write.mode("append").option("maxRecordsPerFile", MESSAGES_PER_FILE).parquet(inbox)
        start(file_stream(spark, inbox), checkpoint).awaitTermination()


def state_partitions(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


# --- raw zone --------------------------------------------------------------

def _raw(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "raw")
    parts = deliveries(change_messages(click_events(spark, folder)))
    run(spark, parts, lambda stream, checkpoint: ingest.raw_ingest(stream, path, checkpoint, INGESTED))
    return path


@query("raw_ingest", f"""
SELECT event_id AS "offset", 'ecommerce_change_events' AS topic, {sql_time('event_time')} AS kafka_timestamp,
  '2024-02-01' AS ingestion_date, event_type, product_id, user_id, 'c' AS operation,
  epoch_us(event_time) AS event_micros FROM click""")
def raw_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, _raw(spark, folder)).select(
        "offset", "topic", "kafka_timestamp", "ingestion_date", "data.payload.event_type",
        "data.payload.product_id", "data.payload.user_id",
        F.col("data.payload.__op").alias("operation"),
        F.col("data.payload.event_time").alias("event_micros"),
    )


@query("medallion_daily", f"SELECT {DAILY_SQL} FROM days")
def medallion_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Raw ingest, working upsert and gold refresh in sequence."""
    base = new_folder(spark, "medallion")
    dates = medallion.working_upsert(spark, _raw(spark, folder), f"{base}/working", INGESTED[:10])
    medallion.gold_refresh(spark, f"{base}/working", f"{base}/gold", dates)
    return scan(spark, f"{base}/gold/agg_daily_events")


# --- event stream ----------------------------------------------------------

@query("stream_ingest", f"""
SELECT event_id AS "offset", {sql_time('event_time')} AS event_time, event_type, product_id, category_id,
  category_code, brand, CAST(price AS DOUBLE) AS price, user_id, user_session FROM click""")
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "stream_ingest")

    def start(stream: DataFrame, checkpoint: str):
        return start_parquet(parsing.parse_events(stream, keep=("offset",)), checkpoint, path)

    run(spark, deliveries(event_messages(click_events(spark, folder))), start)
    return scan(spark, path)


@query("stream_dedup", f"""
SELECT DISTINCT {sql_time('event_time')} AS event_time, user_id, product_id, event_type FROM click""")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "stream_dedup")

    def start(stream: DataFrame, checkpoint: str):
        events = deduplicated(parsing.parse_events(stream, keep=routing.POSITION))
        return start_parquet(events, checkpoint, path, state_partitions=state_partitions(spark))

    run(spark, deliveries(event_messages(click_events(spark, folder)), again=True), start)
    return scan(spark, path).select("event_time", "user_id", "product_id", "event_type")


def _routed(spark: SparkSession, folder: str, fail: bool = False) -> tuple[str, str]:
    served, dead = new_folder(spark, "serving"), new_folder(spark, "dead_letters")

    def unavailable(rows: DataFrame, batch_id: int) -> None:
        raise ConnectionError("serving table unavailable")

    serve = unavailable if fail else routing.serve_files(served)

    def start(stream: DataFrame, checkpoint: str):
        return routing.route(
            stream, checkpoint, serve, routing.dead_letter_files(dead),
            state_partitions=state_partitions(spark),
        )

    run(spark, deliveries(event_messages(click_events(spark, folder)), again=True), start)
    return served, dead


VALID_STREAM_SQL = f"""
SELECT DISTINCT {sql_time('event_time')} AS event_time, user_id, product_id, event_type, category_code, brand FROM good"""


def _valid_columns(rows: DataFrame) -> DataFrame:
    return rows.select("event_time", "user_id", "product_id", "event_type", "category_code", "brand")


@query("stream_route_valid", VALID_STREAM_SQL)
def stream_route_valid(spark: SparkSession, folder: str) -> DataFrame:
    return _valid_columns(scan(spark, _routed(spark, folder)[0]))


@query("stream_serving_sink", VALID_STREAM_SQL)
def stream_serving_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Appending to the serving table, with files in place of a database."""
    path = new_folder(spark, "stream_serving_sink")
    serve = routing.serve_files(path)

    def start(stream: DataFrame, checkpoint: str):
        events = deduplicated(parsing.parse_events(stream, keep=routing.POSITION))
        return start_batches(
            valid(events).drop(*routing.POSITION), checkpoint, serve,
            state_partitions=state_partitions(spark),
        )

    run(spark, deliveries(event_messages(click_events(spark, folder)), again=True), start)
    return _valid_columns(scan(spark, path))


def _letters(spark: SparkSession, path: str, kind: str) -> DataFrame:
    text = F.col("value")

    def field(name: str):
        return F.get_json_object(text, f"$.{name}")

    return scan(spark, path).where(F.col("kind") == kind).select(
        field("event_type").alias("event_type"),
        field("user_id").cast("bigint").alias("user_id"),
        field("product_id").cast("bigint").alias("product_id"),
        field("invalid_reasons").alias("invalid_reasons"),
        field("dlq_reason").alias("dlq_reason"),
        (field("dlq_batch_id").cast("bigint") == F.col("batch_id")).alias("same_batch"),
        field("dlq_timestamp").isNotNull().alias("stamped"),
    )


INVALID_STREAM_SQL = f"""
SELECT event_type, user_id, product_id, invalid_reasons, 'validation_failed' AS dlq_reason,
  true AS same_batch, true AS stamped FROM (
  SELECT DISTINCT {sql_time('event_time')} AS event_time, event_type, user_id, product_id, invalid_reasons
  FROM ({FLAGGED_SQL}) WHERE NOT is_valid_record)"""


@query("stream_route_invalid", INVALID_STREAM_SQL)
def stream_route_invalid(spark: SparkSession, folder: str) -> DataFrame:
    return _letters(spark, _routed(spark, folder)[1], routing.VALIDATION_FAILED)


@query("dlq_invalid", f"""
SELECT event_type, user_id, product_id, invalid_reasons, 'validation_failed' AS dlq_reason, CAST(7 AS BIGINT) AS dlq_batch_id,
  '2024-02-01T00:00:00.000Z' AS dlq_timestamp FROM ({FLAGGED_SQL}) WHERE NOT is_valid_record""")
def dlq_invalid(spark: SparkSession, folder: str) -> DataFrame:
    letters = dead_letters(
        invalid(click_events(spark, folder)), 7, routing.VALIDATION_FAILED, INGESTED
    )
    names = ("event_type", "user_id", "product_id", "invalid_reasons", "dlq_reason", "dlq_batch_id", "dlq_timestamp")
    numbers = {"user_id", "product_id", "dlq_batch_id"}
    fields = [F.get_json_object("value", f"$.{c}").alias(c) for c in names]
    return letters.select(*fields).withColumns({c: F.col(c).cast("bigint") for c in numbers})


@query("dlq_write_failure", f"""
SELECT event_type, user_id, product_id, CAST(NULL AS VARCHAR) AS invalid_reasons,
  'serving_write_failed: serving table unavailable' AS dlq_reason, true AS same_batch, true AS stamped FROM (
  SELECT DISTINCT {sql_time('event_time')} AS event_time, event_type, user_id, product_id FROM good)""")
def dlq_write_failure(spark: SparkSession, folder: str) -> DataFrame:
    return _letters(spark, _routed(spark, folder, fail=True)[1], routing.SERVING_FAILED)


@query("dlq_replay", f"""
SELECT -event_id - 1 AS "offset", md5('{{"event_id": ' || event_id) AS broken_value, {sql_time('event_time')} AS sent FROM click
UNION ALL SELECT event_id, NULL, {sql_time('event_time')} FROM ({FLAGGED_SQL}) WHERE NOT is_valid_record""")
def dlq_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Every event also comes as an unreadable message; the messages of all dead letters, sent again in two runs."""
    dead, sent, checkpoint = (new_folder(spark, name) for name in ("dead_letters", "replayed", "replay_checkpoint"))
    whole = event_messages(click_events(spark, folder))
    text = F.concat(F.lit('{"event_id": '), F.col("offset").cast("string"))
    broken = whole.withColumns({"value": text.cast("binary"), "offset": -F.col("offset") - 1})

    def start(stream: DataFrame, stream_checkpoint: str):
        routing.route(
            stream, stream_checkpoint, routing.serve_files(new_folder(spark, "serving")), routing.dead_letter_files(dead),
            state_partitions=state_partitions(spark),
        ).awaitTermination()
        return replay.replay(spark, dead, checkpoint, replay.send_files(sent))

    run(spark, deliveries(whole.unionByName(broken)), start)
    return scan(spark, sent).select(
        "offset", F.when(F.col("offset") < 0, F.md5("value")).alias("broken_value"), F.col("timestamp").alias("sent"))


# --- rollups kept by the stream --------------------------------------------

def _maintained(spark: SparkSession, folder: str, rollup: str) -> DataFrame:
    path = new_folder(spark, "views")

    def start(stream: DataFrame, checkpoint: str):
        return views.maintain(
            stream, checkpoint, path, (rollup,), state_partitions=state_partitions(spark)
        )

    run(spark, deliveries(event_messages(click_events(spark, folder)), again=True), start)
    return views.current(spark, path, rollup)


@query("stream_mv_daily", f"SELECT {KPI_SUMS} FROM ({KPI_SQL})")
def stream_mv_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _maintained(spark, folder, "daily").drop("daily_unique_users", "unique_users_buy")


@query("stream_mv_daily_hll")
def stream_mv_daily_hll(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.estimate_sketches(_maintained(spark, folder, "daily"))


@query("stream_mv_product", f"SELECT {PERFORMANCE_COLUMNS} FROM ({PERFORMANCE_SQL})")
def stream_mv_product(spark: SparkSession, folder: str) -> DataFrame:
    return _maintained(spark, folder, "product")


@query("stream_mv_15min", f"SELECT {DASHBOARD_SUMS} FROM ({DASHBOARD_SQL})")
def stream_mv_15min(spark: SparkSession, folder: str) -> DataFrame:
    return _maintained(spark, folder, "dashboard").drop("active_users", "active_sessions")


@query("stream_mv_bucket", f"SELECT {BUCKET_COLUMNS} FROM ({BUCKET_SQL})")
def stream_mv_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return _maintained(spark, folder, "bucket")


@query("stream_mv_session", f"SELECT {SESSION_COLUMNS} FROM ({SESSION_SQL})")
def stream_mv_session(spark: SparkSession, folder: str) -> DataFrame:
    return _maintained(spark, folder, "session")


@query("stream_window_15min", f"""
SELECT {DASHBOARD_SUMS} FROM ({DASHBOARD_SQL}) WHERE metric_time + INTERVAL 15 MINUTE <=
  (SELECT max(event_time) FROM good) - INTERVAL 5 MINUTE""")
def stream_window_15min(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "stream_window_15min")

    def start(stream: DataFrame, checkpoint: str):
        return views.closed_windows(
            stream, checkpoint, path, state_partitions=state_partitions(spark)
        )

    run(spark, deliveries(event_messages(click_events(spark, folder)), again=True), start)
    return scan(spark, path).drop("active_users", "active_sessions")
