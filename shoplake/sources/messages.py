"""Event rows as Kafka-shaped messages: plain JSON events and change envelopes."""

from pyspark.sql import Column, DataFrame, functions as F

from shoplake import params, schemas
from shoplake.functions.binary import encode_decimal

EVENT_TOPIC = "ecommerce_streaming_events"
CHANGE_TOPIC = "ecommerce_change_events"
PARTITIONS = 8


def text_fields(timezone: str = params.TIMEZONE) -> list[Column]:
    """The nine event columns as the text the CSV and JSON feeds carry."""
    clock = F.concat(F.date_format("event_time", params.TIMESTAMP_PATTERN), F.lit(f" {timezone}"))
    return [
        (clock if c == "event_time" else F.col(c).cast("string")).alias(c)
        for c in schemas.EVENT_COLUMNS
    ]


def _kafka_row(value: Column, key: Column, offset: Column, topic: str, at: Column) -> list[Column]:
    return [
        key.cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(PARTITIONS)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        at.alias("timestamp"),
    ]


def event_messages(
    events: DataFrame, offset: str = "event_id", topic: str = EVENT_TOPIC
) -> DataFrame:
    """One JSON text message per event, keyed by user."""
    value = F.to_json(F.struct(*text_fields()))
    return events.select(
        *_kafka_row(value, F.col("user_id"), F.col(offset), topic, F.col("event_time"))
    )


def row_messages(rows: DataFrame, topic: str = EVENT_TOPIC) -> DataFrame:
    """Text rows (a CSV feed) as JSON messages to send; missing fields are empty text."""
    fields = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in rows.columns]
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def change_messages(
    events: DataFrame,
    operation: str = "c",
    offset: str = "event_id",
    topic: str = CHANGE_TOPIC,
) -> DataFrame:
    """One change envelope per event; a delete keeps the row image and sets ``__deleted``."""
    deleted = operation == "d"
    types = {"event_time": "int64", "price": "bytes"}
    described = F.array(*[
        F.struct(
            F.lit(types.get(c, "string")).alias("type"),
            F.lit("true").alias("optional"),
            F.lit(c).alias("field"),
        )
        for c in schemas.EVENT_COLUMNS
    ])
    header = F.struct(
        F.lit("struct").alias("type"),
        described.alias("fields"),
        F.lit("false").alias("optional"),
        F.lit(f"{topic}.Value").alias("name"),
    )
    encoded = {"event_time": F.unix_micros("event_time"), "price": encode_decimal(F.col("price"))}
    row = F.struct(
        F.col(offset).try_cast("int").alias("id"),
        *[encoded.get(c, F.col(c)).alias(c) for c in schemas.EVENT_COLUMNS],
        F.lit(str(deleted).lower()).alias("__deleted"),
        F.lit(operation).alias("__op"),
        F.unix_millis("event_time").alias("__source_ts_ms"),
    )
    value = F.to_json(F.struct(header.alias("schema"), row.alias("payload")))
    return events.select(
        *_kafka_row(value, F.col(offset), F.col(offset), topic, F.col("event_time"))
    )
