"""Kafka message values to typed event rows."""

from pyspark.sql import DataFrame, functions as F

from shoplake import params, schemas
from shoplake.functions.binary import decode_decimal


def parse_events(
    messages: DataFrame,
    pattern: str = params.TIMESTAMP_PATTERN,
    timezone: str = params.TIMEZONE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """JSON messages to event rows; anything unreadable becomes null, never an error.

    ``keep`` names message columns to carry along. Times are read in
    ``timezone`` whatever the session's zone is; a trailing `` UTC`` is ignored.
    """
    event = F.from_json(F.col("value").cast("string"), schemas.EVENT_TEXT)
    fields = messages.select(*keep, event.alias("event")).select(*keep, "event.*")
    clock = F.concat(
        F.regexp_replace("event_time", " UTC", ""), F.lit(f" {timezone}")
    )
    typed = {
        "event_time": F.try_to_timestamp(clock, F.lit(f"{pattern} VV")),
        "product_id": F.col("product_id").try_cast("bigint"),
        "category_id": F.col("category_id").try_cast("bigint"),
        "price": F.col("price").try_cast("double"),
        "user_id": F.col("user_id").try_cast("bigint"),
    }
    return fields.withColumns(typed)


def parse_envelope(messages: DataFrame) -> DataFrame:
    """Adds the parsed change envelope of each message as ``data``."""
    return messages.withColumn(
        "data", F.from_json(F.col("value").cast("string"), schemas.CDC_ENVELOPE)
    )


def _event_fields(row: str) -> list:
    """The nine event columns out of a change row image."""
    decoded = {
        "event_time": F.timestamp_micros(F.col(f"{row}.event_time")),
        "price": decode_decimal(F.col(f"{row}.price")),
    }
    return [
        decoded.get(c, F.col(f"{row}.{c}")).alias(c) for c in schemas.EVENT_COLUMNS
    ]


def parse_cdc(messages: DataFrame) -> DataFrame:
    """Change messages to event rows; a message without payload yields nulls."""
    return parse_envelope(messages).select(*_event_fields("data.payload"))


def to_raw(messages: DataFrame, ingested_at=None) -> DataFrame:
    """Rows of the raw zone: payload text, parsed envelope and broker metadata."""
    arrived = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return (
        parse_envelope(messages)
        .select(
            F.col("value").cast("string").alias("raw_payload"),
            "data",
            "topic",
            "partition",
            "offset",
            F.col("timestamp").alias("kafka_timestamp"),
            arrived.alias("ingestion_ts"),
        )
        .withColumn("ingestion_date", F.to_date("ingestion_ts"))
    )


def flatten_raw(raw: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """Flat event rows of the working zone out of raw-zone rows.

    Deleted row images count as ordinary rows unless ``apply_deletes`` asks for
    the ``is_deleted`` flag, which the upsert then honours.
    """
    flat = [
        *_event_fields("data.payload"),
        F.col("topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("kafka_timestamp"),
        F.col("ingestion_ts"),
        F.col("ingestion_date"),
    ]
    if apply_deletes:
        flat.append(F.coalesce(F.col("data.payload.__deleted") == "true", F.lit(False)).alias("is_deleted"))
    return raw.select(*flat)
