"""Message and serving sinks used by the streams."""

from pyspark.sql import DataFrame, functions as F

# A message's columns beside the event parsed from it; the time is in microseconds.
MESSAGE = {
    "message_key": "binary", "message_value": "binary", "message_topic": "string",
    "message_partition": "int", "message_offset": "bigint", "message_micros": "bigint",
}


def with_message(messages: DataFrame) -> DataFrame:
    """Adds the columns of ``MESSAGE``: key, value and place of each message as they came."""
    micros = {"message_micros": F.unix_micros("timestamp")}
    return messages.withColumns({c: micros.get(c, F.col(c.removeprefix("message_"))) for c in MESSAGE})


def letter_messages(letters: DataFrame) -> DataFrame:
    """The messages in dead letters, byte for byte; letters that hold none are left out."""
    schema = ", ".join(f"{name} {kind}" for name, kind in MESSAGE.items())
    rows = letters.select(F.from_json("value", schema).alias("m")).where(F.col("m.message_offset").isNotNull())
    return rows.select(
        *[F.col(f"m.{c}").alias(c.removeprefix("message_")) for c in MESSAGE if c != "message_micros"],
        F.timestamp_micros("m.message_micros").alias("timestamp"),
    )


def dead_letters(rows: DataFrame, batch_id: int, reason: str, at=None) -> DataFrame:
    """One JSON ``value`` per row, including batch id, reason and time of the rejection.

    Binary columns, as those of ``with_message``, become base64 text.
    """
    when = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    tagged = rows.withColumns({
        "dlq_batch_id": F.lit(batch_id).cast("bigint"),
        "dlq_reason": F.lit(reason),
        "dlq_timestamp": when,
    })
    return tagged.select(F.to_json(F.struct("*")).alias("value"))


def write_kafka(values: DataFrame, servers: str, topic: str) -> None:
    """Needs Spark's Kafka connector on the class path (untested here)."""
    values.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Appends to a serving database. Needs its JDBC driver on the class path (untested here)."""
    rows.write.mode("append").jdbc(url, table, properties=properties)
