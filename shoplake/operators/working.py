"""Keys and deduplication of the working zone."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplake import params

KEY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Newest copy of an event first.
NEWEST_FIRST = ("event_time", "kafka_offset", "kafka_partition")


def event_key(columns: tuple[str, ...] = params.DEDUP_KEY) -> Column:
    """Pipe-joined text of the key columns."""
    parts = [
        F.date_format(c, KEY_TIME_FORMAT) if c == "event_time" else F.col(c).cast("string")
        for c in columns
    ]
    return F.concat_ws("|", *parts)


def prepare(valid_events: DataFrame, columns: tuple[str, ...] = params.DEDUP_KEY) -> DataFrame:
    """Adds the partition date and the event key."""
    return valid_events.withColumns(
        {"event_date": F.to_date("event_time"), "event_key": event_key(columns)}
    )


def newest_per_key(
    rows: DataFrame, keys: tuple[str, ...], newest_first: tuple[str, ...]
) -> DataFrame:
    """One row per key, the first by the given columns descending.

    Spark cuts every task's rows to one per key before the shuffle, so copies
    of a hot key do not meet in one task.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in newest_first])
    return (
        rows.withColumn("_position", F.row_number().over(order))
        .where(F.col("_position") == 1)
        .drop("_position")
    )
