"""Stateful deduplication of event streams."""

from pyspark.sql import DataFrame, functions as F

from shoplake import params


def deduplicated(
    events: DataFrame,
    keys: tuple[str, ...] = params.DEDUP_KEY,
    watermark: str = params.WATERMARK,
    salt_by: tuple[str, ...] = ("partition", "offset"),
    salt_buckets: int = 0,
) -> DataFrame:
    """One row per key within the watermark; rows later than the watermark are dropped.

    Rows without event time are left out: a null never falls behind the
    watermark, so its state would stay for ever.

    A key with the event time is forgotten when the watermark passes that time. A key
    without it would be kept for ever, so its copies are dropped for the watermark's delay
    after the first: an event that comes again later is a new one.

    Copies of one event meet in one task. For streams with very many copies of one
    event, ``salt_buckets`` first deduplicates in that many groups by broker
    position (``salt_by``), at the price of a second shuffle and state.
    """
    timed = events.where(F.col("event_time").isNotNull()).withWatermark("event_time", watermark)
    once = DataFrame.dropDuplicates if "event_time" in keys else DataFrame.dropDuplicatesWithinWatermark
    if salt_buckets:
        salt = F.pmod(F.xxhash64(*salt_by), F.lit(salt_buckets))
        timed = once(timed.withColumn("_salt", salt), [*keys, "_salt"]).drop("_salt")
    return once(timed, list(keys))


def untimed(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_time").isNull())
