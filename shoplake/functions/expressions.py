"""Event weights, decay, buckets, ratios and stable hashing as columns."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from shoplake import params

SECONDS_PER_DAY = 86400.0


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def type_weight(weights: Mapping[str, float]) -> Column:
    """Weight of the row's event type, 0 for types not listed."""
    chain = F
    for name, weight in weights.items():
        chain = chain.when(is_type(name), F.lit(weight))
    return chain.otherwise(F.lit(0.0))


def newest_event_second(events: DataFrame) -> Column:
    """Latest event time in epoch seconds, as a scalar subquery (no driver round trip)."""
    return events.select(F.max(F.unix_timestamp("event_time"))).scalar()


def decay(newest_second: Column, rate: float = params.DECAY_PER_DAY) -> Column:
    """exp(-rate * age in days) of the row's event."""
    age_days = (newest_second - F.unix_timestamp("event_time")) / F.lit(SECONDS_PER_DAY)
    return F.exp(F.lit(-rate) * age_days)


def revenue() -> Column:
    """Purchase revenue of a group as decimal(20,2), summed in decimals (order-independent)."""
    price = F.col("price").cast("decimal(10,2)")
    bought = F.sum(F.when(is_type("purchase"), price))
    return F.coalesce(bought, F.lit(0)).cast("decimal(20,2)")


def price_bucket(price: Column) -> Column:
    chain = F
    for edge, label in params.PRICE_BUCKETS:
        chain = chain.when(price <= edge, F.lit(label))
    return chain.otherwise(F.lit(params.PRICE_BUCKET_TOP))


def exact_percent(part: Column, whole: Column) -> Column:
    """100 * part / whole in decimal arithmetic, rounded half up to decimal(10,2)."""
    hundredfold = (part * 100).cast("decimal(22,0)")
    return (hundredfold / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")).cast("decimal(10,2)")


def stable_hash(*columns: str) -> Column:
    """32-bit hash of the columns' text that any SQL engine with md5 can repeat."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
