"""Gold tables: facts, platform days and product days."""

from pyspark.sql import DataFrame, functions as F

from shoplake import schemas
from shoplake.functions.expressions import is_type, revenue


def _counts(**names: str) -> list:
    return [F.count_if(is_type(event_type)).alias(name) for name, event_type in names.items()]


def fact_events(working: DataFrame) -> DataFrame:
    return working.select(*schemas.FACT_COLUMNS)


def agg_daily_events(facts: DataFrame) -> DataFrame:
    """One row per day with counts, exact distinct sessions and users, and revenue.

    Events are first folded to one row per (day, session, user), so the row
    expansion Spark needs for two exact distinct counts works on that far
    smaller input.
    """
    per_visit = facts.groupBy("event_date", "user_session", "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        revenue().alias("revenue"),
        *_counts(views="view", carts="cart", purchases="purchase"),
    )
    return per_visit.groupBy("event_date").agg(
        F.sum("events").alias("total_events"),
        F.count_distinct("user_session").alias("total_sessions"),
        F.count_distinct("user_id").alias("total_users"),
        F.sum("revenue").cast("decimal(20,2)").alias("total_revenue"),
        F.sum("views").alias("view_count"),
        F.sum("carts").alias("cart_count"),
        F.sum("purchases").alias("purchase_count"),
    )


def _product_day_parts(facts: DataFrame) -> DataFrame:
    """Product days split by category and brand; every buffer is fixed-width (hash aggregation)."""
    return facts.groupBy("event_date", "product_id", "category_code", "brand").agg(
        F.max("event_time").alias("last_seen"),
        revenue().alias("revenue"),
        *_counts(views="view", cart_adds="cart", purchases="purchase"),
    )


def _latest_attributes() -> list:
    latest = F.max_by(
        F.struct("category_code", "brand"), F.struct("last_seen", "category_code", "brand")
    )
    return [latest.alias("latest")]


def product_last_attrs(facts: DataFrame) -> DataFrame:
    """Category and brand of each product day's last event; equal times break by value."""
    return (
        _product_day_parts(facts)
        .groupBy("event_date", "product_id")
        .agg(*_latest_attributes())
        .select("event_date", "product_id", "latest.category_code", "latest.brand")
    )


def agg_product_daily(facts: DataFrame) -> DataFrame:
    """Product-day counts, revenue and last attributes, without a window or a join."""
    sums = [F.sum(c).alias(c) for c in ("views", "cart_adds", "purchases")]
    return (
        _product_day_parts(facts)
        .groupBy("event_date", "product_id")
        .agg(*_latest_attributes(), *sums, F.sum("revenue").cast("decimal(20,2)").alias("revenue"))
        .select(
            "event_date", "product_id", "latest.category_code", "latest.brand",
            "views", "cart_adds", "purchases", "revenue",
        )
    )
