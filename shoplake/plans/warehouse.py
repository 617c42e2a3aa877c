"""Analyst queries over the gold tables.

Each takes the date its window ends or starts at, as the data decides what
"recent" means. Limits have a total order behind them.
"""

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from shoplake import schemas
from shoplake.functions.expressions import exact_percent

MIN_VIEWS = 100


def _since(day: date, days: int):
    return F.col("event_date") >= F.lit(day - timedelta(days=days))


def preview(facts: DataFrame, limit: int = 100) -> DataFrame:
    return facts.orderBy(*schemas.FACT_COLUMNS).limit(limit)


def facts_of_day(facts: DataFrame, day: date) -> DataFrame:
    """Newest first; the further sort columns let the sort split a crowded moment."""
    return (
        facts.where(F.col("event_date") == F.lit(day))
        .select(*schemas.FACT_COLUMNS)
        .orderBy(F.desc("event_time"), "user_id", "product_id", "event_type")
    )


def type_counts(facts: DataFrame, day: date, days: int = 7) -> DataFrame:
    """Events, users and products per day and type.

    One row per (day, type, user, product) is left before the two distinct
    counts, so Spark's row expansion for them starts from that.
    """
    pairs = (
        facts.where(_since(day, days))
        .groupBy("event_date", "event_type", "user_id", "product_id")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return (
        pairs.groupBy("event_date", "event_type")
        .agg(
            F.sum("events").alias("event_count"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_distinct("product_id").alias("unique_products"),
        )
        .orderBy(F.desc("event_date"), "event_type")
    )


def daily_window(daily: DataFrame, day: date, days: int = 30) -> DataFrame:
    return daily.where(_since(day, days)).orderBy(F.desc("event_date"))


def period_totals(daily: DataFrame, first: date, last: date) -> DataFrame:
    """Totals of a period; the user total adds up daily distinct users."""
    return daily.where(F.col("event_date").between(F.lit(first), F.lit(last))).agg(
        F.sum("total_revenue").alias("total_revenue_period"),
        F.sum("total_events").alias("total_events_period"),
        F.sum("total_users").alias("total_unique_users"),
        F.avg("total_revenue").alias("avg_daily_revenue"),
    )


def best_sellers(products: DataFrame, day: date, limit: int = 50) -> DataFrame:
    return (
        products.where(F.col("event_date") == F.lit(day))
        .orderBy(F.desc("purchases"), F.desc("revenue"), "product_id")
        .limit(limit)
    )


def conversion_ranking(
    products: DataFrame, day: date, days: int = 30, min_views: int = MIN_VIEWS, limit: int = 20
) -> DataFrame:
    """Products by purchases per view, among those with enough views."""
    views = F.col("total_views")
    return (
        products.where(_since(day, days))
        .groupBy("product_id", "category_code", "brand")
        .agg(
            F.sum("views").alias("total_views"),
            F.sum("cart_adds").alias("total_cart_adds"),
            F.sum("purchases").alias("total_purchases"),
            F.sum("revenue").alias("total_revenue"),
        )
        .where(views >= min_views)
        .withColumns({
            "conversion_rate_pct": exact_percent(F.col("total_purchases"), views),
            "cart_rate_pct": exact_percent(F.col("total_cart_adds"), views),
        })
        .orderBy(F.desc("conversion_rate_pct"), "product_id", "category_code", "brand")
        .limit(limit)
    )


def category_brand(products: DataFrame, day: date, days: int = 30, limit: int = 30) -> DataFrame:
    per_order = F.sum("revenue") / F.nullif(F.sum("purchases"), F.lit(0))
    return (
        products.where(
            _since(day, days) & F.col("category_code").isNotNull() & F.col("brand").isNotNull()
        )
        .groupBy("category_code", "brand")
        .agg(
            F.count_distinct("product_id").alias("product_count"),
            F.sum("views").alias("total_views"),
            F.sum("purchases").alias("total_purchases"),
            F.sum("revenue").alias("total_revenue"),
            per_order.cast("decimal(10,2)").alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "category_code", "brand")
        .limit(limit)
    )


def reconcile(daily: DataFrame, facts: DataFrame, day: date, days: int = 7) -> DataFrame:
    """Daily aggregates beside the distinct products and users of the facts.

    The facts are reduced to one row per day before the join.
    """
    in_window = _since(day, days)
    per_day = (
        facts.where(in_window)
        .select("event_date", "product_id", "user_id")
        .distinct()
        .groupBy("event_date")
        .agg(
            F.count_distinct("product_id").alias("unique_products_in_fact"),
            F.count_distinct("user_id").alias("unique_users_in_fact"),
        )
    )
    filled = ["unique_products_in_fact", "unique_users_in_fact"]
    return (
        daily.where(in_window)
        .select("event_date", "total_events", "total_revenue")
        .join(per_day, "event_date", "left")
        .na.fill(0, filled)
        .orderBy(F.desc("event_date"))
    )
