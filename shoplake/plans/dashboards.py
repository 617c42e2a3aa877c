"""Dashboard queries over the rollups of ``operators.rollups``."""

from pyspark.sql import Column, DataFrame, functions as F

from shoplake.functions.expressions import exact_percent


def daily_kpi_report(kpi: DataFrame) -> DataFrame:
    """Users, buyers, revenue and carts per day, with conversion and revenue per cart."""
    revenue_per_cart = F.col("total_revenue") / F.nullif("total_carts", F.lit(0))
    return (
        kpi.where((F.col("daily_unique_users") > 0) & (F.col("total_carts") > 0))
        .select(
            "event_date",
            F.col("daily_unique_users").alias("DAU"),
            F.col("unique_users_buy").alias("DailyUniqueBuyers"),
            F.col("total_revenue").alias("DailyRevenue"),
            F.col("total_carts").alias("DailyCarts"),
            exact_percent(F.col("unique_users_buy"), F.col("daily_unique_users"))
            .alias("User_Conversion_Rate_Percent"),
            revenue_per_cart.cast("decimal(20,2)").alias("Daily_AOV"),
        )
        .orderBy(F.desc("event_date"))
    )


def _named(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def top_categories(products: DataFrame, limit: int = 10) -> DataFrame:
    return (
        products.where(_named("category_code"))
        .groupBy("category_code")
        .agg(
            F.sum("total_revenue").alias("LifetimeRevenue"),
            F.sum("total_purchases").alias("LifetimeSalesQuantity"),
        )
        .orderBy(F.desc("LifetimeRevenue"), F.desc("LifetimeSalesQuantity"), "category_code")
        .limit(limit)
    )


def top_brands(products: DataFrame, limit: int = 5) -> DataFrame:
    events = F.col("total_views") + F.col("total_carts") + F.col("total_purchases")
    return (
        products.where(_named("brand"))
        .groupBy("brand")
        .agg(
            F.sum("total_revenue").alias("LifetimeRevenue"),
            F.sum(events).alias("TotalEvents"),
            F.sum("total_purchases").alias("TotalPurchases"),
        )
        .orderBy(F.desc("LifetimeRevenue"), F.desc("TotalEvents"), "brand")
        .limit(limit)
    )


def realtime(dashboard: DataFrame, as_of=None, hours: int = 6) -> DataFrame:
    """Dashboard slots of the last hours before ``as_of`` (now by default)."""
    now = F.current_timestamp() if as_of is None else as_of
    return (
        dashboard.where(F.col("metric_time") >= now - F.make_dt_interval(hours=F.lit(hours)))
        .select(
            "metric_time",
            F.col("total_events").alias("TotalEvents"),
            F.col("purchases").alias("TotalPurchases"),
            F.col("revenue_15min").alias("TotalRevenue"),
            F.col("active_users").alias("Realtime_Active_Users"),
            F.col("active_sessions").alias("Realtime_Active_Sessions"),
            F.try_divide(F.col("revenue_15min").cast("double"), F.col("purchases").cast("double"))
            .alias("Realtime_AOV"),
        )
        .orderBy(F.desc("metric_time"))
    )


def bucket_conversion(buckets: DataFrame) -> DataFrame:
    purchases, events = F.sum("total_purchases"), F.sum("total_events")
    return (
        buckets.groupBy("price_bucket")
        .agg(
            F.sum("total_revenue").alias("BucketRevenue"),
            purchases.alias("BucketPurchases"),
            events.alias("BucketTotalEvents"),
            (purchases.cast("double") / events * 100).alias("bucket_conversion_rate"),
        )
        .orderBy(F.desc("BucketRevenue"))
    )


def session_report(sessions: DataFrame) -> DataFrame:
    with_purchase, total = F.sum("has_purchase"), F.count(F.lit(1))
    return (
        sessions.groupBy("event_date")
        .agg(
            total.alias("total_sessions"),
            F.avg("session_duration_sec").alias("avg_session_duration_sec"),
            with_purchase.alias("sessions_with_purchase"),
            (with_purchase.cast("double") / total * 100).alias("session_conversion_rate_percent"),
        )
        .orderBy(F.desc("event_date"))
    )
