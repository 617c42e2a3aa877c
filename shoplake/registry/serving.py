"""Rollups, dashboard queries and analyst queries."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.operators import rollups
from shoplake.plans import dashboards, warehouse
from shoplake.registry.base import (
    DAILY_SQL, EVENT_SQL, PRODUCT_DAY_SQL, daily, facts, product_daily, query, sql_date,
    sql_percent, sql_time, valid_events, valid_orders,
)

# The test events cover 2024-01-01 to 2024-01-30.
DAY = date(2024, 1, 15)
LAST_DAY = date(2024, 1, 30)
# The test tables have few views per product.
MIN_VIEWS = 5

KPI_SQL = """
SELECT CAST(event_time AS DATE) AS event_date,
  sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS total_revenue,
  count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
  count(*) FILTER (WHERE event_type = 'view') AS total_views,
  count(*) FILTER (WHERE event_type = 'cart') AS total_carts,
  count(DISTINCT user_id) AS daily_unique_users,
  count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS unique_users_buy
FROM good GROUP BY 1"""


def performance_sql(source: str) -> str:
    return f"""
SELECT CAST(event_time AS DATE) AS event_date, category_code, brand, product_id,
  count(*) FILTER (WHERE event_type = 'view') AS total_views,
  count(*) FILTER (WHERE event_type = 'cart') AS total_carts,
  count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
  sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS total_revenue
FROM {source} GROUP BY ALL"""


PERFORMANCE_SQL = performance_sql("good")

PERFORMANCE_COLUMNS = f"""{sql_date('event_date')} AS event_date, category_code, brand, product_id,
  total_views, total_carts, total_purchases, CAST(total_revenue AS DOUBLE) AS total_revenue"""

DASHBOARD_SQL = """
SELECT time_bucket(INTERVAL 15 MINUTE, event_time) AS metric_time, count(*) AS total_events,
  count(*) FILTER (WHERE event_type = 'view') AS views,
  count(*) FILTER (WHERE event_type = 'cart') AS add_to_carts,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
  sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS revenue_15min,
  count(DISTINCT user_id) AS active_users, count(DISTINCT user_session) AS active_sessions
FROM good GROUP BY 1"""

DASHBOARD_SUMS = f"""{sql_time('metric_time')} AS metric_time, total_events, views, add_to_carts,
  purchases, CAST(revenue_15min AS DOUBLE) AS revenue_15min"""

BUCKET_SQL = """
SELECT CAST(event_time AS DATE) AS event_date,
  CASE WHEN price <= 10 THEN '0-10$' WHEN price <= 50 THEN '11-50$' WHEN price <= 200 THEN '51-200$'
    ELSE '>200$' END AS price_bucket,
  count(*) AS total_events, sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS total_revenue,
  count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases
FROM good WHERE event_type IN ('view', 'purchase') GROUP BY ALL"""

BUCKET_COLUMNS = f"""{sql_date('event_date')} AS event_date, price_bucket, total_events,
  CAST(total_revenue AS DOUBLE) AS total_revenue, total_purchases"""

SESSION_SQL = """
SELECT user_session, user_id, CAST(min(event_time) AS DATE) AS event_date,
  min(event_time) AS session_start_time, max(event_time) AS session_end_time,
  date_diff('second', min(event_time), max(event_time)) AS session_duration_sec,
  max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase, count(*) AS total_events
FROM good GROUP BY user_session, user_id"""

SESSION_COLUMNS = f"""user_session, user_id, {sql_date('event_date')} AS event_date,
  {sql_time('session_start_time')} AS session_start_time,
  {sql_time('session_end_time')} AS session_end_time,
  session_duration_sec, CAST(has_purchase AS BIGINT) AS has_purchase, total_events"""

KPI_SUMS = f"""{sql_date('event_date')} AS event_date, CAST(total_revenue AS DOUBLE) AS total_revenue,
  total_purchases, total_views, total_carts"""


# --- rollups ---------------------------------------------------------------

@query("mv_daily_kpi", f"SELECT {KPI_SUMS}, daily_unique_users, unique_users_buy FROM ({KPI_SQL})")
def mv_daily_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.daily_kpi(valid_events(spark, folder))


@query("mv_daily_kpi_hll")
def mv_daily_kpi_hll(spark: SparkSession, folder: str) -> DataFrame:
    states = rollups.daily_kpi_states(valid_events(spark, folder))
    return rollups.estimate_sketches(rollups.merge_states(states, "daily"))


@query("mv_daily_kpi_hll_error", f"""
SELECT {KPI_SUMS}, true AS users_close, true AS buyers_close FROM ({KPI_SQL})""")
def mv_daily_kpi_hll_error(spark: SparkSession, folder: str) -> DataFrame:
    """Sketch estimates beside the exact counts: within five percent."""
    def close(estimate: str, exact: str):
        return F.abs(F.col(estimate) - F.col(exact)) <= 0.05 * F.col(exact)

    exact = mv_daily_kpi(spark, folder).select(
        "event_date",
        F.col("daily_unique_users").alias("users"),
        F.col("unique_users_buy").alias("buyers"),
    )
    return mv_daily_kpi_hll(spark, folder).join(exact, "event_date").select(
        "event_date", "total_revenue", "total_purchases", "total_views", "total_carts",
        close("daily_unique_users", "users").alias("users_close"),
        close("unique_users_buy", "buyers").alias("buyers_close"),
    )


@query("mv_product_performance", f"SELECT {PERFORMANCE_COLUMNS} FROM ({PERFORMANCE_SQL})")
def mv_product_performance(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.product_performance(valid_events(spark, folder))


@query(
    "mv_product_performance_orders",
    f"SELECT {PERFORMANCE_COLUMNS} FROM ({performance_sql('good_orders')})",
)
def mv_product_performance_orders(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.product_performance(valid_orders(spark, folder))


@query("mv_realtime_15min", f"""
SELECT {DASHBOARD_SUMS}, active_users, active_sessions FROM ({DASHBOARD_SQL})""")
def mv_realtime_15min(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.realtime_dashboard(valid_events(spark, folder))


@query("mv_price_bucket", f"SELECT {BUCKET_COLUMNS} FROM ({BUCKET_SQL})")
def mv_price_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.price_bucket_performance(valid_events(spark, folder))


@query("mv_user_session", f"SELECT {SESSION_COLUMNS} FROM ({SESSION_SQL})")
def mv_user_session(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.session_summary(valid_events(spark, folder))


# --- dashboard queries -----------------------------------------------------

@query("cq_daily_kpi", f"""
SELECT {sql_date('event_date')} AS event_date, daily_unique_users AS "DAU",
  unique_users_buy AS "DailyUniqueBuyers", CAST(total_revenue AS DOUBLE) AS "DailyRevenue",
  total_carts AS "DailyCarts",
  {sql_percent('unique_users_buy', 'daily_unique_users')} AS "User_Conversion_Rate_Percent",
  CAST((2 * CAST(total_revenue * 100 AS BIGINT) + total_carts) // (2 * total_carts) AS DOUBLE) / 100 AS "Daily_AOV"
FROM ({KPI_SQL}) WHERE daily_unique_users > 0 AND total_carts > 0""")
def cq_daily_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.daily_kpi_report(mv_daily_kpi(spark, folder))


@query("cq_top_categories", f"""
SELECT category_code, CAST(sum(total_revenue) AS DOUBLE) AS "LifetimeRevenue",
  CAST(sum(total_purchases) AS BIGINT) AS "LifetimeSalesQuantity"
FROM ({PERFORMANCE_SQL}) WHERE category_code IS NOT NULL AND category_code <> ''
GROUP BY category_code ORDER BY sum(total_revenue) DESC, 3 DESC, category_code LIMIT 10""")
def cq_top_categories(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.top_categories(mv_product_performance(spark, folder))


@query("cq_top_brands", f"""
SELECT brand, CAST(sum(total_revenue) AS DOUBLE) AS "LifetimeRevenue",
  CAST(sum(total_views + total_carts + total_purchases) AS BIGINT) AS "TotalEvents",
  CAST(sum(total_purchases) AS BIGINT) AS "TotalPurchases"
FROM ({PERFORMANCE_SQL}) WHERE brand IS NOT NULL AND brand <> ''
GROUP BY brand ORDER BY sum(total_revenue) DESC, 3 DESC, brand LIMIT 5""")
def cq_top_brands(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.top_brands(mv_product_performance(spark, folder))


@query("cq_realtime", f"""
SELECT {sql_time('metric_time')} AS metric_time, total_events AS "TotalEvents", purchases AS "TotalPurchases",
  CAST(revenue_15min AS DOUBLE) AS "TotalRevenue", active_users AS "Realtime_Active_Users",
  active_sessions AS "Realtime_Active_Sessions",
  round(CASE WHEN purchases > 0 THEN CAST(revenue_15min AS DOUBLE) / purchases END, 6) AS "Realtime_AOV"
FROM ({DASHBOARD_SQL})
WHERE metric_time >= (SELECT max(event_time) FROM good) - INTERVAL 6 HOUR""")
def cq_realtime(spark: SparkSession, folder: str) -> DataFrame:
    newest = valid_events(spark, folder).agg(F.max("event_time")).scalar()
    return dashboards.realtime(mv_realtime_15min(spark, folder), as_of=newest)


@query("cq_price_bucket", f"""
SELECT price_bucket, CAST(sum(total_revenue) AS DOUBLE) AS "BucketRevenue",
  CAST(sum(total_purchases) AS BIGINT) AS "BucketPurchases",
  CAST(sum(total_events) AS BIGINT) AS "BucketTotalEvents",
  round(CAST(sum(total_purchases) AS DOUBLE) / sum(total_events) * 100, 6) AS bucket_conversion_rate
FROM ({BUCKET_SQL}) GROUP BY price_bucket""")
def cq_price_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.bucket_conversion(mv_price_bucket(spark, folder))


@query("cq_sessions", f"""
SELECT {sql_date('event_date')} AS event_date, count(*) AS total_sessions,
  round(avg(session_duration_sec), 6) AS avg_session_duration_sec,
  CAST(sum(has_purchase) AS BIGINT) AS sessions_with_purchase,
  round(CAST(sum(has_purchase) AS DOUBLE) / count(*) * 100, 6) AS session_conversion_rate_percent
FROM ({SESSION_SQL}) GROUP BY ALL""")
def cq_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return dashboards.session_report(mv_user_session(spark, folder))


# --- analyst queries -------------------------------------------------------

@query("tq_preview", f"""
SELECT {sql_date('event_date')} AS event_date, {EVENT_SQL} FROM (SELECT * FROM fact
ORDER BY event_date, event_time, event_type, product_id, category_id, category_code, brand, price,
  user_id, user_session LIMIT 100)""")
def tq_preview(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.preview(facts(spark, folder))


@query("tq_fact_day", f"""
SELECT {sql_date('event_date')} AS event_date, {EVENT_SQL} FROM fact WHERE event_date = DATE '2024-01-15'""")
def tq_fact_day(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.facts_of_day(facts(spark, folder), DAY)


@query("tq_type_counts", f"""
SELECT {sql_date('event_date')} AS event_date, event_type, count(*) AS event_count,
  count(DISTINCT user_id) AS unique_users, count(DISTINCT product_id) AS unique_products
FROM fact WHERE event_date >= DATE '2024-01-15' - INTERVAL 7 DAY GROUP BY fact.event_date, event_type""")
def tq_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.type_counts(facts(spark, folder), DAY)


@query("tq_daily_window", f"""
SELECT {DAILY_SQL} FROM days WHERE days.event_date >= DATE '2024-01-30' - INTERVAL 30 DAY""")
def tq_daily_window(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.daily_window(daily(spark, folder), LAST_DAY)


@query("tq_period_totals", """
SELECT CAST(sum(total_revenue) AS DOUBLE) AS total_revenue_period,
  CAST(sum(total_events) AS BIGINT) AS total_events_period,
  CAST(sum(total_users) AS BIGINT) AS total_unique_users,
  round(CAST(sum(total_revenue) AS DOUBLE) / count(*), 4) AS avg_daily_revenue
FROM days WHERE event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'""")
def tq_period_totals(spark: SparkSession, folder: str) -> DataFrame:
    totals = warehouse.period_totals(daily(spark, folder), date(2024, 1, 1), date(2024, 1, 31))
    return totals.withColumn("avg_daily_revenue", F.round("avg_daily_revenue", 4))


@query("tq_best_sellers", f"""
SELECT {PRODUCT_DAY_SQL} FROM (SELECT * FROM product_days WHERE event_date = DATE '2024-01-15'
ORDER BY purchases DESC, revenue DESC, product_id LIMIT 50)""")
def tq_best_sellers(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.best_sellers(product_daily(spark, folder), DAY)


@query("tq_conversion", f"""
SELECT product_id, category_code, brand, total_views, total_cart_adds, total_purchases, total_revenue,
  {sql_percent('total_purchases', 'total_views')} AS conversion_rate_pct,
  {sql_percent('total_cart_adds', 'total_views')} AS cart_rate_pct
FROM (SELECT product_id, category_code, brand, CAST(sum(views) AS BIGINT) AS total_views,
    CAST(sum(cart_adds) AS BIGINT) AS total_cart_adds, CAST(sum(purchases) AS BIGINT) AS total_purchases,
    CAST(sum(revenue) AS DOUBLE) AS total_revenue
  FROM product_days WHERE event_date >= DATE '2024-01-30' - INTERVAL 30 DAY
  GROUP BY product_id, category_code, brand HAVING sum(views) >= 5)
ORDER BY conversion_rate_pct DESC, product_id, category_code, brand LIMIT 20""")
def tq_conversion(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.conversion_ranking(product_daily(spark, folder), LAST_DAY, min_views=MIN_VIEWS)


@query("tq_category_brand", """
SELECT category_code, brand, product_count, total_views, total_purchases,
  CAST(total_revenue AS DOUBLE) AS total_revenue,
  CASE WHEN total_purchases <> 0 THEN CAST((2 * CAST(total_revenue * 100 AS BIGINT) + total_purchases)
    // (2 * total_purchases) AS DOUBLE) / 100 END AS avg_order_value
FROM (SELECT category_code, brand, count(DISTINCT product_id) AS product_count,
    CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(purchases) AS BIGINT) AS total_purchases,
    sum(revenue) AS total_revenue
  FROM product_days WHERE event_date >= DATE '2024-01-30' - INTERVAL 30 DAY
    AND category_code IS NOT NULL AND brand IS NOT NULL GROUP BY category_code, brand)
ORDER BY total_revenue DESC, category_code, brand LIMIT 30""")
def tq_category_brand(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.category_brand(product_daily(spark, folder), LAST_DAY)


@query("tq_reconcile", f"""
SELECT {sql_date('d.event_date')} AS event_date, d.total_events, CAST(d.total_revenue AS DOUBLE) AS total_revenue,
  count(DISTINCT f.product_id) AS unique_products_in_fact, count(DISTINCT f.user_id) AS unique_users_in_fact
FROM days d LEFT JOIN fact f ON d.event_date = f.event_date
WHERE d.event_date >= DATE '2024-01-30' - INTERVAL 7 DAY
GROUP BY d.event_date, d.total_events, d.total_revenue""")
def tq_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.reconcile(daily(spark, folder), facts(spark, folder), LAST_DAY)
