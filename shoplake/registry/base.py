"""Registration of queries, the comparable form of results, and shared SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shoplake.operators.gold import agg_daily_events, agg_product_daily, fact_events
from shoplake.operators.validation import valid
from shoplake.operators.working import prepare
from shoplake.sources.adapter import click_events, order_events
from shoplake.workspace import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def comparable(rows: DataFrame) -> DataFrame:
    """Result in types every SQL engine prints alike.

    Decimals become doubles, doubles are rounded to six places, dates and times
    become text, arrays comma-joined text.
    """
    columns = []
    for field in rows.schema.fields:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            value = value.cast("double")
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.round(value.cast("double"), 6)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, TIME_TEXT)
        elif isinstance(kind, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(kind, T.ArrayType):
            value = F.concat_ws(",", value.cast("array<string>"))
        elif isinstance(kind, T.IntegralType):
            value = value.cast("bigint")
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def query(name: str, oracle: str | None = None):
    """Registers a query under ``name`` with the SQL body it must agree with."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return comparable(build(spark, folder))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = PRELUDE + oracle
        return build

    return register


# --- shared inputs ---------------------------------------------------------

def valid_events(spark: SparkSession, folder: str) -> DataFrame:
    return valid(click_events(spark, folder))


def valid_orders(spark: SparkSession, folder: str) -> DataFrame:
    return valid(order_events(spark, folder))


def facts(spark: SparkSession, folder: str) -> DataFrame:
    return fact_events(prepare(valid_events(spark, folder)))


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    return fact_events(prepare(valid_orders(spark, folder)))


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return agg_daily_events(facts(spark, folder))


def product_daily(spark: SparkSession, folder: str) -> DataFrame:
    return agg_product_daily(facts(spark, folder))


# --- shared SQL ------------------------------------------------------------

def sql_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_date(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def sql_percent(part: str, whole: str) -> str:
    """100 * part / whole for integers, rounded half up to two places."""
    return (
        f"CASE WHEN {whole} <> 0 THEN CAST((20000 * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / 100 END"
    )


EVENT_SQL = (
    f"{sql_time('event_time')} AS event_time, event_type, product_id, category_id, category_code, "
    "brand, CAST(price AS DOUBLE) AS price, user_id, user_session"
)

PRODUCT_DAY_SQL = (
    f"{sql_date('event_date')} AS event_date, product_id, category_code, brand, views, cart_adds, "
    "purchases, CAST(revenue AS DOUBLE) AS revenue"
)

DAILY_SQL = (
    f"{sql_date('event_date')} AS event_date, total_events, total_sessions, total_users, "
    "CAST(total_revenue AS DOUBLE) AS total_revenue, view_count, cart_count, purchase_count"
)


def _valid_sql(source: str) -> str:
    return f"""
  SELECT * REPLACE (
    coalesce(nullif(category_code, ''), 'unknown') AS category_code,
    coalesce(nullif(brand, ''), 'unknown') AS brand)
  FROM {source}
  WHERE price BETWEEN 0.01 AND 1000000 AND event_type IN ('view', 'cart', 'purchase', 'remove_from_cart')
    AND product_id > 0 AND user_id > 0 AND event_time IS NOT NULL AND category_id > 0"""


def _daily_sql(source: str) -> str:
    return f"""
  SELECT event_date, count(*) AS total_events, count(DISTINCT user_session) AS total_sessions,
    count(DISTINCT user_id) AS total_users,
    sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS total_revenue,
    count(*) FILTER (WHERE event_type = 'view') AS view_count,
    count(*) FILTER (WHERE event_type = 'cart') AS cart_count,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count
  FROM {source} GROUP BY event_date"""


def _product_daily_sql(source: str) -> str:
    return f"""
  SELECT a.*, l.category_code, l.brand FROM (
    SELECT event_date, product_id,
      count(*) FILTER (WHERE event_type = 'view') AS views,
      count(*) FILTER (WHERE event_type = 'cart') AS cart_adds,
      count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
      sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS revenue
    FROM {source} GROUP BY event_date, product_id) a
  JOIN (
    SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY event_date, product_id
      ORDER BY event_time DESC, category_code DESC, brand DESC) = 1) l
  ON a.event_date = l.event_date AND a.product_id = l.product_id"""


PRELUDE = f"""
WITH click AS (
  SELECT e.event_id, e.ts AS event_time,
    CASE e.event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart'
      ELSE e.event_type END AS event_type,
    e.k AS product_id, CAST(p.p_size AS BIGINT) AS category_id,
    CASE WHEN e.k % 10 = 7 THEN '' ELSE lower(p.p_type) END AS category_code,
    CASE WHEN e.k % 10 <> 3 THEN p.p_brand END AS brand,
    CAST(e.value AS DECIMAL(10,2)) AS price, e.user_id,
    e.user_id || '-' || strftime(e.ts, '%Y-%m-%d') AS user_session
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN part p ON e.k = p.p_partkey),
ordered AS (
  SELECT o.o_orderdate + to_minutes(l.l_linenumber) AS event_time,
    CASE l.l_returnflag WHEN 'A' THEN 'cart' WHEN 'N' THEN 'purchase'
      WHEN 'R' THEN 'remove_from_cart' ELSE l.l_returnflag END AS event_type,
    l.l_partkey AS product_id, CAST(p.p_size AS BIGINT) AS category_id,
    CASE WHEN l.l_partkey % 10 = 7 THEN '' ELSE lower(p.p_type) END AS category_code,
    CASE WHEN l.l_partkey % 10 <> 3 THEN p.p_brand END AS brand,
    CAST(l.l_extendedprice AS DECIMAL(10,2)) AS price, o.o_custkey AS user_id,
    CAST(l.l_orderkey AS VARCHAR) AS user_session
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey),
good AS ({_valid_sql('click')}),
good_orders AS ({_valid_sql('ordered')}),
fact AS (SELECT *, CAST(event_time AS DATE) AS event_date FROM good),
fact_orders AS (SELECT *, CAST(event_time AS DATE) AS event_date FROM good_orders),
days AS ({_daily_sql('fact')}),
product_days AS ({_product_daily_sql('fact')})
"""
