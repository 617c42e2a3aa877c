"""Parsing, validation and gold queries."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.functions.binary import decode_decimal, encode_decimal
from shoplake.operators import gold, parsing, validation, working
from shoplake.registry.base import (
    DAILY_SQL, EVENT_SQL, PRODUCT_DAY_SQL, _daily_sql, _product_daily_sql, daily, facts,
    order_facts, product_daily, query, sql_date, sql_time, valid_events,
)
from shoplake.sources.adapter import click_events
from shoplake.sources.messages import change_messages, event_messages

RULES_SQL = """
  coalesce(price BETWEEN 0.01 AND 1000000, false) AS is_valid_price,
  coalesce(event_type IN ('view', 'cart', 'purchase', 'remove_from_cart'), false) AS is_valid_event_type,
  coalesce(product_id > 0, false) AS is_valid_product_id,
  coalesce(user_id > 0, false) AS is_valid_user_id,
  event_time IS NOT NULL AS is_valid_event_time,
  coalesce(category_id > 0, false) AS is_valid_category_id"""

FLAGGED_SQL = f"""
SELECT *, is_valid_price AND is_valid_event_type AND is_valid_product_id AND is_valid_user_id
    AND is_valid_event_time AND is_valid_category_id AS is_valid_record,
  concat_ws(', ',
    CASE WHEN NOT is_valid_price THEN 'invalid_price' END,
    CASE WHEN NOT is_valid_event_type THEN 'invalid_event_type' END,
    CASE WHEN NOT is_valid_product_id THEN 'invalid_product_id' END,
    CASE WHEN NOT is_valid_user_id THEN 'invalid_user_id' END,
    CASE WHEN NOT is_valid_event_time THEN 'invalid_event_time' END,
    CASE WHEN NOT is_valid_category_id THEN 'invalid_category_id' END) AS invalid_reasons
FROM (SELECT *, {RULES_SQL} FROM click)"""

FLAGS_SQL = (
    "is_valid_price, is_valid_event_type, is_valid_product_id, is_valid_user_id, "
    "is_valid_event_time, is_valid_category_id, is_valid_record, invalid_reasons"
)


# --- messages and parsing --------------------------------------------------

@query("parse_events_json", """
SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
  event_type, product_id, category_id, category_code, brand, CAST(price AS DOUBLE) AS price,
  user_id, user_session FROM click""")
def parse_events_json(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.parse_events(event_messages(click_events(spark, folder)))


@query("parse_cdc", f"SELECT {EVENT_SQL} FROM click")
def parse_cdc(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.parse_cdc(change_messages(click_events(spark, folder)))


@query("cdc_envelope", """
SELECT event_id AS "offset", CAST(event_id AS VARCHAR) AS id, CAST(epoch_us(event_time) AS VARCHAR) AS event_time,
  event_type, CAST(price AS DOUBLE) AS price, 'u' AS operation, 'false' AS deleted,
  CAST(epoch_us(event_time) // 1000 AS VARCHAR) AS source_ms, 'struct' AS schema_type
FROM click""")
def cdc_envelope(spark: SparkSession, folder: str) -> DataFrame:
    messages = change_messages(click_events(spark, folder), operation="u")
    text = F.col("value").cast("string")

    def field(path: str):
        return F.get_json_object(text, f"$.{path}")

    return messages.select(
        "offset",
        field("payload.id").alias("id"),
        field("payload.event_time").alias("event_time"),
        field("payload.event_type").alias("event_type"),
        decode_decimal(F.unbase64(field("payload.price"))).alias("price"),
        field("payload.__op").alias("operation"),
        field("payload.__deleted").alias("deleted"),
        field("payload.__source_ts_ms").alias("source_ms"),
        field("schema.type").alias("schema_type"),
    )


@query("decode_decimal", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_extendedprice AS DOUBLE) AS price,
  CAST(-l_extendedprice AS DOUBLE) AS refund FROM lineitem""")
def decode_decimal_query(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    encoded = lines.select(
        "l_orderkey", "l_linenumber",
        encode_decimal(price).alias("price"), encode_decimal(-price).alias("refund"),
    )
    return encoded.withColumns({c: decode_decimal(F.col(c)) for c in ("price", "refund")})


@query("working_flatten", f"""
SELECT {EVENT_SQL}, 'ecommerce_change_events' AS topic, event_id AS kafka_offset,
  {sql_time('event_time')} AS kafka_timestamp, '2024-02-01' AS ingestion_date FROM click""")
def working_flatten(spark: SparkSession, folder: str) -> DataFrame:
    raw = parsing.to_raw(change_messages(click_events(spark, folder)), "2024-02-01 00:00:00")
    return parsing.flatten_raw(raw).drop("kafka_partition", "ingestion_ts")


# --- validation ------------------------------------------------------------

@query("validate_flags", f"SELECT event_id, {FLAGS_SQL} FROM ({FLAGGED_SQL})")
def validate_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = validation.flag(click_events(spark, folder))
    added = [c for c in flagged.columns if c.startswith("is_valid_")]
    return flagged.select("event_id", *added, "invalid_reasons")


@query("validate_valid", f"SELECT event_id, {EVENT_SQL} FROM good")
def validate_valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_events(spark, folder)


@query("validate_invalid", f"""
SELECT event_id, {EVENT_SQL}, {FLAGS_SQL}, '2024-02-01 00:00:00.000000' AS processing_timestamp
FROM ({FLAGGED_SQL}) WHERE NOT is_valid_record""")
def validate_invalid(spark: SparkSession, folder: str) -> DataFrame:
    return validation.invalid(click_events(spark, folder), "2024-02-01 00:00:00")


@query("dq_metrics", f"""
SELECT count(*) AS total_records, count(*) FILTER (WHERE is_valid_record) AS valid_records,
  count(*) FILTER (WHERE NOT is_valid_record) AS invalid_records FROM ({FLAGGED_SQL})""")
def dq_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return validation.quality_totals(click_events(spark, folder))


@query("dq_reasons", f"""
SELECT reason, count(*) AS record_count FROM (
  SELECT unnest(string_split(invalid_reasons, ', ')) AS reason FROM ({FLAGGED_SQL}) WHERE NOT is_valid_record)
GROUP BY reason""")
def dq_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return validation.failure_histogram(click_events(spark, folder))


# --- working and gold ------------------------------------------------------

@query("working_prepare", f"""
SELECT {sql_date('event_time')} AS event_date,
  concat_ws('|', {sql_time('event_time')}, user_id, product_id, event_type) AS event_key,
  CAST(price AS DOUBLE) AS price FROM good""")
def working_prepare(spark: SparkSession, folder: str) -> DataFrame:
    return working.prepare(valid_events(spark, folder)).select("event_date", "event_key", "price")


@query("fact_events", f"SELECT {sql_date('event_date')} AS event_date, {EVENT_SQL} FROM fact")
def fact_events(spark: SparkSession, folder: str) -> DataFrame:
    return facts(spark, folder)


@query("agg_daily_events", f"SELECT {DAILY_SQL} FROM days")
def agg_daily_events(spark: SparkSession, folder: str) -> DataFrame:
    return daily(spark, folder)


@query("agg_daily_events_orders", f"SELECT {DAILY_SQL} FROM ({_daily_sql('fact_orders')})")
def agg_daily_events_orders(spark: SparkSession, folder: str) -> DataFrame:
    return gold.agg_daily_events(order_facts(spark, folder))


@query("agg_product_daily", f"SELECT {PRODUCT_DAY_SQL} FROM product_days")
def agg_product_daily(spark: SparkSession, folder: str) -> DataFrame:
    return product_daily(spark, folder)


@query("agg_product_daily_orders", f"SELECT {PRODUCT_DAY_SQL} FROM ({_product_daily_sql('fact_orders')})")
def agg_product_daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    return gold.agg_product_daily(order_facts(spark, folder))


@query("product_last_attrs", f"""
SELECT {sql_date('event_date')} AS event_date, product_id, category_code, brand FROM product_days""")
def product_last_attrs(spark: SparkSession, folder: str) -> DataFrame:
    return gold.product_last_attrs(facts(spark, folder))
