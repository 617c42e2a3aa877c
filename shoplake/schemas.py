"""Declared schemas of messages and tables; nothing is inferred."""

from pyspark.sql import types as T

EVENT_COLUMNS = (
    "event_time", "event_type", "product_id", "category_id", "category_code",
    "brand", "price", "user_id", "user_session",
)

# JSON and CSV events carry every field as text.
EVENT_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in EVENT_COLUMNS])

EVENT = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])

# Row image of a change event: times in microseconds, price as the bytes of
# the unscaled decimal (base64 text inside JSON).
CDC_ROW = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("event_time", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.BinaryType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
    T.StructField("__deleted", T.StringType()),
    T.StructField("__op", T.StringType()),
    T.StructField("__source_ts_ms", T.LongType()),
])

CDC_ENVELOPE = T.StructType([
    T.StructField("schema", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("fields", T.ArrayType(T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("optional", T.StringType()),
            T.StructField("field", T.StringType()),
        ]))),
        T.StructField("optional", T.StringType()),
        T.StructField("name", T.StringType()),
    ])),
    T.StructField("payload", CDC_ROW),
])

# What a Kafka source yields; file streams of messages use the same shape.
KAFKA_ROW = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

FACT_COLUMNS = ("event_date",) + EVENT_COLUMNS

GOLD_TABLES = {
    "fact_events": (
        "event_time TIMESTAMP, event_type STRING, product_id BIGINT, category_id BIGINT, "
        "category_code STRING, brand STRING, price DECIMAL(10,2), user_id BIGINT, "
        "user_session STRING, event_date DATE"
    ),
    "agg_daily_events": (
        "total_events BIGINT, total_sessions BIGINT, total_users BIGINT, "
        "total_revenue DECIMAL(20,2), view_count BIGINT, cart_count BIGINT, "
        "purchase_count BIGINT, event_date DATE"
    ),
    "agg_product_daily": (
        "product_id BIGINT, category_code STRING, brand STRING, views BIGINT, "
        "cart_adds BIGINT, purchases BIGINT, revenue DECIMAL(20,2), event_date DATE"
    ),
}
