"""The test tables seen as shop events."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplake import schemas

# Test-table event types that are named differently in the event model.
EVENT_TYPE_NAMES = {"click": "cart", "signup": "remove_from_cart"}
RETURN_FLAG_TYPES = {"A": "cart", "N": "purchase", "R": "remove_from_cart"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _product_attributes(key: Column) -> dict[str, Column]:
    """Attributes from the part row; some products have an empty category or no brand."""
    return {
        "category_id": F.col("p_size").cast("bigint"),
        "category_code": F.when(key % 10 == 7, "").otherwise(F.lower("p_type")),
        "brand": F.when(key % 10 != 3, F.col("p_brand")),
    }


def click_events(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table joined to its products, with its ``event_id``."""
    product = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, folder, "events").withColumn("product_id", product)
    part = table(spark, folder, "part")
    named = F.col("event_type")
    for old, new in EVENT_TYPE_NAMES.items():
        named = F.when(F.col("event_type") == old, F.lit(new)).otherwise(named)
    joined = events.join(part, events.product_id == part.p_partkey, "left")
    return joined.withColumns({
        "event_time": F.col("ts").cast("timestamp"),
        "event_type": named,
        "price": F.col("value").cast("decimal(10,2)"),
        "user_session": F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")),
        **_product_attributes(F.col("product_id")),
    }).select("event_id", *schemas.EVENT_COLUMNS)


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as events: one session per order, one minute between lines."""
    lines, orders, part = (table(spark, folder, n) for n in ("lineitem", "orders", "part"))
    event_type = F.col("l_returnflag")
    for old, new in RETURN_FLAG_TYPES.items():
        event_type = F.when(F.col("l_returnflag") == old, F.lit(new)).otherwise(event_type)
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        part, lines.l_partkey == part.p_partkey, "left"
    )
    minutes = F.make_dt_interval(mins=F.col("l_linenumber"))
    return joined.withColumns({
        "event_time": F.col("o_orderdate").cast("timestamp") + minutes,
        "event_type": event_type,
        "product_id": F.col("l_partkey"),
        "price": F.col("l_extendedprice").cast("decimal(10,2)"),
        "user_id": F.col("o_custkey"),
        "user_session": F.col("l_orderkey").cast("string"),
        **_product_attributes(F.col("l_partkey")),
    }).select(*schemas.EVENT_COLUMNS)
