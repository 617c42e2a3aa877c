"""Table writes, maintenance, upserts and the batch jobs between zones."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.operators import working
from shoplake.plans import medallion
from shoplake.registry.base import (
    DAILY_SQL, EVENT_SQL, facts, query, sql_date, valid_events,
)
from shoplake.operators.merge import merge_rows
from shoplake.sinks import catalog, maintenance, tables as table_sinks
from shoplake.sources import adapter, messages, tables as table_sources
from shoplake.workspace import new_folder

FACT_SQL = f"SELECT {sql_date('event_date')} AS event_date, {EVENT_SQL} FROM fact"


def _stored_facts(spark: SparkSession, folder: str, label: str) -> str:
    path = new_folder(spark, label)
    table_sinks.write_table(facts(spark, folder), path, "overwrite", ["event_date"])
    return path


# --- reading ---------------------------------------------------------------

@query("scan_table", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem")
def scan_table(spark: SparkSession, folder: str) -> DataFrame:
    lines = table_sources.scan(spark, f"{folder}/lineitem.parquet")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity")


@query("scan_partition", f"{FACT_SQL} WHERE fact.event_date = DATE '2024-01-15'")
def scan_partition(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_facts(spark, folder, "scan_partition")
    return table_sources.scan_day(spark, path, date(2024, 1, 15), "event_date")


def _csv_folder(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "csv")
    text = adapter.click_events(spark, folder).select(*messages.text_fields())
    text.write.csv(path, header=True)
    return path


@query("csv_load", f"""
SELECT {sql_date('event_time')} AS event_date, {EVENT_SQL} FROM click""")
def csv_load(spark: SparkSession, folder: str) -> DataFrame:
    events = table_sources.csv_events(spark, _csv_folder(spark, folder))
    path = new_folder(spark, "csv_load")
    dated = events.withColumn("event_date", F.to_date("event_time"))
    table_sinks.write_table(dated, path, "append", ["event_date"])
    return table_sources.scan(spark, path)


@query("csv_to_messages", """
SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S.%f UTC') AS event_time, event_type,
  CAST(product_id AS VARCHAR) AS product_id, coalesce(brand, '') AS brand, CAST(price AS VARCHAR) AS price,
  'ecommerce_streaming_events' AS topic FROM click""")
def csv_to_messages(spark: SparkSession, folder: str) -> DataFrame:
    sent = messages.row_messages(table_sources.csv_rows(spark, _csv_folder(spark, folder)))
    fields = ("event_time", "event_type", "product_id", "brand", "price")
    text = F.col("value").cast("string")
    return sent.select(*[F.get_json_object(text, f"$.{c}").alias(c) for c in fields], "topic")


# --- writing ---------------------------------------------------------------

@query("write_partitioned", FACT_SQL)
def write_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    return table_sources.scan(spark, _stored_facts(spark, folder, "write_partitioned"))


@query("overwrite_partitions", f"""
SELECT * REPLACE (CASE WHEN event_date < '2024-01-16' THEN 0.0 ELSE price END AS price) FROM ({FACT_SQL})""")
def overwrite_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """A table of zero prices whose later half is then replaced by the real rows."""
    path = new_folder(spark, "overwrite_partitions")
    rows = facts(spark, folder)
    free = rows.withColumn("price", F.lit(0).cast("decimal(10,2)"))
    table_sinks.write_table(free, path, "overwrite", ["event_date"])
    later = rows.where(F.col("event_date") >= F.lit(date(2024, 1, 16)))
    table_sinks.overwrite_partitions(later, path, ["event_date"])
    return table_sources.scan(spark, path)


@query("compact_table", FACT_SQL)
def compact_table(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "compact_table")
    scattered = facts(spark, folder).repartition(4)
    scattered.write.partitionBy("event_date").parquet(path)
    maintenance.compact_table(spark, path, "event_date")
    return table_sources.scan(spark, path)


@query("zorder_table", FACT_SQL)
def zorder_table(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_facts(spark, folder, "zorder_table")
    maintenance.zorder_table(spark, path, "event_date", ["user_id", "product_id", "event_time", "brand"])
    return table_sources.scan(spark, path)


# --- upserts ---------------------------------------------------------------

@query("upsert_generic", """
SELECT coalesce(t.product_id, s.product_id) AS product_id,
  CASE WHEN t.product_id IS NULL OR s.price < t.price THEN CAST(s.price AS DOUBLE) ELSE CAST(t.price AS DOUBLE) END AS price,
  CASE WHEN t.product_id IS NULL OR s.price < t.price THEN s.size ELSE t.size END AS size
FROM (SELECT product_id, max(price) AS price, max(category_id) AS size FROM ordered GROUP BY product_id) t
FULL JOIN (SELECT p_partkey AS product_id, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
    CAST(p_size AS BIGINT) AS size FROM part) s ON t.product_id = s.product_id
WHERE t.product_id IS NOT NULL OR s.size >= 10""")
def upsert_generic(spark: SparkSession, folder: str) -> DataFrame:
    """List prices merged into the highest prices sold: lower ones update, big parts are added."""
    sold = adapter.order_events(spark, folder).groupBy("product_id").agg(
        F.max("price").alias("price"), F.max("category_id").alias("size")
    )
    listed = adapter.table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("p_size").cast("bigint").alias("size"),
    )
    return merge_rows(
        sold, listed, ("product_id",),
        update_condition="source.price < target.price", insert_condition="source.size >= 10",
    )


@query("upsert_events", f"""
SELECT {sql_date('event_time')} AS event_date, {EVENT_SQL}, event_id + 1000000000 AS kafka_offset
FROM (SELECT * REPLACE (price + 1 AS price) FROM good)
UNION ALL
SELECT {sql_date('event_time')} AS event_date, {EVENT_SQL}, event_id AS kafka_offset
FROM (SELECT * REPLACE (event_time + INTERVAL 1 DAY AS event_time) FROM good)""")
def upsert_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events; then all of them again, twice with rising prices, and as many a day later."""
    path = new_folder(spark, "upsert_events")
    first = valid_events(spark, folder).withColumnRenamed("event_id", "kafka_offset").withColumn(
        "kafka_partition", F.lit(0)
    )

    def resent(cents: int, offset: int) -> DataFrame:
        raised = F.col("price") + F.lit(cents).cast("decimal(5,0)") / 100
        return first.withColumns({
            "price": raised.cast("decimal(10,2)"), "kafka_offset": F.col("kafka_offset") + offset,
        })

    next_day = first.withColumn("event_time", F.col("event_time") + F.make_dt_interval(days=F.lit(1)))
    second = resent(50, 500_000_000).unionByName(resent(100, 1_000_000_000)).unionByName(next_day)
    for batch in (first, second):
        medallion.upsert_events(spark, path, working.prepare(batch))
    return table_sources.scan(spark, path).drop("event_key", "kafka_partition")


# --- zone jobs -------------------------------------------------------------

def _gold(spark: SparkSession, folder: str) -> str:
    """Working and gold zones of all events; returns the gold path."""
    base = new_folder(spark, "zones")
    prepared = working.prepare(valid_events(spark, folder)).withColumns({
        "kafka_offset": F.col("event_id"), "kafka_partition": F.lit(0),
    })
    dates = medallion.upsert_events(spark, f"{base}/working", prepared)
    medallion.gold_refresh(spark, f"{base}/working", f"{base}/gold", dates)
    return f"{base}/gold"


@query("gold_refresh", f"SELECT {DAILY_SQL} FROM days")
def gold_refresh(spark: SparkSession, folder: str) -> DataFrame:
    return table_sources.scan(spark, f"{_gold(spark, folder)}/agg_daily_events")


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    return working.prepare(valid_events(spark, folder)).withColumns({
        "kafka_offset": F.col("event_id"), "kafka_partition": F.lit(0),
    })


@query("gold_refresh_deletes", f"SELECT {DAILY_SQL} FROM days WHERE event_date <> (SELECT min(event_date) FROM days)")
def gold_refresh_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """The gold table after every event of the first day was deleted."""
    base = new_folder(spark, "zones")
    prepared = _prepared(spark, folder).withColumn("is_deleted", F.lit(False))
    first = prepared.agg(F.min("event_date")).first()[0]
    later = F.col("kafka_offset") + 1_000_000_000
    gone = prepared.where(F.col("event_date") == F.lit(first)).withColumns(
        {"is_deleted": F.lit(True), "kafka_offset": later})
    for batch in (prepared, gone):
        dates = medallion.upsert_events(spark, f"{base}/working", batch, apply_deletes=True)
        medallion.gold_refresh(spark, f"{base}/working", f"{base}/gold", dates)
    return table_sources.scan(spark, f"{base}/gold/agg_daily_events")


MOVE_KEY = ("user_id", "product_id", "event_type")


@query("gold_refresh_moves", """
SELECT '2030-01-01 00:00:00.000000'[1:10] AS event_date, count(*) AS total_events FROM
  (SELECT DISTINCT user_id, product_id, event_type FROM good)""")
def gold_refresh_moves(spark: SparkSession, folder: str) -> DataFrame:
    """Events keyed without their time, all moved to one later day; no earlier day stays in gold."""
    base = new_folder(spark, "zones")
    events = valid_events(spark, folder).withColumns({
        "kafka_offset": F.col("event_id"), "kafka_partition": F.lit(0),
    })
    moved = events.withColumns({
        "event_time": F.lit("2030-01-01 12:00:00").cast(events.schema["event_time"].dataType),
        "kafka_offset": F.col("kafka_offset") + 1_000_000_000,
    })
    for batch in (events, moved):
        dates = medallion.upsert_events(spark, f"{base}/working", working.prepare(batch, MOVE_KEY), MOVE_KEY)
        medallion.gold_refresh(spark, f"{base}/working", f"{base}/gold", dates)
    return table_sources.scan(spark, f"{base}/gold/agg_daily_events").select("event_date", "total_events")


@query("zorder_clustering", """
SELECT true AS fewer_brands, true AS fewer_sizes, (SELECT count(*) FROM part) AS rows_kept""")
def zorder_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the files of a table clustered by brand and size hold fewer values than the table."""
    path = new_folder(spark, "zorder_clustering")
    parts = adapter.table(spark, folder, "part").select("p_partkey", "p_brand", "p_size", F.lit(1).alias("p"))
    table_sinks.write_table(parts, path, "overwrite", ["p"])
    size = maintenance.file_sizes(spark, path, "p").first()["bytes"]
    maintenance.zorder_table(spark, path, "p", ["p_brand", "p_size"], target_bytes=max(1, size // 8))
    rows = table_sources.scan(spark, path)
    spread = rows.groupBy(F.input_file_name().alias("file")).agg(
        F.count_distinct("p_brand").alias("brands"), F.count_distinct("p_size").alias("sizes"), F.count("*").alias("n"))
    every = rows.agg(F.count_distinct("p_brand").alias("all_brands"), F.count_distinct("p_size").alias("all_sizes"))
    return spread.join(F.broadcast(every)).agg(
        (F.avg("brands") < F.first("all_brands")).alias("fewer_brands"),
        (F.avg("sizes") < F.first("all_sizes")).alias("fewer_sizes"), F.sum("n").alias("rows_kept"))


@query("register_gold", f"""
SELECT 'fact_events' AS table_name, {sql_date('event_date')} AS event_date, count(*) AS row_count
FROM fact GROUP BY fact.event_date
UNION ALL SELECT 'agg_daily_events', {sql_date('event_date')}, 1 FROM days
UNION ALL SELECT 'agg_product_daily', {sql_date('event_date')}, count(*) FROM product_days
GROUP BY product_days.event_date""")
def register_gold(spark: SparkSession, folder: str) -> DataFrame:
    path = _gold(spark, folder)
    schema = "gold_" + path.split("-")[-1].split("/")[0]
    names = catalog.register_gold(spark, path, schema)
    counts = [catalog.partition_rows(spark, name) for name in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
