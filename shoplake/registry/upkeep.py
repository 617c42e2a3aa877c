"""Upkeep of tables and states: packing, folding, bounded stream state, sets of users."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.operators import parsing, rollups
from shoplake.registry.base import facts, query, sql_date, valid_events
from shoplake.registry.serving import KPI_SQL, KPI_SUMS
from shoplake.registry.streams import DELIVERIES, deliveries, run, state_partitions
from shoplake.sinks import clustering, packing
from shoplake.sources.adapter import click_events, table
from shoplake.sources.kafka import file_stream
from shoplake.sources.messages import change_messages, event_messages
from shoplake.sources.tables import scan
from shoplake.streaming import folding, ingest, routing, views
from shoplake.streaming.dedup import deduplicated
from shoplake.streaming.jobs import start_parquet
from shoplake.workspace import new_folder

ROOM = 400_000


@query("bin_packing", f""",
item AS (SELECT p_brand, p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS size FROM part),
placed AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY size DESC, p_partkey) AS i FROM item),
steps AS (WITH RECURSIVE s(p_brand, i, p_partkey, place, room) AS (
  SELECT DISTINCT p_brand, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM item
  UNION ALL
  SELECT p_brand, i, p_partkey, place, CASE WHEN place > len(room) THEN room || [{ROOM} - size]
    ELSE [CASE WHEN k = place THEN room[k] - size ELSE room[k] END FOR k IN range(1, len(room) + 1)] END
  FROM (SELECT x.*, s.room, CAST(coalesce(nullif(list_position([v >= x.size FOR v IN s.room], true), 0), len(s.room) + 1) AS BIGINT) AS place
    FROM s JOIN placed x ON x.p_brand = s.p_brand AND x.i = s.i + 1)) SELECT * FROM s)
SELECT p_brand, p_partkey, place - 1 AS bin FROM steps WHERE i > 0""")
def bin_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The packing of compaction over sizes that SQL can see: each brand's parts by price."""
    parts = table(spark, folder, "part").select(
        "p_brand", F.col("p_partkey").cast("bigint").alias("p_partkey"), F.round(F.col("p_retailprice") * 100).cast("bigint").alias("size"))
    return packing.packed(parts, "p_brand", "size", "p_partkey", ROOM).drop("size")


@query("compact_files", f"""
SELECT {sql_date('event_date')} AS event_date, count(*) AS row_count, CAST(sum(price) AS DOUBLE) AS total_price,
  true AS fewer_files, true AS settled FROM fact GROUP BY fact.event_date""")
def compact_files(spark: SparkSession, folder: str) -> DataFrame:
    """Facts in many files below two levels of folders, packed; then packed again, which must find nothing."""
    path = new_folder(spark, "compact_files")
    rows = facts(spark, folder).withColumn("month", F.date_format("event_date", "yyyy-MM"))
    rows.repartition(4).write.partitionBy("month", "event_date").parquet(path)
    before = packing.listing(spark, path).count()
    packing.compact_files(spark, path)
    after = packing.listing(spark, path).count()
    again = packing.compact_files(spark, path)
    return scan(spark, path).groupBy("event_date").agg(
        F.count("*").alias("row_count"), F.sum("price").cast("double").alias("total_price")
    ).withColumns({"fewer_files": F.lit(after < before), "settled": F.lit(again == 0)})


MICROS_SQL = f"SELECT {KPI_SUMS} FROM ({KPI_SQL})"


@query("states_folded", MICROS_SQL)
def states_folded(spark: SparkSession, folder: str) -> DataFrame:
    """Daily states of five batches, folded after each batch but the first."""
    path, events = new_folder(spark, "states"), valid_events(spark, folder)
    for batch in range(5):
        part = events.where(F.pmod("event_id", F.lit(5)) == batch)
        views.append_states(part, batch, path, ("daily",))
        if batch:
            folding.fold_states(spark, path, ("daily",))
    return views.current(spark, path, "daily").drop("daily_unique_users", "unique_users_buy")


@query("raw_folded", """
SELECT event_id AS "offset", event_type, epoch_us(event_time) AS event_micros, '2024-02-01' AS ingestion_date FROM click""")
def raw_folded(spark: SparkSession, folder: str) -> DataFrame:
    """The raw zone after a fold between deliveries and one at the end."""
    path = new_folder(spark, "raw")

    def start(stream: DataFrame, checkpoint: str):
        folding.fold_raw(spark, path)
        return ingest.raw_ingest(stream, path, checkpoint, "2024-02-01 00:00:00")

    run(spark, deliveries(change_messages(click_events(spark, folder)), DELIVERIES + 1), start)
    folding.fold_raw(spark, path)
    return scan(spark, path).select(
        "offset", "data.payload.event_type", F.col("data.payload.event_time").alias("event_micros"), "ingestion_date")


@query("stream_dedup_untimed_key", "SELECT DISTINCT user_id, product_id, event_type FROM click WHERE event_time IS NOT NULL")
def stream_dedup_untimed_key(spark: SparkSession, folder: str) -> DataFrame:
    """One row per user, product and type within a watermark longer than the data."""
    path = new_folder(spark, "stream_dedup")

    def start(stream: DataFrame, checkpoint: str):
        events = parsing.parse_events(stream, keep=routing.POSITION)
        once = deduplicated(events, ("user_id", "product_id", "event_type"), "400 days")
        return start_parquet(once, checkpoint, path, state_partitions=state_partitions(spark))

    run(spark, deliveries(event_messages(click_events(spark, folder)), again=True), start)
    return scan(spark, path).select("user_id", "product_id", "event_type")


@query("stream_sessions_closed", """,
seen AS (SELECT DISTINCT event_time, user_id, product_id, event_type, user_session FROM good),
cut AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first
  FROM seen WINDOW w AS (PARTITION BY user_session, user_id ORDER BY event_time)),
visit AS (SELECT *, sum(first) OVER (PARTITION BY user_session, user_id ORDER BY event_time) AS n FROM cut)
SELECT user_session, user_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S.%f') AS session_start_time,
  strftime(max(event_time), '%Y-%m-%d %H:%M:%S.%f') AS session_end_time,
  CAST(max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS has_purchase, count(*) AS total_events,
  strftime(min(event_time), '%Y-%m-%d') AS event_date,
  date_diff('second', min(event_time), max(event_time)) AS session_duration_sec
FROM visit GROUP BY user_session, user_id, n HAVING max(event_time) + INTERVAL 30 MINUTE <=
  (SELECT max(date_trunc('millisecond', event_time)) FROM click) - INTERVAL 5 MINUTE""")
def stream_sessions_closed(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "sessions")

    def start(stream: DataFrame, checkpoint: str):
        return views.closed_sessions(stream, checkpoint, path, state_partitions=state_partitions(spark))

    run(spark, deliveries(event_messages(click_events(spark, folder)), again=True), start)
    return scan(spark, path)


RETURNING_SQL = f""",
day AS (SELECT DISTINCT CAST(event_time AS DATE) AS event_date, user_id, bool_or(event_type = 'view') AS viewed,
  bool_or(event_type = 'purchase') AS bought FROM good GROUP BY 1, 2)
SELECT {sql_date('d.event_date')} AS event_date, count(*) AS users, count(b.user_id) AS returning_users,
  count(*) FILTER (d.viewed AND NOT d.bought) AS viewers_only
FROM day d LEFT JOIN day b ON b.user_id = d.user_id AND b.event_date = d.event_date - 1 GROUP BY d.event_date"""


@query("returning_users", RETURNING_SQL)
def returning_users(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.returning_users_exact(valid_events(spark, folder))


@query("returning_users_theta_error", """
SELECT count(DISTINCT CAST(event_time AS DATE)) AS days, true AS within FROM good""")
def returning_users_theta_error(spark: SparkSession, folder: str) -> DataFrame:
    """Whether merged theta states of three batches stay within a tenth of the day's users."""
    events = valid_events(spark, folder)
    path = new_folder(spark, "user_sets")
    rollups.user_set_states(events).limit(0).write.parquet(path)
    for batch in range(3):
        rollups.user_set_states(events.where(F.pmod("event_id", F.lit(3)) == batch)).write.mode("append").parquet(path)
    found = rollups.returning_users(rollups.merge_user_sets(scan(spark, path)))
    exact = rollups.returning_users_exact(events).select(
        "event_date", F.col("users").alias("u"), F.col("returning_users").alias("r"), F.col("viewers_only").alias("v"))
    near = [F.abs(F.col(a) - F.col(b)) <= F.col("u") / 10 for a, b in (("users", "u"), ("returning_users", "r"), ("viewers_only", "v"))]
    return found.join(exact, "event_date", "full").agg(
        F.count("event_date").alias("days"), F.bool_and(near[0] & near[1] & near[2]).alias("within"))


PART_RANGES = {"p_size": (10, 15), "p_retailprice": (1000.0, 1100.0)}


@query("cluster_files", f"""
SELECT {sql_date('event_date')} AS event_date, count(*) AS row_count, CAST(sum(price) AS DOUBLE) AS total_price,
  true AS settled FROM fact GROUP BY fact.event_date""")
def cluster_files(spark: SparkSession, folder: str) -> DataFrame:
    """Facts that arrive in two parts, clustered after each; a third run must find nothing."""
    path, columns = new_folder(spark, "cluster_files"), ["user_id", "product_id", "brand"]
    rows = facts(spark, folder)
    for part in (F.col("user_id") % 4 != 0, F.col("user_id") % 4 == 0):
        rows.where(part).write.mode("append").partitionBy("event_date").parquet(path)
        clustering.cluster_files(spark, path, columns)
    settled = clustering.cluster_files(spark, path, columns) == 0
    return scan(spark, path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("price").alias("total_price"), F.lit(settled).alias("settled"))


@query("cluster_skipping", """
SELECT pieces, (SELECT count(*) FROM part WHERE p_size BETWEEN 10 AND 15 AND p_retailprice BETWEEN 1000 AND 1100) AS matching,
  (SELECT count(*) FROM part) AS row_count, true AS skips_half FROM (VALUES (16), (64)) AS t(pieces)""")
def cluster_skipping(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a filter on two columns meets the bounds of at most half of the files, at two file sizes."""
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_size", F.col("p_retailprice").cast("double").alias("p_retailprice"))
    results = []
    for pieces in (16, 64):
        path = new_folder(spark, "cluster_skipping")
        parts.write.parquet(path)
        size = packing.listing(spark, path).agg(F.sum("length")).first()[0]
        clustering.cluster_files(spark, path, list(PART_RANGES), max(1, size // pieces))
        rows = spark.read.parquet(path)
        matching = F.lit(True)
        for column, (low, high) in PART_RANGES.items():
            matching = matching & F.col(column).between(low, high)
        found = rows.agg(F.count_if(matching).alias("matching"), F.count(F.lit(1)).alias("row_count"))
        opened = clustering.files_opened(rows, PART_RANGES)
        results.append(found.join(opened).select(
            F.lit(pieces).alias("pieces"), "matching", "row_count",
            (F.col("opened") * 2 <= F.col("files")).alias("skips_half")))
    return results[0].unionByName(results[1])
