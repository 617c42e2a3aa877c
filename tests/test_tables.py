import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from shoplake import params
from shoplake.operators import validation, working
from shoplake.operators.merge import merge_rows
from shoplake.operators.parsing import to_raw
from shoplake.plans import medallion
from shoplake.sinks import maintenance, tables
from shoplake.sources.messages import change_messages
from shoplake.sources.tables import csv_events, scan_day
from shoplake.workspace import session_settings


def files(path, partition):
    return [f for f in os.listdir(f"{path}/{partition}") if f.endswith(".parquet")]


def batch(events, *changes, key=params.DEDUP_KEY):
    """Prepared events; the position in the call is the offset."""
    rows = None
    for offset, change in enumerate(changes):
        row = events({k: v for k, v in change.items() if k != "offset"}).withColumns({
            "kafka_offset": F.lit(change.get("offset", offset)).cast("bigint"),
            "kafka_partition": F.lit(0),
        })
        rows = row if rows is None else rows.unionByName(row)
    return working.prepare(rows, key)


def prices(spark, path):
    return {r.user_id: str(r.price) for r in spark.read.parquet(path).collect()}


def test_upsert_takes_the_newest_copy_and_can_be_repeated(spark, events, tmp_path):
    path = str(tmp_path / "working")
    medallion.upsert_events(spark, path, batch(events, {"price": "1.00"}, {"price": "2.00"}, {"user_id": 8}))
    assert prices(spark, path) == {7: "2.00", 8: "9.99"}
    second = batch(events, {"price": "3.00"}, {"user_id": 9, "event_time": datetime(2024, 1, 2)})
    for _ in range(2):
        dates = medallion.upsert_events(spark, path, second)
        assert sorted(dates) == [date(2024, 1, 1), date(2024, 1, 2)]
        assert prices(spark, path) == {7: "3.00", 8: "9.99", 9: "9.99"}


def test_upsert_leaves_other_partitions_alone(spark, events, tmp_path):
    path = str(tmp_path / "working")
    medallion.upsert_events(spark, path, batch(events, {}, {"event_time": datetime(2024, 1, 5)}))
    before = files(path, "event_date=2024-01-05")
    medallion.upsert_events(spark, path, batch(events, {"price": "5.00"}))
    assert files(path, "event_date=2024-01-05") == before


def test_upsert_by_key_without_time_moves_rows(spark, events, tmp_path):
    path, key = str(tmp_path / "working"), ("user_id", "product_id")
    medallion.upsert_events(spark, path, batch(events, {}, {"user_id": 8}, key=key), key)
    later = {"event_time": datetime(2024, 1, 3), "price": "4.00"}
    for _ in range(2):
        medallion.upsert_events(spark, path, batch(events, later, {**later, "user_id": 8}, key=key), key)
        rows = spark.read.parquet(path).collect()
        assert {(r.user_id, r.event_date, str(r.price)) for r in rows} == {
            (7, date(2024, 1, 3), "4.00"), (8, date(2024, 1, 3), "4.00")}
        assert len(rows) == 2
    older = batch(events, {"event_time": datetime(2024, 1, 2), "price": "1.00"}, key=key)
    medallion.upsert_events(spark, path, older, key)
    assert prices(spark, path) == {7: "4.00", 8: "4.00"}


def test_deletes_apply_only_on_request(spark, events, tmp_path):
    path = str(tmp_path / "working")
    kept = batch(events, {}, {"user_id": 8}).withColumn("is_deleted", F.lit(False))
    medallion.upsert_events(spark, path, kept, apply_deletes=True)
    gone = batch(events, {}, {"user_id": 9}).withColumn("is_deleted", F.lit(True))
    medallion.upsert_events(spark, path, gone, apply_deletes=True)
    assert set(prices(spark, path)) == {8}


def test_merge_conditions(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (None, 0)], "k int, v int")
    source = spark.createDataFrame([(1, 11), (2, 5), (3, 30), (4, 1), (None, 9)], "k int, v int")
    merged = merge_rows(target, source, ("k",), "source.v > target.v", "source.v >= 9")
    assert sorted(merged.collect(), key=str) == sorted(
        [(1, 11), (2, 20), (3, 30), (None, 0), (None, 9)], key=str)
    every = merge_rows(target, source.where("k IS NOT NULL"), ("k",))
    assert {tuple(r) for r in every.collect()} == {(1, 11), (2, 5), (3, 30), (4, 1), (None, 0)}


def test_merge_with_a_hot_target_key(spark):
    target = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("k"), F.lit(0).alias("v"))
    source = spark.createDataFrame([(-1, 1), (5000, 2)], "k long, v int")
    merged = merge_rows(target, source, ("k",))
    assert merged.count() == 3001
    assert merged.where("v = 1").count() == 1000


def test_newest_per_key_with_a_hot_key(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"))
    newest = working.newest_per_key(rows, ("k",), ("at",))
    assert newest.count() == 6001
    assert newest.where("k = -1").first()["at"] == 8997


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    tables.write_table(rows, path, "errorifexists", ["p"])
    tables.write_table(rows, path, "ignore", ["p"])
    assert spark.read.parquet(path).count() == 2
    tables.write_table(rows, path, "append", ["p"])
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(Exception):
        tables.write_table(rows, path, "errorifexists")
    tables.write_table(rows.where("v = 1"), path, "overwrite")
    assert spark.read.parquet(path).count() == 1


def test_overwrite_replaces_only_given_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    tables.overwrite_partitions(rows, path, ["p"])
    tables.overwrite_partitions(spark.createDataFrame([(9, "b"), (8, "c")], rows.schema), path, ["p"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b"), (8, "c")}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch_id in (0, 1, 1, 0):
        tables.append_batch(spark.range(3), path, batch_id)
    assert spark.read.parquet(path).count() == 6


def test_compaction_keeps_rows_and_merges_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4000).select("id", (F.col("id") % 3).alias("p"))
    rows.repartition(6).write.partitionBy("p").parquet(path)
    maintenance.compact_table(spark, path, "p", where="p <> 2")
    assert [len(files(path, f"p={p}")) for p in range(3)] == [1, 1, 6]
    maintenance.compact_table(spark, path, "p")
    assert len(files(path, "p=2")) == 1
    before = files(path, "p=0")
    maintenance.compact_table(spark, path, "p")
    assert files(path, "p=0") == before
    assert spark.read.parquet(path).agg(F.sum("id"), F.count("*")).first() == (sum(range(4000)), 4000)


def test_a_second_compaction_rewrites_nothing_when_rows_compress(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60000).select(F.lit("the same text in every row").alias("t"), (F.col("id") % 50).alias("v"), F.lit(1).alias("p"))
    rows.repartition(24).write.partitionBy("p").parquet(path)
    maintenance.compact_table(spark, path, "p", target_bytes=4000)
    after = files(path, "p=1")
    assert len(after) < 24
    maintenance.compact_table(spark, path, "p", target_bytes=4000)
    assert files(path, "p=1") == after
    assert spark.read.parquet(path).count() == 60000


def test_zorder_tells_texts_with_one_beginning_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20000).select(
        F.lit(1).alias("p"), F.concat(F.lit("Brand#"), F.pmod(F.xxhash64("id"), F.lit(25))).alias("brand"))
    rows.write.partitionBy("p").parquet(path)
    size = sum(os.path.getsize(f"{path}/p=1/{f}") for f in files(path, "p=1"))
    maintenance.zorder_table(spark, path, "p", ["brand"], target_bytes=size // 8)
    spread = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count_distinct("brand").alias("n"))
    assert spread.agg(F.max("n")).first()[0] < 25 and spark.read.parquet(path).count() == 20000


def test_zorder_narrows_files_on_every_column(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20000).select(
        F.lit("x").alias("p"), F.col("id").alias("a"),
        F.pmod(F.xxhash64("id"), F.lit(20000)).alias("b"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    rows.write.partitionBy("p").parquet(path)
    size = sum(os.path.getsize(f"{path}/p=x/{f}") for f in files(path, "p=x"))
    maintenance.zorder_table(spark, path, "p", ["a", "b"], target_bytes=size // 8)
    table = spark.read.parquet(path)
    assert table.exceptAll(rows.select(*table.columns)).count() == 0 and table.count() == 20000
    spans = table.groupBy(F.input_file_name()).agg(
        (F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b"))
    widths = spans.agg(F.avg("a"), F.avg("b")).first()
    # Unclustered files span 20000 on at least one column.
    assert widths[0] < 15000 and widths[1] < 15000


def test_zorder_with_one_value(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.lit(1).alias("p"), F.lit(None).cast("int").alias("a"), F.lit("k").alias("b")).write.partitionBy("p").parquet(path)
    maintenance.zorder_table(spark, path, "p", ["a", "b"])
    assert spark.read.parquet(path).count() == 100


def test_day_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "v int, ingestion_date date")
    tables.write_table(rows, path, partition_by=["ingestion_date"])
    day = scan_day(spark, path, "2024-01-02")
    assert [r.v for r in day.collect()] == [2]
    assert len(day.inputFiles()) == 2  # listed, but the scan below reads one partition
    assert "PartitionFilters: [isnotnull(ingestion_date" in day._jdf.queryExecution().toString()


def test_csv_events(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(
        "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
        '2019-10-01 00:00:00 UTC,view,5,6,,"",35.79,541,abc\n'
        "never,cart,x,,a.b,acme,cheap,1,d\n")
    first, second = csv_events(spark, str(path)).collect()
    assert (first.event_time, first.product_id, first.price) == (datetime(2019, 10, 1), 5, Decimal("35.79"))
    assert (first.category_code, first.brand) == (None, "")
    assert (second.event_time, second.product_id, second.price, second.brand) == (None, None, None, "acme")


def test_gold_refresh_recomputes_whole_dates(spark, events, tmp_path):
    working_path, gold = str(tmp_path / "working"), str(tmp_path / "gold")
    buy = {"event_type": "purchase", "price": "10.00"}
    dates = medallion.upsert_events(spark, working_path, batch(events, buy, {}, {"event_time": datetime(2024, 1, 2)}))
    medallion.gold_refresh(spark, working_path, gold, dates)
    more = batch(events, {**buy, "user_id": 8})
    for _ in range(2):
        medallion.gold_refresh(spark, working_path, gold, medallion.upsert_events(spark, working_path, more))
        days = {str(r.event_date): r for r in spark.read.parquet(f"{gold}/agg_daily_events").collect()}
        assert (days["2024-01-01"].total_events, str(days["2024-01-01"].total_revenue)) == (3, "20.00")
        assert days["2024-01-02"].total_events == 1
        assert spark.read.parquet(f"{gold}/fact_events").count() == 4


def test_working_zone_from_raw_messages(spark, events, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "working")
    rows = events({}, {"user_id": 8}, {"price": None}).withColumn("n", F.monotonically_increasing_id())
    for day in ("2024-03-01", "2024-03-02"):
        tables.write_table(to_raw(change_messages(rows, offset="n"), f"{day} 06:00:00"), raw, partition_by=["ingestion_date"])
    quality = medallion.working_quality(spark, raw, "2024-03-01").first()
    assert (quality.total_records, quality.valid_records, quality.invalid_price) == (3, 2, 1)
    for day in ("2024-03-01", "2024-03-02"):
        assert medallion.working_upsert(spark, raw, path, day) == [date(2024, 1, 1)]
    assert spark.read.parquet(path).count() == 2
    assert medallion.ingested_dates(spark, path, "2024-03-02") == [date(2024, 1, 1)]
    assert medallion.ingested_dates(spark, path, "2024-03-01") == []


def test_rules_reach_the_scan(spark, events, tmp_path):
    path = str(tmp_path / "t")
    events({}).write.parquet(path)
    with session_settings(spark, spark__sql__maxMetadataStringLength="2000"):
        plan = validation.valid(spark.read.parquet(path)).select("user_id")._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    for part in ("GreaterThan(user_id,0)", "In(event_type", "GreaterThanOrEqual(price,0.01)"):
        assert part in pushed
    assert "user_session" not in plan[plan.index("ReadSchema"):]


def test_upsert_by_a_key_with_missing_values(spark, events, tmp_path):
    path, key = str(tmp_path / "working"), ("event_time", "user_session")
    for price in ("1.00", "2.00"):
        rows = batch(events, {"user_session": None, "price": price}, {"user_session": "x"}, key=key)
        medallion.upsert_events(spark, path, rows, key)
    assert sorted(str(r.price) for r in spark.read.parquet(path).collect()) == ["2.00", "9.99"]


def test_upsert_of_an_empty_batch(spark, events, tmp_path):
    path = str(tmp_path / "working")
    empty = batch(events, {}).where("false")
    assert medallion.upsert_events(spark, path, empty) == []
    medallion.upsert_events(spark, path, batch(events, {}))
    assert medallion.upsert_events(spark, path, empty) == []
    assert spark.read.parquet(path).count() == 1


def test_partitions_are_written_side_by_side_without_sorting_whole_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(40).select("id", (F.col("id") % (tables.OPEN_PARTITIONS + 4)).alias("part"))
    settings = []
    write = DataFrameWriter.parquet

    def seen(self, path, *args, **options):
        settings.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    tables.write_table(rows, f"{tmp_path}/table", "overwrite", ["part"])
    tables.overwrite_partitions(rows, f"{tmp_path}/replaced", ["part"])
    tables.append_batch(rows, f"{tmp_path}/batches", 0, ["part"])
    assert settings == [str(tables.OPEN_PARTITIONS)] * 3
    # More partitions than are open at once: the rest is sorted, nothing is lost.
    for name in ("table", "replaced", "batches"):
        stored = spark.read.parquet(f"{tmp_path}/{name}").select("id", "part")
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
