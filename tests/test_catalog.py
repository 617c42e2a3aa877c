from datetime import datetime

from pyspark.sql import functions as F

from shoplake import schemas
from shoplake.operators import working
from shoplake.plans import medallion
from shoplake.sinks import catalog
from shoplake.workspace import new_folder, session_settings, shared_root


def prepared(events, *changes):
    return working.prepare(events(*changes)).withColumns({
        "kafka_offset": F.monotonically_increasing_id(), "kafka_partition": F.lit(0)})


def test_gold_tables_are_registered_and_synchronised(spark, events, tmp_path):
    work, gold = str(tmp_path / "working"), str(tmp_path / "gold")
    for day in (1, 2):
        rows = prepared(events, {"event_time": datetime(2024, 1, day)}, {"event_time": datetime(2024, 1, day), "user_id": 9})
        medallion.gold_refresh(spark, work, gold, medallion.upsert_events(spark, work, rows))
        names = catalog.register_gold(spark, gold, "shop_gold")
        assert len(names) == len(schemas.GOLD_TABLES)
        counts = {str(r.event_date): r.row_count for r in catalog.partition_rows(spark, "shop_gold.fact_events").collect()}
        assert counts == {f"2024-01-0{d}": 2 for d in range(1, day + 1)}
    assert spark.table("shop_gold.agg_daily_events").where("event_date = '2024-01-02'").first().total_users == 2
    assert spark.table("shop_gold.agg_product_daily").schema["revenue"].dataType.simpleString() == "decimal(20,2)"
    assert "shop_gold" in {r[0] for r in catalog.list_schemas(spark).collect()}
    assert "spark_catalog" in {r[0] for r in catalog.list_catalogs(spark).collect()}


def test_workspace_uses_the_sessions_checkpoint_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_settings(spark, spark__sql__shuffle__partitions="3", spark__sql__some__unset="1"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.some.unset", None) is None
