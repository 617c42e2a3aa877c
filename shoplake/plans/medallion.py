"""Batch jobs between the raw, working and gold zones."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake import params
from shoplake.operators.gold import agg_daily_events, agg_product_daily, fact_events
from shoplake.operators.merge import GUARD_NEWER
from shoplake.operators.parsing import flatten_raw
from shoplake.operators.validation import REQUIRED, quality_counts, valid
from shoplake.operators.working import NEWEST_FIRST, newest_per_key, prepare
from shoplake.sinks.tables import (
    drop_partitions, in_partitions, overwrite_partitions, partition_values, table_exists, upsert_table,
)
from shoplake.sources.tables import scan, scan_day

IS_DELETED = "source.is_deleted"


def upsert_events(
    spark: SparkSession,
    working_path: str,
    prepared: DataFrame,
    key: tuple[str, ...] = params.DEDUP_KEY,
    apply_deletes: bool = False,
) -> list[date]:
    """Merges prepared events into the working table and returns the event dates touched.

    Those are the dates the events carry and the dates that rows moved away from.

    Copies inside the batch are reduced to the newest first. A key with the
    event time fixes the date, so the merge stays inside the batch's dates.
    Rows are matched by the key's own columns where those are never null: they
    sort and hash far faster than their joined text ``event_key``, whose first
    characters are all alike.
    """
    fixed_date = "event_time" in key
    keys = tuple(key) if set(key) <= REQUIRED else ("event_key",)
    if fixed_date:
        keys += ("event_date",)
    deletes = {}
    if apply_deletes:
        deletes = {"delete_condition": IS_DELETED, "insert_condition": f"NOT {IS_DELETED}"}
    return upsert_table(
        spark, working_path, newest_per_key(prepared, keys, NEWEST_FIRST), keys, "event_date",
        update_condition=GUARD_NEWER, moves_partition=not fixed_date, **deletes,
    )


def working_upsert(
    spark: SparkSession,
    raw_path: str,
    working_path: str,
    ingestion_date: date | str | None = None,
    key: tuple[str, ...] = params.DEDUP_KEY,
    apply_deletes: bool = False,
) -> list[date]:
    """One raw ingestion day, flattened and validated, into the working table."""
    flat = flatten_raw(scan_day(spark, raw_path, ingestion_date), apply_deletes)
    return upsert_events(spark, working_path, prepare(valid(flat), key), key, apply_deletes)


def working_quality(
    spark: SparkSession, raw_path: str, ingestion_date: date | str | None = None
) -> DataFrame:
    """Data-quality counts of one raw ingestion day."""
    return quality_counts(flatten_raw(scan_day(spark, raw_path, ingestion_date)))


def ingested_dates(
    spark: SparkSession, working_path: str, ingestion_date: date | str
) -> list[date]:
    """Event dates with rows of an ingestion day, for a refresh without the upsert's list."""
    rows = scan(spark, working_path).where(F.col("ingestion_date") == F.lit(str(ingestion_date)).cast("date"))
    return partition_values(rows, "event_date")


def gold_refresh(
    spark: SparkSession, working_path: str, gold_path: str, dates: Sequence[date]
) -> None:
    """Recomputes the gold tables for whole event dates and replaces those partitions.

    The aggregates read the fact partitions just written, so each reads only
    its own columns and nothing needs to be cached. Dates that the working table no
    longer has are removed from the gold tables.
    """
    aggregates = {"agg_daily_events": agg_daily_events, "agg_product_daily": agg_product_daily}
    facts_path = f"{gold_path}/fact_events"
    left = partition_values(scan(spark, working_path).where(in_partitions("event_date", dates)), "event_date")
    emptied = [day for day in dates if day not in left]
    for path in (facts_path, *(f"{gold_path}/{name}" for name in aggregates)):
        if emptied and table_exists(spark, path):
            drop_partitions(spark, path, "event_date", emptied)
    if not left:
        return
    touched = in_partitions("event_date", left)
    overwrite_partitions(
        fact_events(scan(spark, working_path).where(touched)), facts_path, ["event_date"]
    )
    facts = scan(spark, facts_path).where(touched)
    for name, aggregate in aggregates.items():
        overwrite_partitions(aggregate(facts), f"{gold_path}/{name}", ["event_date"])
