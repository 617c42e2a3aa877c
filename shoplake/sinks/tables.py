"""Partitioned Parquet writes, idempotent batch appends and keyed upserts.

One job writes a table at a time. Partition replacement is safe to repeat: a
rerun with the same input leaves the same table.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplake.operators.merge import merge_rows
from shoplake.workspace import new_folder, session_settings

# Partitions a task writes side by side. Only rows of further ones are sorted first, which
# holds them in memory: small files of like messages unpack to many times their size.
OPEN_PARTITIONS = 16


def _balanced(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups rows by the columns for writing.

    The rebalance hint lets AQE split a hot partition over several tasks and
    files and join small ones, unlike a plain hash repartition.
    """
    return rows.hint("rebalance", *columns) if columns else rows


def _side_by_side(rows: DataFrame):
    return session_settings(rows.sparkSession, spark__sql__maxConcurrentOutputFileWriters=str(OPEN_PARTITIONS))


def write_table(
    rows: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> None:
    """Writes Parquet; ``mode`` is append, overwrite, ignore or errorifexists.

    ``cluster_by`` (default: the partition columns) groups rows before writing.
    """
    writer = _balanced(rows, cluster_by or partition_by).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _side_by_side(rows):
        writer.parquet(path)


def overwrite_partitions(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces exactly the partitions that occur in ``rows``."""
    writer = (
        _balanced(rows, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
    )
    with _side_by_side(rows):
        writer.parquet(path)


def append_batch(
    rows: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()
) -> None:
    """Appends one micro-batch under its stream and batch id, so a replayed batch replaces itself.

    The stream's id lives in its checkpoint: a stream started over with a new
    checkpoint counts its batches from 0 again and must not replace old ones.
    The tasks that hold the batch write it as it is, without another shuffle.
    """
    stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    folder = f"{path}/stream={stream}/batch_id={batch_id}"
    with _side_by_side(rows):
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def _location(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def table_exists(spark: SparkSession, path: str) -> bool:
    files, location = _location(spark, path)
    return files.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    files, location = _location(spark, path)
    files.delete(location, True)


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file with its path, length and partition values; no data is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.drop("content", "modificationTime")


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence) -> None:
    """Removes whole partition folders; those the table lacks are ignored."""
    folder = F.regexp_extract("path", f"^(.*/{column}=[^/]*)/", 1)
    for row in table_files(spark, path).where(in_partitions(column, values)).select(folder).distinct().collect():
        remove(spark, row[0])


def partition_values(rows: DataFrame, column: str) -> list:
    """Distinct values of a partition column: as many as the rows have partitions."""
    return [row[0] for row in rows.select(column).distinct().collect()]


def in_partitions(column: str, values: Sequence) -> Column:
    """Literal partition filter, so that the scan lists only these partitions."""
    known = [v for v in values if v is not None]
    wanted = F.col(column).isin(known)
    return wanted | F.col(column).isNull() if len(known) < len(values) else wanted


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_column: str,
    update_condition: str | None = None,
    insert_condition: str | None = None,
    delete_condition: str | None = None,
    moves_partition: bool = False,
) -> list:
    """Merges ``source`` (one row per key) into the table and returns the partitions touched.

    Those are the source's own and those that rows left for another one.

    The source is stored once in the shared folder: the merge reads it several
    times, and its stored size tells Spark whether to broadcast it.
    """
    staged = new_folder(spark, "upsert")
    try:
        write_table(source, staged, "overwrite", [partition_column])
        stored = spark.read.schema(source.schema).parquet(staged)
        values = partition_values(stored, partition_column)
        if values:
            values = _merge_into(
                spark, path, stored, values, keys, partition_column,
                update_condition, insert_condition, delete_condition, moves_partition,
            )
        return values
    finally:
        remove(spark, staged)


def _merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    source_values: list,
    keys: Sequence[str],
    partition_column: str,
    update_condition: str | None,
    insert_condition: str | None,
    delete_condition: str | None,
    moves_partition: bool,
) -> list:
    """Rewrites the touched partitions of the table, or creates it; returns them.

    By default the key determines the partition, so matches lie in the source's
    own partitions and only those are read. With ``moves_partition`` a match may
    lie anywhere: the index of the keys' locations tells where, and the partitions
    that rows leave are rewritten too.
    """
    from shoplake.sinks import locations

    if not table_exists(spark, path):
        fresh = source.alias("source")
        if insert_condition is not None:
            fresh = fresh.where(F.expr(insert_condition))
        locations.drop(spark, path)
        write_table(fresh, path, "overwrite", [partition_column])
        return source_values

    target = spark.read.parquet(path)
    values = set(source_values)
    if moves_partition:
        values |= set(locations.add(spark, path, source, keys, partition_column))
    else:
        locations.drop(spark, path)
    merged = merge_rows(
        target.where(in_partitions(partition_column, sorted(values, key=str))),
        source, tuple(keys), update_condition, insert_condition, delete_condition,
    )

    # A partition can end up empty, and the overwrite leaves such a one alone:
    # it is removed after the rewrite. Repeating the whole upsert is harmless.
    emptied = []
    if moves_partition or delete_condition is not None:
        emptied = list(values - set(partition_values(merged, partition_column)))
    overwrite_partitions(merged, path, [partition_column])
    if emptied:
        drop_partitions(spark, path, partition_column, emptied)
    if moves_partition:
        locations.settle(spark, path, source, keys, partition_column, sorted(values, key=str))
    return sorted(values, key=str)
