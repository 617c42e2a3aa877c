"""Folding what streams appended batch by batch into one generation of files.

Streams write ``stream=<id>/batch_id=<n>`` folders. A fold merges all of them but the
newest of each stream, which a restart may write once more, with what earlier folds
made, and puts the result in their place as ``stream=folded/batch_id=<turn>``. A crash counts
nothing twice: the replacement is journalled, and done again or undone by the next fold.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.operators.rollups import ROLLUPS, merge_states
from shoplake.sinks.replace import commit, recover, staging
from shoplake.sinks.tables import table_exists, table_files, write_table

FOLDED = "folded"


def fold(
    spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()
) -> int:
    """Folds the batches of the table at ``path``; returns how many folders became one.

    ``merge`` gets the rows of the folded batches. Nothing happens while there is nothing new.
    """
    if not table_exists(spark, path):
        return 0
    recover(spark, path)
    batches = table_files(spark, path).select(
        F.col("stream").cast("string").alias("stream"), F.col("batch_id").cast("bigint").alias("batch_id"),
        F.regexp_extract("path", "^(.*/stream=[^/]*/batch_id=[^/]*)/", 1).alias("folder")).distinct()
    marks = {row["stream"]: row["mark"] for row in batches.groupBy("stream").agg(F.max("batch_id").alias("mark")).collect()}
    turn = marks.pop(FOLDED, -1) + 1
    older = F.lit(False)
    for stream, mark in marks.items():
        older = older | ((F.col("stream") == stream) & (F.col("batch_id") < mark))
    if batches.where(older).isEmpty():
        return 0
    covered = older | (F.col("stream") == FOLDED)
    old = [row[0] for row in batches.where(covered).select("folder").collect()]
    staged = staging(path)
    rows = spark.read.parquet(path).where(covered).drop("stream", "batch_id")
    write_table(merge(rows), f"{staged}/data", "overwrite", partition_by)
    commit(spark, staged, old, [(f"{staged}/data", f"{path}/stream={FOLDED}/batch_id={turn}")])
    return len(old)


def fold_states(spark: SparkSession, path: str, rollups: Sequence[str] = tuple(ROLLUPS)) -> dict[str, int]:
    """Merges the partial states that a stream of batches left of each rollup."""
    return {name: fold(spark, f"{path}/{name}", lambda rows, name=name: merge_states(rows, name)) for name in rollups}


def fold_raw(spark: SparkSession, raw_path: str) -> int:
    """Joins the raw zone's batches; its rows stay as they are, by ingestion date."""
    return fold(spark, raw_path, lambda rows: rows, ["ingestion_date"])
