"""Where the keys of a table lie: an index for upserts whose keys may change partition.

Kept beside the table as ``key_hash, <partition column>``, in buckets of the hash, of
which an upsert reads only those of its own keys. How many there are follows from the
keys when the index is built, and is part of its folders' names. It may name too many partitions, which
are then searched in vain, but never too few: places to come are added before the table
is written, and places left behind are taken out afterwards.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.sinks.tables import in_partitions, overwrite_partitions, partition_values, remove, table_exists

KEYS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 4096


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}.locations"


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumns({"buckets": F.lit(buckets), "bucket": F.pmod("key_hash", F.lit(buckets)).cast("int")})


def _replace(rows: DataFrame, path: str, buckets: int) -> None:
    overwrite_partitions(_dealt(rows, buckets), index_path(path), ["buckets", "bucket"])


def places(rows: DataFrame, keys: Sequence[str], partition_column: str) -> DataFrame:
    return rows.select(F.xxhash64(*keys).alias("key_hash"), partition_column).distinct()


def drop(spark: SparkSession, path: str) -> None:
    """For writers that do not keep the index: it is built again when it is needed."""
    if table_exists(spark, index_path(path)):
        remove(spark, index_path(path))


def known(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_column: str
) -> tuple[DataFrame, int]:
    """The index's rows in the buckets of the source's keys, and the number of buckets.

    Builds an index that is not there.
    """
    if not table_exists(spark, index_path(path)):
        every = places(spark.read.parquet(path), keys, partition_column)
        _replace(every, path, min(MOST_BUCKETS, every.count() // KEYS_PER_BUCKET + 1))
    index = spark.read.parquet(index_path(path))
    count = index.select("buckets").first()[0]
    touched = partition_values(_dealt(places(source, keys, partition_column), count), "bucket")
    return index.where(in_partitions("bucket", touched)).select("key_hash", partition_column), count


def add(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_column: str) -> list:
    """Adds the source's places and returns the partitions that hold its keys so far."""
    own = places(source, keys, partition_column)
    before, count = known(spark, path, source, keys, partition_column)
    found = partition_values(before.join(own.select("key_hash"), "key_hash", "left_semi"), partition_column)
    _replace(before.union(own).distinct(), path, count)
    return found


def settle(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_column: str, values: Sequence) -> None:
    """Takes out the places that the source's keys left; ``values`` are the partitions written."""
    own = places(source, keys, partition_column).select("key_hash").distinct()
    before, count = known(spark, path, source, keys, partition_column)
    table = spark.read.parquet(path).where(in_partitions(partition_column, values))
    now = places(table, keys, partition_column).join(own, "key_hash", "left_semi")
    _replace(before.join(own, "key_hash", "left_anti").union(now), path, count)
