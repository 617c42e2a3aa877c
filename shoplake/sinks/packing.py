"""Bin-pack compaction: only files below the target size are read and rewritten.

Works on the file listing, in partition folders of any depth. Small files of a folder are
packed first-fit-decreasing; every bin of two files or more becomes one file, written by one
task. Files at or above the target, and small ones that fit with no other, stay as they are.
"""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from shoplake.sinks.replace import commit, discard, recover, staging
from shoplake.sinks.tables import table_files

TARGET_FILE_BYTES = 128 * 1024 * 1024


def first_fit_decreasing(sizes: Sequence[int], room: int) -> list[int]:
    """The bin of every item, for items from large to small: the first that has room, else a new one."""
    left, used, found = np.zeros(len(sizes), np.int64), 0, []
    for size in sizes:
        fits = left[:used] >= size
        place = int(fits.argmax()) if fits.any() else used
        if place == used:
            left[used] = room
            used += 1
        left[place] -= size
        found.append(place)
    return found


def packed(items: DataFrame, group: str, size: str, name: str, room: int) -> DataFrame:
    """The items with their ``bin`` in the group, numbered from 0; equal sizes go by name.

    A group is the listing of one folder: a narrow row for each file.
    """
    def pack(rows):
        rows = rows.sort_values([size, name], ascending=[False, True], kind="stable")
        return rows.assign(bin=np.array(first_fit_decreasing(rows[size].tolist(), room), "int32"))

    schema = T.StructType([*items.schema.fields, T.StructField("bin", T.IntegerType())])
    return items.groupBy(group).applyInPandas(pack, schema)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """``file, path, folder, length`` of every data file; no data is read."""
    return table_files(spark, path).select(
        F.col("_metadata.file_path").alias("file"), "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "length")


def plan(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """The listing with ``bin``, the number of the new file; null for files that stay."""
    files = listing(spark, path)
    small = packed(files.where(F.col("length") < target_bytes), "folder", "length", "file", target_bytes)
    several = small.groupBy("folder", "bin").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # one row for each new file
    numbered = several.withColumn("id", F.row_number().over(Window.orderBy("folder", "bin")) - 1)
    chosen = small.join(numbered, ["folder", "bin"]).select("file", "id")
    return files.join(chosen, "file", "left").withColumnRenamed("id", "bin")


def rewritten_files(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """For each folder the files that a compaction would keep, rewrite and make."""
    return plan(spark, path, target_bytes).groupBy("folder").agg(
        F.count_if(F.col("bin").isNull()).alias("files_kept"), F.count("bin").alias("files_rewritten"),
        F.count_distinct("bin").alias("files_made"))


def compact_files(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Packs small files until no two of a folder fit together; returns the number of files rewritten.

    Rows packed together may compress better, so the listing is looked at again until
    nothing fits; every turn leaves fewer files, and a later run finds nothing to do. The
    rows of a new file keep the order they had in the old ones.
    """
    recover(spark, path)
    total = 0
    while True:
        staged = staging(path)
        plan(spark, path, target_bytes).where("bin IS NOT NULL").write.parquet(f"{staged}/plan")
        chosen = spark.read.parquet(f"{staged}/plan")
        count = chosen.agg(F.max("bin")).first()[0]
        if count is None:
            discard(spark, staged)
            return total
        # the filter on sizes keeps large files out of the scan; folders give the partition columns
        rows = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path).where(
            F.col("_metadata.file_size") < target_bytes)
        placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        names = chosen.select(F.col("file").alias("_file"), F.col("bin").alias("_bin"))
        (
            placed.join(names, "_file").repartitionById(count + 1, F.col("_bin")).sortWithinPartitions("_bin", "_file", "_row")
            .drop("_file", "_row").write.partitionBy("_bin").parquet(f"{staged}/data")
        )
        made = table_files(spark, f"{staged}/data").select("path", F.col("_bin").alias("bin"))
        folders = chosen.select("bin", "folder").distinct()
        old = [row[0] for row in chosen.select("path").collect()]
        run = staged.rsplit("/", 1)[1]
        moves = [(row["path"], f"{row['folder']}/packed-{run}-{row['bin']}-{n}.parquet")
                 for n, row in enumerate(made.join(folders, "bin").collect())]
        commit(spark, staged, old, moves)
        total += len(old)
