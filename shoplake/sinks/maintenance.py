"""Compaction and Z-order clustering of partitioned Parquet tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shoplake.sinks.tables import in_partitions, table_files

TARGET_FILE_BYTES = 128 * 1024 * 1024
Z_BITS = 6


def file_sizes(spark: SparkSession, path: str, partition_column: str) -> DataFrame:
    """Files and bytes per partition, from the file listing alone (no data is read)."""
    return table_files(spark, path).groupBy(partition_column).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def _wanted_files(target_bytes: int) -> Column:
    return F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("bigint")


def compact_table(
    spark: SparkSession,
    path: str,
    partition_column: str,
    where: str | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Rewrites the partitions that hold more files than their size calls for.

    ``where`` restricts the partitions looked at. A partition's rows are dealt by
    their old position to as many files as its stored bytes call for. Rows packed
    together may compress better, so the sizes are looked at again until no
    partition has too many files; every turn leaves fewer files, and a later run
    finds nothing to do.
    """
    while True:
        sizes = file_sizes(spark, path, partition_column)
        if where is not None:
            sizes = sizes.where(where)
        wanted = sizes.select(partition_column, "files", _wanted_files(target_bytes).alias("_wanted"))
        fragmented = wanted.where(F.col("files") > F.col("_wanted")).drop("files").collect()
        if not fragmented:
            return
        counts = spark.createDataFrame(fragmented, wanted.drop("files").schema)
        rows = spark.read.parquet(path).where(in_partitions(partition_column, [r[0] for r in fragmented]))
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place")
        dealt = rows.select("*", place).join(
            F.broadcast(counts.withColumnRenamed(partition_column, "_value")),
            F.col(partition_column).eqNullSafe(F.col("_value")),
        ).withColumn("_part", F.pmod("_place", "_wanted")).repartition(
            sum(r["_wanted"] for r in fragmented), partition_column, "_part"
        ).drop("_place", "_part", "_wanted", "_value")
        (
            dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_column).parquet(path)
        )


def _comparable(column: str, kind: T.DataType) -> Column:
    """Order-preserving number; text stays as it is."""
    value = F.col(column)
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    return value.cast("double")


def _text_cuts(rows: DataFrame, column: str, count: int) -> list[str]:
    """At most ``count`` cut points between ranges that hold about as many distinct texts."""
    ranges = rows.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(count + 1, column)
    firsts = ranges.groupBy(F.spark_partition_id()).agg(F.min(column)).collect()
    return sorted(row[1] for row in firsts)[1:]


def _quantile_index(value: Column, cuts: list) -> Column:
    """Number of cut points at or below the value, by binary search; null counts as 0."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), search(low, middle)).otherwise(
            search(middle + 1, high)
        )

    return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(cuts)))


def z_value(indexes: Sequence[Column], bits: int = Z_BITS) -> Column:
    """Interleaves the bits of the quantile indexes, most significant first."""
    result = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for index in indexes:
            digit = F.shiftright(index, bit).bitwiseAND(F.lit(1)).cast("bigint")
            result = F.shiftleft(result, 1).bitwiseOR(digit)
    return result


def z_ordered(rows: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> DataFrame:
    """Adds the Z value of the columns as ``_z``.

    The driver receives the quantile cut points only: ``2 ** bits - 1`` values
    per column.
    """
    kinds = {field.name: field.dataType for field in rows.schema.fields}
    values = {c: _comparable(c, kinds[c]) for c in columns}
    texts = [c for c in columns if isinstance(kinds[c], T.StringType)]
    numbers = [c for c in columns if c not in texts]
    steps = [n / 2 ** bits for n in range(1, 2 ** bits)]
    cuts = {c: _text_cuts(rows, c, 2 ** bits - 1) for c in texts}
    if numbers:
        found = rows.agg(*[F.percentile_approx(values[c], steps, 10_000).alias(c) for c in numbers]).first()
        cuts |= {c: sorted(set(found[c] or [])) for c in numbers}
    # Columns of their own, so each index is computed once and not once per bit.
    indexes = {
        f"_index_{n}": _quantile_index(value, cuts[c]) for n, (c, value) in enumerate(values.items())
    }
    indexed = rows.withColumns(indexes)
    return indexed.withColumn("_z", z_value([F.col(n) for n in indexes], bits)).drop(*indexes)


def zorder_table(
    spark: SparkSession,
    path: str,
    partition_column: str,
    columns: Sequence[str],
    where: str | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Rewrites partitions (those matching ``where``) clustered by the columns' Z value.

    Rows are range-partitioned by partition value, Z value and their position in
    the old file, so any number of equal values can still be split over tasks.
    """
    sizes = file_sizes(spark, path, partition_column)
    if where is not None:
        sizes = sizes.where(where)
    chosen = sizes.agg(
        F.collect_set(partition_column).alias("values"),
        F.sum(_wanted_files(target_bytes)).alias("files"),
    ).first()
    if not chosen["files"]:
        return
    rows = spark.read.parquet(path).where(in_partitions(partition_column, chosen["values"]))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place")
    clustered = (
        z_ordered(rows.select("*", place), columns)
        .repartitionByRange(int(chosen["files"]), partition_column, "_z", "_place")
        .sortWithinPartitions(partition_column, "_z")
        .drop("_z", "_place")
    )
    (
        clustered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_column)
        .parquet(path)
    )
