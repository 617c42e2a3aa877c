"""Z-order clustering that reads and rewrites only files that are not clustered yet.

Clustered files are known by their name, ``zorder-<columns>-<run>-<number>.parquet``, which
a journalled move gives them together with their rows. A job takes the other files of each
folder as a new run; an older run of the folder joins it if it holds at most twice the bytes
taken so far, so a folder keeps a number of runs that grows with the logarithm of its bytes,
and a row is rewritten about as often.

Cuts follow the rows taken: quantiles of a KLL sketch for numbers, dates and times, ranges of
like row counts for texts. A column gets as many bits as the files of the largest folder
call for. Nulls lie before all values. Without new files nothing is read or written.
"""

import math
import uuid
from collections.abc import Mapping, Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shoplake.sinks.maintenance import z_value
from shoplake.sinks.packing import TARGET_FILE_BYTES, listing
from shoplake.sinks.replace import commit, discard, recover, staging
from shoplake.sinks.tables import table_files

# 2 ** MAX_BITS - 1 cut points of a column reach the driver and are sent with the plan.
MAX_BITS = 10
EXTRA_BITS = 3
# Ranges of texts for each cut between them.
RANGES_PER_CUT = 4


def cluster_mark(columns: Sequence[str]) -> str:
    """Beginning of the names of files clustered by the columns, in their order."""
    return f"zorder-{md5('|'.join(columns).encode()).hexdigest()[:12]}-"


def cluster_plan(
    spark: SparkSession, path: str, columns: Sequence[str], target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """``file, path, folder, length, run, taken``; ``run`` is null for files not clustered."""
    mark = cluster_mark(columns)
    name = F.regexp_extract("path", "([^/]*)$", 1)
    run = F.when(name.startswith(mark), F.regexp_extract(name, f"^{mark}([0-9a-f]+)-", 1))
    files = listing(spark, path).withColumn("run", run)
    # One narrow row for each run of a folder.
    runs = files.groupBy("folder", "run").agg(F.sum("length").alias("_bytes"))
    sized = Window.partitionBy("folder").orderBy(F.col("run").isNotNull(), "_bytes", "run")
    before = F.coalesce(F.sum("_bytes").over(sized.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joins = F.col("run").isNull() | ((before > 0) & (F.col("_bytes") <= 2 * before))
    begun = F.max(F.col("run").isNull()).over(Window.partitionBy("folder"))
    judged = runs.select("folder", "run", "_bytes", joins.alias("_joins"), begun.alias("_begun"))
    taken = F.col("_begun") & F.min("_joins").over(sized)
    chosen = judged.select(F.col("folder").alias("_in"), F.col("run").alias("_run"), taken.alias("taken"))
    matches = (F.col("folder") == F.col("_in")) & F.col("run").eqNullSafe(F.col("_run"))
    return files.join(chosen, matches).drop("_in", "_run")


def _number(column: str, kind: T.DataType) -> Column:
    """Order-preserving double of a number, date, time or truth value."""
    value = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp_ltz(value)).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    return value.cast("double")


def _text_cuts(rows: DataFrame, column: str, count: int) -> list[str]:
    """At most ``count`` texts that cut the rows into parts of like size.

    Texts are counted before they are ordered, so a hot text is one row; the driver
    receives the first text and the rows of each range.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranges = counts.repartitionByRange(RANGES_PER_CUT * (count + 1), column)
    parts = sorted(ranges.groupBy(F.spark_partition_id()).agg(F.min(column), F.sum("_n")).collect(), key=lambda r: r[1])
    total, so_far, cuts = sum(r[2] for r in parts), 0, []
    for _, first, n in parts:
        if so_far * (count + 1) >= (len(cuts) + 1) * total:
            cuts.append(first)
        so_far += n
    return cuts[:count]


def cut_points(rows: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """Ascending cut points of each column, ``2 ** bits - 1`` of them or none at all."""
    kinds, count = {c: rows.schema[c].dataType for c in columns}, 2 ** bits - 1
    texts = [c for c in columns if isinstance(kinds[c], T.StringType)]
    found = {c: _text_cuts(rows, c, count) for c in texts}
    numbers = {c: _number(c, kinds[c]) for c in columns if c not in texts}
    numbers = {c: F.when(~F.isnan(v), v) for c, v in numbers.items()}
    if numbers:
        size = F.lit(max(200, 8 * 2 ** bits))
        sketches = rows.agg(
            *[F.kll_sketch_agg_double(v, size).alias(c) for c, v in numbers.items()],
            *[F.count(v).alias(f"{c} known") for c, v in numbers.items()],
        )
        ranks = F.array(*[F.lit(n / 2 ** bits) for n in range(1, 2 ** bits)])
        quantiles = [
            F.when(F.col(f"`{c} known`") > 0, F.kll_sketch_get_quantile_double(c, ranks)).alias(c) for c in numbers
        ]
        cuts = sketches.select(*quantiles).first()
        found |= {c: list(cuts[c] or []) for c in numbers}
    return {c: (cuts + cuts[-1:] * (count - len(cuts))) for c, cuts in found.items()}


def _cell(value: Column, cuts: list, bits: int) -> Column:
    """Number of cut points at or below the value, by binary search; 0 for null."""
    points = F.array(*[F.lit(cut) for cut in cuts])
    steps = F.array(*[F.lit(2 ** bit) for bit in reversed(range(bits))])
    return F.when(value.isNull(), F.lit(0)).otherwise(F.aggregate(
        steps, F.lit(0),
        lambda place, step: place + F.when(F.get(points, place + step - 1) <= value, step).otherwise(F.lit(0)),
    ))


def with_z(rows: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """Adds the Z value of the columns as ``_z``."""
    cuts, cells = cut_points(rows, columns, bits), {}
    for n, column in enumerate(columns):
        kind = rows.schema[column].dataType
        value = F.col(column) if isinstance(kind, T.StringType) else _number(column, kind)
        cells[f"_cell_{n}"] = _cell(value, cuts[column], bits) if cuts.get(column) else F.lit(0)
    return rows.withColumns(cells).withColumn("_z", z_value([F.col(c) for c in cells], bits)).drop(*cells)


def cluster_bits(files: int, columns: int) -> int:
    """Bits a column needs so that its cells are finer than ``files`` files, at least 1."""
    return min(MAX_BITS, max(1, math.ceil(math.log2(max(1, files)) / columns) + EXTRA_BITS), 62 // columns)


def cluster_files(
    spark: SparkSession, path: str, columns: Sequence[str], target_bytes: int = TARGET_FILE_BYTES
) -> int:
    """Clusters files that are not clustered by the columns yet; returns the number of files read.

    Partition folders may have any depth; partition columns are no cluster columns.
    """
    recover(spark, path)
    staged = staging(path)
    cluster_plan(spark, path, columns, target_bytes).where("taken").write.parquet(f"{staged}/plan")
    chosen = spark.read.parquet(f"{staged}/plan")
    wanted = F.ceil(F.sum("length") / F.lit(target_bytes)).cast("bigint")
    # One row for each folder; a number makes a shorter staging folder than the folder's path.
    sizes = chosen.groupBy("folder").agg(wanted.alias("_wanted")).withColumn(
        "_id", F.row_number().over(Window.orderBy("folder")))
    total = sizes.agg(F.sum("_wanted").alias("files"), F.max("_wanted").alias("most")).first()
    if total["files"] is None:
        discard(spark, staged)
        return 0
    mark = cluster_mark(columns)
    runs = [row[0] for row in chosen.where("run IS NOT NULL").select("run").distinct().collect()]
    # Both conditions look at file names only, so runs that stay are not scanned.
    name = F.col("_metadata.file_name")
    wanted_name = ~name.startswith(mark) | F.regexp_extract(name, f"^{mark}([0-9a-f]+)-", 1).isin(runs)
    stored = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path).where(wanted_name)
    placed = stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    rows = placed.join(chosen.join(sizes, "folder").select(F.col("file").alias("_file"), "_id"), "_file")
    (
        with_z(rows, columns, cluster_bits(total["most"], len(columns)))
        .repartitionByRange(int(total["files"]), "_id", "_z", F.xxhash64("_file", "_row"))
        .sortWithinPartitions("_id", "_z").drop("_file", "_row", "_z")
        .write.partitionBy("_id").parquet(f"{staged}/data")
    )
    run = uuid.uuid4().hex
    folder_id = F.regexp_extract("path", "/_id=([0-9]+)/", 1).cast("int").alias("_id")
    made = table_files(spark, f"{staged}/data").select("path", folder_id).join(sizes, "_id").select("path", "folder").collect()
    if not made:
        # Files without rows alone: they hold the schema of an empty table.
        discard(spark, staged)
        return 0
    old = [row[0] for row in chosen.select("path").collect()]
    moves = [(row[0], f"{row[1]}/{mark}{run}-{n}.parquet") for n, row in enumerate(made)]
    commit(spark, staged, old, moves)
    return len(old)


def file_bounds(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and greatest value of each column in each file of a table just read."""
    bounds = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*bounds)


def files_opened(rows: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """One row (files, opened): files whose bounds meet the closed range of every column."""
    meets = F.lit(True)
    for column, (low, high) in ranges.items():
        meets = meets & (F.col(f"{column}_max") >= F.lit(low)) & (F.col(f"{column}_min") <= F.lit(high))
    return file_bounds(rows, list(ranges)).agg(F.count(F.lit(1)).alias("files"), F.count_if(meets).alias("opened"))
