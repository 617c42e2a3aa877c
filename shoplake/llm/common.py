"""Helpers the operators share: tables, words, Arrow tasks, stored results."""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.sinks.tables import remove
from shoplake.workspace import new_folder, session_settings

CACHED_WORDS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage: what follows sees one fixed set of rows, also after an
    executor is lost. So the shuffle files behind the rows go with the query that wrote
    them, instead of when the driver happens to collect its garbage.
    """
    folder = new_folder(frame.sparkSession, label)
    with session_settings(frame.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        frame.write.option("compression", "zstd").parquet(folder)
    stored = frame.sparkSession.read.schema(frame.schema).parquet(folder)
    stored.stored_in = folder
    return stored


def discard(*stored: DataFrame) -> None:
    """Removes tables of :func:`store` that nothing reads any more."""
    for frame in stored:
        remove(frame.sparkSession, frame.stored_in)


def chosen_by_hash(texts: DataFrame, limit: int, marks: DataFrame | None = None) -> DataFrame:
    """``kind, id, text`` of the ``limit`` ids of each kind that come first by a hash.

    ``texts``: ``id, text`` and ``kind``, unless ``marks`` has ``id, kind``. Rows without
    id are passed over; of several texts of an id and kind the smallest one counts.
    Ids are chosen first, so only the chosen texts leave their tasks. ``limit`` and the
    number of kinds bound what is collected: a cut of the hash, widened until every
    kind has enough, lets about four times ``limit`` ids through.
    """
    named = texts.where("id IS NOT NULL")
    rows = named if marks is None else named.select("id").join(marks, "id")
    ids = rows.select("kind", "id").distinct().withColumn("hash", F.xxhash64("id"))
    ids = store(ids, "sample")
    totals = {r["kind"]: r["n"] for r in ids.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    found, room = {}, 4
    while any(len(found.get(k, ())) < min(limit, n) for k, n in totals.items()):
        cut = F.lit(None).cast("bigint")
        for kind, n in totals.items():
            share = min(2 ** 64 - 1, room * limit * 2 ** 64 // n)
            cut = F.when(F.col("kind") == kind, F.lit(share - 2 ** 63)).otherwise(cut)
        found = {}
        for row in ids.where(F.col("hash") <= cut).collect():
            found.setdefault(row["kind"], []).append((row["hash"], row["id"]))
        room *= 2
    chosen = [(kind, id) for kind, members in found.items() for _, id in sorted(members)[:limit]]
    wanted = texts.sparkSession.createDataFrame(chosen, ids.select("kind", "id").schema)
    found = named.join(F.broadcast(wanted), ["id"] if marks is not None else ["kind", "id"])
    return found.groupBy("kind", "id").agg(F.min("text").alias("text"))


def first_by_hash(texts: DataFrame, limit: int, marks: DataFrame | None = None) -> list:
    """The rows of :func:`chosen_by_hash`, by kind and id."""
    return sorted(chosen_by_hash(texts, limit, marks).collect(), key=lambda row: (row["kind"], row["id"]))


def arrow_map(frame: DataFrame, schema: str, start, size: int = 128, bunch: int = 100_000) -> DataFrame:
    """Run Python over the rows of each partition.

    ``start()`` is called once per task and returns a function that turns a list
    of input columns (at most ``size`` rows each) into output rows, a list or an
    iterator, of which ``bunch`` leave together. If that function
    has an attribute ``finish``, it is called at the end for the last rows; with an
    attribute ``arrow`` it gets Arrow arrays instead of lists.
    """
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def pack(rows):
        columns = list(zip(*rows)) if rows else [()] * len(arrow)
        return pa.RecordBatch.from_arrays(
            [pa.array(values, type=field.type) for values, field in zip(columns, arrow)], schema=arrow
        )

    def run(batches):
        def packed(rows):
            left = iter(rows)
            while part := list(itertools.islice(left, bunch)):
                yield pack(part)

        step = start()
        arrays = getattr(step, "arrow", False)
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                columns = batch.slice(at, size).columns
                yield from packed(step(*columns if arrays else [c.to_pylist() for c in columns]))
        finish = getattr(step, "finish", None)
        if finish is not None:
            for rows in finish():
                yield from packed(rows)

    return frame.mapInArrow(run, schema)


def utf8(column: str):
    """Text as bytes, which cross to Python without being decoded."""
    return F.col(f"`{column}`").cast("string").cast("binary")


class Hashes(dict):
    """Word -> 64-bit hash; ``trim`` keeps the size bounded."""

    def __missing__(self, word):
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        if len(self) > CACHED_WORDS:
            self.clear()
        return found


#: Odd multipliers that give every place of a shingle its own weight.
PLACES = np.array([xxhash.xxh64_intdigest(b"place", seed=n) | 1 for n in range(64)], np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit value."""
    values = (values ^ (values >> np.uint64(31))) * PLACES[62]
    return values ^ (values >> np.uint64(29))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; none if there are fewer words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for n in range(width):
        total += hashes[n:n + count] * PLACES[n]
    return mixed(total + np.uint64(width))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
