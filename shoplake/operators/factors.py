"""Exact best products of every user from stored factors, by norm order and the Cauchy-Schwarz bound."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shoplake import params

DIGITS = 6
# Products of one norm band lie within this ratio of each other.
BAND_RATIO = 1.1
# The products with the greatest norms, whose scores give each user a first bound.
HEAD = 4096
# Every user goes to each cell of products that can reach it, so cells are as large as a task holds.
PRODUCTS_PER_CELL = 8192
USERS_PER_CELL = 16384
USERS_AT_ONCE = 256

CELL = ("place", "part", "salt")
PICKS = "user bigint, product bigint, score double"


def normed(rows: DataFrame, index: str) -> DataFrame:
    """(id, features, norm) of rows that have an id and features."""
    squares = F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return rows.where(F.col(index).isNotNull() & F.col("features").isNotNull()).select(
        F.col(index).cast("bigint").alias("id"), "features", F.sqrt(squares).alias("norm"))


def with_band(rows: DataFrame) -> DataFrame:
    """Adds the power of ``BAND_RATIO`` at or below the norm; null for norm 0."""
    return rows.withColumn("band", F.floor(F.log(F.nullif("norm", F.lit(0.0))) / F.log(F.lit(BAND_RATIO))).cast("int"))


def best(users: np.ndarray, products: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rounded scores and, per user, a mask of the k best; of equal scores the first columns."""
    scores = np.round(users @ products.T, digits) + 0.0
    if scores.shape[1] <= k:
        return scores, np.ones(scores.shape, bool)
    limit = np.partition(scores, -k, axis=1)[:, [-k]]
    above, equal = scores > limit, scores == limit
    room = k - above.sum(axis=1, keepdims=True)
    return scores, above | (equal & (np.cumsum(equal, axis=1) <= room))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _bounded(users: DataFrame, head: np.ndarray, bands: np.ndarray, k: int, digits: int) -> DataFrame:
    """Adds ``least``, a score each user's k best reach, and ``low``, the first band that can reach it."""
    slack = 10.0 ** -digits

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, norms = _matrix(batch["features"]), batch["norm"].to_numpy()
            least = np.full(len(vectors), -np.inf)
            if len(head) >= k:
                for at in range(0, len(vectors), USERS_AT_ONCE):
                    scores = np.round(vectors[at:at + USERS_AT_ONCE] @ head.T, digits)
                    least[at:at + USERS_AT_ONCE] = np.partition(scores, -k, axis=1)[:, -k]
            # A product of norm n scores at most n times the user's norm; one band more covers rounding.
            low = np.zeros(len(vectors), np.int32)
            needs = (norms > 0) & (least > slack)
            needed = np.log((least[needs] - slack) / norms[needs]) / np.log(BAND_RATIO)
            low[needs] = np.searchsorted(bands, np.floor(needed) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["features"], pa.array(least), pa.array(low)], ["id", "features", "least", "low"])

    kind = users.schema["features"].dataType.simpleString()
    return users.mapInArrow(bound, f"id bigint, features {kind}, least double, low int")


def _picked(k: int, digits: int):
    """Scores the users of each cell against its products, which come first and by id."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, vectors = None, [], []
        for batch in batches:
            kinds = np.stack([batch[c].to_numpy() for c in (*CELL, "is_user")], axis=1)
            cuts = np.flatnonzero((kinds[1:] != kinds[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(kinds)]):
                if start == end:
                    continue
                if cell != tuple(kinds[start, :3]):
                    cell, ids, vectors = tuple(kinds[start, :3]), [], []
                rows = batch.slice(start, end - start)
                if not kinds[start, 3]:
                    ids.append(rows["id"].to_numpy())
                    vectors.append(_matrix(rows["features"]))
                    continue
                if not ids:
                    continue
                ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                for at in range(0, rows.num_rows, USERS_AT_ONCE):
                    chunk = rows.slice(at, USERS_AT_ONCE)
                    scores, mask = best(_matrix(chunk["features"]), vectors[0], k, digits)
                    user, product = np.nonzero(mask & (scores >= chunk["least"].to_numpy()[:, None]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(chunk["id"].to_numpy()[user]), pa.array(ids[0][product]), pa.array(scores[user, product])],
                        ["user", "product", "score"])
    return pick


def top_k(users: DataFrame, products: DataFrame, k: int = params.TOP_K, digits: int = DIGITS) -> DataFrame:
    """(user, product, score, rank): the k products with the greatest dot product for every user.

    Both frames have ``id`` and ``features``, should be stored (they are read several times) and
    have distinct ids; rows without id or features are left out. Scores are rounded to ``digits``
    places, equal ones rank by product id. Fewer than k products give shorter lists.

    Products lie in bands of like norm, of which small neighbours are taken as one, since each
    user's factors go to every band that they need. The ``HEAD`` products of the greatest norms give every user
    a score that the k best reach; bands whose norm times the user's cannot reach it are skipped.
    What is left is joined in cells of some ``PRODUCTS_PER_CELL`` products and ``USERS_PER_CELL``
    users, products first, so a task holds one cell's products and streams its users. To the
    driver come the head and the bands' sizes (a row for each power of ``BAND_RATIO``).
    """
    spark = users.sparkSession
    products, users = with_band(normed(products, "id")), normed(users, "id")
    head = products.orderBy(F.desc("norm"), "id").limit(HEAD).select("features").collect()
    sizes = sorted(products.groupBy("band").count().collect(), key=lambda r: (r.band is not None, r.band))
    if not sizes:
        return spark.createDataFrame([], f"{PICKS}, rank int")
    places: list[tuple[list, int]] = []  # bands and their products, from the greatest norms down
    for size in reversed(sizes):
        if places and places[-1][1] + size["count"] <= PRODUCTS_PER_CELL:
            places[-1] = (places[-1][0] + [size.band], places[-1][1] + size["count"])
        else:
            places.append(([size.band], size["count"]))
    places.reverse()
    lowest = np.iinfo(np.int32).min
    bands = np.array([lowest if joined[0] is None else joined[0] for joined, _ in places], np.float64)
    vectors = np.array([r.features for r in head], np.float64)
    bounded = _bounded(users, vectors, bands, k, digits)
    depths = {r.low: r["count"] for r in bounded.groupBy("low").count().collect()}

    rows, by_place, wanting = [], [], 0
    for place, (joined, count) in enumerate(places):
        wanting += depths.get(place, 0)
        if wanting:
            by_place.append((place, -(-count // PRODUCTS_PER_CELL), -(-wanting // USERS_PER_CELL)))
            rows.extend((band, *by_place[-1]) for band in joined)
    if not rows:
        return spark.createDataFrame([], f"{PICKS}, rank int")
    cells = F.broadcast(spark.createDataFrame(rows, "band int, place int, parts int, salts int"))
    needed = F.broadcast(spark.createDataFrame(by_place, "place int, parts int, salts int"))

    def dealt(over: str):
        return F.pmod(F.xxhash64("id"), F.col(over)).cast("int")

    def spread(over: str):
        return F.explode(F.sequence(F.lit(0), F.col(over) - 1))

    offered = products.join(cells, products["band"].eqNullSafe(cells["band"])).withColumns(
        {"part": dealt("parts"), "is_user": F.lit(0), "least": F.lit(0.0)}).withColumn("salt", spread("salts"))
    asking = (
        bounded.where(F.col("low") < len(places))
        .withColumn("place", F.explode(F.sequence("low", F.lit(len(places) - 1)))).join(needed, "place")
        .withColumns({"salt": dealt("salts"), "is_user": F.lit(1)}).withColumn("part", spread("parts"))
    )
    columns = [*CELL, "is_user", "id", "features", "least"]
    together = offered.select(*columns).unionByName(asking.select(*columns))
    number = sum(parts * salts for _, parts, salts in by_place)
    picked = (
        together.repartition(number, *CELL).sortWithinPartitions(*CELL, "is_user", "id")
        .mapInArrow(_picked(k, digits), PICKS)
    )
    order = Window.partitionBy("user").orderBy(F.desc("score"), "product")
    return picked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
