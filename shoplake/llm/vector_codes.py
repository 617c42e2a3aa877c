"""Vector code compression: Lloyd's rounds over cover trees, one tree for each part of a chunk.

Components become integers ``floor(256 x)``; vectors are cut into 16 equal parts,
each with a codebook of 64 entries. All arithmetic that decides is on integers.

1. Each task packs its vectors into chunks of bounded size and builds a cover tree of
   every part: a node's children lie further apart than half its radius and cover it
   within that. A node's points are contiguous, so cumulative sums give the sum of any
   subtree. Chunks with their trees are stored once and read by every round.
2. A round goes down the trees. Entries that the triangle inequality rules out for all
   points of a node are dropped; a node left with one entry is assigned whole, by its
   cumulative sum. Only ambiguous leaves compare their points with the entries left.
   Sums are kept by task, then by Spark; what reaches the driver is the codebooks' size.
3. The last assignment writes codes and errors.

Rows whose vector is null, empty, or holds a null or non-finite component are dropped,
and so are those of another length than the vector of the smallest ``vec_id``, or of a
length that 16 does not divide. Entries start as the vectors that come first by
``vec_id`` (null last), then by components; with fewer vectors than entries there are
as many entries. Repeated rows and ids count each. Ties go to the lower index. No rows
give an empty result. A component at or beyond +-65536 fails the job, as its
squares may not fit. Other columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplake.llm.common import arrow_map, store, table
from shoplake.workspace import session_settings

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components in a chunk, which bound its rows; points in a leaf.
CHUNK_VALUES = 262_144
LEAF = 32
LARGEST = 65_536
#: Floats tell distances apart only beyond this share; closer ones are compared as integers.
SLACK = 1e-9


def squares(steps: np.ndarray) -> np.ndarray:
    return np.einsum("...d,...d->...", steps, steps)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points, and nodes: center, start, end, squared radius, first child, children.

    Level by level: the farthest point becomes a center until all points are within half
    the radius of one. A child's radius is at most half its parent's.
    """
    order, levels, made = np.arange(len(points)), [], 0
    centers, starts, ends = np.array([0]), np.array([0]), np.array([len(points)])
    while len(centers):
        sizes = ends - starts
        at, node = spans(starts, sizes), np.repeat(np.arange(len(centers)), sizes)
        rows = order[at]
        near = squares(points[rows] - points[centers[node]])
        radius = np.maximum.reduceat(near, np.cumsum(sizes) - sizes)
        split = (sizes > LEAF) & (radius > 0)
        child, live, number = np.zeros(len(rows), np.int64), np.flatnonzero(split[node]), 0
        heads = [(np.flatnonzero(split), np.zeros(split.sum(), np.int64), centers[split])]
        while len(live):
            owner = node[live]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            counts = np.diff(np.r_[first, len(owner)])
            far = np.maximum.reduceat(near[live], first)
            wide = 4 * far > radius[owner[first]]
            if not wide.all():
                live = live[np.repeat(wide, counts)]
                continue
            number += 1
            farthest = np.flatnonzero(near[live] == np.repeat(far, counts))
            farthest = live[farthest[np.unique(owner[farthest], return_index=True)[1]]]
            heads.append((owner[first], np.full(len(first), number), rows[farthest]))
            steps = squares(points[rows[live]] - points[np.repeat(rows[farthest], counts)])
            closer = steps < near[live]
            near[live[closer]], child[live[closer]] = steps[closer], number
        sort = np.lexsort((child, node))
        order[at] = rows[sort]
        inside = split[node]
        place, key = at[inside], (node * (number + 1) + child[sort])[inside]
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else key
        names = np.concatenate([n * (number + 1) + k for n, k, _ in heads])
        by_name = np.argsort(names)
        next_centers = np.concatenate([c for _, _, c in heads])[by_name[np.searchsorted(names[by_name], key[begins])]]
        children = np.bincount(key[begins] // (number + 1), minlength=len(centers))
        first_child = made + len(centers) + np.cumsum(children) - children
        levels.append(np.stack([centers, starts, ends, radius, first_child, children], 1))
        made += len(centers)
        starts = place[begins]
        ends = starts + np.diff(np.r_[begins, len(key)])
        centers = next_centers
    return order, np.concatenate(levels)


def assign(points: np.ndarray, order: np.ndarray, nodes: np.ndarray, book: np.ndarray):
    """Nearest entry of every point, in tree order, and the sums of points by entry."""
    found = np.empty(len(points), np.int64)
    inside = points[order]
    totals = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(inside, 0)])
    sums = np.zeros_like(book)
    here, able, leaves = np.array([0]), np.ones((1, len(book)), bool), []
    while len(here):
        center, start, end, radius, child, children = nodes[here].T
        away = np.where(able, np.sqrt(squares(points[center][:, None] - book)), np.inf)
        reach = away.min(1) + 2 * np.sqrt(radius)
        able = away <= (reach * (1 + SLACK) + SLACK)[:, None]
        sure = able.sum(1) == 1
        entry = able[sure].argmax(1)
        found[spans(start[sure], (end - start)[sure])] = np.repeat(entry, (end - start)[sure])
        np.add.at(sums, entry, totals[end[sure]] - totals[start[sure]])
        leaf = ~sure & (children == 0)
        leaves.append((start[leaf], (end - start)[leaf], able[leaf]))
        down = ~sure & (children > 0)
        here = spans(child[down], children[down])
        able = np.repeat(able[down], children[down], axis=0)
    for starts, sizes, able in leaves:
        place = spans(starts, sizes)
        if not len(place):
            continue
        point, entry = np.nonzero(np.repeat(able, sizes, axis=0))
        steps = squares(inside[place[point]] - book[entry])
        first = np.flatnonzero(np.r_[True, point[1:] != point[:-1]])
        least = np.repeat(np.minimum.reduceat(steps, first), np.diff(np.r_[first, len(point)]))
        nearest = np.minimum.reduceat(np.where(steps == least, entry, len(book)), first)
        found[place] = nearest
        np.add.at(sums, nearest, inside[place])
    return found, sums


def cleaned(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """``id, label, ints`` of the vectors that hold finite components only."""
    rows = vectors.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"),
                          F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    # comparisons with infinity: NaN is larger than any number to Spark, and infinity equals itself
    good = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    whole = (F.size("vector") > 0) & (F.size("vector") % PARTS == 0)
    large = F.raise_error(F.lit("vector components must lie within +-65536")).cast("int")
    ints = F.transform("vector", lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * SCALE).cast("int")).otherwise(large))
    return rows.where(F.col("vector").isNotNull() & good & whole).select("id", "label", ints.alias("ints"))


def chunks(rows: DataFrame, length: int) -> DataFrame:
    """``ids, labels, ints, orders, nodes``: chunks of vectors with the cover trees of their parts, stored.

    ``ints`` has the vectors one after another, ``orders`` the order of points of each
    part, ``nodes`` seven numbers for each node: its part, then those of ``cover_tree``.
    """
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(kinds["id"])), T.StructField("labels", T.ArrayType(kinds["label"])),
        T.StructField("ints", T.ArrayType(T.IntegerType())), T.StructField("orders", T.ArrayType(T.IntegerType())),
        T.StructField("nodes", T.ArrayType(T.LongType())),
    ])
    arrow, most, width = to_arrow_schema(schema), max(ENTRIES, CHUNK_VALUES // length), length // PARTS

    def packed(parts):
        batch = pa.Table.from_batches(parts).combine_chunks()
        ints = batch.column("ints").combine_chunks().flatten().to_numpy().astype(np.int64).reshape(-1, length)
        orders, nodes = [], []
        for part in range(PARTS):
            order, found = cover_tree(ints[:, part * width:(part + 1) * width])
            orders.append(order)
            nodes.append(np.concatenate([np.full((len(found), 1), part), found], 1))
        values = [batch.column("id").to_pylist(), batch.column("label").to_pylist(), ints.ravel().astype(np.int32),
                  np.concatenate(orders).astype(np.int32), np.concatenate(nodes).ravel()]
        return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, arrow)], schema=arrow)

    def run(batches):
        waiting, held = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - held)
                batch = batch.slice(part.num_rows)
                waiting.append(part)
                held += part.num_rows
                if held == most:
                    yield packed(waiting)
                    waiting, held = [], 0
        if waiting:
            yield packed(waiting)

    return store(rows.mapInArrow(run, schema), "chunks")


def trees(ints: list, orders: list, nodes: list, length: int):
    """For each part of a chunk: its points, their order and its tree."""
    ints = np.asarray(ints, np.int64).reshape(-1, PARTS, length // PARTS)
    orders, nodes = np.asarray(orders, np.int64).reshape(PARTS, -1), np.asarray(nodes, np.int64).reshape(-1, 7)
    for part in range(PARTS):
        yield np.ascontiguousarray(ints[:, part]), orders[part], nodes[nodes[:, 0] == part, 1:]


def refined(packed: DataFrame, books: np.ndarray, length: int) -> np.ndarray:
    """Codebooks after a round; unused entries stay."""
    def start():
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)

        def step(*columns):
            for chunk in zip(*columns):
                for part, (points, order, nodes) in enumerate(trees(*chunk, length)):
                    found, added = assign(points, order, nodes, books[part])
                    sums[part] += added
                    counts[part] += np.bincount(found, minlength=len(books[part]))
            return []

        def finish():
            yield [(part, entry, counts[part, entry].item(), sums[part, entry].tolist()) for part, entry in zip(*np.nonzero(counts))]

        step.finish = finish
        return step

    # as a chunk is large, few may cross to Python together
    with session_settings(packed.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="8"):
        added = arrow_map(packed.select("ints", "orders", "nodes"), "part int, entry int, n bigint, sums array<bigint>", start, size=1)
        whole = added.select("part", "entry", "n", F.posexplode("sums").alias("place", "sum")).groupBy("part", "entry", "place")
        books = books.copy()
        for row in whole.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).collect():
            books[row["part"], row["entry"], row["place"]] = row["sum"] // row["n"]
    return books


def coded(packed: DataFrame, books: np.ndarray, length: int) -> DataFrame:
    """``id, label, code, error`` of every vector, stored."""
    kinds = {f.name: f.dataType.elementType.simpleString() for f in packed.schema if f.name in ("ids", "labels")}

    def start():
        def step(ids, labels, *columns):
            out = []
            for names, marks, *chunk in zip(ids, labels, *columns):
                codes, errors = np.empty((len(names), PARTS), np.uint8), np.zeros(len(names), np.int64)
                for part, (points, order, nodes) in enumerate(trees(*chunk, length)):
                    found, _ = assign(points, order, nodes, books[part])
                    codes[order, part] = found
                    errors[order] += squares(points[order] - books[part][found])
                out.extend(zip(names, marks, [c.tobytes().hex() for c in codes], errors.tolist()))
            return out

        return step

    schema = f"id {kinds['ids']}, label {kinds['labels']}, code string, error bigint"
    with session_settings(packed.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="8"):
        return store(arrow_map(packed.select("ids", "labels", "ints", "orders", "nodes"), schema, start, size=1), "codes")


def compress(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes and errors (``id, label, code, error``) of every vector, and the codebooks: parts, entries, components."""
    rows = cleaned(vectors, id, vector, label)
    order = [F.col("id").asc_nulls_last(), F.col("ints")]
    seeds = [r["ints"] for r in rows.orderBy(*order).limit(ENTRIES).select("ints").collect()]
    length = len(seeds[0]) if seeds else PARTS
    rows = rows.where(F.size("ints") == length)
    if any(len(s) != length for s in seeds):
        seeds = [r["ints"] for r in rows.orderBy(*order).limit(ENTRIES).select("ints").collect()]
    books = np.array(seeds, np.int64).reshape(-1, PARTS, length // PARTS).swapaxes(0, 1)
    packed = chunks(rows, length)
    for _ in range(rounds if seeds else 0):
        books = refined(packed, books, length)
    return coded(packed, books, length), books


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def report(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id, code, error, label_error, codebooks_sha256`` of every vector kept."""
    codes, books = compress(vectors, id, vector, label)
    by_label = codes.groupBy(F.col("label").alias("other")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("other"))).select(
        F.col("id").alias(id), "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return report(table(spark, folder, "embeddings"))


def _oracle() -> str:
    """Every part compared with every entry, round by round."""
    steps = [r"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS k, vec_id, label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT k, j, v[j * len(v) // 16 + 1:(j + 1) * len(v) // 16] AS x FROM v, range(16) t(j)),
first AS (SELECT k, row_number() OVER (ORDER BY vec_id, v) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT j, c, x FROM first JOIN p USING (k) WHERE c < 64)"""]
    for n in range(3):
        steps.append(f"""
a{n} AS MATERIALIZED (SELECT k, j, m // 64 AS error, m % 64 AS c FROM (
    SELECT p.k, p.j, min(64 * list_sum([(p.x[i] - b.x[i]) * (p.x[i] - b.x[i]) FOR i IN range(1, len(p.x) + 1)]) + b.c) AS m
    FROM p JOIN c{n} b USING (j) GROUP BY 1, 2))""")
        if n < 2:
            steps.append(f"""
s{n} AS (SELECT a.j, a.c, i, sum(p.x[i]) AS s, count(*) AS n FROM a{n} a JOIN p USING (k, j), LATERAL (SELECT unnest(range(1, len(p.x) + 1)) AS i)
    GROUP BY 1, 2, 3),
m{n} AS (SELECT j, c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{n} GROUP BY 1, 2),
c{n + 1} AS MATERIALIZED (SELECT b.j, b.c, coalesce(m.x, b.x) AS x FROM c{n} b LEFT JOIN m{n} m USING (j, c))""")
    return ",".join(steps) + r""",
r AS (SELECT k, string_agg(printf('%02x', CAST(c AS INTEGER)), '' ORDER BY j) AS code, CAST(sum(error) AS BIGINT) AS error FROM a2 GROUP BY 1),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY j, c)) AS h FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN r USING (k), h
"""


ORACLE = _oracle()
