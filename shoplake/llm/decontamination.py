"""Benchmark decontamination as a prefix-filtered set join.

Words are runs of characters outside ASCII other than letters and digits, with
A-Z lowered. An item's windows are its runs of 13 words; an item with fewer words
is one window. A window occurs in a document only if all its shingles do, in
place, so one shingle of it is a sufficient prefix: the one that is rarest among
the documents. Documents meet windows on that shingle alone; a candidate must
leave room for the window on both sides (position and length bounds) and is then
verified word by word against the words around the shingle.

Rows with null or empty text have no words: such documents have no hits, such
items no windows. Items with a null id are ignored. Each input document gives one
row, repeated rows and null ids included; rows of one item id count as one item.
"""

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shoplake.llm.common import Hashes, arrow_map, shingles, signed, store, table, utf8

WINDOW = 13
SHINGLE = 3
#: Documents drop shingles that no window holds by a bitmap of this many bits.
FILTER_BITS = 22

#: Every ASCII byte but digits and letters separates words.
SEPARATED = bytes(
    n + 32 if 65 <= n <= 90 else n if n >= 128 or 48 <= n <= 57 or 97 <= n <= 122 else 32 for n in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(SEPARATED).split()


def windows(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, window, at, width, shingle, hashes``: shingles of each window."""
    schema = "item string, window bigint, at int, width int, shingle bigint, hashes array<bigint>"

    def start():
        cache = Hashes()

        def step(ids, texts):
            out = []
            for item, body in zip(ids, texts):
                found = cache.of(words(body))
                size = min(len(found), WINDOW)
                width = min(size, SHINGLE)
                for begin in range(len(found) - size + 1 if size else 0):
                    part = found[begin:begin + size]
                    name = int(signed(shingles(part, size) if size > 1 else part * np.uint64(1))[0])
                    values = signed(part).tolist()
                    out.extend((item, name, at, width, int(h), values)
                               for at, h in enumerate(signed(shingles(part, width))))
            return out

        return step

    rows = items.select(F.col(f"`{id}`").cast("string").alias("item"), utf8(text).alias("text"))
    return arrow_map(rows.where("item IS NOT NULL"), schema, start)


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bits set where a key's top bits fall; fixed size whatever the number of keys."""
    shift = 64 - FILTER_BITS
    slots = keys.select(F.expr(f"shiftrightunsigned(shingle, {shift})").cast("int").alias("slot")).distinct()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[np.array([row[0] for row in slots.collect()], np.int64)] = True
    return np.packbits(bits)


def occurrences(docs: DataFrame, keys: DataFrame, counted: bool, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shingles of documents that may be among ``keys`` (``width, shingle``).

    ``counted``: ``shingle, n`` by input task. Otherwise one row for each document,
    ``row, id, n_words, found`` with position, shingle and the words around it.
    """
    spark = docs.sparkSession
    widths = sorted(r[0] for r in keys.select("width").distinct().collect())
    shared = spark.sparkContext.broadcast(bitmap(keys))
    shift, reach = np.uint64(64 - FILTER_BITS), WINDOW - 1

    def start():
        bits, cache, totals = np.unpackbits(shared.value).view(bool), Hashes(), {}

        def step(ids, texts):
            out = []
            for name, body in zip(ids, texts):
                hashes = cache.of(words(body))
                near = []
                for width in widths:
                    all_here = shingles(hashes, width)
                    places = np.flatnonzero(bits[all_here >> shift])
                    if counted:
                        for h in signed(all_here[places]).tolist():
                            totals[h] = totals.get(h, 0) + 1
                    else:
                        near.extend(
                            (p, int(h), max(0, p - reach), signed(hashes[max(0, p - reach):p + reach + 1]).tolist())
                            for p, h in zip(places.tolist(), signed(all_here[places]).tolist())
                        )
                if not counted:
                    out.append((name, len(hashes), near))
            return out

        if counted:
            step.finish = lambda: [list(totals.items())]
        return step

    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("id"), utf8(text).alias("text"))
    if counted:
        return arrow_map(rows, "shingle bigint, n bigint", start)
    schema = "id bigint, n_words bigint, found array<struct<at: int, shingle: bigint, first: int, hashes: array<bigint>>>"
    return arrow_map(rows, schema, start).withColumn("row", F.monotonically_increasing_id())


def prefixes(spans: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """The rarest shingle of each window by its number in the documents."""
    total = occurrences(docs, spans, True, id, text).groupBy("shingle").agg(F.sum("n").alias("n"))
    ranked = spans.join(total, "shingle", "left").groupBy("item", "window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at", "width", "hashes")).alias("best")
    )
    # a window whose rarest shingle no document has cannot occur
    return ranked.where("best.n > 0").select("item", "window", "best.at", "best.width", "best.shingle", "best.hashes")


def contamination(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row for each document: words, hit words, the items found, the verdict.

    ``spans`` lists the hit runs of words, ``items`` the ids of the items found,
    sorted. Contaminated: at least a word in twenty is hit.
    """
    spans = store(windows(items, item_id, item_text).distinct(), "windows")
    keys = store(prefixes(spans, docs, id, text), "prefixes")
    rows = store(occurrences(docs, keys, False, id, text), "candidates")
    near = rows.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    window = keys.select("item", F.col("at").alias("offset"), "shingle", F.col("hashes").alias("wanted"))
    begin, size = F.col("at") - F.col("offset"), F.size("wanted")
    hits = (
        near.join(window, "shingle")
        .where((begin >= 0) & (begin + size <= F.col("n_words")))
        .where(F.slice("hashes", begin - F.col("first") + 1, size) == F.col("wanted"))
        .select("row", "item", begin.alias("begin"), (begin + size).alias("end"))
    )
    hits = store(hits.distinct(), "hits")
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0))))
    covered = (
        hits.select("row", "begin", "end").distinct().withColumn("fresh", fresh)
        .groupBy("row").agg(
            F.sum("fresh").alias("n_hit"),
            F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"),
        )
    )
    found = hits.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return (
        rows.select("row", "id", "n_words").join(covered, "row", "left").join(found, "row", "left")
        .select(
            F.col("id").alias(id), "n_words", n_hit.alias("n_hit"), "spans",
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


#: Documents' words under the numbers that the items' words have; runs of 13 compared as lists.
ORACLE = r"""
WITH d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents),
b AS (SELECT item_id, [x FOR x IN regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
      FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS size,
      array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS run
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
runs AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS run
      FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, item_id, i, size FROM runs JOIN win USING (size, run)),
places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY 1),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n,
      string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY 1)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(f.n, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
  coalesce(p.n, 0) > 0 AND 20 * coalesce(p.n, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN places p USING (doc_id) LEFT JOIN found f USING (doc_id)
"""
