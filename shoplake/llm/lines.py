"""Line dedup by a deletion-neighbourhood join.

A line is what ``\\n`` separates, without ASCII white space at its ends. A line that
is not blank is dropped if an equal line occurs earlier in any document, or, if both
have at least ``MIN_CHARS`` code points, one within one edit (a code point put in,
left out or replaced): in shorter ones an edit often makes another word. Earlier
means a smaller doc_id, then a smaller line number. The earlier line counts
whether or not it is dropped itself. A higher ``min_chars`` leaves lines below it alone.

1. Equal lines become one, named by a 128-bit hash; its first place is kept.
2. A line within one edit of another shares one of its halves, unshifted or seen
   from the end. Lines that share no half with any other need no neighbourhood.
3. The others emit every variant with one code point deleted, as a hashed key with
   the place of the deletion, and themselves. Lines with equal variants at one
   place are one replacement apart; a variant equal to a line is one deletion
   apart. Each key keeps the earliest place, so a key met by many lines gives one
   candidate for each line, never pairs among them.
4. Candidates are verified on the text with Levenshtein's distance.

Null and empty texts have no lines that are compared. Each input row gives one
output row. Rows of one doc_id are ordered by a hash of their text; identical rows
count as one document and all get its result. Rows without doc_id come last.
"""

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shoplake.llm.common import arrow_map, discard, mixed, store, table

MIN_CHARS = 20

#: An odd base of the polynomial hash and its inverse modulo 2**64.
BASE = xxhash.xxh64_intdigest(b"base") | 1
INVERSE = pow(BASE, -1, 1 << 64)


def code_points(line: bytes) -> np.ndarray:
    return mixed(np.frombuffer(line.decode().encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))


_POWERS = [np.ones(1, np.uint64)]


def powers(count: int) -> np.ndarray:
    if len(_POWERS[0]) < count:
        _POWERS[0] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * count, BASE, np.uint64))])
    return _POWERS[0][:count]


def sums(line: bytes) -> np.ndarray:
    """Polynomial hash of every beginning of the line, the empty one first."""
    points = code_points(line)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * powers(len(points)))])


def halves(line: bytes) -> list[int]:
    """Keys of the line's halves, for partners of its length and one shorter."""
    text = line.decode()
    points, out = len(text), []
    for length in (points, points - 1):
        cut = length // 2
        for side, part in ((0, text[:cut]), (1, text[points - (length - cut):])):
            value = xxhash.xxh64_intdigest(part.encode(), seed=2 * length + side)
            out.append(value - (1 << 64) if value >> 63 else value)
    return out


def variants(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the line without each code point in turn, and that place; then of the line itself, at -1."""
    total = sums(line)
    size = len(total) - 1
    rest = (total[-1] - total[1:]) * np.uint64(INVERSE)
    keys = np.concatenate([total[:-1] + rest, total[-1:]])
    lengths = np.full(size + 1, size - 1, np.uint64)
    lengths[-1] = size
    return mixed(keys + lengths), np.concatenate([np.arange(size), [-1]])


def line_rows(rows: DataFrame, min_chars: int = 1) -> DataFrame:
    """``id, row, at, name_a, name_b, halves`` for every line that is compared.

    Lines below ``MIN_CHARS`` have no halves, so they meet equal lines only.
    """
    def start():
        def step(ids, numbers, texts):
            out = []
            for name, number, text in zip(ids, numbers, texts):
                for at, line in enumerate((text or b"").split(b"\n")):
                    line = line.strip()
                    size = len(line) if line.isascii() else len(line.decode())
                    if size >= max(min_chars, 1):
                        digest = xxhash.xxh3_128_digest(line)
                        out.append((name, number, at, int.from_bytes(digest[:8], "big", signed=True),
                                    int.from_bytes(digest[8:], "big", signed=True),
                                    halves(line) if size >= MIN_CHARS else []))
            return out

        return step

    schema = "id bigint, row bigint, at int, name_a bigint, name_b bigint, halves array<bigint>"
    return arrow_map(rows.select("id", "row", "text"), schema, start)


def neighbourhood(lines: DataFrame) -> DataFrame:
    """``key, place, line`` of every variant of the lines (``id, row, at, text``)."""
    def start():
        def step(ids, numbers, places, lines):
            out = []
            for name, number, at, line in zip(ids, numbers, places, lines):
                keys, cuts = variants(line)
                out.extend((k, p, name, number, at) for k, p in zip(keys.view(np.int64).tolist(), cuts.tolist()))
            return out

        return step

    rows = arrow_map(lines.select("id", "row", "at", "text"), "key bigint, place int, id bigint, row bigint, at int", start)
    return rows.select("key", "place", where())


def where():
    """A line's place; structs compare field by field, so rows without id come last."""
    return F.struct(
        F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), "row", "at"
    ).alias("line")


def with_text(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``id, row, at, text`` of lines given by ``line``, read from their documents."""
    wanted = chosen.groupBy("line.no_id", "line.id", "line.row").agg(F.collect_list("line.at").alias("ats"))
    texts = rows.select(F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), "row", "text")
    found = texts.join(wanted, ["no_id", "id", "row"]).dropDuplicates(["no_id", "id", "row"]).select(
        "no_id", "id", "row", F.split(F.col("text").cast("string"), "\n", -1).alias("every"), F.explode("ats").alias("at")
    )
    line = F.regexp_replace(F.element_at("every", F.col("at") + 1), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return found.select(F.when(~F.col("no_id"), F.col("id")).alias("id"), "row", "at", line.alias("text"))


def dropped(rows: DataFrame, min_chars: int = 1) -> DataFrame:
    """The lines to drop, ``id, row, at, near``, of documents ``id, row, text``.

    ``near``: no earlier line is equal, but one is within an edit.
    """
    lines = store(line_rows(rows, min_chars), "lines")
    names = ["name_a", "name_b"]
    distinct = store(
        lines.withColumn("line", where()).groupBy(*names).agg(F.min("line").alias("line"), F.first("halves").alias("halves")),
        "distinct",
    )
    halved = distinct.select("line", F.explode("halves").alias("half"))
    shared = halved.groupBy("half").agg(F.count("*").alias("lines")).where("lines > 1").select("half")
    chosen = halved.join(shared, "half", "left_semi").select("line").distinct()
    texts = store(with_text(rows, chosen), "open")
    keyed = neighbourhood(texts.withColumn("text", F.col("text").cast("binary")))

    def earliest(condition, *names):
        return F.min(F.when(condition, F.col("line"))).over(Window.partitionBy(*names))

    # a key's rows: lines alike but for one code point, at most one of them whole
    met = keyed.repartition("key").select(
        "line",
        F.when(F.col("place") >= 0, earliest(F.lit(True), "key", "place")).alias("replaced"),
        F.when(F.col("place") >= 0, earliest(F.col("place") == -1, "key")).alias("shorter"),
        F.when(F.col("place") == -1, earliest(F.col("place") >= 0, "key")).alias("longer"),
    )
    candidates = met.select("line", F.explode(F.array("replaced", "shorter", "longer")).alias("earlier")).where(
        F.col("earlier") < F.col("line")).distinct()
    text = texts.select(where(), "text")
    # each query's shuffle files go when its rows are stored, so few lie on disk together
    checked = store(
        candidates.join(text.withColumnRenamed("text", "later_text"), "line")
        .join(text.select(F.col("line").alias("earlier"), F.col("text").alias("earlier_text")), "earlier")
        .where(F.levenshtein("later_text", "earlier_text", 1) >= 0).select("line").distinct(),
        "near",
    )
    first = distinct.join(checked.withColumn("near", F.lit(True)), "line", "left").select(
        *names, F.col("line").alias("first"), F.coalesce("near", F.lit(False)).alias("near"))
    found = store(
        lines.withColumn("line", where()).join(first, names)
        .withColumn("near", F.col("near") & (F.col("line") == F.col("first")))
        .where((F.col("line") != F.col("first")) | F.col("near")).select("id", "row", "at", "near").distinct(),
        "dropped",
    )
    discard(lines, distinct, texts, checked)
    return found


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 1) -> DataFrame:
    """All columns of ``docs``, what stays of the text, and three counts.

    Added, in place of columns of these names: ``text_kept`` (null for null text),
    ``n_lines``, ``n_copies`` and ``n_near``, the lines dropped for an equal line
    and for one within an edit.
    """
    added = ["text_kept", "n_lines", "n_copies", "n_near"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("doc"),
        F.col(f"`{id}`").cast("bigint").alias("id"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("row"),
    )
    body = F.col(f"doc.`{text}`").cast("string")
    gone = dropped(rows.select("id", "row", body.cast("binary").alias("text")), min_chars).groupBy(
        F.col("id").alias("its_id"), F.col("row").alias("its_row")
    ).agg(F.collect_list("at").alias("gone"), F.count_if("near").alias("near"))
    every = F.split(body, "\n", -1)
    none = F.array().cast("array<int>")
    kept = F.filter(every, lambda line, at: ~F.array_contains(F.coalesce("gone", none), at))
    return (
        rows.join(gone, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("row") == F.col("its_row")), "left")
        .select(
            "doc.*", F.when(F.col("gone").isNull(), body).otherwise(F.array_join(kept, "\n")).alias("text_kept"),
            F.when(body.isNull(), 0).otherwise(F.size(every)).cast("bigint").alias("n_lines"),
            (F.size(F.coalesce("gone", none)) - F.coalesce("near", F.lit(0))).cast("bigint").alias("n_copies"),
            F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"),
        )
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_copies", "n_near", F.sha2("text_kept", 256).alias("kept_sha256"))


#: Variants as strings, without hashes and without the choice of lines by halves.
ORACLE = r"""
WITH l AS (SELECT doc_id, i - 1 AS pos, raw, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s
  FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS raw
        FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))),
u AS (SELECT s, min((doc_id, pos)) AS f FROM l WHERE s <> '' GROUP BY s),
c AS (SELECT s, f FROM u WHERE length(s) >= 20),
v AS (SELECT s, f, i, left(s, i) || substr(s, i + 2) AS v FROM (SELECT s, f, unnest(range(0, length(s))) AS i FROM c)),
m AS (SELECT v, i, min(f) AS f FROM v GROUP BY 1, 2),
mv AS (SELECT v, min(f) AS f FROM v GROUP BY 1),
near AS (SELECT DISTINCT s FROM (
  SELECT v.s FROM v JOIN m USING (v, i) WHERE m.f < v.f
  UNION ALL SELECT v.s FROM v JOIN c ON v.v = c.s WHERE c.f < v.f
  UNION ALL SELECT c.s FROM c JOIN mv ON mv.v = c.s WHERE mv.f < c.f)),
k AS (SELECT l.doc_id, l.pos, l.raw, u.f IS NOT NULL AND u.f <> (l.doc_id, l.pos) AS copied,
  u.f IS NOT NULL AND u.f = (l.doc_id, l.pos) AND near.s IS NOT NULL AS near
  FROM l LEFT JOIN u ON u.s = l.s LEFT JOIN near ON near.s = l.s)
SELECT doc_id, count(k.pos) AS n_lines, count(*) FILTER (copied) AS n_copies, count(*) FILTER (near) AS n_near,
  CASE WHEN any_value(text) IS NULL THEN NULL ELSE
  sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT copied AND NOT near), '')) END AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id) GROUP BY doc_id
"""
