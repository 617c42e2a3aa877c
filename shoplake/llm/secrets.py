"""Secret scan: fixed patterns, and a battery of randomness tests on every long string.

1. Patterns: assignments to names like ``password``, access keys, hexadecimal strings.
   Their spans always stay.
2. Every other run of at least ``SHORTEST`` key characters (padding included) gets the smallest
   encoding that holds it; runs of digits alone, or of no one encoding, are no keys.
   Three tests ask whether its symbols could be uniform and independent: chi-squared over the
   alphabet, runs above and below its middle, serial correlation of neighbours. The
   least of the three p-values, times three, must not be below ``DOUBT``.
3. Ordinary text is the null hypothesis: symbols as frequent as in all texts, counted
   over the whole corpus. A string's sum of squared symbol counts is large under it
   and small for a key; its mean and variance follow from length and frequencies. Short
   strings cannot stray far from them, so their p-values stay high.
4. False discoveries are held to ``DISCOVERIES`` by Benjamini and Hochberg's step-up
   rule within each class of lengths (doublings), over all strings of the corpus. The
   p-values are counted in fixed bins, rounded up, so the driver sees a few thousand
   counts at any corpus size.

Positions are code points. Null and empty texts have no spans; each row, repeated or
without id, gives one row. Ties in start go by kind in the order of ``KINDS``. Bytes that are no
UTF-8 count as replacement characters. Other columns are not read.
"""

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplake.llm.common import arrow_map, store, table, utf8

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Every name that ``ASSIGN`` knows holds one of these, in lower case.
NAMED = ("passw", "secret", "token", "api")
LEAST = {"assign": 6, "access": 20, "hex": 24}
SHORTEST = 16
LONG = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST)

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Alphabets from small to large; a string has the first that holds it.
ENCODINGS = (DIGITS + "abcdef", DIGITS + "ABCDEF", UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
             DIGITS + UPPER + LOWER, DIGITS + UPPER + LOWER + "+/", DIGITS + UPPER + LOWER + "-_")
PLACE = [{symbol: n for n, symbol in enumerate(alphabet)} for alphabet in ENCODINGS]
HOLDS = [re.compile(f"[{re.escape(alphabet)}]+") for alphabet in ENCODINGS]

DOUBT, DISCOVERIES = 0.01, 0.01
#: Bins of a hundredth of a standard deviation, from -40 to 40; classes of lengths.
BINS, WIDEST, CLASSES = 100, 40, 12


def above(z: float) -> float:
    """Upper tail of the normal distribution."""
    return math.erfc(z / math.sqrt(2)) / 2


def uniformity(counts: np.ndarray) -> float:
    """p-value of chi-squared against a uniform alphabet, by Wilson and Hilferty's cube root."""
    size, total = len(counts), counts.sum()
    free = size - 1
    value = size * float((counts ** 2).sum()) / total - total
    spread = 2 / (9 * free)
    return above(((max(value, 0.0) / free) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def runs_test(high: np.ndarray) -> float:
    """Two-sided p-value of the number of runs of two kinds of symbols."""
    n, a = len(high), int(high.sum())
    b = n - a
    if not a or not b:
        return 2 * 0.5 ** n
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * a * b / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return min(1.0, 2 * above(abs(runs - mean) / math.sqrt(variance))) if variance > 0 else 1.0


def serial_correlation(places: np.ndarray) -> float:
    """Two-sided p-value of the correlation of neighbours."""
    away = places - places.mean()
    total = float((away ** 2).sum())
    if not total:
        return 0.0
    n = len(places)
    return min(1.0, 2 * above(abs(float((away[1:] * away[:-1]).sum()) / total + 1 / n) * math.sqrt(n)))


def judged(string: str) -> tuple[int, int, int, bool] | None:
    """Encoding, length, sum of squared symbol counts, and whether the battery finds it random."""
    key = string.rstrip("=")
    if key.isdigit():
        return None
    for number, (holds, place) in enumerate(zip(HOLDS, PLACE)):
        if holds.fullmatch(key):
            places = np.fromiter(map(place.__getitem__, key), np.int64, len(key))
            counts = np.bincount(places, minlength=len(place))
            worst = min(uniformity(counts), runs_test(2 * places >= len(place)), serial_correlation(places))
            return number, len(key), int((counts ** 2).sum()), 3 * worst >= DOUBT
    return None


def patterns(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the fixed patterns, in order."""
    small = text.lower()
    named = any(name in small for name in NAMED)  # far cheaper than the search
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]] if named else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def strings(text: str, taken: list[tuple[int, int, int]]) -> list[tuple]:
    """``start, end, encoding, n, squares, random`` of long strings that no pattern span touches."""
    found, at, reach = [], 0, -1
    for m in LONG.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][2])
            at += 1
        if reach <= m.start():
            facts = judged(m[0])
            if facts:
                found.append((m.start(), m.end(), *facts))
    return found


def read(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id, spans, strings`` of every text, and rows that have ``symbols`` instead: counts of bytes by task."""
    rows = docs.select(F.col(f"`{id}`").alias("id"), utf8(text).alias("text"))

    def start():
        symbols = np.zeros(256, np.int64)

        def step(ids, texts):
            out = []
            for name, data in zip(ids, texts):
                whole = (data or b"").decode(errors="replace")
                symbols[:] += np.bincount(np.frombuffer(data or b"", np.uint8), minlength=256)
                taken = patterns(whole)
                out.append((name, taken, strings(whole, taken), None))
            return out

        step.finish = lambda: [[(None, None, None, symbols.tolist())]]
        return step

    schema = (f"id {rows.schema['id'].dataType.simpleString()}, spans array<struct<start: int, kind: int, `end`: int>>, "
              "strings array<struct<start: int, `end`: int, encoding: int, n: int, squares: bigint, random: boolean>>, symbols array<bigint>")
    return store(arrow_map(rows, schema, start), "secrets")


def frequencies(found: DataFrame) -> list[tuple[float, float]]:
    """For each encoding the sums of squares and cubes of its symbols' frequencies in all texts."""
    bytes_of = found.where("symbols IS NOT NULL").select(F.posexplode("symbols").alias("byte", "n"))
    counts = np.zeros(256)
    for row in bytes_of.groupBy("byte").agg(F.sum("n").alias("n")).collect():
        counts[row["byte"]] = row["n"]
    out = []
    for alphabet in ENCODINGS:
        own = counts[[ord(c) for c in alphabet]]
        share = own / max(own.sum(), 1.0)
        out.append((float((share ** 2).sum()), float((share ** 3).sum())))
    return out


def strangeness(string: Column, known: list[tuple[float, float]]) -> Column:
    """Bin of a string's distance from ordinary text, in standard deviations; very low for keys."""
    def of(n):
        return F.element_at(F.array(*[F.lit(pair[n]) for pair in known]), string["encoding"] + 1)

    n, s2, s3 = string["n"].cast("double"), of(0), of(1)
    mean = n + n * (n - 1) * s2
    variance = 2 * n * (n - 1) * (s2 - s2 * s2) + 4 * n * (n - 1) * (n - 2) * (s3 - s2 * s2)
    away = F.when(variance > 0, (string["squares"] - mean) / F.sqrt(variance)).otherwise(0.0)
    return F.floor(F.greatest(F.lit(-float(WIDEST)), F.least(F.lit(float(WIDEST)), away)) * BINS).cast("int")


def length_class(string: Column) -> Column:
    return F.least(F.lit(CLASSES - 1), F.floor(F.log2(string["n"].cast("double") / SHORTEST)).cast("int"))


def cuts(counts: list[tuple[int, int, bool, int]]) -> dict[int, int]:
    """The highest bin of each class of lengths that the step-up rule lets through.

    ``counts``: class, bin, whether the battery found the strings random, strings. Strings that it did not
    count as tests that are never significant.
    """
    tests, random = {}, {}
    for kind, place, good, n in counts:
        tests[kind] = tests.get(kind, 0) + n
        if good:
            random.setdefault(kind, {}).setdefault(place, 0)
            random[kind][place] += n
    found = {}
    for kind, bins in random.items():
        below = 0
        for place in sorted(bins):
            below += bins[place]
            if above(-(place + 1) / BINS) * tests[kind] <= DISCOVERIES * below:
                found[kind] = place
    return found


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: ``id, spans`` (start, kind as a number, end) in order."""
    found = read(docs, id, text)
    known = frequencies(found)
    one = found.where("symbols IS NULL").select(F.explode("strings").alias("string"))
    one = one.select(length_class(F.col("string")).alias("class"), strangeness(F.col("string"), known).alias("bin"), "string.random")
    limits = cuts([tuple(r) for r in one.groupBy("class", "bin", "random").agg(F.count("*").alias("n")).collect()])
    limit = F.array(*[F.lit(limits.get(n, -BINS * WIDEST - 1)) for n in range(CLASSES)])
    kept = F.filter("strings", lambda s: s["random"] & (strangeness(s, known) <= F.element_at(limit, length_class(s) + 1)))
    new = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))
    return found.where("symbols IS NULL").select(F.col("id").alias(id), F.array_sort(F.concat("spans", new)).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_assign, n_access, n_hex, base_sha256, spans`` and ``n_random``."""
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return scan(docs, id, text).select(
        f"`{id}`", count(0), count(1), count(2), F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"), count(3))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return report(table(spark, folder, "documents"))
