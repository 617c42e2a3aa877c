"""Token counts of a document's sections by offset-mapped attribution.

A document is its fields in order, joined by ``\\n``, and is encoded once as a
whole. Sections are the lines of each field, every line with the ``\\n`` that ends
it. A byte-level token covers a span of the text; tokens and sections are matched
by interval. A token that crosses a boundary goes, by ``rule``, to

* ``first``: the section that holds its first byte (the default);
* ``most``: the section that holds most of its bytes, the first of equal ones;
* ``split``: to every section it touches, by the share of its bytes.

Each of the rules hands out every token once, so a document's sections add up to
its tokens. Null fields count as empty; a document whose fields are all empty has
one section of no tokens. Each input row gives its own sections, repeated rows and
null ids included. Other columns are not read.
"""

import base64

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.llm.common import arrow_map, table, utf8

RANKS = "byte_bpe_50k.tiktoken"
RULES = ("first", "most", "split")


def tokenizer(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding and the number of bytes of each token."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, n in ranks.items():
        sizes[n] = len(piece)
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ), sizes


def sections(fields: list[bytes]) -> tuple[bytes, list[tuple[int, int]], np.ndarray]:
    """The joined text, (field, line) of every section, and where sections start and end."""
    names, ends, at, last = [], [0], 0, len(fields) - 1
    for n, field in enumerate(fields):
        lines = field.split(b"\n")
        for m, line in enumerate(lines):
            at += len(line) + (n < last or m + 1 < len(lines))
            names.append((n, m))
            ends.append(at)
    return b"\n".join(fields), names, np.array(ends, np.int64)


def attributed(sizes: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section; ``sizes`` are the bytes of the tokens in order."""
    count = len(ends) - 1
    stop = np.cumsum(sizes)
    start = stop - sizes
    # sections of no bytes share their start with the next one, which is found here
    first = np.searchsorted(ends, start, side="right") - 1
    last = np.searchsorted(ends, stop, side="left") - 1
    if rule == "first":
        return np.bincount(first, minlength=count).astype(np.float64)
    total = np.bincount(first[first == last], minlength=count).astype(np.float64)
    for n in np.flatnonzero(first != last):
        touched = np.arange(first[n], last[n] + 1)
        part = np.minimum(ends[touched + 1], stop[n]) - np.maximum(ends[touched], start[n])
        if rule == "split":
            total[touched] += part / sizes[n]
        else:
            total[touched[part.argmax()]] += 1
    return total


def counts(
    docs: DataFrame, id: str = "doc_id", fields: tuple[str, ...] = ("text",), rule: str = "first", path: str | None = None
) -> DataFrame:
    """``id, field, line, n_bytes, n_tokens`` for every section of every document."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = path or public_tokenizers.path(RANKS)

    def start():
        encoding, piece_bytes = tokenizer(path)

        def step(ids, *columns):
            out = []
            for name, *texts in zip(ids, *columns):
                text, names, ends = sections([t or b"" for t in texts])
                tokens = np.asarray(encoding.encode_ordinary(text.decode()), np.int64)
                found = attributed(piece_bytes[tokens], ends, rule)
                out.extend(
                    (name, fields[field], line, size, total)
                    for (field, line), size, total in zip(names, np.diff(ends).tolist(), found.tolist())
                )
            return out

        return step

    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("id"), *[utf8(f).alias(f"f{n}") for n, f in enumerate(fields)])
    return arrow_map(rows, f"`{id}` bigint, field string, line int, n_bytes bigint, n_tokens double", start)


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = counts(table(spark, folder, "documents"), fields=("source", "text"))
    return found.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))
