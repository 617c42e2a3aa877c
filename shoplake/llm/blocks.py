"""Documents packed by input task, with the distinct keys of each block.

A key (a word, a pair of word ids) occurs once in a block however often its
documents use it, so joining the keys of all blocks with a global table moves
far fewer rows than joining every position, and a frequent key has at most one
row for each block. The documents' keys are numbers by frequency in the block,
kept as compressed byte planes. A block closes at ``BLOCK_BYTES`` of text; one
longer document is a block alone.
"""

import numpy as np
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shoplake.llm.common import arrow_map, store

BLOCK_BYTES = 64_000_000


def squeezed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte by byte, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def expanded(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def pack(docs: DataFrame, key: str, start, carried: str = "", label: str | None = None, most: int = BLOCK_BYTES) -> DataFrame:
    """One row for each block, of at most ``most`` bytes of text or one document: ``block, mark, keys, docs, codes``; stored if there is a label.

    Input rows are the text as bytes, then the ``carried`` columns (DDL). ``docs``
    has those and the number of keys of each document, ``n``. ``codes`` has all
    documents' keys in order, as places in ``keys``. ``start()`` gives a function
    from a text to its keys, in order. ``mark`` is a hash of the codes: where blocks
    are packed anew for each use, it shows that the uses saw the same block.
    """
    fields = f"{carried}, " if carried else ""
    schema = f"block bigint, mark bigint, keys array<{key}>, docs array<struct<{fields}n: int>>, codes binary"

    def begin():
        keys_of = start()
        codes, members, found = {}, [], []
        state = {"bytes": 0, "number": 0, "task": TaskContext.get().partitionId()}

        def close():
            every = np.concatenate(found)
            order = np.argsort(-np.bincount(every, minlength=len(codes)), kind="stable")
            rank = np.empty(len(codes), np.int64)
            rank[order] = np.arange(len(codes))
            names = list(codes)
            data = squeezed(rank[every] if len(every) else every)
            row = (state["task"] << 32 | state["number"], xxhash.xxh64_intdigest(data) >> 1,
                   [names[n] for n in order.tolist()], list(members), data)
            codes.clear()
            members.clear()
            found.clear()
            state.update(bytes=0, number=state["number"] + 1)
            return row

        def step(texts, *others):
            done = []
            for text, *rest in zip(texts, *others):
                size = len(text or b"")
                if members and state["bytes"] + size > most:
                    done.append(close())
                state["bytes"] += size
                own = keys_of(text or b"")
                found.append(np.fromiter((codes.setdefault(k, len(codes)) for k in own), np.int32, len(own)))
                members.append((*rest, len(own)))
            return done

        step.finish = lambda: [[close()]] if members else []
        return step

    packed = arrow_map(docs, schema, begin)
    return store(packed, label) if label else packed


def keys(packed: DataFrame) -> DataFrame:
    """``block, place, key``: every distinct key of every block."""
    return packed.select("block", F.posexplode("keys").alias("place", "key"))


def by_document(docs: list, codes: bytes):
    """Each document of a block with the places of its keys."""
    every, at = expanded(codes), 0
    for member in docs:
        yield member, every[at:at + member["n"]]
        at += member["n"]


def unpack(packed: DataFrame, values: DataFrame, schema: str, start, carried: list[str] = []) -> DataFrame:
    """Join values back to the documents of their block.

    ``start()`` gives a function of (lists of value columns, ``docs``, ``codes`` and the
    ``carried`` columns of the blocks) that returns output rows. What meets in one task is one block. If ``values`` has a
    ``mark``, it must be that of the block.
    """
    columns = [c for c in values.columns if c not in ("block", "mark")]
    marks = [F.min("mark").alias("low"), F.max("mark").alias("high")] if "mark" in values.columns else []
    by_block = values.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias("found"), *marks)
    joined = packed.select("block", "mark", "docs", "codes", *carried).join(by_block, "block", "left")
    if marks:
        other = (F.col("low") != F.col("mark")) | (F.col("high") != F.col("mark"))
        error = F.raise_error(F.lit("the documents did not read the same twice; store them first")).cast("binary")
        joined = joined.withColumn("codes", F.when(other, error).otherwise(F.col("codes")))
    parts = [F.col(f"found.{c}").alias(c) for c in columns]
    return arrow_map(joined.select(*parts, "docs", "codes", *carried), schema, start, size=1)
