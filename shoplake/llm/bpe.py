"""BPE encoding and decoding over a table of distinct words.

The tokenizer never merges across white space and its normalizer works within
words, so a text's ids are the ids of its words in order.

1. Each task splits its texts into words and packs them into blocks: the distinct
   words of some documents, and the documents as places in that list.
2. The words of all blocks are grouped into one table of distinct words, each with
   the (block, place) where it stands. A word that every block holds would collect
   without bound, so words are grouped by lots of ``LOT`` tasks.
3. Every word of the table is encoded once; its ids go back to the places of its
   blocks, and the documents of a block read theirs by place.
4. Decoding joins token ids with the table of pieces.

Texts are split once for their words and once for their places rather than stored
between the two; the input must read the same twice, as files and stored tables do.
Blocks are named by a hash of what they hold, and the job fails if a name is not met.

Null and empty texts have no ids and decode to the empty text. Every input row
gives one output row, repeated rows and null identifiers included; other columns
are not read.
"""

import functools
import hashlib
import itertools
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from shoplake.llm import blocks
from shoplake.llm.blocks import by_document
from shoplake.llm.common import arrow_map, store, table, utf8
from shoplake.workspace import session_settings

VOCABULARY = "word_bpe_49k.json"
#: Text in a block; few blocks are in a task's memory at a time.
BLOCK_BYTES = 40_000_000
#: Tasks whose blocks share a row of the distinct-word table.
LOT = 1024
WORDS_PER_BATCH = 8192
BATCH_BYTES = "16m"


def words(text: bytes) -> list[bytes]:
    """What white space separates, in small letters unless a token that knows letter case may be inside."""
    return (text if b"<|" in text else text.lower()).split()


def split(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``block, lot, keys, docs, codes``: blocks of documents with their distinct words."""
    rows = docs.select(utf8(text).alias("text"), F.col(f"`{id}`").cast("bigint").alias("id"))
    packed = blocks.pack(rows, "binary", lambda: words, "id bigint", most=BLOCK_BYTES)
    lot = (F.shiftright("block", 32) / LOT).cast("int").alias("lot")
    return packed.select(F.xxhash64("block", "mark").alias("block"), lot, "keys", "docs", "codes")


def distinct_words(packed: DataFrame) -> DataFrame:
    """``word, lot, uses``: every distinct word of a lot with the blocks and places that hold it."""
    every = packed.select("block", "lot", F.posexplode("keys").alias("place", "word"))
    # a block has a word once, so lists made before the shuffle would only make it larger
    return every.repartition("word").groupBy("word", "lot").agg(F.collect_list(F.struct("block", "place")).alias("uses"))


def encode_words(table: DataFrame, path: str) -> DataFrame:
    """``block, places, sizes, flat``: ids of the words at places of blocks; each row of ``table`` is encoded once.

    Ids are numbers from ``base(path)`` on, which fit two bytes where the vocabulary does.
    """
    kind, least = ("smallint", -(1 << 15)) if base(path) else ("int", 0)

    def start():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)

        def step(names, blocks_of, places_of):
            encoded = tokenizer.encode_batch([w.decode() for w in names], add_special_tokens=False)
            ids = [e.ids for e in encoded]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(sizes.sum())) + least
            starts = np.cumsum(sizes) - sizes
            word = np.repeat(np.arange(len(ids)), np.fromiter(map(len, blocks_of), np.int64, len(ids)))
            block = np.fromiter(itertools.chain.from_iterable(blocks_of), np.int64, len(word))
            place = np.fromiter(itertools.chain.from_iterable(places_of), np.int64, len(word))
            order = np.argsort(block, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                size = sizes[word[own]]
                at = np.repeat(starts[word[own]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                yield int(block[own[0]]), place[own].tolist(), size.tolist(), flat[at].tolist()

        return step

    columns = table.select("word", F.col("uses.block").alias("blocks"), F.col("uses.place").alias("places"))
    return arrow_map(columns, f"block bigint, places array<int>, sizes array<int>, flat array<{kind}>", start, size=WORDS_PER_BATCH)


def base(path: str) -> int:
    """What ids are moved down by, so that a vocabulary of at most 65536 fits two bytes."""
    return 1 << 15 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 0


def returned(packed: DataFrame, encoded: DataFrame) -> DataFrame:
    """Blocks with ``places, sizes, flat``: the ids of the word at each place."""
    parts = ("places", "sizes", "flat")
    found = encoded.groupBy("block").agg(F.collect_list(F.struct(*parts)).alias("found"))
    return packed.select("block", "docs", "codes").join(
        found.select("block", *[F.flatten(f"found.{c}").alias(c) for c in parts]), "block", "left")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``id, piece``: as many rows as the tokenizer has ids, a fixed number."""
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame([(n, piece) for piece, n in vocabulary.items()], "id int, piece string")


def decode(tokens: DataFrame, key: list[str], path: str) -> DataFrame:
    """Add ``decoded``: the pieces of ``ids`` in order, joined by spaces.

    The vocabulary has no decoder of its own, and then the library joins the
    pieces of all tokens with spaces. ``key`` names the rows.
    """
    spark = tokens.sparkSession
    one = tokens.select(*key, F.posexplode("ids").alias("at", "id"))
    text = (
        one.join(F.broadcast(pieces(spark, path)), "id")
        .groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("found"))
    )
    return text.select(*key, F.array_join(F.col("found.piece"), " ").alias("decoded"))


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row for each document: ``id, ids array<int>, decoded string``."""
    path = path or public_tokenizers.path(VOCABULARY)
    return _joined(docs, id, text, path, f"`{id}` bigint, ids array<int>, decoded string",
                   lambda name, ids, words: (name, ids.tolist(), b" ".join(words).decode()))


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """As ``encode``, with the number of tokens and SHA-256 of ids and decoded text."""
    path = path or public_tokenizers.path(VOCABULARY)
    schema = f"`{id}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _joined(docs, id, text, path, schema, lambda name, ids, words: (
        name, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
        hashlib.sha256(b" ".join(words)).hexdigest()))


def _joined(docs, id, text, path, schema, row) -> DataFrame:
    packed = split(docs, id, text)
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    shared = docs.sparkSession.sparkContext.broadcast({n: piece.encode() for piece, n in vocabulary.items()})
    least = base(path)
    whole = returned(packed, encode_words(distinct_words(packed), path))
    result = arrow_map(whole.select("places", "sizes", "flat", "docs", "codes"), schema, lambda: _rows(shared.value, row, least), size=1, bunch=64)
    # a row holds a block, so bytes and not rows bound what crosses to Python together
    with session_settings(docs.sparkSession, spark__sql__execution__arrow__maxBytesPerBatch=BATCH_BYTES):
        return store(result, "encoded")


def _rows(piece_of, row, least):
    """Ids and pieces of each document out of those of its block's words.

    The id-to-piece table has a fixed number of rows, so every task joins its
    words' ids with a broadcast copy of it. A block's lists stay Arrow arrays: as
    Python numbers they would take ten times the room.
    """
    def numbers(values):
        return (values.values if values.is_valid else pa.array([], pa.int32())).to_numpy(zero_copy_only=False)

    def step(*columns):
        for places, sizes, flat, docs, codes in zip(*columns):
            at, count, flat = numbers(places), numbers(sizes).astype(np.int64), numbers(flat).astype(np.int32) + np.int32(least)
            docs, codes = docs.as_py(), codes.as_py()
            lengths, starts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            lengths[at], starts[at] = count, np.cumsum(count) - count

            @functools.lru_cache(maxsize=None)
            def piece(place):
                return b" ".join(map(piece_of.__getitem__, flat[starts[place]:starts[place] + lengths[place]].tolist()))

            for member, own in by_document(docs, codes):
                if len(own) and own.max() >= len(at):
                    raise RuntimeError("the documents did not read the same twice; store them first")
                size = lengths[own]
                shift = np.repeat(starts[own] - (np.cumsum(size) - size), size)
                yield row(member["id"], flat[shift + np.arange(len(shift))], filter(None, map(piece, own.tolist())))

    step.arrow = True
    return step


def query(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))
