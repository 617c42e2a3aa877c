"""Language-model scoring by cross-entropy difference.

Two bigram models share one vocabulary, one order and one smoothing: the target
model counts documents labelled good (quality 1), the background model counts all
documents. Tokens are lowered words; the vocabulary holds every word of all
documents, and every text starts after a start token. (With ``VOCABULARY`` set to a
number it holds that many of the commonest words, and any other word is one unknown
token.) A document's score is the mean over its tokens of target loss minus
background loss, in nats: the lower, the more like the target.

  p(w | v) = (c(v, w) + K p(w)) / (c(v) + K),   p(w) = (c(w) + 1) / (N + V + 2)

c(v) counts every occurrence of v, so a word that ends a text leaves its share to
the end, which is not scored.

Counts cover every document. Words are numbered in a stored table that has their
counts, and each block gets those of its own words by join. Bigrams are counted by
block and move as compressed columns, so a bigram moves once for each block that has
it; its sums over all blocks return by join, and losses are summed by position.
Texts without words score null. Without labels the target counts are
zero, and both models still give every token a probability. Each input row gives
one row; rows of one doc_id take the label of that id, the best of several.
"""

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.llm import blocks
from shoplake.llm.blocks import expanded, squeezed
from shoplake.llm.common import arrow_map, mixed, store, table, utf8

#: Words in the vocabulary, the commonest first; None: all of them.
VOCABULARY = None
#: Weight of the unigram model in the bigram model, as a number of tokens.
PRIOR = 5.0
START, UNKNOWN = 0, 1
#: Bigrams, counted once for each block that has them, that meet in one task, at most about.
PART_KEYS = 2_000_000


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def with_targets(packed: DataFrame, labels: DataFrame) -> DataFrame:
    """Blocks with the places of their target documents, ``good``.

    Only ids meet the labels; texts and codes stay where they are. The places are
    stored, so that Spark knows their size when it joins them.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").alias("id")).distinct()
    members = packed.select("block", F.posexplode("docs.id").alias("at", "id")).join(good, "id", "left_semi")
    return packed.join(store(members.groupBy("block").agg(F.collect_list("at").alias("good")), "targets"), "block", "left")


def lengths(docs: list) -> np.ndarray:
    return np.fromiter((m["n"] for m in docs), np.int64, len(docs))


def chosen(docs: list, good: list | None) -> np.ndarray:
    """Which of a block's documents are target documents."""
    found = np.zeros(len(docs), bool)
    found[good or []] = True
    return found


def word_counts(marked: DataFrame) -> DataFrame:
    """``word, n, n_target`` over all documents; the empty word counts texts with words."""
    def start():
        def step(keys, docs, good, codes):
            out = []
            for own, members, named, code in zip(keys, docs, good, codes):
                every, sizes, target = expanded(code), lengths(members), chosen(members, named)
                inside = np.repeat(target, sizes)
                sums = [np.bincount(e, minlength=len(own)) for e in (every, every[inside])]
                texts = [(sizes > 0).sum(), (sizes[target] > 0).sum()]
                out.append(([*own, b""], *(np.append(n, first) for n, first in zip(sums, texts))))
            return out

        return step

    schema = "word array<binary>, n array<bigint>, n_target array<bigint>"
    parts = arrow_map(marked.select("keys", "docs", "good", "codes"), schema, start, size=1)
    each = parts.select(F.inline(F.arrays_zip("word", "n", "n_target")))
    return each.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def numbered(counts: DataFrame) -> DataFrame:
    """``word, number, n, n_target``, numbers from ``UNKNOWN + 1`` without a gap.

    Only the number of words in each stored part goes to the driver.
    """
    rows = store(counts.withColumn("at", F.monotonically_increasing_id()), "vocabulary")
    part = F.shiftright("at", 33)
    sizes, first, offsets = sorted(rows.groupBy(part.alias("part")).count().collect()), UNKNOWN + 1, []
    for number, size in sizes:
        offsets.append((number, first))
        first += size
    if first >= 1 << 32:
        raise ValueError("more words than 32 bits can number")
    shift = counts.sparkSession.createDataFrame(offsets, "part bigint, first bigint")
    number = F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)
    return rows.withColumn("part", part).join(F.broadcast(shift), "part").select("word", number.alias("number"), "n", "n_target")


def wide(values: np.ndarray) -> bytes:
    """64-bit numbers as their low, then their high halves, compressed."""
    return squeezed(np.concatenate([values & 0xFFFFFFFF, values >> 32]))


def narrow(data: bytes) -> np.ndarray:
    low, high = expanded(data).reshape(2, -1)
    return high << 32 | low


def of_blocks(packed: DataFrame, known: DataFrame, unknown: list[int]) -> DataFrame:
    """``block, numbers, own, own_target``: numbers and counts of each block's words, in its order.

    ``unknown``: both counts of the words that ``known`` has not.
    """
    def start():
        def step(names, places, *columns):
            out = []
            for block, at, *row in zip(names, places, *columns):
                order = np.argsort(np.array(at, np.int64))
                out.append((block, *(wide(np.array(values, np.int64)[order]) for values in row)))
            return out

        return step

    found = blocks.keys(packed).join(known.withColumnRenamed("word", "key"), "key", "left").select(
        "block", "place", F.coalesce("number", F.lit(UNKNOWN)).alias("number"),
        F.coalesce("n", F.lit(unknown[0])).alias("n"), F.coalesce("n_target", F.lit(unknown[1])).alias("n_target"))
    names = ["place", "number", "n", "n_target"]
    by_block = found.groupBy("block").agg(F.collect_list(F.struct(*names)).alias("found"))
    schema = "block bigint, numbers binary, own binary, own_target binary"
    return arrow_map(by_block.select("block", *[F.col(f"found.{c}").alias(c) for c in names]), schema, start, size=1)


def bigrams(sizes: np.ndarray, codes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous word and word of a block's distinct bigrams, as places, and the bigram of each token.

    The word before a text's first one has place -1.
    """
    every = expanded(codes)
    pairs = np.empty_like(every)
    pairs[1:] = every[:-1]
    pairs[(np.cumsum(sizes) - sizes)[sizes > 0]] = -1
    pairs <<= 32
    pairs |= every
    # as np.unique does, in less memory
    del every
    order = np.argsort(pairs)
    pairs = pairs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    which = np.empty(len(pairs), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    pairs = pairs[new]
    return pairs >> 32, pairs & 0xFFFFFFFF, which


def dealt(marked: DataFrame, parts: int) -> DataFrame:
    """``part, block, keys, places, n, n_target``: the bigrams of every block, by hash.

    Each row has compressed columns: keys (``previous << 32 | word``, as numbers) in
    order, as differences, their places among the block's bigrams, and their counts there.
    """
    def start():
        def step(names, numbers, docs, good, codes):
            out = []
            for block, number, members, named, code in zip(names, numbers, docs, good, codes):
                sizes = lengths(members)
                before, word, which = bigrams(sizes, code)
                if not len(word):
                    continue
                number = np.append(narrow(number), START)
                own = number[before] << 32 | number[word]
                del before, word
                total = np.bincount(which, minlength=len(own))
                target = np.bincount(which[np.repeat(chosen(members, named), sizes)], minlength=len(own))
                part = (mixed(own.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((own, part))
                for places in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                    out.append((int(part[places[0]]), block, wide(np.diff(own[places], prepend=0)),
                                squeezed(places), squeezed(total[places]), squeezed(target[places])))
            return out

        return step

    schema = "part bigint, block bigint, keys binary, places binary, n binary, n_target binary"
    return arrow_map(marked.select("block", "numbers", "docs", "good", "codes"), schema, start, size=1)


def summed(parts: DataFrame) -> DataFrame:
    """``block, places, n, n_target`` with the counts of all blocks.

    What meets in one task is one part: about ``PART_KEYS`` bigrams, and of a bigram
    one count from each block.
    """
    def start():
        def step(groups):
            out = []
            for rows in groups:
                keys = [np.cumsum(narrow(r["keys"])) for r in rows]
                _, which = np.unique(np.concatenate(keys), return_inverse=True)
                sums = []
                for name in ("n", "n_target"):
                    every = np.zeros(which.max() + 1, np.int64)
                    np.add.at(every, which, np.concatenate([expanded(r[name]) for r in rows]))
                    sums.append(np.split(every[which], np.cumsum([len(k) for k in keys])[:-1]))
                out.extend((r["block"], r["places"], wide(n), wide(t)) for r, n, t in zip(rows, *sums))
            return out

        return step

    by_part = parts.groupBy("part").agg(F.collect_list(F.struct("block", "keys", "places", "n", "n_target")).alias("rows"))
    return arrow_map(by_part.select("rows"), "block bigint, places binary, n binary, n_target binary", start, size=1)


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, score`` for every document."""
    rows = docs.select(utf8(text).alias("text"), F.col(f"`{id}`").cast("bigint").alias("id"))
    packed = blocks.pack(rows, "binary", lambda: words, "id bigint", "words")
    marked = with_targets(packed, labels)
    counts = store(word_counts(marked), "counts")
    every, texts = counts.where("length(word) > 0"), counts.where("length(word) = 0")
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("n", "n_target")]
    known = numbered(every if VOCABULARY is None else every.orderBy(F.desc("n"), "word").limit(VOCABULARY))
    texts, total = (list(f.agg(*sums).first()) for f in (texts, every))
    size, *inside = known.agg(F.count("*"), *sums).first()
    own = store(of_blocks(packed, known, [a - b for a, b in zip(total, inside)]), "numbers")
    tokens = packed.select(F.explode("docs.n").alias("n")).agg(F.sum("n")).first()[0] or 0
    found = summed(dealt(marked.join(own, "block"), max(1, -(-tokens // PART_KEYS))))

    def start():
        def losses(before, word, own, counts):
            back, target = (
                -np.log((n + PRIOR * (c[word] + 1) / (all_words + size + UNKNOWN + 1)) / (c[before] + PRIOR))
                for n, c, all_words in zip(counts, own, total))
            return target - back

        def step(*columns):
            out = []
            for places, n, n_target, members, codes, *own in zip(*columns):
                sizes = lengths(members)
                before, word, which = bigrams(sizes, codes)
                counts = np.zeros((2, len(word)))
                for at, *row in zip(places or [], n or [], n_target or []):
                    counts[:, expanded(at)] = [narrow(c) for c in row]
                own = [np.append(narrow(c) if c else [], first) for c, first in zip(own, texts)]
                loss = losses(before, word, own, counts)[which]
                for member, used in zip(members, np.split(loss, np.cumsum(sizes)[:-1])):
                    out.append((member["id"], len(used), float(used.mean()) if len(used) else None))
            return out

        return step

    # a block without a word has no numbers
    with_own = packed.join(own, "block", "left")
    return blocks.unpack(with_own, found, f"`{id}` bigint, n_tokens bigint, score double", start, ["own", "own_target"])


def query(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"), table(spark, folder, "labels"))
