"""Language identification by cross-parsing entropy.

For each language, a suffix automaton holds the distinct words of labelled text, so
phrases end where words do. A text's words (runs of letters and their marks, lowered,
with a space at either end) are parsed from left to right into the
longest phrases that the automaton holds; a character it lacks is a phrase. The
language needing the fewest phrases for each character wins; ties go to the
language whose name comes first.

The automata are built from at most ``TRAIN_ROWS`` documents of each language
(those that come first by a hash of doc_id), of each of which at most ``TRAIN_CHARS``
characters are learned; the query takes only documents whose crc32(doc_id as text) mod 4 is
not 2. Every whole text is predicted from its text alone.

Null text, text without letters, and any text when no labelled row can be learned
from get ``und`` with score 0. ``score``: one minus the winner's phrases over those
of the next language; 1 if there is no other. Each input row gives one output row.
"""

import functools
import re
import sys
import unicodedata
from collections.abc import Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.llm.common import CACHED_WORDS, arrow_map, first_by_hash, table

TRAIN_ROWS = 64
TRAIN_CHARS = 6000
_PLAIN = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


@functools.cache
def special() -> np.ndarray:
    """Code points that are marks, or numbers that ``_PLAIN`` takes for letters, such as a half."""
    kinds = map(unicodedata.category, map(chr, range(sys.maxunicode + 1)))
    return np.fromiter((kind[0] == "M" or kind in ("Nl", "No") for kind in kinds), bool, sys.maxunicode + 1)


def runs_of_letters(text: str) -> list[str]:
    """Runs of letters (Unicode category L) with the marks that follow them."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = text.isascii() or not special()[points].any()
    return (_PLAIN if plain else _LETTERS).findall(text)


#: Longer words are parsed each time they occur instead of being remembered.
REMEMBERED = 40


def automaton(words: list[str]) -> dict[tuple[int, str], int]:
    """Suffix automaton of several words as moves ``(state, character) -> state``."""
    move, link, length = [{}], [-1], [0]

    def extend(last: int, char: str) -> int:
        if char in move[last]:
            known = move[last][char]
            if length[known] == length[last] + 1:
                return known
            return split(last, known, char)
        state = len(move)
        move.append({})
        link.append(0)
        length.append(length[last] + 1)
        while last >= 0 and char not in move[last]:
            move[last][char] = state
            last = link[last]
        if last >= 0:
            known = move[last][char]
            link[state] = known if length[known] == length[last] + 1 else split(last, known, char)
        return state

    def split(at: int, known: int, char: str) -> int:
        copy = len(move)
        move.append(dict(move[known]))
        link.append(link[known])
        length.append(length[at] + 1)
        link[known] = copy
        while at >= 0 and move[at].get(char) == known:
            move[at][char] = copy
            at = link[at]
        return copy

    for word in words:
        state = 0
        for char in word:
            state = extend(state, char)
    return {(state, char): to for state, moves in enumerate(move) for char, to in moves.items()}


def phrases(word: str, moves: dict[tuple[int, str], int]) -> int:
    """Number of longest-match phrases of a word."""
    count, state, at = 0, 0, 0
    while at < len(word):
        to = moves.get((state, word[at]))
        if to is None:
            count += 1
            if state == 0:
                at += 1  # a character the automaton lacks
            state = 0
        else:
            state, at = to, at + 1
    return count + (state != 0)


def model(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, dict]]:
    """An automaton for each language of the bounded sample, by name."""
    rows = labelled.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("kind"))
    rows = rows.where("kind IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("text", F.substring(F.regexp_extract("text", r"(?s)\p{L}.*", 0), 1, TRAIN_CHARS))
    words: dict[str, dict] = {}
    for row in first_by_hash(rows, TRAIN_ROWS):
        words.setdefault(row["kind"], {}).update(dict.fromkeys(runs_of_letters(row["text"].lower())))
    return [(name, automaton([f" {w} " for w in sorted(words[name])])) for name in sorted(words)]


def predict(
    docs: DataFrame, fitted: list[tuple[str, dict]], id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """``id, lang_pred, score, phrase_rate`` for every document, and its columns ``keep``, which no prediction reads."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def start():
        names = [name for name, _ in shared.value]
        moves = [m for _, m in shared.value]
        known: dict[str, tuple] = {}

        def parse(word):
            found = known.get(word)
            if found is None:
                found = tuple(phrases(f" {word} ", m) for m in moves)
                if len(word) <= REMEMBERED:
                    known[word] = found
            return found

        def step(ids, texts, *kept):
            out = []
            if len(known) > CACHED_WORDS:
                known.clear()
            for name, body, *rest in zip(ids, texts, *kept):
                words = runs_of_letters((body or "").lower())
                if not words or not names:
                    out.append((name, "und", 0.0, None, *rest))
                    continue
                total = np.array(list(map(parse, words)), np.int64).sum(0)
                best = int(total.argmin())
                others = np.delete(total, best)
                score = 1.0 - total[best] / others.min() if len(others) else 1.0
                out.append((name, names[best], float(score), float(total[best] / sum(map(len, words))), *rest))
            return out

        return step

    own = [F.col(f"`{c}`").alias(f"kept_{n}") for n, c in enumerate(keep)]
    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), *own)
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return arrow_map(rows, f"`{id}` bigint, lang_pred string, score double, phrase_rate double{kinds}", start)


def held_out(id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(f"`{id}`").cast("string")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fitted = model(docs.where(~held_out()))
    found = predict(docs, fitted)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
