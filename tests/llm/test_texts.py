"""Operators that judge one text at a time, against plain Python."""

import collections
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shoplake.llm import language, quality, token_counts, toxicity
from shoplake.llm.common import Hashes

ODD = [(1, None), (2, ""), (3, " \n\t\n"), (3, " \n\t\n"), (None, "a b"), (4, "né à 👍 " * 3000), (5, "x" * 20000)]


def test_quality_counts_match_plain_python():
    random.seed(5)

    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, copies = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                copies += line in seen
                seen.add(line)
        windows = collections.Counter(tuple(words[n:n + 8]) for n in range(len(words) - 7))
        hit = {m for n in range(len(words) - 7) if windows[tuple(words[n:n + 8])] > 1 for m in range(n, n + 8)}
        return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(hit)

    texts = ["", "é #a\n\né #a\n", "a " * 30, "  b"]
    texts += [" ".join(random.choices("ab cd\n e# é".split(" "), k=random.randrange(60))) for _ in range(200)]
    assert all(quality.counts(t.encode(), Hashes()) == plain(t) for t in texts)
    assert quality.counts(None, Hashes()) == (0, 0, 0, 0, 0)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5):
        scores, move = rng.normal(size=(size, 2)), rng.normal(size=(2, 2))

        def value(path):
            return sum(scores[n, s] for n, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))

        paths = [[n >> k & 1 for k in range(size)] for n in range(2 ** size)]
        assert value(quality.viterbi(scores, move).tolist()) == pytest.approx(max(map(value, paths)))
    assert len(quality.viterbi(np.zeros((0, 2)), np.zeros((2, 2)))) == 0


def test_crf_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    scores, move = rng.normal(size=(1, 3, 2)), rng.normal(size=(2, 2))
    near, pairs = quality.marginals(scores, move, np.ones((1, 3), bool))
    weights = {p: np.exp(sum(scores[0, n, s] for n, s in enumerate(p)) + move[p[0], p[1]] + move[p[1], p[2]])
               for p in np.ndindex(2, 2, 2)}
    total = sum(weights.values())
    assert near[0, 1, 1] == pytest.approx(sum(w for p, w in weights.items() if p[1] == 1) / total)
    assert pairs[0, 0, 1] == pytest.approx(sum(w * ((p[:2] == (0, 1)) + (p[1:] == (0, 1))) for p, w in weights.items()) / total)


def test_quality_rules_on_odd_rows(docs, spark):
    fitted = quality.model(docs(*ODD), spark.createDataFrame([], "doc_id bigint, quality int"))
    found = quality.rules(docs(*ODD), fitted).collect()
    assert len(found) == len(ODD) and not any(r.kept for r in found if r.doc_id in (1, 2, 3, 5, None))
    assert quality.rules(docs(*ODD).limit(0), fitted).count() == 0


def test_quality_keeps_most_labelled_good(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.rules(docs, quality.model(docs, labels)).join(labels, "doc_id").where("NOT base_failed")
    good = found.where("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.95


def test_automaton_holds_exactly_the_substrings():
    words = ["abab", "bca", "abc", "caab"]
    moves = language.automaton(words)
    inside = {w[a:b] for w in words for a in range(len(w)) for b in range(a + 1, len(w) + 1)}

    def has(text):
        state = 0
        for char in text:
            state = moves.get((state, char))
            if state is None:
                return False
        return True

    for size in range(1, 5):
        for n in range(3 ** size):
            text = "".join("abc"[n // 3 ** k % 3] for k in range(size))
            assert has(text) == (text in inside)
    assert language.phrases("ababzbca", moves) == 3 and language.phrases("", moves) == 0


def test_only_letters_make_words(docs):
    assert language.runs_of_letters("½ ² ① Ⅷ ab1c né e\u0301a _x 日本語 हिन्दी") == ["ab", "c", "né", "e\u0301a", "x", "日本語", "हिन्दी"]
    found = language.predict(docs((1, "½ ²"), (2, "①Ⅷ 12"), (3, "è")), [("en", language.automaton([" the "]))]).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "und", 2: "und", 3: "en"}


def test_language_of_long_texts_only_is_learned(docs):
    fitted = language.model(docs(*[(n, "wort " * 3000) for n in range(5)]))
    assert [name for name, _ in fitted] == ["en"] and fitted[0][1]


def test_fewest_phrases_win_by_brute_force(docs):
    random.seed(11)
    known = {name: ["".join(random.choices("abc" if name == "x" else "bcd", k=random.randrange(1, 7))) for _ in range(6)] for name in "xy"}
    texts = [" ".join("".join(random.choices("abcd", k=random.randrange(1, 9))) for _ in range(4)) for _ in range(40)]

    def count(word, words):
        inside, at, n = {f" {w} "[a:b] for w in words for a in range(len(w) + 2) for b in range(a + 1, len(w) + 3)}, 0, 0
        while at < len(word):
            size = max([1, *(s for s in range(1, len(word) - at + 1) if word[at:at + s] in inside)])
            at, n = at + size, n + 1
        return n

    fitted = [(name, language.automaton([f" {w} " for w in sorted(set(words))])) for name, words in known.items()]
    found = {r.doc_id: r for r in language.predict(docs(*enumerate(texts)), fitted).collect()}
    for n, text in enumerate(texts):
        x, y = (sum(count(f" {w} ", known[name]) for w in text.split()) for name in "xy")
        assert found[n].lang_pred == ("x" if x <= y else "y") and found[n].score == pytest.approx(1 - min(x, y) / max(x, y))


def test_language_on_odd_rows_and_held_out(docs, spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fitted = language.model(table.where(~language.held_out()))
    found = {(r.doc_id, r.lang_pred, r.score) for r in language.predict(docs(*ODD), fitted).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)} <= found
    assert {r.lang_pred for r in language.predict(docs((1, "a")), []).collect()} == {"und"}
    scored = language.predict(table, fitted).join(table.where(language.held_out()).select("doc_id", "lang"), "doc_id")
    assert scored.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_toxicity_grades_and_thresholds(spark, sf_dir, docs):
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = [("you awful horrid thing " + "word " * n, 1) for n in range(5, 30)] + [("nice day " + "word " * n, 0) for n in range(5, 60)]
    weights, thresholds = toxicity.train([(toxicity.Buckets().of(text), mark) for text, mark in rows])
    assert (np.diff(thresholds) > 0).all() and all(w > 0 for w in weights.values())
    found = {r.doc_id: r for r in toxicity.severity(docs(*ODD, (9, "you awful horrid thing"), (10, "a nice word")), (weights, thresholds)).collect()}
    assert found[9].toxic and not found[10].toxic and not found[1].toxic and 0 <= found[9].severity <= toxicity.GRADES - 1
    none = toxicity.model(documents.limit(0), labels)
    assert not toxicity.severity(docs(*ODD), none).where("toxic OR severity > 0").count()


def test_likelihood_and_slopes_of_the_ordinal_model():
    rng = np.random.default_rng(3)
    x, grade, share = rng.random((40, 3)), rng.integers(0, toxicity.GRADES, 40), np.full(40, 1 / 40)

    def plain(value):
        weights, cuts = value[:3], [value[3], value[3] + math.exp(value[4]), value[3] + math.exp(value[4]) + math.exp(value[5])]
        total = 0.5e-4 * sum(w * w for w in weights)
        for row, g in zip(x, grade):
            at_most = [0, *(1 / (1 + math.exp(sum(a * b for a, b in zip(row, weights)) - c)) for c in cuts), 1]
            total -= math.log(at_most[g + 1] - at_most[g]) / 40
        return total

    value = rng.normal(size=6)
    total, slopes = toxicity.loss(value, x, grade, share)
    assert total == pytest.approx(plain(value))
    for n in range(6):
        step = np.zeros(6)
        step[n] = 1e-5
        assert slopes[n] == pytest.approx((plain(value + step) - plain(value - step)) / 2e-5, abs=1e-6)
    weights, cuts = toxicity.fit(x, grade, share)
    best = np.concatenate([weights, [cuts[0]], np.log(np.diff(cuts))])
    assert all(plain(best) <= plain(best + rng.normal(size=6) * 0.2) for _ in range(50))


def test_a_document_has_no_say_in_its_grade():
    """Grades follow the other half: by plain counting, and unmoved by a word that one document alone has."""
    rng = random.Random(4)
    bad, plain = [f"{a}wful" for a in "abcdefgh"], [f"{a}word" for a in "abcdefghij"]
    texts = [rng.choices(bad, k=rng.randrange(1, 30)) + rng.choices(plain, k=20) for _ in range(80)]
    texts += [rng.choices(plain, k=20) for _ in range(80)]
    marks, cache = np.array([1] * 80 + [0] * 80), toxicity.Buckets()
    found = [cache.of(" ".join(t)) for t in texts]
    grade = toxicity.graded(found, marks)
    assert (grade[80:] == 0).all() and set(grade[:80]) == {1, 2, 3}

    for side in (0, 1):
        other, own = range(1 - side, 80, 2), range(side, 80, 2)
        odds = {}
        for bucket in set().union(*found):
            hit, clean = sum(bucket in found[n] for n in other), sum(bucket in found[n + 80] for n in other)
            parts = [hit + 0.5, 40 - hit + 0.5, clean + 0.5, 40 - clean + 0.5]
            value = math.log(parts[0] / parts[1]) - math.log(parts[2] / parts[3])
            if value / math.sqrt(sum(1 / p for p in parts)) >= toxicity.MIN_Z and hit >= 4 * clean and hit >= 40 * toxicity.MIN_SUPPORT:
                odds[bucket] = value
        totals = [round(sum(v * math.log1p(found[n][b]) for b, v in odds.items()), 9) for n in own]
        low, high = np.quantile(totals, [1 / 3, 2 / 3])
        assert [grade[n] for n in own] == [1 + (t > low) + (t > high) for t in totals]

    found[10] = found[10] + cache.of("strange " * 500)
    assert toxicity.graded(found, marks)[10] == grade[10]


def test_toxicity_without_rows(spark, sf_dir):
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    assert toxicity.severity(documents.limit(0), toxicity.model(documents, labels)).count() == 0
    weights, thresholds = toxicity.model(documents, labels.where("toxic = 1"))
    assert weights == {} and np.isinf(thresholds).all()


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_add_up_to_the_tokens_of_the_whole(docs, rule):
    encoding, _ = token_counts.tokenizer(public_tokenizers.path(token_counts.RANKS))
    rows = [(1, None), (2, ""), (3, "one.\n\n\ntwo  three\n"), (4, "é👍\n" * 40), (5, "\n\n")]
    found = token_counts.counts(docs(*rows), fields=("source", "text"), rule=rule).groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n"), F.sum("n_bytes").alias("b")).collect()
    for row in found:
        whole = "s\n" + (dict(rows)[row.doc_id] or "")
        assert row.n == pytest.approx(len(encoding.encode_ordinary(whole))) and row.b == len(whole.encode())


def test_boundary_rules():
    sizes, ends = np.array([2, 4, 1]), np.array([0, 3, 3, 7])  # the second token lies 1 : 3 over the boundary
    assert token_counts.attributed(sizes, ends, "first").tolist() == [2, 0, 1]
    assert token_counts.attributed(sizes, ends, "most").tolist() == [1, 0, 2]
    assert token_counts.attributed(sizes, ends, "split").tolist() == [1.25, 0, 1.75]
