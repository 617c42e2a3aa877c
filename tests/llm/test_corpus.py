"""Operators over many texts, against brute force on small fixtures."""

import hashlib
import itertools
import math
import pathlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shoplake.llm import blocks, bpe, chat, common, decontamination, jaccard, lines, lm_score

ODD = [(1, None), (2, ""), (3, " \n\t\n"), (4, "né à 👍 " * 2000), (None, "alone here")]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_line_dedup_matches_brute_force(docs):
    random.seed(3)
    base = ["the quick brown fox jumps over", "lörem ipsum dolor sit amet, aa", "short", "x" * 30]
    pool = [*base, "shorp", "全角", "nineteen characters", "nineteen characters."]
    for line in base:
        for _ in range(6):
            n = random.randrange(len(line))
            pool += [line[:n] + line[n + 1:], line[:n] + "q" + line[n:], line[:n] + "é" + line[n + 1:]]
    rows = [(n, "\n".join(random.choices(pool, k=4)) + random.choice(["", "\n", " \n "])) for n in range(1, 25)]
    found = {r.doc_id: r for r in lines.dedup(docs(*rows, *[(100 + (i or 50), t) for i, t in ODD])).collect()}
    earlier = []
    for name, text in rows:
        kept, copies, near = [], 0, 0
        for line in text.split("\n"):
            key = line.strip(" \t\n\r\x0b\x0c")
            if not key:
                kept.append(line)
                continue
            long = len(key) >= lines.MIN_CHARS
            if key in earlier:
                copies += 1
            elif long and any(edits(key, other) <= 1 for other in earlier if len(other) >= lines.MIN_CHARS):
                near += 1
            else:
                kept.append(line)
            earlier.append(key)
        assert (found[name].text_kept, found[name].n_copies, found[name].n_near) == ("\n".join(kept), copies, near)
    assert found[101].text_kept is None and found[102].text_kept == "" and found[4 + 100].n_copies == 0
    assert lines.dedup(docs((1, "a")).limit(0)).count() == 0


def test_pipeline_drops_equal_lines_of_any_length(docs, spark):
    import corpus_pipeline

    long = "a line of more than twenty characters"
    rows = [(1, f"short\n{long}\n全角的短句\n"), (2, f"{long}\nshort\n"), (3, "全角的短句"), (4, "shorp\n\nshort"), (5, " \n"), (6, None)]
    found = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs(*rows), "").collect()}
    # 2 and 3 have nothing of their own; 4 keeps its near copy, as short lines have no one-edit rule
    assert found == {1: rows[0][1], 4: "shorp\n", 5: " \n", 6: None}


def test_deletion_variants_are_equal_where_texts_are():
    for line in (b"abcdefgh", "né à 👍x".encode()):
        text = line.decode()
        keys, _ = lines.variants(line)
        for n in range(len(text)):
            assert keys[n] == lines.variants((text[:n] + text[n + 1:]).encode())[0][-1]


@pytest.mark.parametrize("paired", [2, 32])
def test_jaccard_join_matches_brute_force(docs, monkeypatch, paired):
    random.seed(4)
    monkeypatch.setattr(jaccard, "PAIRED_ROWS", paired)
    monkeypatch.setattr(jaccard, "BLOCK_CELLS", 300)  # several blocks to a group
    words = [f"w{n}" for n in range(400)]
    rows, name = [], 1
    for _ in range(5):
        text = random.choices(words, k=70)
        for _ in range(8):
            copy = list(text)
            for n in random.sample(range(70), random.randrange(3)):
                copy[n] = random.choice(words)
            rows.append((name, " ".join(copy)))
            name += 1
    rows += [(200, "one two"), (201, "ONE  two"), (202, "one"), (203, rows[0][1]), (204, rows[0][1].upper())]
    odd = [(300, None), (301, ""), (302, "\n "), (None, rows[0][1])]

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[n:n + 3]) for n in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in rows + odd if i}
    links = {(a, b) for a, b in itertools.permutations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.doc_id: r for r in jaccard.join(docs(*rows, *odd)).collect()}
    assert len(found) == len(rows) + len(odd) and found[None].component_id is None
    for i in sets:
        expected = (len(sets[i]), root[i], sum(a == i for a, _ in links))
        assert (found[i].n_shingles, found[i].component_id, found[i].n_links) == expected
    assert jaccard.join(docs((1, "a b c")).limit(0)).count() == 0


def test_jaccard_rows_of_one_id_are_one_node(docs):
    x, y = " ".join(f"x{n}" for n in range(30)), " ".join(f"y{n}" for n in range(30))
    found = jaccard.join(docs((3, x), (5, x), (5, y), (7, y), (8, "z"), (9, None), (9, y))).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (5, 3), (5, 3), (7, 3), (8, 8), (9, 3), (9, 3)]


def test_pairs_of_blocks_are_dealt_before_they_are_gathered(spark, monkeypatch):
    members = spark.range(200).select(F.lit(1).alias("group"), "id")
    pairs = jaccard.blockwise(members, F.ceil(F.count("*") / 20), lambda left, right, same: [(len(left), len(right), same)], "l int, r int, same boolean")
    found = pairs.groupBy("same").agg(F.count("*").alias("n"), F.sum("l").alias("l")).collect()
    assert {r.same: r.n for r in found} == {True: 10, False: 45} and {r.same: r.l for r in found}[True] == 200


def test_large_groups_get_larger_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 4)
    fine = [0.5, 3.0, 8.0, 9.0, 64.0, 100.0]
    found = spark.createDataFrame([(x,) for x in fine], "x double").select(jaccard.coarse(F.col("x")).alias("n"))
    assert [r.n for r in found.collect()] == [1, 3, 8, 8, 8, 13]
    members = spark.range(400).select(F.lit(1).alias("group"), "id")
    met = jaccard.blockwise(members, jaccard.coarse(F.count("*") / 4), lambda left, right, same: [
        (len(left), len(right), len(left) * (len(left) - 1) // 2 if same else len(left) * len(right))], "l int, r int, pairs int")
    largest = met.agg(F.max("l"), F.max("r"), F.sum("pairs")).first()
    assert largest == (4, 4, 400 * 399 // 2)  # every two rows once, never more than 4 by 4


def test_whole_sets_meet_sets_of_like_size_only(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 2)
    sizes = [n for n in (5, 20, 80, 320) for _ in range(6)] + [360]
    sets = [(i, i, n, list(range(n))) for i, n in enumerate(sizes)]
    rows = spark.createDataFrame(sets * 2, "id bigint, text_key bigint, n int, shingles array<bigint>")
    members = rows.select(F.lit(1).alias("group"), "id", "text_key", "n", F.lit(1).alias("copies")).distinct()

    def met(left, right, same, good):
        return [(a["n"], b["n"], bool(good[i, j])) for i, a in enumerate(left) for j, b in enumerate(right) if not same or i < j]

    found = [tuple(r) for r in jaccard.products(members, rows, met, "a int, b int, linked boolean").collect()]
    assert {tuple(sorted(x[:2])) for x in found} == {(n, n) for n in (5, 20, 80, 320)} | {(320, 360)}
    assert sum(x[2] for x in found) == 4 * 15  # each linked pair once; 320 of 360 are below the bound
    counts = jaccard.products(members, rows, jaccard.link_counts, "id bigint, links bigint")
    assert {r.id: r.n for r in counts.groupBy("id").agg(F.sum("links").alias("n")).collect()} == {i: 5 if i < 24 else 0 for i in range(25)}


def test_stored_rows_leave_no_shuffle_files(spark):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffled():
        return {f.name for folder in folders for f in pathlib.Path(folder).rglob("shuffle_*")}

    before = shuffled()
    stored = common.store(spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count(), "counts")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before and stored.count() == 1000
    common.discard(stored)
    assert not pathlib.Path(stored.stored_in).exists()


def test_pipeline_stage_keeps_one_row_of_each_group(docs, spark):
    x = " ".join(f"x{n}" for n in range(30))
    rows = [(1, "a"), (1, "b"), (2, x), (2, "c"), (0, x), (None, x), (None, x), (None, None), (None, "lone words here")]
    found = corpus_pipeline.ngram_jaccard(spark, docs(*rows), "").collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(
        [(1, "a"), (1, "b"), (2, "c"), (0, x), (None, None), (None, "lone words here")], key=str)
    nulls = corpus_pipeline.ngram_jaccard(spark, docs((None, x), (None, x)), "").collect()
    assert [(r.doc_id, r.text) for r in nulls] == [(None, x)]


def test_pipeline_language_stage_stores_no_copy_of_the_documents(docs, spark, monkeypatch):
    def refused(rows):
        raise AssertionError("the stage keeps a second copy of the texts")

    monkeypatch.setattr(corpus_pipeline, "numbered", refused)
    rows = [(1, "same words"), (1, "same words"), (None, "né à 👍\n"), (None, None), (2, ""), (3, "12 !"), (4, "x" * 9000)]
    given = docs(*rows).withColumns({c: F.lit(None).cast(t) for c, t in (("source", "string"), ("n_chars", "bigint"))})
    given = given.withColumn("lang", F.when(F.col("doc_id") == 1, "en"))
    found = corpus_pipeline.language_id(spark, given, "")
    assert found.columns == corpus_pipeline.COLUMNS
    kept = [(r.doc_id, r.text, r.lang) for r in found.collect()]
    assert sorted(kept, key=str) == sorted(
        [(1, "same words", "en")] * 2 + [(None, "né à 👍\n", None), (4, "x" * 9000, None)], key=str)


def test_overlap_counts_over_column_blocks(monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_COLUMNS", 7)
    random.seed(6)
    sets = [sorted(random.sample(range(60), random.randrange(1, 40))) for _ in range(9)]
    found = jaccard.overlap_counts(sets[:4], sets[4:])
    assert found.tolist() == [[len(set(a) & set(b)) for b in sets[4:]] for a in sets[:4]]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(1, 40)] + [(70, 60), (60, 65)], "a bigint, b bigint")
    roots = {r.node: r.root for r in jaccard.components(spark, edges).collect()}
    assert {roots[n] for n in range(1, 41)} == {1} and roots[70] == roots[65] == 60


def test_decontamination_matches_brute_force(docs, spark):
    random.seed(8)
    words = [f"w{n}" for n in range(30)] + ["é", "ÀB"]
    items = [(str(n), " ".join(random.choices(words, k=random.choice([1, 2, 5, 13, 20])))) for n in range(12)]
    items += [("9", "dup one two"), (None, "w1"), ("e", ""), ("n", None)]
    rows = []
    for n in range(1, 30):
        w = random.choices(words, k=random.randrange(60))
        if n % 2:
            w[5:5] = random.choice(items[:12])[1].upper().split()
        rows.append((n, ", ".join(w)))
    rows += [(90, None), (91, ""), (None, items[3][1])]
    found = {r.doc_id: r for r in decontamination.contamination(docs(*rows), spark.createDataFrame(items, "item_id string, text string")).collect()}
    for name, text in rows:
        own = decontamination.words((text or "").encode())
        hit, names = set(), set()
        for item, body in items:
            w = decontamination.words((body or "").encode())
            size = min(13, len(w))
            for a in range(len(w) - size + 1 if size and item else 0):
                for b in range(len(own) - size + 1):
                    if own[b:b + size] == w[a:a + size]:
                        hit.update(range(b, b + size))
                        names.add(item)
        row = found[name]
        assert (row.n_words, row.n_hit, row["items"]) == (len(own), len(hit), sorted(names))
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(own))
    assert decontamination.contamination(docs((1, "a")), spark.createDataFrame([], "item_id string, text string")).first().n_hit == 0


def test_bpe_matches_the_library(docs, monkeypatch):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    texts = ["It's  A\tTEST <|endoftext|>x<|startoftext|>", "İstanbul ΣΑΣ ﬁ é 12345 don'T", "a b c\u0085d", "日本語 テキスト 👍🏽", "z" * 3000]
    rows = [*ODD, *[(10 + n, t) for n, t in enumerate(texts)], (10, texts[0])]
    found = sorted(bpe.encode(docs(*rows)).collect(), key=str)
    expected = []
    for name, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        expected.append((name, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert found == sorted(expected, key=lambda r: str(r)) or {str(tuple(r)) for r in found} == {str(r) for r in expected}
    assert len(found) == len(rows)
    digest = bpe.digests(docs(rows[-1])).first()
    ids = expected[-1][1]
    assert digest.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.digests(docs((1, "a")).limit(0)).count() == 0


def test_distinct_words_are_encoded_once(docs, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 30)
    rows = docs(*[(n, f"the same words and w{n % 3}") for n in range(40)])
    table = bpe.distinct_words(bpe.split(rows)).collect()
    assert sorted(bytes(r.word) for r in table) == sorted(w.encode() for w in "the same words and w0 w1 w2".split())
    assert max(len(r.uses) for r in table) > 10
    assert bpe.digests(rows).select("ids_sha256").distinct().count() == 3


def test_decoding_by_join_gives_the_library_text(spark):
    path = public_tokenizers.path(bpe.VOCABULARY)
    tokenizer = Tokenizer.from_file(path)
    ids = tokenizer.encode("Decoding joins pieces again", add_special_tokens=False).ids
    rows = bpe.decode(spark.createDataFrame([(1, ids)], "doc_id int, ids array<int>"), ["doc_id"], path).collect()
    assert rows[0].decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_byte_planes_round_trip():
    for values in ([], [0], [1, 70000, 2 ** 31]):
        assert blocks.expanded(blocks.squeezed(np.array(values, np.int64))).tolist() == values


def test_lm_score_matches_brute_force(docs, spark, monkeypatch):
    random.seed(9)
    monkeypatch.setattr(lm_score, "VOCABULARY", 6)
    monkeypatch.setattr(lm_score, "PART_KEYS", 20)
    rows = [(n, " ".join(random.choices("a b c d e f g h I".split(), k=random.randrange(1, 20)))) for n in range(1, 30)]
    good = set(range(1, 12))
    labels = spark.createDataFrame([(n, int(n in good)) for n in range(1, 20)], "doc_id bigint, quality int")
    found = {r.doc_id: r for r in lm_score.score(docs(*rows, (80, None), (81, " ")), labels).collect()}
    assert found[80].score is None and found[81].n_tokens == 0
    texts = {n: t.lower().split() for n, t in rows}
    order = sorted({w for t in texts.values() for w in t}, key=lambda w: (-sum(t.count(w) for t in texts.values()), w))[:6]
    tokens = {n: ["<s>"] + [w if w in order else "?" for w in t] for n, t in texts.items()}

    def model(names):
        one, two, before = {}, {}, {}
        for n in names:
            for v, w in zip(tokens[n], tokens[n][1:]):
                one[w] = one.get(w, 0) + 1
                two[v, w] = two.get((v, w), 0) + 1
            for v in tokens[n]:
                before[v] = before.get(v, 0) + 1
        size = sum(one.values())
        return lambda v, w: -math.log((two.get((v, w), 0) + 5 * (one.get(w, 0) + 1) / (size + 6 + 2)) / (before.get(v, 0) + 5))

    target, background = model(good), model(texts)
    for n, t in tokens.items():
        expected = sum(target(v, w) - background(v, w) for v, w in zip(t, t[1:])) / (len(t) - 1)
        assert math.isclose(found[n].score, expected, rel_tol=1e-9)


def test_lm_score_tells_rare_words_apart(docs, spark):
    """More words than any fixed vocabulary; bigrams of rare words are not merged."""
    many = " ".join(f"w{n}" for n in range(40_000))
    rows = [(1, f"{many} {many}"), (2, "rareone raretwo"), (3, "rareone raretwo"), (4, "rareone rarethree"), (5, "rarefour raretwo")]
    labels = spark.createDataFrame([(2, 1)], "doc_id bigint, quality int")
    found = {r.doc_id: r.score for r in lm_score.score(docs(*rows), labels).collect()}

    def loss(pair, before, word, total):
        return -math.log((pair + 5 * (word + 1) / (total + 40_004 + 2)) / (before + 5))

    total = 80_008
    first = loss(1, 1, 1, 2) - loss(3, 5, 3, total)
    assert math.isclose(found[2], (first + loss(1, 1, 1, 2) - loss(2, 3, 3, total)) / 2, rel_tol=1e-9)
    assert found[3] == found[2] and math.isclose(
        found[4], (first + loss(0, 1, 0, 2) - loss(1, 3, 1, total)) / 2, rel_tol=1e-9)


def test_tool_calls(spark):
    calls = spark.createDataFrame([
        ("a", None, "add", '{"y": 2, "x": 1}'), ("b", "a", "add", '{"x": 1}'), ("c", "b", "add", "{bad"),
        ("d", "e", "add", '{"x":1,"y":2}'), ("e", "d", "add", '{"x":1,"y":2}'), ("f", "zz", "add", '{"x":1,"y":2}'),
        ("g", None, "no", "{}"), ("h", None, "add", None), (None, None, "add", "{}"), ("i", "b", "add", '{"x":"1","y":2}'),
        ("k", "i", "add", '{"x":1,"y":2,"z":3}'), ("a", None, "add", '{"y": 2, "x": 1}'), ("l", "k", "add", '{"x":1,"y":null}'),
    ], "call_id string, parent_id string, tool string, arguments string")
    results = spark.createDataFrame([("a", "tw\"o"), ("a", "zwei"), ("f", None), ("q", "none"), (None, "x")], "call_id string, content string")
    schema = {"add": {"x": ("integer", True), "y": ("number", False)}}
    found = {r.call_id: r for r in chat.link(calls, results, schema).collect()}
    assert {k: (r.status, r.depth) for k, r in found.items()} == {
        "a": ("ok", 0), "b": ("no_result", 1), "c": ("bad_json", 2), "d": ("cycle", None), "e": ("cycle", None),
        "f": ("orphan", 0), "g": ("unknown_tool", 0), "h": ("bad_json", 0), "i": ("bad_arguments", 2),
        "k": ("bad_arguments", 3), "l": ("no_result", 4)}
    assert found["a"].canonical == '{"arguments":{"x":1,"y":2},"id":"a","parent":null,"result":"tw\\"o","tool":"add"}'
    assert found["a"].n_results == 2 and found["h"].canonical.startswith('{"arguments":null')
    assert chat.link(calls.limit(0), results, schema).count() == 0


def test_depth_of_a_long_chain(spark):
    chain = spark.createDataFrame([(str(n), str(n - 1) if n else None) for n in range(50)], "call_id string, parent_id string")
    assert {int(r.call_id) - r.depth for r in chat.depths(chain).collect()} == {0}


def test_pipeline_stages(spark, sf_dir, tmp_path):
    repeated = "a passage of enough words that comes back again and again in many texts"
    extra = [(900001, None), (900002, "123 456"), (900003, repeated), (900004, f"{repeated}\nand a line of its own to keep"), (900004, "twice this id")]
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in extra], table.schema)
    stored = table.unionByName(more)
    folder = str(tmp_path)
    stored.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        assert n == 4 or result.columns == corpus_pipeline.COLUMNS
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept.append({r.doc_id: r for r in docs.collect()})
    assert not {900001, 900002} & set(kept[0]) and 900003 in kept[0]
    assert kept[1][900004].text in ("and a line of its own to keep", "twice this id")
    contaminated = decontamination.contamination(spark.read.parquet(f"{folder}/ngram_jaccard"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert set(kept[2]) - set(kept[3]) == {r.doc_id for r in contaminated.where("contaminated").collect()}
    groups = jaccard.join(spark.read.parquet(f"{folder}/line_dedup")).where("doc_id = component_id").select("doc_id")
    assert set(kept[2]) == {r.doc_id for r in groups.collect()} and set(kept[4]) == set(kept[3])
    # both texts of the id that comes twice stay, as they do not resemble each other
    assert docs.where("doc_id = 900004").count() == 2 and docs.count() == len(kept[4]) + 1
