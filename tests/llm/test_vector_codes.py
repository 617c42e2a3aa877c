"""Cover trees and codes against comparing every part with every entry."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from shoplake.llm import vector_codes as v


@pytest.mark.parametrize("seed", range(12))
def test_trees_cover_and_assign_as_brute_force_does(seed):
    draw = np.random.default_rng(seed)
    reach = (2, 40, 4000)[seed % 3]
    points = draw.integers(-reach, reach, (draw.integers(1, 900), draw.integers(1, 6)))
    book = draw.integers(-reach, reach, (draw.integers(1, 65), points.shape[1]))
    book[-1] = book[0]  # equal entries: the lower index wins
    order, nodes = v.cover_tree(points)
    assert sorted(order) == list(range(len(points)))
    for center, start, end, radius, child, children in nodes:
        assert squared(points[order[start:end]] - points[center]).max() == radius
        if children:
            own = nodes[child:child + children]
            assert own[0, 1] == start and own[-1, 2] == end and (own[1:, 1] == own[:-1, 2]).all()
            assert (4 * own[:, 3] <= radius).all()
            apart = squared(points[own[:, 0]][:, None] - points[own[:, 0]])
            assert (4 * apart[~np.eye(children, dtype=bool)] > radius).all()
    found, sums = v.assign(points, order, nodes, book)
    nearest = squared(points[:, None] - book).argmin(1)
    assert (found == nearest[order]).all()
    expected = np.zeros_like(book)
    np.add.at(expected, nearest, points)
    assert (sums == expected).all()


def squared(steps):
    return (steps ** 2).sum(-1)


def test_well_parted_points_are_assigned_whole(monkeypatch):
    draw = np.random.default_rng(0)
    points = np.concatenate([draw.integers(-5, 5, (300, 3)), 10_000 + draw.integers(-5, 5, (300, 3))])
    order, nodes = v.cover_tree(points)
    compared = []
    monkeypatch.setattr(v, "squares", lambda steps, own=v.squares: compared.append(steps.shape) or own(steps))
    v.assign(points, order, nodes, np.array([[0, 0, 0], [10_000, 10_000, 10_000]]))
    assert sum(math.prod(s[:-1]) for s in compared) < 20  # nodes, not points


def brute(rows):
    """``vec_id -> [(code, error, label_error)]`` and the codebooks, in plain Python."""
    kept = []
    for name, vector, label in rows:
        if vector is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((name, tuple(math.floor(256 * float(np.float32(x))) for x in vector), label))
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // 16
    parts = [[r[1][p * width:(p + 1) * width] for r in kept] for p in range(16)]
    books = [list(part[:64]) for part in parts]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, entry)), n) for n, entry in enumerate(book))

    for _ in range(2):
        for part, book in zip(parts, books):
            chosen = [nearest(point, book)[1] for point in part]
            for entry in set(chosen):
                own = [point for point, n in zip(part, chosen) if n == entry]
                book[entry] = tuple(sum(c) // len(own) for c in zip(*own))
    result, total = [], Counter()
    for n, (name, _, label) in enumerate(kept):
        found = [nearest(parts[p][n], books[p]) for p in range(16)]
        result.append((name, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        total[label] += result[-1][2]
    return sorted((repr((name, code, error, total[label])) for name, code, error, label in result)), books


def table(spark, rows):
    full = [(*r, 1, "x") for r in rows]
    return spark.createDataFrame(full, "vec_id bigint, embedding array<float>, label int, id int, error string").repartition(3)


@pytest.mark.parametrize("count", [1, 40, 300])
def test_codes_match_plain_python(spark, count):
    draw = random.Random(count)
    rows = [(n, [draw.gauss(0, 0.3) for _ in range(32)], draw.choice([None, 1, 2])) for n in range(count)]
    rows += [rows[0], (None, rows[0][1], 1), (900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, 1),
             (903, [float("-inf")] * 32, 2), (904, [], 1)]
    found = v.report(table(spark, rows)).collect()
    expected, books = brute(rows)
    assert sorted(repr((r["vec_id"], r["code"], r["error"], r["label_error"])) for r in found) == expected
    assert {r["codebooks_sha256"] for r in found} == {v.fingerprint(np.array(books))}


def test_chunks_do_not_change_the_codes(spark, monkeypatch):
    draw = random.Random(9)
    rows = table(spark, [(n, [draw.gauss(0, 1) for _ in range(16)], n % 3) for n in range(400)])
    whole = sorted(v.report(rows).collect())
    monkeypatch.setattr(v, "CHUNK_VALUES", 16 * 64)
    assert sorted(v.report(rows).collect()) == whole


def test_other_lengths_and_nothing_to_keep(spark):
    rows = [(1, [0.5] * 16, 1), (2, [0.5] * 17, 1), (0, [0.5] * 3, 1), (3, [0.25] * 32, 2), (4, [0.5] * 16, None)]
    found = sorted(v.report(table(spark, rows)).collect())
    assert [(r["vec_id"], r["code"], r["error"]) for r in found] == [(1, "00" * 16, 0), (4, "00" * 16, 0)]
    assert v.report(table(spark, rows).where("false")).collect() == []
    assert v.report(table(spark, [(1, None, 2)])).collect() == []
    with pytest.raises(Exception, match="65536"):
        v.report(table(spark, [(1, [1e9] * 16, 1)])).collect()
