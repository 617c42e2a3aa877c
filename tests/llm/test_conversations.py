"""Conversation repair against exhaustive search over all edits."""

import hashlib
import heapq
import random

import pytest

from shoplake.llm import conversations as c

ROLES = {"u": "user", "a": "assistant", "s": "system"}


def brute(rows):
    """Cheapest audit by Dijkstra over (turn, roles so far), ties ASCII-least; then counts and the repaired text."""
    rows = sorted(((t, r or " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda v: (v[0] is not None, v[0], v[1], hashlib.md5(v[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        short = text.rstrip(c.BLANKS)
        fault = "blank" if not short else "duplicate" if (role, text) in seen else "" if short[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)

    def fits(role, after):
        return {"": role in "su", "s": role == "u", "u": role == "a", "a": role == "u"}[after]

    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, after, lines = heapq.heappop(heap)
        if at == len(rows) and after in ("", "a"):
            break
        if (at, after, audit) in done or len(audit) > 3 * len(rows) + 4:
            continue
        done.add((at, after, audit))
        for role in "ua":
            if fits(role, after):
                heapq.heappush(heap, (cost + 3, audit + "I", at, role, (*lines, f"{ROLES[role]}:")))
        if at == len(rows):
            continue
        _, role, text = rows[at]
        heapq.heappush(heap, (cost + 4, audit + "D", at + 1, after, lines))
        if faults[at] in ("", "truncated"):
            more = 3 if faults[at] else 0
            if role[0] in "sua" and fits(role[0], after):
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[0], (*lines, f"{role}:{text}")))
            for new in "ua":
                if fits(new, after):
                    heapq.heappush(heap, (cost + more + 3, audit + "R", at + 1, new, (*lines, f"{ROLES[new]}:{text}")))
    numbers = [t for t, *_ in rows if t is not None]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a[1][0] + b[1][0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def table(spark, rows):
    full = [(*r, 1, 2, "x") for r in rows]
    return spark.createDataFrame(full, "conv_id bigint, turn bigint, role string, text string, at int, run int, start string").repartition(5)


@pytest.mark.parametrize("per_run", [3, 100_000])
def test_repair_is_the_least_of_all_edits(spark, monkeypatch, per_run):
    monkeypatch.setattr(c, "ROWS_PER_RUN", per_run)
    draw = random.Random(per_run)
    roles, said = ["user", "assistant", "system", "tool", None], ["hi.", "so?", "cut", " ", "", None, "né! \n", "no\tend"]
    rows = []
    for conv in [*range(60), None]:
        for n in range(draw.randrange(1, 9)):
            rows.append((conv, draw.choice([n, n, n, 3, None]), draw.choices(roles, [6, 6, 2, 1, 1])[0], draw.choice(said)))
    found = {r["conv_id"]: tuple(r)[1:] for r in c.report(table(spark, rows)).collect()}
    for conv in {r[0] for r in rows}:
        assert found[conv] == brute([r[1:] for r in rows if r[0] == conv]), [r for r in rows if r[0] == conv]
    assert len(found) == len({r[0] for r in rows})


def test_long_conversation_is_cut_into_runs_without_changing_it(spark, monkeypatch):
    draw = random.Random(2)
    rows = [(1, n, draw.choice(["user", "assistant", "system"]), draw.choice([f"say {n}.", f"cut {n}", "same.", ""])) for n in range(400)]
    whole = c.report(table(spark, rows)).collect()
    monkeypatch.setattr(c, "ROWS_PER_RUN", 20)
    placed = c.ordered(table(spark, rows), "conv_id", "turn", "role", "text")
    assert c.runs(c.faults(placed)).count() > 5
    assert c.report(table(spark, rows)).collect() == whole


def test_walk_needs_the_same_edits_as_all_vectors_at_once():
    draw = random.Random(3)
    for size in (1, 2, 7, 90):
        codes = [draw.randrange(12) for _ in range(size)]
        vectors = [c.END]
        for code in reversed(codes):
            vectors.append(c.before(vectors[-1], code))
        vectors.reverse()
        state, made = c.START, []
        for n, code in enumerate(codes):
            steps, state = c.chosen(state, code, vectors[n + 1])
            made.append((steps, state))
        assert list(c.walk(codes, c.START, c.END)) == made
        for start in range(4):
            assert min(c.crossing(codes)[4 * start + e] + c.END[e] for e in range(4)) == vectors[0][start]


def test_texts_longer_than_a_batch_and_repeated_turns(spark):
    long = "word " * 200_000 + "."
    rows = [(1, 0, "user", long), (1, 0, "user", long), (1, 1, "assistant", "ok."), (2, None, None, None)]
    found = {r["conv_id"]: r for r in c.report(table(spark, rows)).collect()}
    assert found[1]["audit"] == "KDK" and found[1]["duplicate"] == 1
    assert found[1]["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:ok.".encode()).hexdigest()
    assert found[2]["audit"] == "D" and found[2]["repaired_sha256"] == hashlib.sha256().hexdigest()


def test_empty_tables(spark, tmp_path):
    assert c.report(table(spark, [(1, 0, "user", "x")]).where("false")).collect() == []
    spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert c.query(spark, str(tmp_path)).collect() == []
