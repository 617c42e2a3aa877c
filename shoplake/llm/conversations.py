"""Conversation structure repair: the cheapest edits that give well-formed turns.

A conversation must read ``(s?(ua)+)?`` by the initials of its roles. Edits: Keep (0),
Rerole to user or assistant (3), Delete (4), Insert an empty user or assistant turn
anywhere (3). Blank and duplicate turns must go; truncated ones that stay add 3. Of
all cheapest edits the ones whose initials come first in ASCII are taken; as each
initial leads from one state to one other, they fix the repaired turns too.

1. Turns are dealt by ranges of (conversation, turn, role, digest of text) and sorted
   there; their place is stored. What a task holds of one conversation is a run, at
   most about ``ROWS_PER_RUN`` turns, so a long conversation is many runs.
2. Duplicates are found from the first place of each text in each run.
3. The cost of repairing what follows a place, for each of four states, is a vector.
   Vectors are kept at checkpoints only: first at the ends of runs, where the least
   costs from state to state of whole runs chain to them, then at every square root
   of a run's length. Walking forward recomputes the block between two checkpoints.

Nulls in role or text count as one space, so such turns are blank or need a role. A
null conversation id is a conversation. Null turns come first; turns with one number
are ordered by role, then by digest. Repeated rows are duplicates. A conversation
without turns has no edits. Digests (128 bits) stand for texts. Other columns are
not read, whatever their names.
"""

import functools
import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shoplake.llm.common import arrow_map, store, table

ROWS_PER_RUN = 100_000
BLANKS = " \t\n\x0b\x0c\r"
RUN_BITS = 33

#: States: nothing yet, after system, after user, after assistant. Roles: s, u, a, others.
ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
#: The role that a new or renamed turn needs in each state.
NEEDED = (1, 1, 2, 1)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: A turn's code: its role and four times its state (sound, truncated, must go).
SOUND, CUT, GONE = range(3)
NEVER = 1 << 50
END = (0, 2 * INSERT, INSERT, 0)


def choices(state: int, code: int) -> list[tuple[str, int, int, int]]:
    """Edits of a turn: initial, next state, cost, role it has then (-1: none)."""
    role, fault = code % 4, code // 4
    found = [("D", state, DELETE, -1)]
    if fault != GONE:
        added = TRUNCATED if fault == CUT else 0
        if role in NEXT[state]:
            found.append(("K", NEXT[state][role], KEEP + added, role))
        found.append(("R", NEXT[state][NEEDED[state]], REROLE + added, NEEDED[state]))
    return found


def with_inserts(costs: list[int]) -> tuple:
    """Costs where turns may be inserted first; two inserts reach every state that helps."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[s][NEEDED[s]]]) for s, c in enumerate(costs)]
    return tuple(costs)


@functools.lru_cache(maxsize=65_536)
def before(after: tuple, code: int) -> tuple:
    """Costs before a turn, given those after it."""
    return with_inserts([min(cost + after[to] for _, to, cost, _ in choices(s, code)) for s in range(4)])


def based(costs: tuple) -> tuple:
    """Costs less their least; few such vectors occur, so their steps are remembered."""
    least = min(costs)
    return tuple(min(c - least, NEVER) for c in costs)


@functools.lru_cache(maxsize=65_536)
def chosen(state: int, code: int, after: tuple) -> tuple[tuple, int]:
    """Edits before and at a turn as (initial, role), and the state that follows."""
    here, made = before(after, code), []
    while True:
        tight = [(e, to, role) for e, to, cost, role in choices(state, code) if cost + after[to] == here[state]]
        to = NEXT[state][NEEDED[state]]
        if here[state] == INSERT + here[to]:
            tight.append(("I", to, NEEDED[state]))
        edit, to, role = min(tight)
        made.append((edit, role))
        state = to
        if edit != "I":
            return tuple(made), state


def walk(codes: list[int], state: int, after: tuple):
    """For each turn its edits and the state after it; keeps a vector for every block only.

    ``after``: costs where the codes end.
    """
    block = math.isqrt(len(codes)) + 1
    starts = range(0, len(codes), block)
    ends, costs = {}, based(after)
    for start in reversed(starts):
        ends[start] = costs
        for code in reversed(codes[start:start + block]):
            costs = based(before(costs, code))
    for start in starts:
        part = codes[start:start + block]
        vectors = [ends[start]]
        for code in reversed(part[1:]):
            vectors.append(based(before(vectors[-1], code)))
        for code, costs in zip(part, reversed(vectors)):
            made, state = chosen(state, code, costs)
            yield made, state


def closing(state: int) -> list[tuple[str, int]]:
    """Inserts that end a conversation."""
    made = []
    while END[state]:
        made.append(("I", NEEDED[state]))
        state = NEXT[state][NEEDED[state]]
    return made


def crossing(codes: list[int]) -> list[int]:
    """Least costs of a run from each state before it to each state after it, row by row."""
    columns = []
    for end in range(4):
        costs, base = tuple(0 if s == end else NEVER for s in range(4)), 0
        for code in reversed(codes):
            costs = before(costs, code)
            least = min(costs)
            costs, base = based(costs), base + least
        columns.append([min(c + base, NEVER) for c in costs])
    return [columns[end][start] for start in range(4) for end in range(4)]


def ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, digest`` with their place ``at`` in the order of all turns, stored."""
    spark = turns.sparkSession
    rows = turns.select(
        F.struct(F.col(f"`{conv}`").alias("id")).alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.md5("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_RUN))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return store(placed.withColumn("at", F.monotonically_increasing_id()), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """``conv, at, run, turn, role_code, fault``: blank, duplicate, truncated or null."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    role = F.substring("role", 1, 1)
    known = rows.select(
        "conv", "turn", "at", F.shiftright("at", RUN_BITS).alias("run"),
        F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3).alias("role_code"),
        (trimmed == "").alias("blank"), F.substring(trimmed, -1, 1).alias("last"),
        F.md5(F.to_json(F.struct("conv", "role", "digest"))).alias("said"),
    )
    local = known.where("NOT blank").groupBy("said", "run").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    several = local.groupBy("said").agg(F.min("first").alias("first"), F.sum("rows").alias("rows")).where("rows > 1")
    # a text has one row for each run here, however often it occurs
    repeated = local.select("said", "run").join(several.select("said", "first"), "said")
    return known.join(repeated, ["said", "run"], "left").select(
        "conv", "at", "run", "turn", "role_code",
        F.when(F.col("blank"), "blank").when(F.col("first") < F.col("at"), "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated").alias("fault"),
    )


def runs(faulty: DataFrame) -> DataFrame:
    """One row for each run: ``conv, start, codes, pieces`` and ``last``, whether none follows."""
    fault = F.when(F.col("fault") == "truncated", CUT).when(F.col("fault").isNull(), SOUND).otherwise(GONE)
    found = faulty.groupBy("conv", "run").agg(
        F.min("at").alias("start"),
        F.array_sort(F.collect_list(F.struct("at", (F.col("role_code") + 4 * fault).alias("code")))).alias("rows"),
    )
    every = Window.partitionBy("conv")
    return store(found.select(
        "conv", "start", F.col("rows.code").alias("codes"), F.count("*").over(every).alias("pieces"),
        (F.max("start").over(every) == F.col("start")).alias("last"),
    ), "runs")


def chained(rows: DataFrame, columns: list[str], schema: str, step) -> DataFrame:
    """What ``step`` makes of the runs of each conversation, in order; a few numbers for each run."""
    lists = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("start", *columns))).alias("runs"))
    return arrow_map(lists.select("runs"), schema, lambda: lambda many: [row for runs in many for row in step(runs)])


def checkpoints(pieces: DataFrame) -> DataFrame:
    """``start, after, state``: costs after each run and the state that the edits before lead to.

    Only conversations of several runs are chained; ``pieces`` are their runs.
    """
    vectors = "after array<bigint>"
    crossed = arrow_map(
        pieces.select("conv.id", "start", "codes"), f"id {pieces.schema['conv'].dataType['id'].dataType.simpleString()}, start bigint, costs array<bigint>",
        lambda: lambda ids, starts, codes: [(i, s, crossing(c)) for i, s, c in zip(ids, starts, codes)],
    ).select(F.struct("id").alias("conv"), "start", "costs")

    def backward(found):
        after = END
        for run in reversed(found):
            yield run["start"], list(after)
            after = tuple(min(run["costs"][4 * s + e] + after[e] for e in range(4)) for s in range(4))

    ends = store(chained(crossed, ["costs"], f"start bigint, {vectors}", backward), "checkpoints")

    def leaving(starts, codes, after):
        return [(name, [last_state(c, s, tuple(a)) for s in range(4)]) for name, c, a in zip(starts, codes, after)]

    left = arrow_map(pieces.join(ends, "start").select("start", "codes", "after"), "start bigint, leaves array<int>",
                     lambda: leaving)

    def forward(found):
        state = START
        for run in found:
            yield run["start"], state
            state = run["leaves"][state]

    entered = chained(left.join(pieces.select("conv", "start"), "start"), ["leaves"], "start bigint, state int", forward)
    return ends.join(entered, "start")


def last_state(codes: list[int], state: int, after: tuple) -> int:
    for _, state in walk(codes, state, after):
        pass
    return state


def edits(found: DataFrame) -> DataFrame:
    """One row for each run: ``conv, start, cost, illegal, first, last_role`` and its edits in order.

    ``made`` has the turn's number in the run, the edit's initial and the role the
    turn has then (-1 for deleted ones).
    """
    pieces = found.where("pieces > 1")
    planned = found.join(checkpoints(pieces), "start", "left")

    def step(starts, codes, lasts, afters, states):
        out = []
        for start, own, last, after, state in zip(starts, codes, lasts, afters, states):
            state, after, made, cost = state or START, tuple(after or END), [], 0
            for place, (steps, then) in enumerate(walk(own, state, after)):
                for edit, role in steps:
                    made.append((place, edit, role))
                    cost += {"D": DELETE, "I": INSERT, "R": REROLE, "K": KEEP}[edit]
                if role >= 0 and own[place] // 4 == CUT:
                    cost += TRUNCATED
                state = then
            if last:
                more = closing(state)
                made.extend((len(own), *e) for e in more)
                cost += INSERT * len(more)
            roles = [code % 4 for code in own]
            illegal = sum(not lawful(a, b) for a, b in zip(roles, roles[1:]))
            out.append((start, cost, illegal, roles[0], roles[-1], made))
        return out

    schema = "start bigint, cost bigint, illegal bigint, first int, final int, made array<struct<place int, edit string, role int>>"
    made = arrow_map(planned.select("start", "codes", "last", "after", "state"), schema, lambda: step, size=16)
    return store(made.join(found.select("conv", "start"), "start"), "edits")


def lawful(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def repaired(rows: DataFrame, made: DataFrame) -> DataFrame:
    """``conv, at, place, role, text``: the turns that stay or are new; ``at, place`` order them."""
    one = made.select("conv", "start", F.posexplode("made").alias("place", "edit")).where("edit.role >= 0").select(
        "conv", (F.col("start") + F.col("edit.place")).alias("at"), "place", "edit.edit", "edit.role")
    named = F.element_at(F.array(*map(F.lit, ROLES)), F.col("role") + 1)
    new = one.where("edit = 'I'").select("conv", "at", "place", named.alias("role"), F.lit("").alias("text"))
    old = one.where("edit <> 'I'").withColumnRenamed("role", "new").join(rows.select("at", "role", "text"), "at")
    named = F.when(F.col("edit") == "K", F.col("role")).otherwise(F.element_at(F.array(*map(F.lit, ROLES)), F.col("new") + 1))
    return old.select("conv", "at", "place", named.alias("role"), "text").union(new)


def digests(lines: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of ``role:text`` lines, read one after another.

    A digest depends on all that comes before, so one conversation is one task's
    work; it streams over sorted rows and holds one Arrow batch.
    """
    id_type = lines.schema["conv"].dataType["id"].dataType.simpleString()
    dealt = lines.repartition("conv").sortWithinPartitions("conv", "at", "place")

    def start():
        state = {"open": False, "id": None, "hash": None}

        def close():
            return (state["id"], state["hash"].hexdigest())

        def step(ids, roles, texts):
            out = []
            for name, role, text in zip(ids, roles, texts):
                if not state["open"] or name != state["id"]:
                    if state["open"]:
                        out.append(close())
                    state.update(open=True, id=name, hash=hashlib.sha256())
                else:
                    state["hash"].update(b"\n")
                state["hash"].update(f"{role}:".encode())
                state["hash"].update(text)
            return out

        step.finish = lambda: [[close()]] if state["open"] else []
        return step

    rows = dealt.select("conv.id", "role", F.col("text").cast("binary").alias("text"))
    found = arrow_map(rows, f"id {id_type}, repaired_sha256 string", start)
    return found.select(F.struct("id").alias("conv"), "repaired_sha256")


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Faults of the turns, edits of the runs, the repaired turns, and the placed turns."""
    rows = ordered(turns, conv, turn, role, text)
    faulty = store(faults(rows), "faults")
    made = edits(runs(faulty))
    return faulty, made, repaired(rows, made), rows


def report(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation with turns: counts of faults, cost, audit, digest of the repaired turns."""
    faulty, made, lines, _ = repair(turns, conv, turn, role, text)

    def count(name: str) -> Column:
        return F.count(F.when(F.col("fault") == name, 1)).alias(name)

    facts = faulty.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1).alias("span"), count("blank"), count("duplicate"), count("truncated"))
    numbers = faulty.where("turn IS NOT NULL").select("conv", "turn").distinct().groupBy("conv").agg(F.count("*").alias("numbers"))
    between = Window.partitionBy("conv").orderBy("start")  # runs, not turns
    lawless = F.lag("final").over(between).isNotNull() & ~F.coalesce(F.array_contains(
        F.array(*[F.lit(4 * a + b) for a, b in ((0, 1), (1, 2), (2, 1))]), 4 * F.lag("final").over(between) + F.col("first")), F.lit(True))
    steps = made.withColumn("lawless", lawless.cast("bigint")).groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.sum(F.col("illegal") + F.col("lawless")).alias("illegal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", F.array_join("made.edit", "").alias("edits")))),
                                 lambda run: run["edits"]), "").alias("audit"))
    return (
        facts.join(numbers, "conv", "left").join(steps, "conv").join(digests(lines), "conv", "left")
        .select(F.col("conv.id").alias(conv), F.coalesce(F.col("span") - F.col("numbers"), F.lit(0)).cast("bigint").alias("gaps"),
                "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with one row in twenty dropped and four others spoilt."""
    def printed(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(printed("conv_id"), F.lit(":"), printed("turn")).cast("binary")) % 20
    spoilt = rows.select("conv_id", "turn", printed("role").alias("role"), printed("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return spoilt.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    ).drop("copy")


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    every = rows.select(F.struct(F.col("conv_id").alias("id")).alias("conv")).distinct()
    found = report(damaged(rows)).withColumn("conv", F.struct(F.col("conv_id").alias("id"))).drop("conv_id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, "conv", "left").select(
        F.col("conv.id").alias("conv_id"), *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


#: Forward search with the best audit of each state: another way to the same edits.
ORACLE = r"""
WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
summed AS (SELECT *, xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(name, '')],
    lambda crc, b: list_reduce([xor(crc, b)] || [CAST(0 AS BIGINT) FOR i IN range(8)],
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS kind FROM named),
kept AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM summed WHERE kind <> 0),
c AS (SELECT DISTINCT conv_id FROM conversations),
k AS (SELECT row_number() OVER () AS k, conv_id FROM c),
r AS (SELECT k.k, x.*, row_number() OVER w AS i,
    row_number() OVER (PARTITION BY k.k, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    lag(left(role, 1)) OVER w AS earlier, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS short
    FROM kept x JOIN k ON k.conv_id IS NOT DISTINCT FROM x.conv_id
    WINDOW w AS (PARTITION BY k.k ORDER BY turn NULLS FIRST, role, md5(text), copy)),
f AS (SELECT *, left(role, 1) AS r, CASE WHEN short = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN right(short, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM r),
moves(q, r, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(q, q2, cost, tail, made) AS (SELECT q, q, 0, '', CAST([] AS VARCHAR[]) FROM range(4) t(q)
    UNION ALL SELECT q, q2, 3, 'I', [CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM moves WHERE r <> 's'
    UNION ALL SELECT * FROM (VALUES (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:']))),
p(k, i, q, cost, audit, made) AS (
  SELECT k, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), '', CAST([] AS VARCHAR[]) FROM k
  UNION ALL
  SELECT k, i, q, cost, audit, made FROM (
    SELECT p.k, f.i, e.q2 AS q, CAST(p.cost + n.cost + e.cost AS BIGINT) AS cost, p.audit || n.tail || e.edit AS audit,
      p.made || n.made || e.line AS made,
      row_number() OVER (PARTITION BY p.k, e.q2 ORDER BY p.cost + n.cost + e.cost, p.audit || n.tail || e.edit) AS place
    FROM p JOIN f ON f.k = p.k AND f.i = p.i + 1 JOIN ins n ON n.q = p.q,
    LATERAL (SELECT n.q2 AS q2, 4 AS cost, 'D' AS edit, CAST([] AS VARCHAR[]) AS line
      UNION ALL SELECT m.q2, CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END, 'K', [f.role || ':' || f.text]
        FROM moves m WHERE m.q = n.q2 AND m.r = f.r AND (f.fault IS NULL OR f.fault = 'truncated')
      UNION ALL SELECT m.q2, CASE WHEN f.fault = 'truncated' THEN 6 ELSE 3 END, 'R',
          [CASE m.r WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text]
        FROM moves m WHERE m.q = n.q2 AND m.r <> 's' AND (f.fault IS NULL OR f.fault = 'truncated')) e) WHERE place = 1),
done AS (SELECT p.k, p.cost + n.cost AS cost, p.audit || n.tail AS audit, p.made || n.made AS made
  FROM p JOIN ins n ON n.q = p.q AND n.q2 IN (0, 3)
  LEFT JOIN (SELECT k, max(i) AS n FROM f GROUP BY 1) s ON s.k = p.k WHERE p.i = coalesce(s.n, 0)
  QUALIFY row_number() OVER (PARTITION BY p.k ORDER BY p.cost + n.cost, p.audit || n.tail) = 1),
t AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND earlier || r NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
SELECT k.conv_id, CAST(coalesce(t.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(d.cost AS BIGINT) AS cost, d.audit, sha256(array_to_string(d.made, chr(10))) AS repaired_sha256
FROM k JOIN done d USING (k) LEFT JOIN t USING (k)
"""
