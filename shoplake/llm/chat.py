"""Chat formatting: tool calls linked with their results, as canonical JSON.

Calls are ``call_id, parent_id, tool, arguments``: a call may wait for one other
call. Results are ``call_id, content``. DataFrame operations only:

1. Calls and results are joined by identifier. Of several calls or results with one
   identifier the smallest one by value counts; ``n_results`` tells how many came.
2. Calls are ordered topologically: ``depth`` is the number of calls that must run
   before, found by pointer doubling in as many turns as the logarithm of the
   longest chain. A call whose chain leads into a cycle has null depth and status
   ``cycle``; a parent that does not exist counts as none, with status ``orphan``.
3. Arguments are checked against the schema of their tool (names, kinds, required
   fields, no others). Status ``bad_json``, ``unknown_tool`` or ``bad_arguments``.
4. ``canonical`` has the call and its result as JSON with sorted keys and no blanks.

Statuses rank in that order: cycle, bad_json, unknown_tool, bad_arguments, orphan,
no_result, ok. Calls without an identifier and results of no call are left out. Null
arguments are bad JSON; an empty table gives an empty result. Other columns are not
read.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplake.llm.common import store, table

#: Types that JSON text of each kind may have.
KINDS = {"string": r"STRING", "integer": r"BIGINT", "number": r"BIGINT|DOUBLE|DECIMAL.*", "boolean": r"BOOLEAN",
         "array": r"ARRAY.*", "object": r"OBJECT.*"}


def valid(value: Column, schema: dict[str, tuple[str, bool]]) -> Column:
    """Whether a variant object has the schema's fields: name -> (kind, required)."""
    found = F.from_json(F.to_json(value), "map<string,string>")
    good = F.size(F.array_except(F.map_keys(found), F.array(*[F.lit(n) for n in schema]))) == 0
    for name, (kind, required) in schema.items():
        field = F.variant_get(value, f"$['{name}']", "variant")
        fits = F.schema_of_variant(field).rlike(f"^({KINDS[kind]})$")
        good = good & F.when(field.isNull() | F.is_variant_null(field), F.lit(not required)).otherwise(fits)
    return F.coalesce(F.schema_of_variant(value).rlike("^OBJECT") & good, F.lit(False))


def depths(calls: DataFrame) -> DataFrame:
    """``call_id, depth, orphan``; depth is null where the parents go round in a cycle.

    Every turn doubles the distance that a call has looked up its chain, so after
    the turn that passes the number of calls only cycles are still on the way.
    """
    known = calls.select(F.col("call_id").alias("parent"), F.lit(True).alias("known"))
    here = calls.select("call_id", F.col("parent_id").alias("parent")).join(known, "parent", "left")
    state = store(here.select(
        "call_id", F.when(F.col("known"), F.col("parent")).alias("up"),
        F.when(F.col("known"), 1).otherwise(0).cast("bigint").alias("steps"),
        (F.col("parent").isNotNull() & F.col("known").isNull()).alias("orphan"),
    ), "chains")
    total, reach = calls.count(), 1
    while reach <= total and not state.where("up IS NOT NULL").isEmpty():
        above = state.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        state = store(state.join(above, "up", "left").select(
            "call_id", F.col("next").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), "orphan"
        ), "chains")
        reach *= 2
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("steps")).alias("depth"), "orphan")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """``call_id, parent_id, tool, depth, status, n_results, canonical`` for every call."""
    calls = calls.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min(F.struct("parent_id", "tool", "arguments")).alias("c")
    ).select("call_id", "c.*")
    calls = store(calls, "calls")
    answers = results.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min("content").alias("content"), F.count("*").alias("n_results")
    )
    value = F.try_parse_json("arguments")
    checks = F.lit(None).cast("boolean")
    for tool, schema in schemas.items():
        checks = F.when(F.col("tool") == tool, valid(F.col("value"), schema)).otherwise(checks)
    linked = (
        calls.join(depths(calls), "call_id").join(answers, "call_id", "left")
        .withColumn("value", value).withColumn("good", checks)
    )
    status = (
        F.when(F.col("depth").isNull(), "cycle").when(F.col("value").isNull(), "bad_json")
        .when(F.col("good").isNull(), "unknown_tool").when(~F.col("good"), "bad_arguments")
        .when(F.col("orphan"), "orphan").when(F.col("n_results").isNull(), "no_result").otherwise("ok")
    )

    def quoted(column):
        return F.regexp_extract(F.to_json(F.struct(F.col(column).alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)

    def field(name, column):
        return F.concat(F.lit(f'"{name}":'), F.when(F.col(column).isNull(), F.lit("null")).otherwise(quoted(column)))

    body = F.concat_ws(
        ",", F.concat(F.lit('"arguments":'), F.coalesce(F.to_json("value"), F.lit("null"))),
        field("id", "call_id"), field("parent", "parent_id"), field("result", "content"), field("tool", "tool"),
    )
    return linked.select(
        "call_id", "parent_id", "tool", "depth", status.alias("status"),
        F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        F.concat(F.lit("{"), body, F.lit("}")).alias("canonical"),
    )


#: What the calls of the test conversations take.
REPLY = {"reply": {"text": ("string", True), "turn": ("integer", True)}}


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in conversations ``conv_id, turn, role, text``.

    A user's turn is a call of the tool ``reply`` with the turn as its argument; the
    assistant's turn of the next number is its result. The call waits for the call two
    turns before. Turns with a null conversation, number or role are left out.
    """
    known = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    name = F.concat_ws(":", "conv_id", "turn")
    calls = known.where("role = 'user'").select(
        name.alias("call_id"), F.when(F.col("turn") >= 2, F.concat_ws(":", "conv_id", F.col("turn") - 2)).alias("parent_id"),
        F.lit("reply").alias("tool"),
        F.to_json(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("arguments"),
    )
    results = known.where("role = 'assistant'").select(
        F.concat_ws(":", "conv_id", F.col("turn") - 1).alias("call_id"), F.coalesce("text", F.lit("")).alias("content")
    )
    return calls, results


def query(spark: SparkSession, folder: str) -> DataFrame:
    linked = link(*from_turns(table(spark, folder, "conversations")), REPLY)
    return linked.withColumn("canonical_sha256", F.sha2("canonical", 256)).drop("canonical")


ORACLE = r"""
WITH RECURSIVE u AS (SELECT conv_id, turn, min(coalesce(text, '')) AS text FROM conversations
  WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2),
a AS (SELECT conv_id, turn - 1 AS turn, min(coalesce(text, '')) AS text, count(*) AS n FROM conversations
  WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2),
d AS (SELECT conv_id, turn, 0 AS depth FROM u x
      WHERE NOT EXISTS (SELECT 1 FROM u y WHERE y.conv_id = x.conv_id AND y.turn = x.turn - 2)
      UNION ALL SELECT u.conv_id, u.turn, depth + 1 FROM d JOIN u ON u.conv_id = d.conv_id AND u.turn = d.turn + 2),
c AS (SELECT u.conv_id, u.turn, u.text, d.depth, a.text AS result, coalesce(a.n, 0) AS n,
      u.turn >= 2 AND d.depth = 0 AS orphan,
      concat(u.conv_id, ':', u.turn) AS call_id, CASE WHEN u.turn >= 2 THEN concat(u.conv_id, ':', u.turn - 2) END AS parent_id
      FROM u JOIN d USING (conv_id, turn) LEFT JOIN a USING (conv_id, turn))
SELECT call_id, parent_id, 'reply' AS tool, CAST(depth AS BIGINT) AS depth,
  CASE WHEN orphan THEN 'orphan' WHEN n = 0 THEN 'no_result' ELSE 'ok' END AS status, n AS n_results,
  sha256(concat('{"arguments":{"text":', to_json(text), ',"turn":', turn, '},"id":"', call_id, '","parent":',
    coalesce(to_json(parent_id), 'null'), ',"result":', coalesce(to_json(result), 'null'), ',"tool":"reply"}')) AS canonical_sha256
FROM c
"""
