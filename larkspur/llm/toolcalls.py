"""Tool-call linking: calls and results joined by identifier, levels of a topological order, schema checks, canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import cut

#: Schema rows up to which the schemas are broadcast.
MAX_BROADCAST_FIELDS = 10_000

#: Variant type names that a schema type accepts (fixed values).
TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DOUBLE", "DECIMAL"],
    "boolean": ["BOOLEAN"],
    "array": ["ARRAY"],
    "object": ["OBJECT"],
}


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and no blanks; null where the text is not JSON."""
    return F.to_json(F.try_parse_json(text))


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls that are not on or behind a cycle: 0 without a known call before it, else one
    more than the highest of those.

    A call that waits for one call points to it, and pointers are doubled until they reach an anchor: a call that waits for
    none or for several. So a chain of n calls takes log n rounds. Then one round for each level of the calls that wait for
    several; a round reads only what is still open.
    """
    at = ["conv_id", "call_id"]
    nodes = calls.select(*at).distinct()
    edges = calls.select(*at, F.explode("after").alias("before")).distinct()
    edges = cut(edges.join(nodes.select("conv_id", F.col("call_id").alias("before")), ["conv_id", "before"], "left_semi"))
    waits = edges.groupBy(*at).agg(F.count("*").alias("n"), F.min("before").alias("before"))
    one = F.coalesce(F.col("n") == 1, F.lit(False))
    state = cut(
        nodes.join(waits, at, "left").select(
            *at, F.coalesce("n", F.lit(0)).alias("n"), F.when(one, F.col("before")).otherwise(F.col("call_id")).alias("anchor"),
            F.when(one, 1).otherwise(0).cast("long").alias("far"), one.alias("open"),
        )
    )
    longest = state.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length()):
        if state.where("open").isEmpty():
            break
        to = state.select("conv_id", F.col("call_id").alias("anchor"), F.col("anchor").alias("next"), F.col("far").alias("more"), F.col("open").alias("on"))
        moved = state.where("open").join(to, ["conv_id", "anchor"]).select(
            *at, "n", F.col("next").alias("anchor"), (F.col("far") + F.col("more")).alias("far"), F.col("on").alias("open")
        )
        state = cut(state.where("NOT open").unionByName(moved))
    ends = state.where("NOT open").select(*at, "anchor", "far")
    levels = state.where("n = 0").select("conv_id", F.col("call_id").alias("anchor"), F.lit(0).cast("long").alias("base"))
    several = state.where("n > 1").select(*at)
    if several.isEmpty():
        known = ends.join(levels, ["conv_id", "anchor"])
        return cut(known.select(*at, F.col("far").alias("level")))
    behind = state.select("conv_id", F.col("call_id").alias("before"), F.when(F.col("open"), None).otherwise(F.col("anchor")).alias("anchor"), "far")
    open_ = edges.join(several, at, "left_semi").join(behind, ["conv_id", "before"])
    # an anchor that is null is never reached; steps: how far behind its anchor, reached: the level itself
    open_ = cut(open_.groupBy(*at, "anchor").agg((F.max("far") + 1).alias("steps"), F.lit(None).cast("long").alias("reached")))
    fresh = levels
    while not fresh.isEmpty():
        met = open_.join(fresh, ["conv_id", "anchor"], "left").select(*at, "anchor", "steps", F.coalesce("reached", F.col("base") + F.col("steps")).alias("reached"))
        met = cut(met)
        ready = met.groupBy(*at).agg(F.max("reached").alias("base"), F.every(F.col("reached").isNotNull()).alias("all")).where("all")
        fresh = cut(ready.select("conv_id", F.col("call_id").alias("anchor"), "base"))
        levels = levels.unionByName(fresh)
        open_ = met.join(fresh.select("conv_id", F.col("anchor").alias("call_id")), at, "left_anti")
    return cut(ends.join(levels, ["conv_id", "anchor"]).select(*at, (F.col("far") + F.col("base")).alias("level")))


def _problems(fields: Column, arguments: Column) -> Column:
    """What is wrong with a map of variants, field by field in the order of the names."""

    def one(f: Column) -> Column:
        value = F.try_element_at(arguments, f["field"])
        kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
        fits = F.lit(False)
        for name, kinds in TYPES.items():
            fits = fits | ((f["type"] == name) & kind.isin(kinds))
        text = F.length(value.cast("string"))
        return (
            F.when(value.isNull() | (kind == "VOID"), F.when(f["required"], F.concat(f["field"], F.lit(": missing"))))
            .when(~fits, F.concat(f["field"], F.lit(": not "), f["type"]))
            .when((kind == "STRING") & (text < f["least"]), F.concat(f["field"], F.lit(": too short")))
            .when((kind == "STRING") & (text > f["most"]), F.concat(f["field"], F.lit(": too long")))
        )

    return F.filter(F.transform(fields, one), lambda x: x.isNotNull())


def _object(pairs: list[tuple[str, Column]]) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in pairs]), {"ignoreNullFields": "false"})


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call and each result: conv_id, turn, kind, call_id, name, status, level, problems, json.

    ``calls``: (conv_id, turn, call_id, name, arguments as JSON, after as array of call ids). ``results``: (conv_id, turn,
    call_id, content). ``schemas``: (name, field, type, required, least, most), with lengths for strings.
    Status of a call: linked, unanswered, duplicate (its identifier was used before in the conversation; equal rows
    share a status) or cycle; of a result: linked, early (before its call), orphan or duplicate. level: calls have even
    ones, a result follows its call, and what a call waits for comes before it; null for orphans and cycles. Sorting by
    (conv_id, level, turn) is a topological order. Calls that are waited for but unknown are ignored. problems: arguments
    that are no JSON object, unknown tools, and fields that miss their schema. json: sorted keys; arguments that are not
    JSON stay a string. Null identifiers and null conversations link with nothing; other columns are ignored; empty tables give no rows.
    """
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "after")
    results = results.select("conv_id", "turn", "call_id", "content")
    first = calls.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "name", "arguments")).alias("c"))
    answer = results.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"))
    linked = cut(first.join(answer.hint("shuffle_hash"), ["conv_id", "call_id"], "full").join(_levels(calls.where("call_id IS NOT NULL")), ["conv_id", "call_id"], "left"))

    fields = F.array_sort(F.collect_list(F.struct("field", "type", "required", "least", "most"))).alias("fields")
    known = schemas.groupBy("name").agg(fields)
    if schemas.limit(MAX_BROADCAST_FIELDS + 1).count() <= MAX_BROADCAST_FIELDS:
        known = F.broadcast(known)
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    call_rows = (
        calls.join(linked, ["conv_id", "call_id"], "left").join(known, "name", "left")
        .withColumn("map", F.when(is_object, F.from_json("arguments", "map<string,variant>")))
        .select(
            "conv_id", "turn", F.lit("call").alias("kind"), "call_id", "name",
            F.when(F.col("c").isNotNull() & (F.struct("turn", "name", "arguments") != F.col("c")), "duplicate")
            .when(F.col("call_id").isNotNull() & F.col("conv_id").isNotNull() & F.col("level").isNull(), "cycle")
            .when(F.col("r").isNotNull() & (F.col("r.turn") >= F.col("turn")), "linked").otherwise("unanswered").alias("status"),
            F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), 0).otherwise(F.col("level") * 2).cast("int").alias("level"),
            F.when(F.col("map").isNull(), F.array(F.lit("arguments: not an object")))
            .when(F.col("fields").isNull(), F.array(F.lit("name: unknown tool")))
            .otherwise(_problems(F.col("fields"), F.col("map"))).alias("problems"),
            F.concat(
                F.lit('{"arguments":'),
                F.coalesce(F.to_json(parsed), F.when(F.col("arguments").isNull(), "null").otherwise(F.regexp_extract(F.to_json(F.struct("arguments")), r'(?s)^\{"arguments":(.*)\}$', 1))),
                F.lit(","),
                F.substring(_object([("call_id", F.col("call_id")), ("kind", F.lit("call")), ("name", F.col("name")), ("turn", F.col("turn"))]), 2, 2**31 - 1),
            ).alias("json"),
        )
    )
    result_rows = results.join(linked, ["conv_id", "call_id"], "left").select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", F.col("c.name").alias("name"),
        F.when(F.col("c").isNull(), "orphan")
        .when(F.struct("turn", "content") != F.col("r"), "duplicate")
        .when(F.col("turn") < F.col("c.turn"), "early").otherwise("linked").alias("status"),
        (F.col("level") * 2 + 1).cast("int").alias("level"),
        F.array().cast("array<string>").alias("problems"),
        _object([("call_id", F.col("call_id")), ("content", F.col("content")), ("kind", F.lit("result")), ("turn", F.col("turn"))]).alias("json"),
    )
    return call_rows.unionByName(result_rows)


#: Schemas of the registered query: (name, field, type, required, least, most).
SCHEMAS = [("reply", "prompt", "string", True, 1, 400), ("configure", "instructions", "string", True, 1, 400)]


def query(spark, sf_dir: str) -> DataFrame:
    """Turns as tool calls: a user turn calls ``reply``, the assistant turn behind it is the result; a user turn waits for the
    one two turns before it; a system turn calls ``configure``, which nothing answers. Turns of any other role, or of none, are
    results without an identifier, orphans."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    ident = lambda t: F.concat_ws(":", F.col("conv_id").cast("string"), t.cast("string"))
    user = turns.where("role = 'user'").select(
        "conv_id", "turn", ident(F.col("turn")).alias("call_id"), F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"))).alias("arguments"), F.array(ident(F.col("turn") - 2)).alias("after"),
    )
    system = turns.where("role = 'system'").select(
        "conv_id", "turn", ident(F.col("turn")).alias("call_id"), F.lit("configure").alias("name"),
        F.to_json(F.struct(F.col("text").alias("instructions"))).alias("arguments"), F.array().cast("array<string>").alias("after"),
    )
    answers = turns.where("role IS NULL OR role NOT IN ('user', 'system')")
    results = answers.select("conv_id", "turn", F.when(F.col("role") == "assistant", ident(F.col("turn") - 1)).alias("call_id"), F.col("text").alias("content"))
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean, least int, most int")
    return link_tool_calls(user.unionByName(system), results, schemas).withColumn("problems", F.array_join("problems", "; "))


ORACLE_SQL = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, role, text, conv_id::VARCHAR || ':' || turn::VARCHAR AS call_id,
         CASE role WHEN 'user' THEN 'reply' ELSE 'configure' END AS name,
         CASE role WHEN 'user' THEN 'prompt' ELSE 'instructions' END AS field
  FROM conversations WHERE role IN ('user', 'system')
), results AS (
  SELECT conv_id, turn, text, CASE WHEN role = 'assistant' THEN conv_id::VARCHAR || ':' || (turn - 1)::VARCHAR END AS call_id
  FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'system')
), levels AS (
  SELECT c.conv_id, c.turn, c.call_id, 0 AS level FROM calls c
  WHERE c.role = 'system' OR NOT EXISTS (SELECT 1 FROM calls b WHERE b.conv_id = c.conv_id AND b.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, c.call_id, l.level + 1 FROM levels l JOIN calls c ON c.conv_id = l.conv_id AND c.turn = l.turn + 2 AND c.role = 'user'
)
SELECT c.conv_id, c.turn, 'call' AS kind, c.call_id, c.name,
       CASE WHEN EXISTS (SELECT 1 FROM results r WHERE r.call_id = c.call_id) THEN 'linked' ELSE 'unanswered' END AS status,
       (2 * l.level)::INTEGER AS level,
       CASE WHEN c.text IS NULL THEN c.field || ': missing' WHEN length(c.text) < 1 THEN c.field || ': too short'
            WHEN length(c.text) > 400 THEN c.field || ': too long' ELSE '' END AS problems,
       '{"arguments":{' || CASE WHEN c.text IS NULL THEN '' ELSE '"' || c.field || '":' || to_json(c.text)::VARCHAR END
         || '},"call_id":"' || c.call_id || '","kind":"call","name":"' || c.name || '","turn":' || c.turn::VARCHAR || '}' AS json
FROM calls c JOIN levels l ON l.call_id = c.call_id
UNION ALL
SELECT r.conv_id, r.turn, 'result', r.call_id, c.name, CASE WHEN c.call_id IS NULL THEN 'orphan' ELSE 'linked' END,
       (2 * l.level + 1)::INTEGER, '',
       '{"call_id":' || coalesce('"' || r.call_id || '"', 'null') || ',"content":' || coalesce(to_json(r.text)::VARCHAR, 'null') || ',"kind":"result","turn":' || r.turn::VARCHAR || '}'
FROM results r LEFT JOIN calls c ON c.call_id = r.call_id LEFT JOIN levels l ON l.call_id = r.call_id
"""
