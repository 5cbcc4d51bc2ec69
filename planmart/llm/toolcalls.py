"""Chat formatting: link tool calls and results, order them, check arguments, write canonical JSON.

DataFrame functions only.  Results find their call by a shuffled hash join on
the identifier; the build side holds each identifier once, so repeated results
or calls of one identifier never pile up in a hash table.  Calls are ordered
topologically by their distance from the call that starts their chain, found by
pointer doubling: the number of joins grows with the logarithm of the longest
chain, and a hot conversation is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planmart.llm.common import written

#: Type names a schema may use, and how the value's own type must begin (5.0 is written as 5 and counts as an integer).
TYPES = {"integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", "string": "^STRING$",
         "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT", "null": "^VOID$"}


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth) of unique calls (call_id, parent_id): how many calls come before
    it in its chain.  A parent that isn't a call starts a chain; calls in a circle have NULL."""
    ids = calls.select(F.col("call_id").alias("known"))
    nodes = (calls.select("call_id", "parent_id")
             .join(ids, F.col("parent_id") == F.col("known"), "left")
             .select("call_id", F.col("known").alias("up"),
                     F.when(F.col("known").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    nodes = written(nodes)
    n = nodes.count()
    for _ in range(max(1, n).bit_length() + 1):
        if not nodes.where("up IS NOT NULL").limit(1).count():
            break
        above = nodes.select(F.col("call_id").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        nodes = written(nodes.join(above, "up", "left")
                        .select("call_id", F.col("further").alias("up"),
                                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
    return nodes.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def parsed(arguments: Column) -> Column:
    """The value of a JSON text; NULL for what isn't one JSON text.

    The parser stops behind the first value, so the text must also stand as the only
    item of an array and as the only member of an object: nothing may follow
    it.  Repeated members aren't JSON here, nor are numbers beyond a double
    (which would be written as the text Infinity).
    """
    value = F.try_parse_json(arguments)
    item = F.try_parse_json(F.concat(F.lit("["), arguments, F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"":'), arguments, F.lit("}")))
    alone = member.isNotNull() & item.isNotNull() & F.try_variant_get(item, "$[1]", "variant").isNull()
    infinite = r'"-?Infinity"'
    finite = F.regexp_count(F.to_json(value), F.lit(infinite)) <= F.regexp_count(arguments, F.lit(infinite))
    return F.when(alone & finite, value)


def errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """`calls` (name, arguments, ...) with errors, sorted and joined by commas: bad_json,
    unknown_tool, missing:<p>, unknown:<p>, type:<p>; empty for valid calls.

    `schemas` (name, params: map of parameter to a name in TYPES, required:
    array); of repeated names the smallest row counts.  Arguments are parsed as they are for
    the output (`parsed`); what isn't an object is bad_json.
    """
    one = (schemas.groupBy("name").agg(F.min(F.struct(
        F.array_sort(F.map_entries("params")).alias("params"), F.array_sort("required").alias("required"))).alias("_s"))
        .withColumnRenamed("name", "_tool"))
    rows = calls.join(one, F.col("name") == F.col("_tool"), "left").withColumn(
        "_v", parsed(F.col("arguments"))).withColumn(
        "_a", F.when(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")), F.col("_v").cast("map<string,variant>")))
    rows = rows.withColumns({
        "_p": F.map_from_entries("_s.params"),
        "_t": F.transform_values("_a", lambda _, v: F.schema_of_variant(v))})
    pattern = F.create_map(*[x for k, v in TYPES.items() for x in (F.lit(k), F.lit(v))])
    missing = F.transform(F.filter("_s.required", lambda r: ~F.array_contains(F.map_keys("_a"), r)),
                          lambda r: F.concat(F.lit("missing:"), r))
    unknown = F.transform(F.filter(F.map_keys("_a"), lambda k: ~F.array_contains(F.map_keys("_p"), k)),
                          lambda k: F.concat(F.lit("unknown:"), k))
    wrong = F.transform(
        F.filter(F.map_entries("_t"), lambda e: F.array_contains(F.map_keys("_p"), e["key"])
                 & ~F.coalesce(F.regexp(e["value"], F.element_at(pattern, F.element_at("_p", e["key"]))), F.lit(False))),
        lambda e: F.concat(F.lit("type:"), e["key"]))
    found = (F.when(F.col("_a").isNull(), F.array(F.lit("bad_json")))
             .when(F.col("_tool").isNull(), F.array(F.lit("unknown_tool")))
             .otherwise(F.array_sort(F.concat(missing, unknown, wrong))))
    return rows.withColumn("errors", F.array_join(found, ",")).drop("_a", "_v", "_p", "_t", "_s", "_tool")


def canonical(arguments: Column) -> Column:
    """JSON with sorted keys and no blanks, at every depth; NULL for what isn't JSON."""
    return F.to_json(parsed(arguments))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call and each result.

    `calls`: conv_id, turn, call_id, parent_id (the call whose result it uses, or
    NULL), name, arguments (JSON text).  `results`: conv_id, turn, call_id, content.

    Returns conv_id, turn, kind (call, result), call_id, level (topological:
    every call comes after its parent's result, every result after its call;
    NULL for circles and for results without a call), linked (a call with a
    result; a result with a call), repeated (a later row of the same call_id and
    kind), errors (calls; NULL for results) and json, the row as canonical JSON.
    The order within a conversation is (level, turn, call_id).  NULL call_ids
    link to nothing.  NULL texts are JSON null; invalid arguments are kept as a
    JSON string.  No row is dropped.
    """
    calls = written(errors(calls.select("conv_id", "turn", "call_id", "parent_id", "name", "arguments"), schemas))
    results = results.select("conv_id", "turn", "call_id", "content")
    firsts = written(calls.where("call_id IS NOT NULL").groupBy("call_id")
                     .agg(F.min(F.struct("turn", "conv_id", "parent_id")).alias("f"))
                     .select("call_id", "f.turn", "f.conv_id", "f.parent_id"))
    depth = depths(firsts)
    known = written(firsts.join(depth, "call_id").select(
        F.col("call_id").alias("_id"), F.col("turn").alias("_turn"), F.col("conv_id").alias("_conv"), "depth"))
    answered = (results.where("call_id IS NOT NULL").groupBy("call_id")
                .agg(F.min(F.struct("turn", "conv_id")).alias("_first")).withColumnRenamed("call_id", "_answer"))
    side = known.join(answered, F.col("_id") == F.col("_answer"), "left").drop("_answer")

    def joined(rows: DataFrame) -> DataFrame:
        return rows.join(side.hint("shuffle_hash"), F.col("call_id") == F.col("_id"), "left")

    # an object's fields in alphabetical order, NULLs written out
    def text(**fields: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())]), {"ignoreNullFields": "false"})

    arguments = F.coalesce(parsed(F.col("arguments")), F.col("arguments").cast("variant"))
    made = joined(calls).select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id", (2 * F.col("depth")).alias("level"),
        F.col("_first").isNotNull().alias("linked"),
        F.coalesce((F.col("turn") != F.col("_turn")) | (F.col("conv_id") != F.col("_conv")), F.lit(False)).alias("repeated"),
        "errors", text(arguments=arguments, call_id=F.col("call_id"), conv_id=F.col("conv_id"), kind=F.lit("call"),
                       name=F.col("name"), turn=F.col("turn")).alias("json"))
    got = joined(results).select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", (2 * F.col("depth") + 1).alias("level"),
        F.col("_id").isNotNull().alias("linked"),
        F.coalesce((F.col("turn") != F.col("_first.turn")) | (F.col("conv_id") != F.col("_first.conv_id")),
                   F.lit(False)).alias("repeated"),
        F.lit(None).cast("string").alias("errors"),
        text(call_id=F.col("call_id"), content=F.col("content"), conv_id=F.col("conv_id"), kind=F.lit("result"),
             turn=F.col("turn")).alias("json"))
    return made.unionByName(got)


# --- calls and results of the conversations table -----------------------------------------------

#: The tools that assistant turns call, by the length of the turn's text.
SCHEMAS = (("search", {"limit": "integer", "query": "string"}, ["query"]),
           ("summarise", {"max_words": "integer", "text": "string"}, ["max_words", "text"]),
           ("lookup", {"exact": "boolean", "key": "string"}, ["key"]))


def schema_table(spark) -> DataFrame:
    return spark.createDataFrame(list(SCHEMAS), "name string, params map<string,string>, required array<string>")


def conversation_calls(turns: DataFrame) -> DataFrame:
    """Assistant turns as calls: each uses the result of the assistant turn two turns before.

    Some are bad, by the length of the text: arguments with text behind them or with a member twice; and
    by the conversation: a first turn that uses its own result (every third of ten), and
    calls whose identifier another turn has used (turn 3 of every seventh).
    """
    n = F.length("text")
    pick = F.pmod(n, F.lit(4))
    arguments = (F.when(pick == 0, F.to_json(F.struct(F.col("text").alias("query"), (n % 50).alias("limit"))))
                 .when(pick == 1, F.when(n % 3 == 0, F.to_json(F.struct("text")))
                       .otherwise(F.to_json(F.struct("text", n.alias("max_words")))))
                 .when(pick == 2, F.to_json(F.struct(F.col("text").alias("key"),
                                                     F.when(n % 5 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("exact"))))
                 .otherwise(F.to_json(F.struct("text"))))
    arguments = (F.when(n % 17 == 3, F.concat(arguments, F.lit(" and more"))).when(n % 19 == 4, F.lit('{"text":"a","text":"b"}'))
                 .otherwise(arguments))
    name = F.element_at(F.array(F.lit("search"), F.lit("summarise"), F.lit("lookup"), F.lit("translate")),
                        (pick + 1).cast("int"))
    again = (F.col("conv_id") % 7 == 0) & (F.col("turn") == 3)
    loop = (F.col("conv_id") % 10 == 3) & (F.col("turn") == 1)
    of = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    call = of(F.when(again, 1).otherwise(F.col("turn")))
    parent = of(F.when(loop, 1).otherwise(F.col("turn") - 2))
    return turns.where("role = 'assistant'").select("conv_id", "turn", call.alias("call_id"),
                                                    parent.alias("parent_id"), name.alias("name"),
                                                    arguments.alias("arguments"))


def conversation_results(turns: DataFrame) -> DataFrame:
    """All other turns as results of the call one turn before them."""
    call = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - 1).cast("string"))
    return turns.where("role <> 'assistant' OR role IS NULL").select("conv_id", "turn", call.alias("call_id"),
                                                                     F.col("text").alias("content"))


ORACLE_SQL = """
WITH RECURSIVE a AS (
  SELECT conv_id, turn, 'c' || conv_id || '-' || CASE WHEN conv_id % 7 = 0 AND turn = 3 THEN 1 ELSE turn END AS call_id,
    'c' || conv_id || '-' || CASE WHEN conv_id % 10 = 3 AND turn = 1 THEN 1 ELSE turn - 2 END AS parent_id,
    length(text) AS n, length(text) % 4 AS pick, CAST(to_json(text) AS VARCHAR) AS t
  FROM conversations WHERE role = 'assistant'),
c AS (
  SELECT *, CASE pick WHEN 0 THEN 'search' WHEN 1 THEN 'summarise' WHEN 2 THEN 'lookup' ELSE 'translate' END AS name,
    CASE pick WHEN 0 THEN '{"limit":' || (n % 50) || ',"query":' || t || '}'
      WHEN 1 THEN CASE WHEN n % 3 = 0 THEN '{"text":' || t || '}' ELSE '{"max_words":' || n || ',"text":' || t || '}' END
      WHEN 2 THEN '{"exact":"' || CASE WHEN n % 5 = 0 THEN 'yes' ELSE 'no' END || '","key":' || t || '}'
      ELSE '{"text":' || t || '}' END AS good,
    CASE pick WHEN 0 THEN '{"query":' || t || ',"limit":' || (n % 50) || '}'
      WHEN 1 THEN CASE WHEN n % 3 = 0 THEN '{"text":' || t || '}' ELSE '{"text":' || t || ',"max_words":' || n || '}' END
      WHEN 2 THEN '{"key":' || t || ',"exact":"' || CASE WHEN n % 5 = 0 THEN 'yes' ELSE 'no' END || '"}'
      ELSE '{"text":' || t || '}' END || ' and more' AS tailed,
    n % 17 = 3 AS tail, n % 17 <> 3 AND n % 19 = 4 AS twice,
    CASE WHEN n % 17 = 3 OR n % 19 = 4 THEN 'bad_json' WHEN pick = 1 AND n % 3 = 0 THEN 'missing:max_words'
      WHEN pick = 2 THEN 'type:exact' WHEN pick = 3 THEN 'unknown_tool' ELSE '' END AS errors
  FROM a),
f AS (SELECT call_id, min(turn) AS turn, arg_min(parent_id, turn) AS parent_id FROM c GROUP BY call_id),
u AS (
  SELECT conv_id, turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, CAST(to_json(text) AS VARCHAR) AS t
  FROM conversations WHERE role <> 'assistant' OR role IS NULL),
d(call_id, depth) AS (
  SELECT call_id, CAST(0 AS BIGINT) FROM f WHERE parent_id NOT IN (SELECT call_id FROM f)
  UNION ALL SELECT f.call_id, d.depth + 1 FROM f JOIN d ON f.parent_id = d.call_id)
SELECT c.conv_id, c.turn, 'call' AS kind, c.call_id, 2 * depth AS level,
  c.call_id IN (SELECT call_id FROM u) AS linked, c.turn <> f.turn AS repeated, errors,
  '{"arguments":' || CASE WHEN tail THEN CAST(to_json(tailed) AS VARCHAR)
      WHEN twice THEN CAST(to_json('{"text":"a","text":"b"}') AS VARCHAR) ELSE good END
    || ',"call_id":"' || c.call_id || '","conv_id":' || c.conv_id || ',"kind":"call","name":"'
    || name || '","turn":' || c.turn || '}' AS json
FROM c JOIN f USING (call_id) LEFT JOIN d USING (call_id)
UNION ALL
SELECT conv_id, turn, 'result', call_id, 2 * depth + 1, call_id IN (SELECT call_id FROM f), false, NULL,
  '{"call_id":"' || call_id || '","content":' || t || ',"conv_id":' || conv_id || ',"kind":"result","turn":' || turn || '}'
FROM u LEFT JOIN d USING (call_id)
"""
