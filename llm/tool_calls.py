"""Chat formatting: tool calls with their results, in order, checked and as canonical JSON.

Calls and results are joined by conversation and identifier, as identifiers are only unique within a
conversation. A call may name others of its conversation that it waits for; the calls
are put in the order of the longest chain of waits before them, a level at a time. Arguments
are checked against a schema for each tool, and each call becomes one line of JSON whose keys
are sorted and which has no spare white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.graph import kept
from meterflow.shared import scratch_path

#: Types of a schema and how a variant names them.
TYPES = {
    "string": r"STRING",
    "integer": r"BIGINT",
    "number": r"(BIGINT|DOUBLE|FLOAT|DECIMAL.*)",
    "boolean": r"BOOLEAN",
    "array": r"ARRAY<.*",
    "object": r"OBJECT<.*",
}


def canonical(value: Column) -> Column:
    """JSON text with sorted keys and without white space; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(value))


def _problem(tool: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """Null, or what is wrong with the arguments; fields are looked at in the order of the schema."""
    value = F.try_parse_json(arguments)
    found = F.when(~tool.isin(*schemas) | tool.isNull(), F.lit("unknown tool"))
    found = found.when(value.isNull(), "not JSON").when(~F.schema_of_variant(value).startswith("OBJECT"), "not an object")
    for name, fields in schemas.items():
        for field, (kind, required) in fields.items():
            got = F.try_variant_get(value, f"$['{field}']", "variant")
            missing = got.isNull() | (F.schema_of_variant(got) == "VOID")
            if required:
                found = found.when((tool == name) & missing, f"missing {field}")
            found = found.when(
                (tool == name) & ~missing & ~F.schema_of_variant(got).rlike(f"^{TYPES[kind]}$"), f"{field} is not {kind}"
            )
    keys = F.json_object_keys(arguments)
    for name, fields in schemas.items():
        spare = F.array_except(keys, F.array(*[F.lit(f) for f in fields]).cast("array<string>"))
        found = found.when((tool == name) & (F.size(spare) > 0), F.concat(F.lit("unexpected "), F.array_min(spare)))
    return found


def _key(call: Column | str = "call_id") -> Column:
    """One text for a conversation and an identifier; null if the latter is. Null conversations are one."""
    conv = F.col("conv_id").cast("string")
    return F.concat(F.coalesce(F.length(conv).cast("string"), F.lit("")), F.lit(":"), F.coalesce(conv, F.lit("")), call)


def levels(calls: DataFrame) -> DataFrame:
    """(key, level): how long the longest chain of waits before a call is; none for calls in or behind a circle.

    ``calls`` (key, before): keys that aren't among the calls are not waited for. One round
    for each level: a call gets its level when the last it waits for has its own. Each level is a folder of one table, so
    the plan doesn't grow with the longest chain.
    """
    spark = calls.sparkSession
    path = scratch_path(spark, "levels")
    names = calls.select("key").where("key IS NOT NULL").distinct()
    waits = (
        calls.select("key", F.explode("before").alias("before"))
        .where("key IS NOT NULL AND before IS NOT NULL")
        .distinct()
        .join(names.select(F.col("key").alias("before")), "before")
    )
    waits = kept(waits, "waits")

    def settled(ready: DataFrame, level: int) -> DataFrame:
        ready.select("key").write.mode("overwrite").parquet(f"{path}/level={level}")
        return spark.read.schema("key STRING").parquet(f"{path}/level={level}")

    done, at = settled(names.join(waits.select("key").distinct(), "key", "left_anti"), 0), 0
    while waits.take(1) and done.take(1):
        at += 1
        left = kept(waits.join(done.select(F.col("key").alias("before")), "before", "left_anti"), "left")
        done = settled(waits.select("key").distinct().join(left.select("key").distinct(), "key", "left_anti"), at)
        waits = left
    return spark.read.schema("key STRING, level INT").parquet(path)


def linked_calls(
    calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]
) -> DataFrame:
    """One row per call: conv_id, call_id, position, level, problem, status, json.

    ``calls``: conv_id, call_id, position, tool, arguments (JSON text), after (array of call_id of the same
    conversation). ``results``: conv_id, call_id, position, content. Of several results of a call the one with the least
    position, then content, counts; results without a call are left out; a call without a result
    is ``pending``, one with wrong arguments ``invalid``, one in or behind a circle of waits
    ``circular``. Calls with one identifier in one conversation share their level, which is that after all their waits, and their
    result; equal calls come as often as they are there. A null call_id never has a result; null conv_ids are one conversation.
    Texts of any length are handled whole; an empty table gives no rows; further columns don't matter.
    Order by level, position and call_id to have each call of a conversation behind all that it waits for.
    """
    answers = (
        results.select(_key().alias("key"), "position", "content")
        .where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min(F.struct("position", "content")).alias("answer"))
        .select("key", F.struct("answer.position", "answer.content").alias("answer"))
    )
    keyed = calls.select("conv_id", "call_id", "position", "tool", "arguments", "after", _key().alias("key"))
    ordered = levels(keyed.select("key", F.transform("after", _key).alias("before")))
    joined = (
        keyed.join(ordered, "key", "left")
        .join(answers, "key", "left")
        .withColumn("problem", _problem(F.col("tool"), F.col("arguments"), schemas))
    )
    status = (
        F.when(F.col("level").isNull() & F.col("call_id").isNotNull(), "circular")
        .when(F.col("problem").isNotNull(), "invalid")
        .when(F.col("answer").isNull(), "pending")
        .otherwise("ok")
    )
    # a variant keeps the keys of its objects sorted
    line = F.to_json(
        F.struct(
            F.to_json(F.try_parse_json("arguments")).alias("arguments"),
            F.col("call_id").alias("id"),
            F.col("answer.content").alias("result"),
            F.col("tool"),
        )
    )
    return joined.select("conv_id", "call_id", "position", "level", "problem", status.alias("status"), line.alias("json"))


#: Tools that the turns of a conversation are read as.
SCHEMAS = {
    "search": {"query": ("string", True), "turn": ("integer", True)},
    "count": {"words": ("integer", True), "role": ("string", False)},
}


#: Every so many lengths of a turn's text there is one fault of each kind.
FAULTS = 24


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assistant turns read as calls and the turns after them as results, with the faults that real calls have.

    A call is named by its turn, so all conversations have the same identifiers. Every other assistant turn (by its
    number) searches for its own text, the others count words; within eight turns a call waits for the assistant turn two before it.
    The remainder of the text's length by 24 says what is wrong: 0 the turn or the number of words is text, 1 that field is
    missing, 2 there is one field too many, 3 the JSON is cut off, 4 the tool is unknown, 5 the arguments are a list, 6 the call waits
    for itself, 7 it has the identifier of the assistant turn two before it, 8 its result names another identifier.
    """
    name = lambda turn: F.concat(F.lit("call_"), turn)
    turn = F.col("turn")
    searches = turn % 4 < 2
    fault = F.coalesce(F.length("text") % FAULTS, F.lit(-1))
    number = F.when(searches, turn.cast("long")).otherwise(F.size(F.split(F.coalesce("text", F.lit("")), " ")).cast("long"))
    field = F.when(searches, "turn").otherwise("words")
    shown = F.when(fault == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number.cast("string"))
    given = F.when(fault != 1, F.concat(F.lit('"'), field, F.lit('":'), shown, F.lit(","))).otherwise("")
    spare = F.when(fault == 2, '"spare":null,').otherwise("")
    other = F.when(searches, F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("query")))).otherwise(F.to_json(F.struct("role")))
    whole = F.concat(F.lit("{"), given, spare, F.substr(other, F.lit(2)))
    arguments = F.when(fault == 3, F.substr(whole, F.lit(1), F.length(whole) - 1)).when(fault == 5, F.concat(F.lit("["), whole, F.lit("]")))
    waits = F.when(fault == 6, F.array(name(turn))).when(turn % 8 >= 2, F.array(name(turn - 2)))
    calls = turns.where("role = 'assistant'").select(
        "conv_id",
        name(F.when(fault == 7, turn - 2).otherwise(turn)).alias("call_id"),
        turn.alias("position"),
        F.when(fault == 4, "look").when(searches, "search").otherwise("count").alias("tool"),
        arguments.otherwise(whole).alias("arguments"),
        waits.otherwise(F.array().cast("array<string>")).alias("after"),
    )
    results = turns.where("role <> 'assistant'").select(
        "conv_id", name(F.when(fault == 8, -turn).otherwise(turn - 1)).alias("call_id"), turn.alias("position"), F.col("text").alias("content")
    )
    return calls, results
