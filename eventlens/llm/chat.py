"""Chat formatting with linked tool calls, in DataFrame functions only.

Calls and results are hash-joined by (conversation, call id).  Calls are ordered
topologically: every call gets a level, at first its turn, and a call whose dependency
does not come earlier is moved behind it, round by round, until nothing moves.
Logs in which dependencies point backwards need no round; a call that still
moves after as many rounds as there are calls in its conversation is in a cycle
and marked.  Arguments are validated against schemas (required, unknown, type,
least value or length; a null value is absent), and each message is one line of canonical JSON: keys
sorted, no blanks, absent values left out.

One row per message comes out, so a conversation of any length stays spread
out; what needs an order inside a conversation (the call that a result answers, the
place of a message) works on blocks of ``BLOCK`` turns with a carry between
blocks.

Defined cases: a null text is empty; a call without result is unanswered; a
result without call is an orphan; of several results for one call the one with the
earliest turn is linked, the others are extra; rows that repeat are each kept, with
equal results except their place; null roles are kept as they are and are neither
call nor result; rows with a null conversation form one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import stage_table

BLOCK = 1_024

#: name, field, type, required, least (value of numbers, length of strings)
SCHEMA_COLUMNS = "name string, field string, type string, required boolean, least long"


def link(calls: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls with ``result_turn`` (null: unanswered), results with ``link`` (linked, extra or orphan).

    Both have ``conv, call_id, turn``; calls and results meet in hash joins on (conv, call_id).
    """
    firsts = results.where(F.col("call_id").isNotNull()).groupBy("conv", "call_id").agg(F.min("turn").alias("result_turn"))
    known = calls.select("conv", "call_id").distinct().withColumn("called", F.lit(True))
    left = calls.join(firsts.hint("shuffle_hash"), ["conv", "call_id"], "left")
    right = results.join(known.hint("shuffle_hash"), ["conv", "call_id"], "left").join(firsts, ["conv", "call_id"], "left")
    state = F.when(F.col("called").isNull(), "orphan").when(F.col("turn") == F.col("result_turn"), "linked").otherwise("extra")
    return left, right.withColumn("link", state).drop("called", "result_turn")


def order(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """``conv, call_id, level, cyclic`` with every call behind those that it needs.

    ``calls (conv, call_id, turn)``, ``needs (conv, call_id, needed)``; needs of unknown calls are ignored.
    """
    spark = calls.sparkSession
    levels = calls.groupBy("conv", "call_id").agg(F.min("turn").cast("long").alias("level"))
    known = levels.select("conv", F.col("call_id").alias("needed"))
    edges = needs.join(known, ["conv", "needed"]).distinct()
    state = stage_table(spark, levels.withColumn("moves", F.lit(0).cast("long")), "levels")
    calls_in = None
    while True:
        before = state.select("conv", F.col("call_id").alias("needed"), F.col("level").alias("before"))
        late = (
            edges.join(before, ["conv", "needed"]).join(state, ["conv", "call_id"])
            .where((F.col("before") >= F.col("level")) & (F.col("moves") >= 0))
            .groupBy("conv", "call_id").agg((F.max("before") + 1).alias("to"))
        )
        late = stage_table(spark, late, "late")
        if late.isEmpty():
            return state.select("conv", "call_id", "level", (F.col("moves") < 0).alias("cyclic"))
        if calls_in is None:
            calls_in = stage_table(spark, levels.groupBy("conv").agg(F.count("*").alias("n_calls")), "sizes")
        moved = state.join(late, ["conv", "call_id"], "left").join(calls_in, "conv")
        moves = F.when(F.col("to").isNull(), F.col("moves")).when(F.col("moves") >= F.col("n_calls"), -1).otherwise(F.col("moves") + 1)
        state = stage_table(spark, moved.select("conv", "call_id", F.coalesce("to", "level").alias("level"), moves.alias("moves")), "levels")


def _type_ok(value: Column, kind: Column) -> Column:
    """Does the JSON text of a value have the type?"""
    return (
        F.when(kind == "string", value.startswith('"'))
        .when(kind == "integer", value.rlike(r"^-?[0-9]+$"))
        .when(kind == "number", value.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"))
        .when(kind == "boolean", value.isin("true", "false"))
        .when(kind == "object", value.startswith("{"))
        .when(kind == "array", value.startswith("["))
        .otherwise(F.lit(False))
    )


def invalid_fields(name: Column, arguments: Column, lengths: Column, schemas: Column) -> Column:
    """Sorted ``field:fault`` texts of a call's arguments.

    ``arguments`` maps fields to the JSON text of their values, ``lengths`` to the
    number that ``least`` is held against; ``schemas`` is an array of structs like
    ``SCHEMA_COLUMNS``.
    """
    own = F.filter(schemas, lambda s: s["name"] == name)
    arguments = F.map_filter(arguments, lambda k, v: v.isNotNull())
    faults = F.transform(
        own,
        lambda s: F.when(~F.map_contains_key(arguments, s["field"]), F.when(s["required"], F.concat(s["field"], F.lit(":missing"))))
        .when(~_type_ok(arguments[s["field"]], s["type"]), F.concat(s["field"], F.lit(":type")))
        .when(lengths[s["field"]] < s["least"], F.concat(s["field"], F.lit(":least"))),
    )
    fields = F.transform(own, lambda s: s["field"])
    unknown = F.transform(F.array_except(F.map_keys(arguments), fields), lambda k: F.concat(k, F.lit(":unknown")))
    none = F.when(F.size(own) == 0, F.array(F.lit("name:unknown"))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_compact(F.concat(faults, F.when(F.size(own) > 0, unknown).otherwise(none))))


def json_text(c: Column) -> Column:
    """A string as JSON text: the value of a one-field object, cut out."""
    line = F.to_json(F.struct(c.alias("v")))
    return F.substr(line, F.lit(6), F.length(line) - 6)


def canonical(fields: dict[str, Column]) -> Column:
    """A JSON object of JSON texts, keys sorted, null values left out."""
    parts = [F.when(v.isNotNull(), F.concat(F.lit(f'"{k}":'), v)) for k, v in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _value(text: Column, kind: str) -> Column:
    """The value of a JSON text, as a Spark type."""
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"v {kind}")["v"]


def argument_lengths(arguments: Column) -> Column:
    """What ``least`` is held against: the length of strings, the value of numbers, null for others."""
    number = lambda v: F.coalesce(v.try_cast("decimal(38,9)").cast("double"), v.try_cast("double"))
    return F.transform_values(arguments, lambda k, v: F.when(v.startswith('"'), F.length(_value(v, "string")).cast("double")).otherwise(number(v)))


def arguments_line(arguments: Column) -> Column:
    """A JSON object of a map's JSON texts, keys sorted, null values left out."""
    entries = F.array_sort(F.map_entries(F.map_filter(arguments, lambda k, v: v.isNotNull())))
    parts = F.transform(entries, lambda e: F.concat(json_text(e["key"]), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def _block(turn: Column) -> Column:
    return F.floor(F.coalesce(turn, F.lit(0)) / BLOCK)


def answered_turn(messages: DataFrame) -> DataFrame:
    """``messages (conv, turn, role, ...)`` with ``asked``, the last user turn before, and ``place`` in the conversation."""
    rows = messages.withColumn("block", _block(F.col("turn")))
    user = F.when(F.col("role") == "user", F.col("turn"))
    sums = rows.groupBy("conv", "block").agg(F.max(user).alias("last_user"), F.count("*").alias("n"))
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        F.col("conv").alias("of_conv"), F.col("block").alias("of_block"), F.max("last_user").over(ahead).alias("carried"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("skipped")
    )
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    so_far = Window.partitionBy("conv", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    joined = rows.select("*", F.max(user).over(so_far).alias("own"), F.row_number().over(inside).alias("number")).join(
        carry, F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block"))
    )
    return joined.select(*messages.columns, F.coalesce("own", "carried").alias("asked"), (F.col("skipped") + F.col("number")).alias("place"))


def from_turns(conversations: DataFrame, name: str = "reply") -> tuple[DataFrame, DataFrame]:
    """(messages, needs) of a plain log: a user turn calls ``name``, the assistant's next turn is its result.

    A call's id is its conversation and turn; it needs the call before it.
    """
    rows = conversations.select(
        F.col("conv_id").alias("conv"), "turn", "role", F.coalesce("text", F.lit("")).alias("text")
    )
    rows = answered_turn(rows)
    call_id = lambda turn: F.concat_ws("-", F.lit("call"), F.coalesce(F.col("conv").cast("string"), F.lit("")), turn)
    own = F.when(F.col("role") == "user", call_id(F.col("turn"))).when(
        (F.col("role") == "assistant") & F.col("asked").isNotNull(), call_id(F.col("asked"))
    )
    calls = rows.withColumn("call_id", own).withColumn("name", F.when(F.col("role") == "user", F.lit(name)))
    arguments = F.create_map(F.lit("text"), json_text(F.col("text")), F.lit("turn"), F.col("turn").cast("string"))
    calls = calls.withColumn("arguments", F.when(F.col("role") == "user", arguments))
    calls = calls.withColumn("is_result", F.coalesce(F.col("role") == "assistant", F.lit(False)))
    needs = calls.where((F.col("role") == "user") & F.col("asked").isNotNull())
    return calls, needs.select("conv", "call_id", call_id(F.col("asked")).alias("needed")).distinct()


def format_chat(messages: DataFrame, needs: DataFrame, schemas: list[tuple]) -> DataFrame:
    """One row per message: ``conv, turn, place, role, call_id, link, level, faults, line``.

    ``messages (conv, turn, place, role, text, call_id, name, arguments, is_result)``; a row with
    a name is a call, whose ``arguments`` map fields to the JSON texts of their values; a
    row without that is ``is_result`` is a result, whatever its role.
    ``schemas``: rows of ``SCHEMA_COLUMNS``.
    """
    # Keys that no null and no value share, for ids of any type.
    kind = messages.schema["conv"].dataType
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    messages, needs = messages.withColumn("conv", key), needs.withColumn("conv", key)
    messages = stage_table(messages.sparkSession, messages, "messages")
    calls = messages.where(F.col("name").isNotNull())
    is_result = F.coalesce(F.col("is_result"), F.lit(False))
    results = messages.where(F.col("name").isNull() & is_result)
    rest = messages.where(F.col("name").isNull() & ~is_result)
    linked, answers = link(calls, results)
    levels = order(calls, needs)
    linked = linked.join(levels, ["conv", "call_id"], "left")
    linked = linked.withColumn("link", F.when(F.col("result_turn").isNull(), "unanswered").otherwise("linked"))
    kinds = [x.strip().split(" ") for x in SCHEMA_COLUMNS.split(",")]
    schema = F.array(*[F.struct(*[F.lit(v).cast(t).alias(k) for v, (k, t) in zip(row, kinds, strict=True)]) for row in schemas])
    columns = ["conv", "turn", "place", "role", "text", "call_id", "name", "arguments", "link", "level", "cyclic"]
    whole = linked.select(*columns)
    for part in (answers, rest):
        blank = {"link": "string", "level": "bigint", "cyclic": "boolean"}
        whole = whole.unionByName(part.select(*[c if c in part.columns else F.lit(None).cast(blank[c]).alias(c) for c in columns]))
    arguments = F.coalesce(F.col("arguments"), F.create_map().cast("map<string,string>"))
    faults = F.when(F.col("name").isNotNull(), invalid_fields(F.col("name"), arguments, argument_lengths(arguments), schema))
    is_call = F.col("name").isNotNull()
    call = F.concat(
        F.lit("["),
        canonical({
            "arguments": arguments_line(arguments),
            "id": json_text(F.col("call_id")),
            "name": json_text(F.col("name")),
        }),
        F.lit("]"),
    )
    line = canonical({
        "content": F.when(~is_call, json_text(F.col("text"))),
        "role": F.when(F.col("role").isNotNull(), json_text(F.col("role"))),
        "tool_call_id": F.when(~is_call & F.col("call_id").isNotNull(), json_text(F.col("call_id"))),
        "tool_calls": F.when(is_call, call),
    })
    conv = F.when(F.col("conv") != "", F.substring("conv", 2, 2**31 - 1)).cast(kind).alias("conv")
    return whole.select(conv, "turn", "place", "role", "call_id", "link", "level", "cyclic", faults.alias("faults"), line.alias("line"))
