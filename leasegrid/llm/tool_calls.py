"""Tool-call linking for chat data. DataFrame operations only.

Calls and results are hash-joined by identifier; calls are put in topological order of what they depend on; arguments are checked
against the tools' schemas; each call becomes one line of canonical JSON: keys sorted, no spaces.

A call may depend on several others; its depth is the longest path to it. Pointer doubling first takes every call with one parent
to the nearest call before it that has none or several (a chain of n calls takes log n rounds). Those with several parents are
then settled in order, a round for each such call on a path. No conversation is gathered in one row or task.

Defined results: a call without result has n_results 0 and result null; of several results the first by (seq, content, conv_id)
is taken and all are counted, and each other one is a `further` row, which counts its own copies; results of no call are `orphan`
rows; results with a null call id are an `orphan` row each, whose n_results is 0 if conv_id is null too (as in the SQL); a parent
that doesn't exist counts for nothing and gives error `parent missing`; calls on a cycle, or behind one, have depth null and error `cyclic`; null call
ids link with nothing; rows that repeat a call id are one call that depends on all their parents, and give a row each; arguments
that aren't JSON objects have error `not an object`; texts may be empty or of any length; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.shared import discard, written

#: What schema_of_variant calls the JSON types.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|DECIMAL.*)", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*"}


def _own(key: Column, row: Column) -> Column:
    """key, or where it is null a value that meets nothing and differs from row to row, so that nulls don't meet in one task."""
    return F.coalesce(key, F.concat(F.lit("\x00"), F.coalesce(row, F.lit(""))))


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth) of calls (call_id, parents array): length of the longest path of parents; null on or behind a cycle."""
    known = calls.where("call_id is not null").select("call_id").distinct()
    edges = calls.where("call_id is not null").select("call_id", F.explode("parents").alias("up")).distinct()
    edges = edges.join(known.select(F.col("call_id").alias("up")), "up", "left_semi")
    edges = written(edges.select("call_id", "up"), "calls")
    count = edges.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("up").alias("one"))
    # up: the one parent, or null for calls with none or several, which are where chains end.
    now = known.join(count, "call_id", "left").select("call_id", F.when(F.col("n") == 1, F.col("one")).alias("up"), F.when(F.col("n") == 1, F.col("call_id")).isNotNull().cast("long").alias("far"), F.coalesce("n", F.lit(0)).alias("n"))
    now = written(now, "calls")
    chains = now.where("n = 1").count()
    # Each call's `up` goes to where its chain ends, `far` steps before; what doesn't end in so many rounds is a cycle.
    for _ in range(chains.bit_length() + 1):
        ahead = now.select(F.col("call_id").alias("_id"), F.col("up").alias("_up"), F.col("far").alias("_far"))
        ends = now.join(ahead, _own(now["up"], now["call_id"]) == ahead["_id"], "left")
        moved = ends.select("call_id", F.coalesce("_up", "up").alias("up"), (F.col("far") + F.when(F.col("_up").isNotNull(), F.col("_far")).otherwise(0)).alias("far"), "n", F.col("_up").isNotNull().alias("_moves"))
        before, now = now, written(moved, "calls")
        discard(before)
        if not now.where("_moves").limit(1).count():
            break
    end = F.coalesce("up", "call_id")
    known_depth = written(now.where("n = 0").select(F.col("call_id").alias("end"), F.lit(0).cast("long").alias("base")), "depths")
    # Calls with several parents: each parent's end, and its distance to it.
    joints = edges.join(now.where("n > 1").select("call_id"), "call_id", "left_semi").join(now.select(F.col("call_id").alias("up"), end.alias("end"), F.when(F.col("n") == 1, F.col("far")).otherwise(0).alias("far")), "up")
    joints = written(joints.select("call_id", "end", "far"), "joints")
    while True:
        done = joints.join(known_depth, "end", "left").groupBy("call_id").agg(F.max(F.col("base") + F.col("far") + 1).alias("base"), F.count(F.when(F.col("base").isNull(), 1)).alias("waits")).where("waits = 0")
        done = written(done.select(F.col("call_id").alias("end"), "base"), "depths")
        if not done.limit(1).count():
            break
        known_depth = written(known_depth.unionByName(done), "depths")
        joints = written(joints.join(done.select(F.col("end").alias("call_id")), "call_id", "left_anti"), "joints")
    return now.select("call_id", end.alias("end"), F.when(F.col("n") == 1, F.col("far")).otherwise(0).alias("far")).join(known_depth, "end", "left").select("call_id", (F.col("base") + F.col("far")).alias("depth"))


def argument_errors(tool: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """Sorted messages; schemas: tool -> field -> (JSON type, required). The catalogue is a parameter and becomes expressions."""
    value = F.try_parse_json(arguments)
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    none = F.array().cast("array<string>")
    per_tool = F.when(tool.isNull() | ~tool.isin(*schemas), F.array(F.concat(F.lit("unknown tool "), F.coalesce(tool, F.lit("null")))))
    for name, wanted in sorted(schemas.items()):
        found = [F.transform(F.array_except(F.map_keys(fields), F.array(*[F.lit(f) for f in wanted]).cast("array<string>")), lambda f: F.concat(F.lit("unexpected "), f))]
        for field, (kind, required) in sorted(wanted.items()):
            has = F.array_contains(F.map_keys(fields), field)
            shape = F.schema_of_variant(F.try_variant_get(value, f"$['{field}']", "variant"))
            wrong = has & ~F.coalesce(shape.rlike(f"^{TYPES[kind]}$"), F.lit(False))
            found.append(F.when(wrong, F.array(F.lit(f"{field} is not {kind}"))).when(F.lit(required) & ~has, F.array(F.lit(f"{field} missing"))).otherwise(none))
        per_tool = per_tool.when(tool == name, F.concat(*found))
    return F.array_sort(F.when(fields.isNull(), F.array(F.lit("not an object"))).otherwise(per_tool))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """(conv_id, call_id, depth, status, n_results, errors, json).

    calls: conv_id, call_id, parent_id (or parent_ids, an array), tool, arguments (JSON text). results: conv_id, call_id, seq, content.
    status: linked, open (no result), orphan (result without call) or further (one more result of an id). Read in order of conv_id, depth, call_id.
    """
    up = "parent_ids" if "parent_ids" in calls.columns else "parent_id"
    parents = F.coalesce(F.array_sort(F.array_distinct(F.array_compact(up if up == "parent_ids" else F.array(up)))), F.array().cast("array<string>"))
    calls = calls.select("conv_id", "call_id", F.col(up).alias("up"), parents.alias("parents"), "tool", "arguments")
    each = results.where("call_id is not null").groupBy("call_id", F.struct("seq", "content", "conv_id").alias("r")).agg(F.count(F.lit(1)).alias("n"))
    firsts = each.groupBy("call_id").agg(F.min("r").alias("r"), F.sum("n").alias("n_results"), F.count(F.lit(1)).alias("n_distinct"))
    got = firsts.select(F.col("call_id").alias("_id"), F.col("r.content").alias("result"), F.col("n_results"), F.col("r.conv_id").alias("_conv"))
    order = depths(calls).select(F.col("call_id").alias("_call"), "depth")
    known = calls.where("call_id is not null").select(F.col("call_id").alias("_parent")).distinct()
    # Sets of parents of which one is missing; calls without parents meet nothing there.
    sets = calls.where(F.size("parents") > 0).select("parents").distinct().withColumn("_one", F.explode("parents"))
    lost = sets.join(known, F.col("_one") == F.col("_parent"), "left_anti").select(F.col("parents").alias("_lost")).distinct()
    rows = calls.join(got.hint("shuffle_hash"), calls["call_id"] == got["_id"], "left")
    rows = rows.join(order, F.col("call_id") == F.col("_call"), "left")
    rows = rows.join(lost, F.when(F.size("parents") > 0, F.col("parents")).otherwise(F.array(_own(F.lit(None), F.col("call_id")))) == F.col("_lost"), "left")
    errors = F.concat(
        F.when(F.col("_lost").isNotNull(), F.array(F.lit("parent missing"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("call_id").isNotNull() & F.col("depth").isNull(), F.array(F.lit("cyclic"))).otherwise(F.array().cast("array<string>")),
        argument_errors(F.col("tool"), F.col("arguments"), schemas),
    )
    rows = rows.select("conv_id", "call_id", "depth", F.when(F.col("_id").isNull(), "open").otherwise("linked").alias("status"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), errors.alias("errors"), "tool", "arguments", "up", "result")
    # Variants keep the keys of objects in order; fields of the line are in order too.
    line = F.to_json(F.struct(F.coalesce(F.try_parse_json("arguments"), F.try_parse_json(F.lit("null"))).alias("arguments"), F.col("call_id").alias("id"), F.col("up").alias("parent" if up == "parent_id" else "parents"), "result", "tool"), {"ignoreNullFields": "false"})
    linked = rows.select("conv_id", "call_id", "depth", "status", "n_results", "errors", line.alias("json"))
    orphan = _lone(got.join(known, got["_id"] == known["_parent"], "left_anti").select(F.col("_conv").alias("conv_id"), F.col("_id").alias("call_id"), "n_results", "result"), "orphan", "call missing")
    nameless = results.where("call_id is null").select("conv_id", "call_id", F.col("conv_id").isNotNull().cast("long").alias("n_results"), F.col("content").alias("result"))
    several = firsts.where("n_distinct > 1").select(F.col("call_id").alias("_id"), F.col("r").alias("_first"))
    further = each.join(several, (each["call_id"] == several["_id"]) & ~each["r"].eqNullSafe(several["_first"])).select("r.conv_id", "call_id", F.col("n").alias("n_results"), F.col("r.content").alias("result"))
    return linked.unionByName(orphan).unionByName(_lone(nameless, "orphan", "call missing")).unionByName(_lone(further, "further"))


def _lone(results: DataFrame, status: str, *errors: str) -> DataFrame:
    """Rows of link for results (conv_id, call_id, n_results, result) that stand by themselves."""
    line = F.to_json(F.struct(F.col("call_id").alias("id"), "result"), {"ignoreNullFields": "false"})
    return results.select("conv_id", "call_id", F.lit(None).cast("long").alias("depth"), F.lit(status).alias("status"), "n_results", F.array(*map(F.lit, errors)).cast("array<string>").alias("errors"), line.alias("json"))


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of plain conversations: each user turn calls `reply`, the assistant's next turn is its result.

    A call is named conversation-turn and depends on the call two turns before, if there is one.
    """
    ident = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))
    turns = turns.select("conv_id", "turn", "role", "text")
    users = turns.where("role = 'user'")
    before = users.select(ident(0).alias("_before")).where("_before is not null").distinct()
    args = F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn")), {"ignoreNullFields": "false"})
    calls = users.select("conv_id", ident(0).alias("call_id"), ident(2).alias("_up"), F.lit("reply").alias("tool"), args.alias("arguments"))
    calls = calls.join(before, calls["_up"] == before["_before"], "left").select("conv_id", "call_id", F.col("_before").alias("parent_id"), "tool", "arguments")
    results = turns.where("role = 'assistant'").select("conv_id", ident(1).alias("call_id"), F.col("turn").alias("seq"), F.col("text").alias("content"))
    return calls, results
