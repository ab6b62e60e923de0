"""Chat formatting: tool calls linked with their results, ordered, validated, as canonical JSON.

Calls and results are hash-joined by (conversation, call id), both reduced to one row a
key beforehand, so a key of very many rows costs no task more than its share. A string
``{"$result": id}`` in a call's arguments uses the result of another call of the same
conversation; a call comes after all that it uses. Levels are found over the ids alone:
conversations of at most ``LOCAL_USES`` uses in buckets of many, each bucket in one task;
longer ones by pointer doubling over the whole cluster, each round written to the shared
folder. Chains take as many rounds as their length has binary digits.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune, write_shared

#: JSON Schema's names of the types.
TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


#: Uses that a conversation may have to be ordered within a task, and uses in a bucket of such ones.
LOCAL_USES, BUCKET_USES = 100_000, 200_000


def plain(value):
    """A JSON value in its one form: integral numbers as integers, keys in order of UTF-16."""
    if isinstance(value, dict):
        return {k: plain(value[k]) for k in sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))}
    if isinstance(value, list):
        return [plain(v) for v in value]
    if isinstance(value, float) and value.is_integer() and abs(value) < 2**53:
        return int(value)
    return value


def escaped(text: str) -> str:
    """The text with halves of surrogate pairs that stand alone, which UTF-8 can't hold, as JSON escapes."""
    return text if text.isascii() else re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m.group()):04x}", text)


def canonical(value) -> str:
    return escaped(json.dumps(plain(value), ensure_ascii=False, separators=(",", ":"), allow_nan=False))


def uses(value) -> set[str]:
    """The call ids whose results a value uses."""
    if isinstance(value, dict):
        if set(value) == {"$result"} and isinstance(value["$result"], str):
            return {value["$result"]}
        return set().union(*map(uses, value.values())) if value else set()
    if isinstance(value, list):
        return set().union(*map(uses, value)) if value else set()
    return set()


def _is(value, kind: str) -> bool:
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    return isinstance(value, TYPES[kind])


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """What breaks a schema (type, enum, required, properties, additionalProperties, items, lengths, bounds)."""
    if isinstance(value, dict) and set(value) == {"$result"}:
        return []  # known once the other call has run
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: not {kinds}"]
    out = [f"{at}: not in enum"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        own = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties", True) is False:
            out += [f"{at}.{k}: unknown" for k in sorted(set(value) - set(own))]
        for k in sorted(set(value) & set(own)):
            out += violations(value[k], own[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for k, v in enumerate(value):
            out += violations(v, schema["items"], f"{at}[{k}]")
    if isinstance(value, str):
        out += [f"{at}: too short"] if len(value) < schema.get("minLength", 0) else []
        out += [f"{at}: too long"] if len(value) > schema.get("maxLength", len(value)) else []
    if _is(value, "number"):
        out += [f"{at}: too small"] if value < schema.get("minimum", value) else []
        out += [f"{at}: too large"] if value > schema.get("maximum", value) else []
    return out


def _unique(pairs: list[tuple]) -> dict:
    if len({k for k, _ in pairs}) < len(pairs):
        raise ValueError("repeated name")
    return dict(pairs)


def _no_constant(name: str):
    raise ValueError(name)


def read_arguments(text: str | None, name: str | None, schemas: dict[str, dict]) -> tuple[str | None, list[str], list[str]]:
    """Canonical arguments (None where they are no JSON object), errors, and ids of the results used.

    A lone half of a surrogate pair is written as its escape.
    """
    try:
        value = json.loads(text or "", object_pairs_hook=_unique, parse_constant=_no_constant)
        if not isinstance(value, dict):
            return None, ["$: not an object"], []
        errors = violations(value, schemas[name]) if name in schemas else ["unknown tool"]
        return canonical(value), [escaped(e) for e in errors], sorted(map(escaped, uses(value)))
    except RecursionError:
        return None, ["$: too deep"], []
    except (ValueError, TypeError):
        return None, ["$: not JSON"], []


_READ = "conv_id long, call_id string, turn long, pos long, name string, arguments string, errors array<string>, uses array<string>"


def levels_of(edges: list[tuple]) -> dict[tuple, int]:
    """The level of each (conversation, call) in edges (conversation, call, used call); none for cycles."""
    waits: dict[tuple, int] = {}
    users: dict[tuple, list[tuple]] = {}
    for conv, call, needs in edges:
        waits[conv, call] = waits.get((conv, call), 0) + 1
        users.setdefault((conv, needs), []).append((conv, call))
    level = {k: 0 for k in users if k not in waits}
    ready = list(level)
    while ready:
        k = ready.pop()
        for u in users.get(k, ()):
            level[u] = max(level.get(u, 0), level[k] + 1)
            waits[u] -= 1
            if not waits[u]:
                ready.append(u)
    return {u: level[u] for u, n in waits.items() if not n}


def _bucket_levels(group: pa.Table) -> pa.Table:
    found = levels_of(list(zip(*(group.column(c).to_pylist() for c in ("conv_id", "call_id", "needs")))))
    return pa.table({"conv_id": pa.array([k[0] for k in found], pa.int64()), "call_id": pa.array([k[1] for k in found], pa.string()), "level": pa.array(list(found.values()), pa.int32())})


def _round_levels(edges: DataFrame) -> DataFrame:
    """The levels of calls with uses, by pointer doubling; none for cycles.

    A call's level is at least ``base`` and, for each of its ``outs``, ``w`` above that of
    ``needs``. In a round, a use of a settled call (no outs) goes into the base, and one of
    a call with a single out is led on to where that points, so chains halve. A path of
    more steps than there are uses ends in a cycle.
    """
    key = ["conv_id", "call_id"]
    outs = edges.distinct().groupBy(*key).agg(F.collect_list(F.struct("needs", F.lit(1).cast("long").alias("w"))).alias("outs"))
    used = edges.select("conv_id", F.col("needs").alias("call_id")).distinct().join(edges.select(*key), key, "left_anti")
    base, none = F.lit(0).cast("long").alias("base"), F.array().cast("array<struct<needs:string,w:bigint>>").alias("outs")
    state = write_shared(outs.select(*key, base, "outs").union(used.select(*key, base, none)), "levels")
    most = edges.count()
    while True:
        lost = F.exists("outs", lambda o: o["w"] > most)
        known = state.filter((F.size("outs") < 2) & ~lost).select("conv_id", F.col("call_id").alias("needs"), F.col("base").alias("b"), F.try_element_at("outs", F.lit(1)).alias("o"))
        step = state.filter((F.size("outs") > 0) & ~lost).select(*key, "base", F.inline("outs")).join(known, ["conv_id", "needs"], "left")
        led = F.when(F.col("b").isNull(), F.col("needs")).otherwise(F.col("o.needs")).alias("to")
        step = step.groupBy(*key, led).agg(F.max(F.greatest("base", F.col("b") + F.col("w"))).alias("base"), F.max(F.col("w") + F.coalesce("o.w", F.lit(0))).alias("w"), F.max(F.col("b").isNotNull()).alias("moved"))
        step = step.groupBy(*key).agg(F.max("base").alias("base"), F.collect_list(F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("needs"), "w"))).alias("outs"), F.max("moved").alias("moved"))
        step = write_shared(step, "levels")
        if step.filter("moved").isEmpty():
            return state.filter("size(outs) = 0 and base > 0").select(*key, F.col("base").cast("int").alias("level"))
        state = state.filter((F.size("outs") == 0) | lost).union(step.drop("moved"))
        state = write_shared(state, "levels")


def use_levels(edges: DataFrame, local: int = LOCAL_USES, bucket: int = BUCKET_USES) -> DataFrame:
    """(conv_id, call_id, level) of the calls in edges (conv_id, call_id, needs)."""
    sizes = write_shared(edges.groupBy("conv_id").count(), "sizes")
    small, large = sizes.filter(F.col("count") <= local), sizes.filter(F.col("count") > local)
    total = small.agg(F.sum("count").alias("n")).first()["n"] or 0
    mine = edges.join(small.select("conv_id"), "conv_id", "left_semi")
    dealt = mine.withColumn("bucket", F.pmod(F.xxhash64("conv_id"), F.lit(int(total // bucket + 8))).cast("int"))
    found = dealt.groupBy("bucket").applyInArrow(_bucket_levels, "conv_id long, call_id string, level int")
    if large.isEmpty():
        return found
    return found.union(_round_levels(edges.join(large.select("conv_id"), "conv_id", "left_semi")))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row a call: (conv_id, level, turn, pos, call_id, name, valid, errors, n_results, result_turn, json).

    ``calls`` has conv_id, turn, pos, call_id, name and arguments (JSON text), ``results``
    conv_id, turn, call_id and content. Sorted by (conv_id, level, turn, pos) the calls of
    a conversation are in topological order; level 0 uses no other call. Calls of a cycle
    have a null level and an error. ``json`` is the canonical form of call and result, with
    arguments null where they can't be read.

    A call id that comes twice in a conversation counts once, at its first place, and a
    call with several results has the first, by turn and then by content; both counts
    show. A result whose call is missing gives a row with a null name and an error. Rows
    without a conversation or call id are left out. Null arguments or names are errors,
    null contents stay null. Other columns are left out. Empty tables give an empty one.
    """
    tune(calls.sparkSession)
    key = ["conv_id", "call_id"]
    one = calls.filter("conv_id is not null and call_id is not null").groupBy(*key).agg(F.min(F.struct("turn", "pos", "name", "arguments")).alias("c"), F.count(F.lit(1)).alias("n_calls"))
    one = one.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", F.col("c.turn").cast("long").alias("turn"), F.col("c.pos").cast("long").alias("pos"), "c.name", "c.arguments", "n_calls")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [read_arguments(a, n, schemas) for a, n in zip(batch.column(5).to_pylist(), batch.column(4).to_pylist())]
            twice = [["repeated call id"] if n > 1 else [] for n in batch.column(6).to_pylist()]
            new = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] + t for r, t in zip(rows, twice)], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *new], names=["conv_id", "call_id", "turn", "pos", "name", "arguments", "errors", "uses"])

    known = write_shared(one.mapInArrow(read, _READ), "calls")
    answers = results.filter("conv_id is not null and call_id is not null").groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results"))
    answers = answers.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", F.col("r.turn").cast("long").alias("result_turn"), F.col("r.content").alias("content"), "n_results")

    edges = known.select(*key, F.explode("uses").alias("needs"))
    there = known.select("conv_id", F.col("call_id").alias("needs"))
    lost = edges.join(there, ["conv_id", "needs"], "left_anti").groupBy(*key).agg(F.sort_array(F.collect_set("needs")).alias("lost"))
    edges = write_shared(edges.join(there, ["conv_id", "needs"], "left_semi"), "uses")
    free = known.join(edges.select(*key), key, "left_anti").select(*key, F.lit(0).alias("level"))
    settled = free.union(use_levels(edges))

    whole = known.join(answers, key, "full").join(settled, key, "left").join(lost, key, "left")
    extra = F.filter(
        F.array(
            F.when(F.col("errors").isNull(), "no call"),
            F.when(F.col("errors").isNotNull() & F.col("level").isNull(), "cycle"),
            F.when(F.col("n_results").isNull(), "no result"),
            F.when(F.col("n_results") > 1, "several results"),
            F.when(F.col("lost").isNotNull(), F.concat(F.lit("unknown call: "), F.array_join("lost", ", "))),
            F.when(F.col("result_turn") < F.col("turn"), "result before call"),
        ),
        lambda e: e.isNotNull(),
    )
    whole = whole.select("conv_id", "level", "turn", "pos", "call_id", "name", F.concat(F.coalesce("errors", F.array().cast("array<string>")), extra).alias("errors"), F.coalesce("n_results", F.lit(0)).alias("n_results"), "result_turn", "arguments", "content")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "level", "turn", "pos", "call_id", "name", "valid", "errors", "n_results", "result_turn", "json"]
        for batch in batches:
            out = []
            for i, n, e, a, c in zip(*(batch.column(k).to_pylist() for k in (4, 5, 6, 9, 10))):
                out.append(canonical({"arguments": None if a is None else json.loads(a), "errors": e, "id": i, "name": n, "result": c}))
            valid = pa.array([not e for e in batch.column(6).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], valid, *batch.columns[6:9], pa.array(out, pa.string())], names=names)

    schema = "conv_id long, level int, turn long, pos long, call_id string, name string, valid boolean, errors array<string>, n_results long, result_turn long, json string"
    return whole.mapInArrow(lines, schema)
