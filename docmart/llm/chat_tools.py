"""Tool calls of conversations: linked to their results, ordered, checked and written as JSON.

Calls and results meet in a hash join by conversation and identifier. A call's level is one
more than the largest level of the calls it depends on, so ``(level, seq, call_id)`` is a
topological order of a conversation. Levels are found for all conversations at once; no task holds
a conversation, and a chain of calls takes a logarithmic number of rounds (``levels``). Arguments are
checked against the tool's schema (a subset of JSON Schema), and each call becomes one line of
canonical JSON: sorted keys, no white space, no escapes but the necessary ones.

Cases: of calls that repeat an identifier in a conversation the first by ``seq`` (then by name
and arguments) counts, of results the smallest content; ``n_calls`` and ``n_results`` tell how
many there were. A result without a call is ``orphan``, a call without a result ``pending``. A
call without conversation or identifier is left out, as nothing can refer to it. Dependencies on
unknown calls are listed in ``missing`` and do not delay a call. Calls on a cycle, or behind
one, have no level and are ``cyclic``. Arguments that are no JSON object, or null, are invalid
and written as the text they are. Tools without a schema are invalid.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import flush, rows_of, stage
from docmart.session import delete_path

KEY = ["conv_id", "call_id"]

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def violations(value: object, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` the schema forbids: ``type, enum, minimum, maximum, minLength, properties,
    required, additionalProperties, items`` are known."""
    wanted = schema.get("type")
    if wanted and (not isinstance(value, _TYPES[wanted]) or (isinstance(value, bool) and wanted in ("integer", "number"))):
        return [f"{at}: not of type {wanted}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            found.append(f"{at}: below minimum")
        if value > schema.get("maximum", value):
            found.append(f"{at}: above maximum")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        found.append(f"{at}: too short")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                found += violations(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            found += violations(v, schema["items"], f"{at}[{i}]")
    return sorted(found)


def _no_constant(name: str) -> None:
    raise ValueError(name)


def parse_arguments(text: str | None) -> tuple[object, list[str]]:
    try:
        value = json.loads(text or "", parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return text, ["$: not JSON"]
    return (value, []) if isinstance(value, dict) else (text, ["$: not of type object"])


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def first_calls(calls: DataFrame) -> DataFrame:
    """One row per identifier of a conversation; ``depends_on`` without repeats, sorted."""
    rows = calls.where("conv_id is not null and call_id is not null")
    own = F.struct("seq", "name", "arguments", F.array_sort(F.array_distinct(F.filter(F.coalesce("depends_on", F.array().cast("array<string>")), lambda d: d.isNotNull()))).alias("depends_on"))
    rows = rows.groupBy(*KEY).agg(F.min(own).alias("c"), F.count("*").alias("n_calls"))
    return rows.select(*KEY, "c.seq", "c.name", "c.arguments", "c.depends_on", "n_calls")


def _replaced(old: DataFrame, new: DataFrame, label: str) -> DataFrame:
    new = stage(new, label)
    files = old.inputFiles()
    if files:
        delete_path(old.sparkSession, files[0].rsplit("/", 1)[0])
    return new


def jumps(single: DataFrame) -> DataFrame:
    """``(conv_id, call_id, to, dist)`` for calls with one dependency each (``dep``): the first call
    behind them that is not of the kind, and how many steps away. Steps double every round, so a chain
    of n calls takes log n rounds. Calls on a cycle, or behind one, have no row."""
    now = stage(single.select(*KEY, F.col("dep").alias("to"), F.lit(1).alias("dist"), F.lit(False).alias("done")), "jumps")
    open_ = now.count()
    for _ in range(open_.bit_length() + 1):
        if not open_:
            break
        further = now.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("dist").alias("more"))
        moved = now.where("not done").join(further, ["conv_id", "to"], "left").select(
            *KEY, F.coalesce("next", "to").alias("to"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), F.col("next").isNull().alias("done")
        )
        now = _replaced(now, now.where("done").unionByName(moved), "jumps")
        open_ = now.where("not done").count()
    return now


def levels(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level, missing)``. Chains of calls with one dependency each are passed by
    pointer doubling; what takes a round for each step is only calls that join several others."""
    names = calls.select("conv_id", F.col("call_id").alias("dep"), F.lit(True).alias("known"))
    needs = calls.select(*KEY, F.explode("depends_on").alias("dep")).join(names, ["conv_id", "dep"], "left")
    edges = stage(needs, "edges")
    per_call = edges.groupBy(*KEY).agg(F.count("known").alias("n"), F.array_sort(F.collect_list(F.when(F.col("known").isNull(), F.col("dep")))).alias("missing"))
    every = calls.select(*KEY).join(per_call, KEY, "left")
    every = stage(every.select(*KEY, F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("missing", F.array().cast("array<string>")).alias("missing")), "calls")
    known = edges.where("known").select(*KEY, "dep")
    jump = jumps(known.join(every.where("n = 1").select(*KEY), KEY))

    # Edges of the calls that join several, each to the end of the chain it leads to.
    ends = jump.select("conv_id", F.col("call_id").alias("dep"), F.col("to").alias("end"), "dist", "done")
    joining = known.join(every.where("n > 1").select(*KEY), KEY).join(ends, ["conv_id", "dep"], "left")
    joining = stage(joining.select(*KEY, F.when(F.col("done").isNull(), F.col("dep")).when(F.col("done"), F.col("end")).alias("dep"), (F.coalesce("dist", F.lit(0)) + 1).alias("step")), "joining")
    now = stage(every.where("n <> 1").select(*KEY, F.when(F.col("n") == 0, 0).alias("level")), "levels")
    open_ = now.where("level is null").count()
    while open_:
        ready = joining.join(now.select("conv_id", F.col("call_id").alias("dep"), F.col("level").alias("before")), ["conv_id", "dep"], "left")
        ready = ready.groupBy(*KEY).agg(F.max(F.col("before") + F.col("step")).alias("next"), F.count(F.when(F.col("before").isNull(), 1)).alias("waits")).where("waits = 0")
        now = _replaced(now, now.join(ready.select(*KEY, "next"), KEY, "left").select(*KEY, F.coalesce("level", "next").alias("level")), "levels")
        left = now.where("level is null").count()
        if left == open_:
            break
        open_ = left
    behind = jump.where("done").join(now.select("conv_id", F.col("call_id").alias("to"), "level"), ["conv_id", "to"])
    both = now.unionByName(behind.select(*KEY, (F.col("level") + F.col("dist")).alias("level")))
    return every.join(both, KEY, "left").select(*KEY, "level", "missing")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls`` has ``conv_id, seq, call_id, name, arguments`` (JSON text) and ``depends_on`` (ids);
    ``results`` has ``conv_id, call_id, content``. One row per call or orphaned result."""
    called = stage(first_calls(calls), "calls")
    given = results.where("conv_id is not null and call_id is not null").groupBy(*KEY).agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    linked = called.join(given.hint("shuffle_hash"), KEY, "full").join(levels(called), KEY, "left")
    schema = pa.schema([
        ("conv_id", pa.int64()), ("call_id", pa.string()), ("seq", pa.int64()), ("level", pa.int32()), ("name", pa.string()), ("status", pa.string()),
        ("valid", pa.bool_()), ("errors", pa.list_(pa.string())), ("missing", pa.list_(pa.string())), ("n_calls", pa.int64()), ("n_results", pa.int64()), ("json", pa.string()),
    ])
    columns = ("conv_id", "call_id", "seq", "level", "name", "arguments", "depends_on", "missing", "content", "n_calls", "n_results")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for conv, call, seq, level, name, text, needs, missing, content, n_calls, n_results in rows_of(batches, *columns):
            if n_calls is None:
                line = canonical({"id": call, "result": content})
                rows.append((conv, call, None, None, None, "orphan", None, [], [], 0, n_results, line))
            else:
                value, errors = parse_arguments(text)
                if not errors:
                    errors = violations(value, schemas[name]) if name in schemas else ["$: no schema"]
                status = "cyclic" if level is None else "linked" if n_results else "pending"
                line = canonical({"arguments": value, "depends_on": needs, "id": call, "level": level, "name": name, "result": content})
                rows.append((conv, call, seq, level, name, status, not errors, errors, missing, n_calls, n_results or 0, line))
            if len(rows) >= 5000:
                yield flush(schema, rows)
        yield flush(schema, rows)

    ddl = (
        "conv_id long, call_id string, seq long, level int, name string, status string, valid boolean, errors array<string>,"
        " missing array<string>, n_calls long, n_results long, json string"
    )
    typed = linked.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", F.col("seq").cast("long").alias("seq"), *columns[3:])
    return typed.mapInArrow(run, ddl)
