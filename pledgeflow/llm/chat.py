"""Tool calls of chats: linked to their results, ordered, validated and serialised.

Calls and results meet in a hash join on their identifier. A call may follow another one;
its place in topological order is its distance from a call that follows none, found by
pointer doubling. Arguments are checked against the tool's schema, and every call becomes one
line of canonical JSON: keys sorted, no spaces, UTF-8.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.llm.text_batches import ship
from pledgeflow.session import materialise

# the tool of the query's binding: a user's turn asks for a reply
SCHEMAS = {
    "reply": {
        "type": "object",
        "required": ["text", "words"],
        "properties": {
            "after": {"type": ["string", "null"]},
            "text": {"type": "string", "minLength": 1},
            "words": {"type": "integer", "minimum": 1, "maximum": 4096},
        },
        "additionalProperties": False,
    }
}
_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
}


def canonical(value: object) -> str:
    """JSON with sorted keys, without spaces, in UTF-8 characters."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def schema_errors(value: object, schema: Mapping, at: str = "$") -> list[str]:
    """What a value breaks of type, enum, required, properties, items and the bounds of a schema."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[kind](value) for kind in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    errors = []
    if "enum" in schema and value not in schema["enum"]:
        errors.append(f"{at}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        errors += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        if schema.get("additionalProperties") is False:
            errors += [f"{at}.{name}: unknown" for name in sorted(value) if name not in known]
        for name in sorted(known):
            if name in value:
                errors += schema_errors(value[name], known[name], f"{at}.{name}")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            errors += schema_errors(item, schema["items"], f"{at}[{i}]")
    size = len(value) if isinstance(value, str) else value if _TYPES["number"](value) else None
    low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minimum", "maximum")
    if size is not None and low in schema and size < schema[low]:
        errors.append(f"{at}: below {low}")
    if size is not None and high in schema and size > schema[high]:
        errors.append(f"{at}: above {high}")
    return errors


def topological_order(calls: DataFrame) -> DataFrame:
    """(call_id, place): calls that a call follows, directly or not; null on a cycle.

    ``calls`` has call_id and after. An ``after`` that names no call counts as none. Every round
    doubles the distance looked back, so rounds grow with the logarithm of the longest chain.
    """
    unique = calls.filter("call_id is not null").groupBy("call_id").agg(F.min("after").alias("after"))
    known = unique.select(F.col("call_id").alias("after"))
    chained = unique.join(known, "after", "left_semi").select("call_id", F.col("after").alias("up"), F.lit(1).cast("long").alias("place"))
    roots = unique.join(chained.select("call_id"), "call_id", "left_anti")
    graph = materialise(chained.unionByName(roots.select("call_id", F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("place"))))
    open_calls = graph.filter("up is not null").count()
    rounds = math.ceil(math.log2(open_calls + 1)) + 1 if open_calls else 0
    for _ in range(rounds):
        above = graph.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("place").alias("more"))
        graph = graph.join(above, "up", "left").select(
            "call_id", F.col("next").alias("up"), (F.col("place") + F.coalesce("more", F.lit(0))).alias("place")
        )
        graph = materialise(graph)
        if not graph.filter("up is not null").limit(1).count():
            break
    return graph.select("call_id", F.when(F.col("up").isNull(), F.col("place")).alias("place"))


def linked_calls(
    calls: DataFrame,
    results: DataFrame,
    schemas: Mapping[str, Mapping] = SCHEMAS,
    passed: Sequence[str] = (),
    others: DataFrame | None = None,
) -> DataFrame:
    """One row per call, per result that is not a call's first answer, and per other message.

    ``calls`` has call_id, name, arguments (JSON text), after and the ``passed`` columns; ``results``
    has call_id, content and the ``passed`` columns; ``others``, messages that neither call nor answer, role,
    content and the ``passed`` columns. Returns ``kept`` (struct of passed columns), call_id, place, status,
    errors and line. ``status`` is ``linked``, ``unanswered`` (no result), ``cycle`` or ``invalid`` for a call, ``orphan``
    for a result that answers no call, ``repeated_result`` for a further one of a call, ``no_call`` for another
    message. ``line`` is canonical JSON: of a call its id, name, arguments, place and result, with arguments
    kept as text that aren't JSON (numbers beyond doubles, lone surrogates and too deep nesting included).

    Of several results of one call the least content is taken, null last; calls that share an identifier
    get the same result and are noted in errors. Null identifiers meet nothing. Empty tables
    give no rows; equal rows give equal lines.
    """

    def kept(frame: DataFrame):
        return F.struct(F.lit(0).alias("_"), *[frame[c] for c in passed]).alias("kept")

    def text(name: str, value=None):
        return (F.lit(value) if isinstance(value, str | None) else value).cast("string").alias(name)

    def rest(frame: DataFrame, kind: str, name=None) -> DataFrame:
        return frame.select(
            "kept", "call_id", text("name", name), text("arguments"), "content", F.lit(True).alias("answered"),
            F.lit(None).cast("long").alias("place"), F.lit(0).cast("long").alias("times"), F.lit(kind).alias("kind"),
        )

    given = materialise(results.select(kept(results), "call_id", "content", F.monotonically_increasing_id().alias("row")))
    answer = F.min(F.struct(F.col("content").isNull(), "content", "row"))
    answers = given.filter("call_id is not null").groupBy("call_id").agg(answer.alias("a"))
    answers = materialise(answers.select("call_id", F.col("a.content").alias("content"), F.col("a.row").alias("first"), F.lit(True).alias("answered")))
    times = calls.filter("call_id is not null").groupBy("call_id").agg(F.count("*").alias("times"))
    order = topological_order(calls)
    asked = calls.select(kept(calls), "call_id", "name", "arguments")
    joined = asked.join(answers, "call_id", "left").join(order.join(times, "call_id"), "call_id", "left")
    called = calls.select("call_id").distinct()
    orphans = given.join(called, "call_id", "left_anti")
    further = given.join(called, "call_id", "left_semi").join(answers.select("call_id", "first"), "call_id").filter("row <> first")
    rows = joined.select(
        "kept", "call_id", "name", "arguments", "content", F.coalesce("answered", F.lit(False)).alias("answered"), "place", "times", F.lit("call").alias("kind")
    ).unionByName(rest(orphans, "orphan")).unionByName(rest(further, "repeated_result"))
    if others is not None:
        spoken = others.select(kept(others), F.lit(None).cast("string").alias("call_id"), "role", "content")
        rows = rows.unionByName(rest(spoken, "no_call", F.col("role")))
    rules = {name: dict(schema) for name, schema in schemas.items()}
    schema = T.StructType([rows.schema["kept"], rows.schema["call_id"], rows.schema["place"]])
    schema.add("status", T.StringType()).add("errors", T.ArrayType(T.StringType())).add("line", T.StringType())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_line(row, rules) for row in batch.drop_columns(["kept"]).to_pylist()]
            status, errors, lines = ([f[i] for f in found] for i in range(3))
            arrays = [batch.column("kept"), batch.column("call_id"), batch.column("place")]
            arrays += [pa.array(status, pa.string()), pa.array(errors, pa.list_(pa.string())), pa.array(lines, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["kept", "call_id", "place", "status", "errors", "line"])

    return ship(rows).mapInArrow(write, schema)


def _finite(number: str) -> float:
    value = float(number)
    if not math.isfinite(value):
        raise ValueError(number)
    return value


def _no_number(name: str) -> None:
    raise ValueError(name)


def _parsed(text: str | None) -> object:
    """JSON by the letter of its standard, which can be written again; ValueError for all else."""
    try:
        value = json.loads(text or "null", parse_float=_finite, parse_constant=_no_number)
        canonical(value).encode()
    except RecursionError as deep:
        raise ValueError("nested too deeply") from deep
    return value


def _line(row: Mapping, schemas: Mapping[str, Mapping]) -> tuple[str, list[str], str]:
    """Status, errors and canonical JSON of one call, result or other message."""
    if row["kind"] == "no_call":
        return "no_call", [], canonical({"content": row["content"], "role": row["name"]})
    if row["kind"] != "call":
        return row["kind"], [], canonical({"id": row["call_id"], "result": row["content"]})
    errors = []
    try:
        arguments = _parsed(row["arguments"])
    except ValueError:
        arguments = row["arguments"]
        errors.append("$: not JSON")
    else:
        schema = schemas.get(row["name"])
        errors += ["$: no such tool"] if schema is None else schema_errors(arguments, schema)
    on_cycle = row["call_id"] is not None and row["place"] is None
    if (row["times"] or 0) > 1:
        errors.append("id: repeated")
    status = "cycle" if on_cycle else "invalid" if errors else "linked" if row["answered"] else "unanswered"
    line = {"arguments": arguments, "id": row["call_id"], "name": row["name"], "place": row["place"], "result": row["content"]}
    return status, errors, canonical(line)


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read chats as tool use: a user's turn calls ``reply``, an assistant's answers the turn before.

    Calls, results, and the turns of all other roles, null among them. A call follows the user's turn
    two before; a null conversation or turn gives a null identifier.
    """
    def name(back: int):
        return F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - back).cast("string"))

    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t-\r]+"), lambda w: w != "")).alias("words")
    arguments = F.to_json(F.struct(name(2).alias("after"), F.col("text"), words))
    calls = conversations.filter("role = 'user'").select(
        "conv_id", "turn", name(0).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), name(2).alias("after")
    )
    results = conversations.filter("role = 'assistant'").select("conv_id", "turn", name(1).alias("call_id"), F.col("text").alias("content"))
    neither = ~F.col("role").eqNullSafe(F.lit("user")) & ~F.col("role").eqNullSafe(F.lit("assistant"))
    others = conversations.filter(neither).select("conv_id", "turn", "role", F.col("text").alias("content"))
    return calls, results, others
