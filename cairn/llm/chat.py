"""Chat formatting with tool calls: link calls and results, order them, check
arguments, and write canonical JSON.

A conversation table is read by :func:`conversations_read`: conversations with turns
that hold calls or results as JSON by :func:`parsed`, plain ones by
:func:`asked_and_answered`, which takes what a user asks as a call of ``respond``
and the assistant's next turn as its result (so that a corpus without a single
tool call gives calls too; they depend on the one before, and are invalid only
for an empty or null text).

Input frames: ``calls`` (conv_id, turn, call_id, name, arguments as JSON text,
depends_on as array of call ids), ``results`` (conv_id, turn, call_id, content)
and ``messages`` (conv_id, turn, role, text). :func:`parsed` makes them from a
conversation table whose assistant turns hold ``{"tool_calls": [...]}`` and
whose tool turns hold ``{"tool_call_id": ...}``; :func:`asked_and_answered`
reads a plain conversation as calls (what a user asks) and results (the
assistant's next turn).

Calls and results meet in a hash join by (conv_id, call_id). Each side is first
reduced to one lead row a key, so a much-repeated identifier makes no product of
its rows. Calls are ordered by level: one more than the largest level among
those a call depends on. Canonical JSON has sorted keys, no white space,
shortest numbers and unescaped Unicode.

Defined results. A call is ``answered``, ``unanswered``, or ``duplicate`` (not
the first of its id: by turn, then arguments). A result is ``linked``,
``orphan``, or ``duplicate``; of identical rows all count as the first. A call
whose dependency doesn't exist is checked as if it weren't there, with an error;
calls on or behind a cycle have no level. Null arguments, or arguments that are
no JSON object, are invalid. Null texts and contents are null in the JSON. Rows
with a null identifier are never linked. One row for every input row; an empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, column, forget, prepare, written

KEY = ["conv_id", "call_id"]

#: Argument schemas by tool name, as used for plain conversations.
SCHEMAS = {
    "respond": {
        "type": "object",
        "required": ["text", "turn"],
        "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "role": {"enum": ["user"]}},
        "additionalProperties": False,
    }
}


# ------------------------------------------------------------ JSON
def canonical(value) -> str:
    """Canonical JSON text of a parsed value."""
    if isinstance(value, dict):
        # sorted by UTF-16 units, as canonical JSON asks
        items = sorted(value.items(), key=lambda kv: kv[0].encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(v)}" for k, v in items) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float) and not isinstance(value, bool):
        if not math.isfinite(value):
            return "null"
        if value == int(value) and abs(value) < 1e21:
            return str(int(value))
        mantissa, _, power = repr(value).partition("e")
        return mantissa + (f"e{'+' if int(power) > 0 else ''}{int(power)}" if power else "")
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: (isinstance(v, int) and not isinstance(v, bool)) or (isinstance(v, float) and v.is_integer()),
}


def faults(value, schema: dict, at: str = "$") -> list[str]:
    """What a value breaks of a schema: type, enum, required, properties,
    additionalProperties, items, minimum, maximum, minLength, maxLength."""
    out = []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(TYPES[k](value) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        out += [e for k, v in enumerate(value) for e in faults(v, schema["items"], f"{at}[{k}]")]
    if TYPES["number"](value):
        out += [f"{at}: below minimum"] * (value < schema.get("minimum", value)) + [f"{at}: above maximum"] * (value > schema.get("maximum", value))
    if isinstance(value, str):
        out += [f"{at}: too short"] * (len(value) < schema.get("minLength", 0)) + [f"{at}: too long"] * (len(value) > schema.get("maxLength", len(value)))
    return out


def checked(name: str | None, arguments: str | None, schemas: dict) -> tuple[object, list[str]]:
    """(parsed arguments, faults)."""
    try:
        value = json.loads(arguments)
    except (TypeError, ValueError, RecursionError):
        return arguments, ["$: no JSON"]
    if name not in schemas:
        return value, ["unknown tool"]
    return value, faults(value, {"type": "object"} | schemas[name])


# ------------------------------------------------------------ frames
def asked_and_answered(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A plain conversation as (calls, results, messages): a user turn calls
    ``respond`` with its text and depends on the call two turns before; the
    assistant's next turn is the result; other roles are messages."""
    base = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    name = lambda turn: F.concat(F.lit("c"), turn.cast("string"))
    calls = base.where("role = 'user'").select(
        "conv_id",
        "turn",
        name(F.col("turn")).alias("call_id"),
        F.lit("respond").alias("name"),
        F.to_json(F.struct("turn", "text", "role"), {"ignoreNullFields": "false"}).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    results = base.where("role = 'assistant'").select("conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    messages = base.where("role IS NULL OR role NOT IN ('user', 'assistant')").select("conv_id", "turn", "role", "text")
    return calls, results, messages


def parsed(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, messages) of turns that hold tool calls as JSON."""
    base = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    call = "struct<id:string,name:string,arguments:string,depends_on:array<string>>"
    seen = base.withColumn("j", F.from_json("text", f"struct<tool_calls:array<{call}>,tool_call_id:string,content:string>"))
    asks = (F.col("role") == "assistant") & (F.coalesce(F.size("j.tool_calls"), F.lit(0)) > 0)
    answers = (F.col("role") == "tool") & F.col("j.tool_call_id").isNotNull()
    asks, answers = F.coalesce(asks, F.lit(False)), F.coalesce(answers, F.lit(False))
    calls = seen.where(asks).select("conv_id", "turn", F.explode("j.tool_calls").alias("c")).select(
        "conv_id", "turn", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"),
        F.coalesce("c.depends_on", F.array().cast("array<string>")).alias("depends_on"),
    )
    results = seen.where(answers).select("conv_id", "turn", F.col("j.tool_call_id").alias("call_id"), F.col("j.content").alias("content"))
    return calls, results, seen.where(~asks & ~answers).select("conv_id", "turn", "role", "text")


#: Shares into which the turns of a conversation are dealt to learn its kind.
SALTS = 16


def conversations_read(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, messages) of a table in which some conversations hold
    calls as JSON and others are plain. A conversation may hold most turns, so
    its turns are dealt by their number to meet its id."""
    calls, results, messages = parsed(conversations)
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    busy = calls.select("conv_id").unionByName(results.select("conv_id")).where("conv_id IS NOT NULL").distinct().withColumn("salt", salts)
    dealt = messages.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)))
    of_calls = dealt.join(busy, ["conv_id", "salt"], "left_semi").drop("salt")
    more_calls, more_results, plain = asked_and_answered(dealt.join(busy, ["conv_id", "salt"], "left_anti").drop("salt"))
    return calls.unionByName(more_calls), results.unionByName(more_results), of_calls.unionByName(plain)


# ------------------------------------------------------------ order
def levels(lead: DataFrame) -> DataFrame:
    """conv_id, call_id, level, missing: of lead calls.

    A call with one dependency follows it; such chains are followed by doubling
    steps to their anchor (a call with no dependency, or with several), so a chain
    of n calls takes log2(n) rounds. Calls with several dependencies are settled
    in rounds once the anchors they lead to are."""
    spark = lead.sparkSession
    nodes = lead.select(*KEY)
    wants = lead.select(*KEY, F.explode(F.array_distinct("depends_on")).alias("needs"))
    there = nodes.select("conv_id", F.col("call_id").alias("needs"), F.lit(1).alias("there"))
    edges = written(wants.join(there, ["conv_id", "needs"], "left"), "chat-edges")
    met = edges.groupBy(*KEY).agg(F.count("there").alias("deps"), F.min(F.when(F.col("there") == 1, F.col("needs"))).alias("only"), F.count(F.lit(1)).alias("all"))
    start = nodes.join(met, KEY, "left")
    single = F.coalesce(F.col("deps") == 1, F.lit(False))
    state = written(
        start.select(
            *KEY,
            F.when(single, F.col("only")).otherwise(F.col("call_id")).alias("anchor"),
            F.when(single, 1).otherwise(0).alias("steps"),
            (~single).alias("settled"),
            F.coalesce("deps", F.lit(0)).alias("deps"),
            F.coalesce(F.col("all") - F.col("deps"), F.lit(0)).alias("missing"),
        ),
        "chat-state",
    )
    total = nodes.count()
    for _ in range(total.bit_length() + 1):  # then only cycles are unsettled
        if state.where("NOT settled").isEmpty():
            break
        further = state.select("conv_id", F.col("call_id").alias("anchor"), F.col("anchor").alias("far"), F.col("steps").alias("more"), F.col("settled").alias("end"))
        jumped = state.where("NOT settled").join(further, ["conv_id", "anchor"]).select(
            *KEY, F.col("far").alias("anchor"), (F.col("steps") + F.col("more")).alias("steps"), F.col("end").alias("settled"), "deps", "missing"
        )
        new = written(state.where("settled").unionByName(jumped), "chat-state")
        forget(spark, state)
        state = new
    anchored = state.where("settled")
    ends = anchored.select("conv_id", F.col("call_id").alias("needs"), "anchor", (F.col("steps") + 1).alias("steps"))
    several = state.where("deps > 1").select(*KEY)
    waiting = written(edges.where("there = 1").join(several, KEY).join(ends, ["conv_id", "needs"], "left").select(*KEY, "anchor", "steps"), "chat-waiting")
    rounds = [written(state.where("settled AND deps = 0").select(*KEY, F.lit(0).alias("level")), "chat-level")]
    while not waiting.isEmpty() and not rounds[-1].isEmpty():
        known = rounds[0]
        for more in rounds[1:]:
            known = known.unionByName(more)
        step = waiting.join(known.select("conv_id", F.col("call_id").alias("anchor"), "level"), ["conv_id", "anchor"], "left")
        ready = step.groupBy(*KEY).agg(F.count(F.lit(1)).alias("all"), F.count("level").alias("met"), F.max(F.col("level") + F.col("steps")).alias("level"))
        rounds.append(written(ready.where("all = met").select(*KEY, "level"), "chat-level"))
        left = written(waiting.join(rounds[-1].select(*KEY), KEY, "left_anti"), "chat-waiting")
        forget(spark, waiting)
        waiting = left
    known = rounds[0]
    for more in rounds[1:]:
        known = known.unionByName(more)
    known = known.select("conv_id", F.col("call_id").alias("anchor"), F.col("level").alias("base"))
    level = F.when(F.col("settled"), F.col("base") + F.col("steps")).cast("int")
    out = written(state.join(known, ["conv_id", "anchor"], "left").select(*KEY, level.alias("level"), "missing"), "chat-levels")
    forget(spark, edges, state, waiting, *rounds)
    return out


def linked(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """conv_id, turn, kind, call_id, status, level, valid, json: calls with
    what they got, and results."""
    prepare(calls.sparkSession)
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "depends_on")
    results = results.select("conv_id", "turn", "call_id", "content")
    order = F.struct("turn", "arguments", "name", "depends_on")
    lead = calls.where(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()).groupBy(*KEY).agg(F.min(order).alias("lead"))
    lead = written(lead.select(*KEY, F.col("lead.depends_on").alias("depends_on"), F.col("lead.turn").alias("lead_turn"), F.col("lead.arguments").alias("lead_arguments")), "chat-calls")
    firsts = results.where(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()).groupBy(*KEY).agg(F.min(F.struct("turn", "content")).alias("first"))
    firsts = written(firsts.select(*KEY, F.col("first.turn").alias("first_turn"), F.col("first.content").alias("first_content")), "chat-results")
    known = written(levels(lead).join(lead.drop("depends_on"), KEY).join(firsts, KEY, "left"), "chat-known")

    is_lead = F.col("turn").eqNullSafe(F.col("lead_turn")) & F.col("arguments").eqNullSafe(F.col("lead_arguments"))
    answered = F.when(F.col("first_turn").isNotNull() | F.col("first_content").isNotNull(), "answered").otherwise("unanswered")
    asked = calls.join(known, KEY, "left").select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id", "name", F.col("arguments").alias("body"),
        F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), "unanswered").when(is_lead, answered).otherwise("duplicate").alias("status"),
        F.when(is_lead, F.col("level")).alias("level"), F.coalesce("missing", F.lit(0)).alias("missing"),
    )
    is_first = F.col("turn").eqNullSafe(F.col("first_turn")) & F.col("content").eqNullSafe(F.col("first_content"))
    got = results.join(known, KEY, "left").select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", F.lit(None).cast("string").alias("name"), F.col("content").alias("body"),
        F.when(F.col("lead_turn").isNull() & F.col("lead_arguments").isNull(), "orphan").when(is_first, "linked").otherwise("duplicate").alias("status"),
        F.when(is_first, F.col("level")).alias("level"), F.lit(0).cast("long").alias("missing"),
    )
    return serialised(asked.unionByName(got), schemas)


OUT = "conv_id long, turn long, kind string, call_id string, status string, level int, valid boolean, errors array<string>, json string"


def serialised(rows: DataFrame, schemas: dict) -> DataFrame:
    names = [part.split()[0] for part in OUT.split(", ")]

    def run(batch):
        cols = {n: column(batch, n) for n in ("conv_id", "turn", "kind", "call_id", "name", "body", "status", "level", "missing")}
        out = {n: cols.get(n, []) for n in names} | {"valid": [], "errors": [], "json": []}
        for kind, call_id, name, body, missing in zip(cols["kind"], cols["call_id"], cols["name"], cols["body"], cols["missing"]):
            if kind == "call":
                value, errors = checked(name, body, schemas)
                errors = errors + ["missing dependency"] * bool(missing)
                made = {"arguments": value, "id": call_id, "name": name, "type": "call"}
            elif kind == "result":
                made, errors = {"content": body, "id": call_id, "type": "result"}, []
            else:
                made, errors = {"content": body, "role": name, "type": "message"}, []
            out["valid"].append(not errors)
            out["errors"].append(errors)
            out["json"].append(canonical(made))
        return out

    return arrow_map(rows, run, OUT)


def formatted(calls: DataFrame, results: DataFrame, messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """Every call, result and message as one line. Lines of a conversation go
    by level (messages and unordered calls: none), then turn."""
    prepare(calls.sparkSession)
    nothing = F.lit(None).cast("string")
    plain = messages.select(
        "conv_id", "turn", F.lit("message").alias("kind"), nothing.alias("call_id"), F.col("role").alias("name"), F.col("text").alias("body"),
        F.lit("plain").alias("status"), F.lit(None).cast("int").alias("level"), F.lit(0).cast("long").alias("missing"),
    )
    return linked(calls, results, schemas).unionByName(serialised(plain, schemas))
