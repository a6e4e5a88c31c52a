"""Chat formatting: tool calls linked with results, ordered, checked and written as canonical JSON."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import staged

#: A tool's arguments: name to {"type", "required", "min", "max", "min_length", "enum"}.
Schema = Mapping[str, Mapping[str, object]]

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}
_EVENT = "conv string, turn bigint, idx int, kind string, id string, name string, payload string, after array<string>"


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, characters as they are; NaN and infinities are null."""

    def plain(x: object) -> object:
        if isinstance(x, float) and not math.isfinite(x):
            return None
        if isinstance(x, dict):
            return {str(k): plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        return x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def problems(arguments: object, schema: Schema | None) -> list[str]:
    """What is wrong with a call's arguments, in the order of their names; empty if nothing is."""
    if schema is None:
        return ["unknown tool"]
    if not isinstance(arguments, dict):
        return ["arguments are no object"]
    out = []
    for name in sorted({*schema, *arguments}):
        rule = schema.get(name)
        if rule is None:
            out.append(f"{name}: unknown")
        elif name not in arguments:
            if rule.get("required"):
                out.append(f"{name}: missing")
        else:
            value, kind = arguments[name], str(rule.get("type", ""))
            wanted = _TYPES.get(kind)
            if wanted and (not isinstance(value, wanted) or isinstance(value, bool) != (kind == "boolean")):
                out.append(f"{name}: not {kind}")
                continue
            if "enum" in rule and value not in rule["enum"]:
                out.append(f"{name}: not among the choices")
            if isinstance(value, (int, float)) and not isinstance(value, bool):
                if "min" in rule and value < rule["min"]:
                    out.append(f"{name}: below {rule['min']}")
                if "max" in rule and value > rule["max"]:
                    out.append(f"{name}: above {rule['max']}")
            if isinstance(value, str) and len(value) < int(rule.get("min_length", 0)):
                out.append(f"{name}: too short")
    return out


def _parsed(text: str | None) -> object:
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


def events_of(turns: DataFrame) -> DataFrame:
    """Calls, results and plain messages of turns (``conv_id``, ``turn``, ``role``, ``text``).

    A turn whose text is a JSON object with a list ``tool_calls`` holds calls (``id``, ``name``,
    ``arguments``, and ``after``: ids of calls that must come first); one of role "tool" whose text is
    a JSON object with ``tool_call_id`` is a result. Any other turn is a message.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, turn, role, text in zip(batch["conv"], batch["turn"], batch["role"], batch["text"]):
                found = _parsed(text) if text and text.lstrip()[:1] == "{" else None
                calls = found.get("tool_calls") if isinstance(found, dict) else None
                if isinstance(calls, list):
                    for i, call in enumerate(calls):
                        call = call if isinstance(call, dict) else {}
                        after = call.get("after")
                        out.append(
                            (conv, turn, i, "call", _name(call.get("id")), _name(call.get("name")), canonical(call.get("arguments")),
                             [str(a) for a in after] if isinstance(after, list) else [])
                        )
                elif role == "tool" and isinstance(found, dict) and "tool_call_id" in found:
                    out.append((conv, turn, 0, "result", _name(found["tool_call_id"]), None, canonical(found.get("content")), []))
                else:
                    out.append((conv, turn, 0, "message", None, role, canonical(text), []))
            yield pd.DataFrame(out, columns=["conv", "turn", "idx", "kind", "id", "name", "payload", "after"])

    return turns.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    ).mapInPandas(run, _EVENT)


def _name(value: object) -> str | None:
    return None if value is None else str(value)


def exchange_events(turns: DataFrame) -> DataFrame:
    """Plain conversations as events: a user's turn calls the tool "reply", the assistant's turn right
    behind it is the result, a later call comes after the user's call before it; others are messages.

    Neighbouring turns are found by joins on (conversation, turn), so a conversation of any length is
    never gathered. All rows come back, repeated ones too, numbered (``idx``) by role and text within
    their turn: of several user rows of a turn the first is the call that is answered, the others are
    calls with ids of their own. Rows without a conversation or a
    turn are messages, one each, and link nothing.
    """
    rows = turns.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    nowhere = F.col("conv").isNull() | F.col("turn").isNull()
    lone = rows.where(nowhere).withColumn("idx", F.lit(0)).withColumn("result", F.lit(False))
    # rows alike are one row with their number until they are numbered, so a turn of many copies is small
    rows = rows.where(~nowhere).groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    before = Window.partitionBy("conv", "turn").orderBy("role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("base", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    rows = rows.withColumn("ask", F.min(F.when(F.col("role") == "user", F.col("base").cast("int"))).over(Window.partitionBy("conv", "turn")))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = staged(rows.select("conv", "turn", "role", "text", (F.col("base") + F.col("copy")).cast("int").alias("idx"), "ask"), "turns")
    asked = rows.where("role = 'user' and idx = ask").select("conv", "turn")
    call_id = F.concat_ws(":", F.col("conv"), F.col("turn"), F.when(F.col("idx") != F.col("ask"), F.col("idx")))
    before = asked.select("conv", (F.col("turn") + 2).alias("turn"), F.lit(True).alias("follows"))
    calls = (
        rows.where("role = 'user'")
        .join(before, ["conv", "turn"], "left")
        .select(
            "conv", "turn", "idx", F.lit("call").alias("kind"), call_id.alias("id"), F.lit("reply").alias("name"),
            F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn"))).alias("payload"),
            F.when(F.col("follows"), F.array(F.concat_ws(":", F.col("conv"), F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("after"),
        )
    )
    answered = asked.select("conv", (F.col("turn") + 1).alias("turn"), F.lit(True).alias("answers"))
    others = (
        rows.where("role <> 'user' or role is null")
        .join(answered, ["conv", "turn"], "left")
        .withColumn("result", F.coalesce(F.col("answers") & (F.col("role") == "assistant"), F.lit(False)))
        .select("conv", "turn", "role", "text", "idx", "result")
        .unionByName(lone)
        .select(
            "conv", "turn", "idx",
            F.when(F.col("result"), F.lit("result")).otherwise(F.lit("message")).alias("kind"),
            F.when(F.col("result"), F.concat_ws(":", F.col("conv"), F.col("turn") - 1)).alias("id"),
            F.when(~F.col("result"), F.col("role")).alias("name"),
            F.to_json(F.struct(F.col("text").alias("content"))).alias("payload"),
            F.array().cast("array<string>").alias("after"),
        )
    )
    return calls.unionAll(others)


def _ordered(calls: DataFrame, links: DataFrame) -> DataFrame:
    """``conv``, ``id``, ``place`` (turn, index, hops) of every call, larger than that of all calls it
    comes after, and ``cyclic``.

    A call keeps its own place unless a call it waits for stands later; then it follows that one, a
    hop behind. Places are raised by joins until none changes: at once where calls stand in order
    already, else in as many rounds as late calls follow each other. A call that would have to follow
    itself is marked, and what it waits for is no longer heeded. Where a later call stands before a
    circle its place hides that; then calls are marked that others wait for and that stand more hops
    behind it than the conversation has calls, which opens the circle: they are of one, or between two
    calls of which the first waits for one.
    """
    own = F.struct(F.col("turn"), F.col("idx"), F.lit(0).alias("hops"))
    sizes = calls.groupBy("conv").agg(F.count(F.lit(1)).alias("many"))
    links = staged(links, "waits")
    awaited = links.select("conv", F.col("first").alias("id"), F.lit(True).alias("awaited")).distinct()
    places = calls.select("conv", "id", own.alias("own"), own.alias("place"), F.lit(False).alias("cyclic"))
    places = places.join(sizes, "conv").join(awaited, ["conv", "id"], "left")
    places = staged(places.withColumn("many", F.when(F.col("awaited"), F.col("many"))).drop("awaited"), "places")
    while True:
        pushed = (
            links.join(places.select("conv", F.col("id").alias("first"), F.col("place").alias("p")), ["conv", "first"])
            .groupBy("conv", "id")
            .agg(F.max(F.struct("p.turn", "p.idx", (F.col("p.hops") + 1).alias("hops"))).alias("least"))
        )
        raised = places.join(pushed, ["conv", "id"], "left").withColumn(
            "back",
            F.coalesce(
                ((F.col("least.turn") == F.col("own.turn")) & (F.col("least.idx") == F.col("own.idx"))) | (F.col("least.hops") > F.col("many")),
                F.lit(False),
            ),
        )
        raised = raised.select(
            "conv", "id", "own", "many",
            F.when(F.col("cyclic") | F.col("back"), F.col("own")).otherwise(F.greatest("place", F.coalesce("least", "place"))).alias("next"),
            "place", (F.col("cyclic") | F.col("back")).alias("cyclic"),
        )
        raised = staged(raised, "places")
        changed = raised.where(F.col("next") != F.col("place")).limit(1).count()
        places = raised.select("conv", "id", "own", "many", F.col("next").alias("place"), "cyclic")
        if not changed:
            return places.select("conv", "id", "place", "cyclic")


def format_events(events: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """One row per event: ``conv``, ``turn``, ``idx``, ``kind``, ``call_id``, ``linked``, ``valid``,
    ``place_turn``, ``place_idx``, ``hops``, ``rank``, ``json``.

    Rows in the order (place_turn, place_idx, hops, rank, turn, idx) within a conversation are in
    topological order: a call comes behind every call it waits for, a result right behind its call,
    messages at their turn. ``linked``: a call with a result or a result with a call, by a hash join
    on the conversation and the id. ``valid``: the call's arguments fit its tool's schema and it is
    in no cycle; a result is valid if it is linked, a message always. Of several calls of one id the
    first by place stands for it in links; the others are invalid. NULL ids link nothing. A NULL
    conversation or turn is one of its own. No events, no rows.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fits, written = [], []
            for kind, id_, name, payload in zip(batch["kind"], batch["id"], batch["name"], batch["payload"]):
                value = _parsed(payload)
                if kind == "call":
                    fits.append(not problems(value, schemas.get(name)))
                    written.append(canonical({"arguments": value, "id": id_, "name": name, "type": "call"}))
                elif kind == "result":
                    fits.append(True)
                    written.append(canonical({"content": value, "id": id_, "type": "result"}))
                else:
                    fits.append(True)
                    written.append(canonical({"content": value, "role": name, "type": "message"}))
            yield batch[["conv", "turn", "idx", "kind", "id", "after"]].assign(fits=fits, json=written)

    rows = staged(
        events.select(
            F.coalesce("conv", F.lit("")).alias("conv"), F.coalesce("turn", F.lit(-1)).alias("turn"), "idx", "kind", "id", "name", "payload", "after"
        ).mapInPandas(run, "conv string, turn bigint, idx int, kind string, id string, after array<string>, fits boolean, json string"),
        "events",
    )
    named = rows.where("kind = 'call' and id is not null")
    firsts = staged(
        named.groupBy("conv", "id").agg(F.min(F.struct("turn", "idx")).alias("f")).select("conv", "id", "f.turn", "f.idx"), "calls"
    )
    waits = (
        named.join(firsts, ["conv", "id", "turn", "idx"], "left_semi")
        .select("conv", "id", F.explode("after").alias("first"))
        .distinct()
    )
    known = firsts.select("conv", F.col("id").alias("first"))
    placed = staged(_ordered(firsts, waits.join(known, ["conv", "first"])), "placed").select(
        "conv", "id", "place", "cyclic", F.lit(True).alias("has_call")
    )
    placed = placed.join(firsts.select("conv", "id", F.col("turn").alias("f_turn"), F.col("idx").alias("f_idx")), ["conv", "id"])
    answered = rows.where("kind = 'result' and id is not null").select("conv", "id").distinct().withColumn("has_result", F.lit(True))
    heads = rows.where("kind <> 'message' and id is not null").join(staged(placed, "heads"), ["conv", "id"], "left").join(
        staged(answered, "answered"), ["conv", "id"], "left"
    )
    lone = rows.where("kind = 'message' or id is null")
    for name, kind in (("place", "struct<turn:bigint,idx:int,hops:int>"), ("cyclic", "boolean"), ("has_call", "boolean"), ("f_turn", "bigint"), ("f_idx", "int"), ("has_result", "boolean")):
        lone = lone.withColumn(name, F.lit(None).cast(kind))
    all_ = heads.select(*lone.columns).unionAll(lone)
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    stands = is_call & (F.col("f_turn") == F.col("turn")) & (F.col("f_idx") == F.col("idx"))
    linked = F.coalesce((is_result & F.col("has_call")) | (stands & F.col("has_result")), F.lit(False))
    own = F.struct("turn", "idx", F.lit(0).alias("hops"))
    place = F.when(F.coalesce(stands | is_result, F.lit(False)), F.coalesce("place", own)).otherwise(own)
    return all_.select(
        "conv", "turn", "idx", "kind", F.col("id").alias("call_id"), linked.alias("linked"),
        F.when(is_call, F.col("fits") & F.coalesce(stands & ~F.col("cyclic"), F.lit(False))).when(is_result, linked).otherwise(True).alias("valid"),
        place["turn"].alias("place_turn"), place["idx"].alias("place_idx"), place["hops"].alias("hops"),
        F.when(is_result, 1).otherwise(0).alias("rank"), "json",
    )
