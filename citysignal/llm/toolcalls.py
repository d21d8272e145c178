"""Tool-call linking: calls joined to results, ordered, validated and written as JSON.

Messages have conv_id, turn, kind (``call`` or ``result``), call_id, name, body (JSON of the
arguments or of the result) and needs (ids of calls whose results a call uses).

Calls and results are hash-joined by (conv_id, call_id). Of calls that share an id the
earliest counts, the others are counted in ``copies``; so with results. Order: a call
stands at its turn unless a call it needs stands later; then it moves behind that one.
(``order_at``, ``order_hops``, ``turn``, ``call_id``) sorts each conversation so that every
call follows those it needs. Only calls with a need ahead of them, and what depends on
them, are worked on; calls in a circle get status ``circular``.

Arguments are parsed as variants, checked against the tool's schema, and written with
sorted keys and without spaces. No Python runs on rows, and no conversation is gathered
into one task: grouping is by call, summed before the shuffle.

Null bodies are invalid JSON. Rows with a null conv_id, turn or call_id are linked to nothing
but kept, each as a row of its own: calls as ``unanswered``, results as ``orphan``. Empty
tables give no rows.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal.llm.common import cut_lineage, text_of

# Tools and their arguments; the types are JSON's.
Schema = dict[str, dict[str, dict]]


def canonical(body: Column) -> Column:
    """JSON with keys sorted and no spaces; null if it is not valid."""
    return F.to_json(F.try_parse_json(body))


def _errors(schema: Schema) -> Column:
    """What is wrong with ``parsed``, a variant, for the tool ``name``; sorted, comma-joined."""
    listed: list[Column] = [
        F.when(F.col("parsed").isNull(), F.lit("json")),
        F.when(F.col("parsed").isNotNull() & ~F.col("name").isin(*schema), F.lit("tool")),
        F.when(F.col("parsed").isNotNull() & F.col("name").isNull(), F.lit("tool")),
    ]
    for tool, fields in schema.items():
        here = F.col("parsed").isNotNull() & (F.col("name") == tool)
        for field, rule in fields.items():
            path = f"$.{field}"
            kind = F.schema_of_variant(F.try_variant_get("parsed", path, "variant"))
            as_text = F.try_variant_get("parsed", path, "string")
            number = F.try_variant_get("parsed", path, "double")
            missing = kind.isNull() | (kind == "VOID")
            wanted = {
                "string": kind == "STRING",
                "integer": kind == "BIGINT",
                "number": kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"),
                "boolean": kind == "BOOLEAN",
                "array": kind.startswith("ARRAY"),
                "object": kind.startswith("OBJECT"),
            }[rule["type"]]
            if rule.get("required"):
                listed.append(F.when(here & missing, F.lit(f"{field}:missing")))
            listed.append(F.when(here & ~missing & ~wanted, F.lit(f"{field}:type")))
            limits = []
            if "minimum" in rule:
                limits.append(number < rule["minimum"])
            if "maximum" in rule:
                limits.append(number > rule["maximum"])
            if "min_length" in rule:
                limits.append(F.char_length(as_text) < rule["min_length"])
            if "enum" in rule:
                limits.append(~as_text.isin(*rule["enum"]))
            if limits:
                outside = functools.reduce(operator.or_, limits)
                listed.append(F.when(here & ~missing & wanted & outside, F.lit(f"{field}:value")))
    return F.array_join(F.array_sort(F.array_compact(F.array(*listed))), ",")


def ordered(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, order_at, order_hops and circular for calls that are not in turn order.

    Rounds end when nothing moves. A circle is known when a call has moved behind more
    calls than its conversation has late ones.
    """
    keys = calls.select("conv_id", "call_id", "turn")
    edges = (
        calls.select("conv_id", "call_id", F.explode(F.array_distinct("needs")).alias("need"))
        .join(
            keys.select(
                "conv_id",
                F.col("call_id").alias("need"),
                F.col("turn").alias("need_turn"),
            ),
            ["conv_id", "need"],
        )
        .join(keys, ["conv_id", "call_id"])
    )
    moved = cut_lineage(
        edges.where("need_turn >= turn")
        .groupBy("conv_id", "call_id")
        .agg(F.max("need_turn").alias("order_at"), F.lit(1).alias("order_hops"))
        .withColumn("circular", F.lit(False))
    )
    if moved.isEmpty():
        return moved
    edges = cut_lineage(edges)
    size = calls.groupBy("conv_id").agg(F.count(F.lit(1)).alias("calls"))
    while True:
        place = F.struct(F.col("order_at").alias("at"), F.col("order_hops").alias("hops"))
        ahead = F.when(~F.col("circular") & (F.col("p.at") >= F.col("turn")), F.struct("p.at", (F.col("p.hops") + 1).alias("hops")))
        pushed = (
            edges.join(
                moved.select("conv_id", F.col("call_id").alias("need"), place.alias("p"), "circular"),
                ["conv_id", "need"],
            )
            .groupBy("conv_id", "call_id")
            .agg(F.max(ahead).alias("new"), F.max("circular").alias("blocked"))
        )
        stepped = moved.join(pushed, ["conv_id", "call_id"], "full").join(size, "conv_id")
        old = F.struct(F.col("order_at").alias("at"), F.col("order_hops").alias("hops"))
        changes = F.col("new").isNotNull() & (F.col("order_at").isNull() | (F.col("new") > old))
        blocked = F.coalesce("blocked", F.lit(False))
        changes = (changes | blocked) & ~F.coalesce("circular", F.lit(False))
        stepped = cut_lineage(
            stepped.select(
                "conv_id",
                "call_id",
                F.when(changes & ~blocked, F.col("new.at")).otherwise(F.col("order_at")).alias("order_at"),
                F.when(changes & ~blocked, F.col("new.hops")).otherwise(F.col("order_hops")).alias("order_hops"),
                (F.coalesce("circular", F.lit(False)) | blocked | (changes & (F.col("new.hops") > F.col("calls")))).alias("circular"),
                changes.alias("changes"),
            )
        )
        moved = stepped.drop("changes")
        if stepped.where("changes").isEmpty():
            return moved


def link(messages: DataFrame, schema: Schema) -> DataFrame:
    """One row a call (and one an orphan result): status, order, errors, canonical JSON."""
    body = lambda *names: F.struct("turn", *names)
    keyed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("call_id").isNotNull()

    def earliest(kind: str, *names: str) -> DataFrame:
        rows = messages.where((F.col("kind") == kind) & keyed)
        return rows.groupBy("conv_id", "call_id").agg(
            F.min(body(*names)).alias("first"), F.count(F.lit(1)).alias("copies")
        )

    calls = earliest("call", "name", "body", "needs").select(
        "conv_id", "call_id", "first.turn", "first.name", "first.body", "first.needs", "copies"
    )
    results = earliest("result", "body").select(
        "conv_id",
        "call_id",
        F.col("first.turn").alias("result_turn"),
        F.col("first.body").alias("result_body"),
        F.col("copies").alias("result_copies"),
    )
    places = ordered(calls)
    joined = (
        calls.withColumn("is_call", F.lit(True))
        .join(results.hint("shuffle_hash"), ["conv_id", "call_id"], "full")
        .join(places, ["conv_id", "call_id"], "left")
    )
    # Grouping would put all null keys together; these rows go past it.
    is_call = F.col("kind") == "call"
    single = messages.where(F.col("kind").isin("call", "result") & ~keyed).select(
        "conv_id",
        "call_id",
        *(F.when(is_call, F.col(name)).alias(name) for name in ("turn", "name", "body", "needs")),
        F.when(is_call, F.lit(1)).alias("copies"),
        F.when(is_call, F.lit(True)).alias("is_call"),
        *(F.when(~is_call, F.col(name)).alias(f"result_{name}") for name in ("turn", "body")),
        F.when(~is_call, F.lit(1)).alias("result_copies"),
    )
    joined = joined.unionByName(single, allowMissingColumns=True)
    joined = joined.withColumn("parsed", F.try_parse_json("body"))
    status = (
        F.when(F.col("is_call").isNull(), "orphan")
        .when(F.coalesce("circular", F.lit(False)), "circular")
        .when(F.col("result_copies").isNull(), "unanswered")
        .when(F.col("result_turn") <= F.col("turn"), "answered_early")
        .otherwise("linked")
    )
    errors = F.when(F.col("is_call"), _errors(schema)).otherwise(F.lit(""))
    text = lambda value: F.coalesce(value, F.lit("null"))
    quoted = lambda name: F.regexp_replace(F.to_json(F.array(name)), r"^\[|\]$", "")
    written = F.concat(
        F.lit('{"arguments":'), text(canonical(F.col("body"))),
        F.lit(',"id":'), quoted("call_id"),
        F.lit(',"name":'), quoted("name"),
        F.lit(',"result":'), text(canonical(F.col("result_body"))),
        F.lit("}"),
    )
    return joined.select(
        "conv_id",
        "call_id",
        "name",
        "turn",
        "result_turn",
        F.coalesce("order_at", "turn", "result_turn").alias("order_at"),
        F.coalesce("order_hops", F.lit(0)).alias("order_hops"),
        status.alias("status"),
        F.coalesce("copies", "result_copies").alias("copies"),
        (F.col("is_call").isNotNull() & (errors == "")).alias("valid"),
        errors.alias("errors"),
        written.alias("record"),
    )


# What the query's calls look like: conversations as search calls and their answers.
SEARCH: Schema = {
    "search": {
        "query": {"type": "string", "required": True, "min_length": 20},
        "limit": {"type": "integer", "required": True, "minimum": 1, "maximum": 50},
        "mode": {"type": "string", "enum": ["plain", "long"]},
    },
    "instruct": {"text": {"type": "string", "required": True, "min_length": 1}},
}


def from_conversations(conversations: DataFrame) -> DataFrame:
    """Turns as tool messages: a user's turn calls ``search``, a system's ``instruct``, an
    assistant's turn is the result of the turn before it; each call needs the one two turns back."""
    at = lambda n: F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - n).cast("string"))  # noqa: E731,E501
    text = text_of()
    call = F.col("role") != "assistant"
    search = F.struct(
        text.alias("query"),
        F.size(F.split(text, " ")).alias("limit"),
        F.when(F.char_length(text) > 300, "long").otherwise("plain").alias("mode"),
    )
    return conversations.select(
        "conv_id",
        "turn",
        F.when(call, "call").otherwise("result").alias("kind"),
        F.when(call, at(0)).otherwise(at(1)).alias("call_id"),
        F.when(F.col("role") == "user", "search").when(call, "instruct").alias("name"),
        F.when(F.col("role") == "user", F.to_json(search))
        .otherwise(F.to_json(F.struct(text.alias("text"))))
        .alias("body"),
        F.array(at(2)).alias("needs"),
    )
