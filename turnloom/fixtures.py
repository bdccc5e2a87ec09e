"""Spans made from a table of conversations, with known turns: input for queries, tests and benchmarks.

Conversation c belongs to family c % 6 (exchange, HTTP boundary, started agent, parent
boundary, closing answer, agent state); each user turn k becomes the spans that family
records.  A user turn without an answer leaves the spans of a broken turn.  One
span a conversation belongs to another agent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions.tables import cut

START = 1_700_000_000_000_000_000
AGENT, OTHER = "A1", "A2"
LABELS = ("alpha", "beta", "gamma")


def question_answer(conversations: DataFrame) -> DataFrame:
    """(c, k, text, ans, t, label): user turns with the assistant's next turn, or null."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = conversations.select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("nr"), F.lead("text").over(w).alias("nt"))
    rows = rows.where("role = 'user'").select(F.col("conv_id").alias("c"), F.col("turn").alias("k"), "text", F.when(F.col("nr") == "assistant", F.col("nt")).alias("ans"))
    label = F.element_at(F.array(*map(F.lit, LABELS)), (F.col("k") % 3 + 1).cast("int"))
    return rows.withColumns({"t": F.lit(START) + F.col("c") * 10**13 + F.col("k") * 10**9, "label": label})


def _json(**fields) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _parts(*texts: Column) -> Column:
    return F.struct(F.array(*[F.struct(F.lit("text").alias("type"), t.alias("value")) for t in texts]).alias("message"))


def _envelope(**fields) -> Column:
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def spans_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = question_answer(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    c, k, text, ans, label, t = (F.col(x) for x in ("c", "k", "text", "ans", "label", "t"))
    key = F.concat_ws("-", c.cast("string"), k.cast("string"))
    trace, none = F.concat(F.lit("t-"), key), F.lit(None).cast("string")

    def span(where: Column, name: str, kind: str, title: str, inp: Column, out: Column, at: Column = t, tr: Column = trace, parent: Column = none) -> Column:
        row = F.struct(
            tr.alias("trace_id"), F.concat(F.lit(f"{name}-"), key).alias("span_id"), F.lit(AGENT).alias("agent_id"), F.concat(F.lit("s"), c.cast("string")).alias("session_id"),
            F.lit(kind).alias("aef_kind"), F.lit(title).alias("span_name"), inp.cast("string").alias("input_text"), out.cast("string").alias("output_text"), at.cast("bigint").alias("start_time_ns"),
            (at + 1000).cast("bigint").alias("end_time_ns"), parent.cast("string").alias("parent_span_id"),
        )
        return F.when(where, row)

    lit = F.lit
    family = lambda f: c % 6 == f
    conversation, user, agent, worker = F.concat(lit("c"), c.cast("string")), lit("user"), lit("agent"), lit("worker")
    reply, down = F.concat(lit("r"), k.cast("string")), F.concat(lit("d"), k.cast("string"))
    ask = _envelope(performative=lit("request"), conversation_id=conversation, reply_with=reply, sender=user, receiver=agent, content=_parts(text))
    hand = _envelope(performative=lit("request"), conversation_id=conversation, reply_with=down, sender=agent, receiver=worker, content=_parts(label, text))
    back = _envelope(performative=lit("inform"), conversation_id=conversation, in_reply_to=down, sender=worker, receiver=agent, content=_parts(ans))
    done = _envelope(performative=lit("inform"), conversation_id=conversation, in_reply_to=reply, sender=agent, receiver=user, content=_parts(ans, none))
    far = F.when(k % 4 == 0, F.concat(lit("x-"), key)).otherwise(trace)
    bare = lambda s, r, p: _envelope(message_id=F.concat(lit("m"), key), sender=s, receiver=r, content=p)
    state = lambda stage: _json(stage=lit(stage), product_agent=lit("gamma"), message_to_user=F.coalesce(ans, lit("...")), messages=F.array(F.struct(user.alias("role"), text.alias("content"))))
    blank = lit("{}")
    parent_out = F.when(ans.isNotNull(), _json(outgoing=bare(agent, user, _parts(ans)))).otherwise(_json(outgoing=bare(agent, user, F.struct(F.array().cast("array<struct<type:string,value:string>>").alias("message")))))
    parts = [
        span(family(0), "in", "input_request", "handle", _json(message=ask), _json(outgoing=hand)),
        span(family(0) & ans.isNotNull(), "out", "other", "deliver", _json(incoming=back), _json(outgoing=done), at=t + 500_000_000, tr=far),
        span(family(1), "http", "other", "POST /v1/chat", _json(body=F.struct(text.alias("query"))), F.when(ans.isNotNull(), _json(response=F.struct(F.struct(ans.alias("answer")).alias("body")))).otherwise(_json(status=lit("ok")))),
        span(family(2), "agent", "start_agent", "run", _json(goal=text), F.when(ans.isNotNull(), _json(summary=ans)).otherwise(blank)),
        span(family(3), "edge", "input_request", "handle", _json(message=bare(user, agent, _parts(label, text))), parent_out),
        span(family(3), "agent", "start_agent", "run", _json(query=F.concat_ws(" ", label, text)), blank, at=t + 1, parent=F.concat(lit("edge-"), key)),
        span(family(4), "agent", "start_agent", "run", _json(query=F.concat_ws(" ", lit("alpha"), text)), blank),
        span(family(4) & ans.isNotNull(), "model", "llm", "answer", none, _json(final_response=F.array(ans)), at=t + 1, parent=F.concat(lit("agent-"), key)),
        span(family(5), "plan", "chain", "step", none, state("plan"), at=t - 1),
        span(family(5) & ans.isNotNull(), "state", "chain", "step", none, state("exit")),
    ]
    # one scan of the turns: each becomes the spans of its family
    spans = rows.select(F.explode(F.array_compact(F.array(*parts))).alias("span")).select("span.*")
    return spans.unionByName(_noise(rows))


def _noise(rows: DataFrame) -> DataFrame:
    """One span a conversation of another agent."""
    none, name, t = F.lit(None).cast("string"), F.concat(F.lit("noise-"), F.col("c").cast("string")), F.col("t").cast("bigint")
    return rows.groupBy("c").agg(F.min("t").alias("t")).select(
        name.alias("trace_id"), name.alias("span_id"), F.lit(OTHER).alias("agent_id"), F.concat(F.lit("s"), F.col("c").cast("string")).alias("session_id"), F.lit("llm").alias("aef_kind"),
        F.lit("noise").alias("span_name"), none.alias("input_text"), none.alias("output_text"), t.alias("start_time_ns"), t.alias("end_time_ns"), none.alias("parent_span_id"),
    )


def with_injected_faults(spans: DataFrame) -> DataFrame:
    """The exchange family with replicas and gaps: a respaced entry replica (c % 5 = 0), a second, different
    answer (c % 7 = 0), entries removed (c % 11 = 0)."""
    conv = F.substring("session_id", 2, 20).cast("bigint")
    entry, leave = F.col("span_id").startswith("in-"), F.col("span_id").startswith("out-")
    own = spans.where((conv % 6 == 0) & (F.col("agent_id") == AGENT))
    kept = own.where(~(entry & (conv % 11 == 0)))
    # spaces within the texts alone: the JSON itself has none
    respaced = kept.where(entry & (conv % 5 == 0)).withColumns({"input_text": F.replace("input_text", F.lit(" "), F.lit("  ")), "span_id": F.concat(F.lit("twin-"), "span_id"), "start_time_ns": F.col("start_time_ns") + 10})
    changed = kept.where(leave & (conv % 7 == 0)).withColumns({"output_text": F.regexp_replace("output_text", '"value":"', '"value":"changed '), "span_id": F.concat(F.lit("twin-"), "span_id")})
    return kept.unionByName(respaced).unionByName(changed)


def with_failing_gates(spans: DataFrame) -> DataFrame:
    """Spans in which every gate fails somewhere.

    Exchange conversations by (c div 6) % 11: 0 as they are; 1 no session; 2 another session on the
    exit; 3 none on the exit; 4 no time on the entry; 5 an exit before its entry; 6 a failure without text;
    7 an entry without a span id; 8 a route by the receiver alone; 9 an answer without text; 10 no exit, and the
    trace's last state says the same.  Parent conversations by (c div 6) % 3: 1 a second boundary in the trace.
    """
    own = cut(spans.where(F.col("agent_id") == AGENT), "own")
    c, k = F.substring("session_id", 2, 20).cast("bigint"), F.element_at(F.split("span_id", "-"), -1)
    own = own.withColumns({"c": c, "k": k, "v": F.when(c % 6 == 0, F.floor(c / 6) % 11), "entry": F.col("span_id").startswith("in-"), "exit": F.col("span_id").startswith("out-")})
    at = lambda v, side=None: (F.col("v") == v) & (F.col(side) if side else F.lit(True))
    conversation, lit = F.concat(F.lit("c"), F.col("c").cast("string")), F.lit

    def mute(act: str) -> Column:
        return _json(outgoing=_envelope(performative=lit(act), conversation_id=conversation, in_reply_to=F.concat(lit("r"), "k"), sender=lit("agent"), receiver=lit("user"), content=F.struct(F.array().cast("array<string>").alias("message"))))

    hand = _json(outgoing=_envelope(performative=lit("request"), conversation_id=conversation, reply_with=F.concat(lit("d"), "k"), sender=lit("agent"), receiver=lit("worker"), content=_parts(lit("go on"))))
    session = F.when(at(1) | at(3, "exit"), "").when(at(2, "exit"), F.concat(lit("z"), F.col("c").cast("string"))).otherwise(F.col("session_id"))
    start = F.when(at(4, "entry"), None).when(at(5, "exit"), F.col("start_time_ns") - 500_000_001).otherwise(F.col("start_time_ns"))
    output = F.when(at(6, "exit"), mute("failure")).when(at(9, "exit"), mute("inform")).when(at(8, "entry"), hand).otherwise(F.col("output_text"))
    changed = own.where(~at(10, "exit") | F.col("v").isNull()).withColumns({"session_id": session, "start_time_ns": start, "output_text": output, "span_id": F.when(at(7, "entry"), " ").otherwise(F.col("span_id"))})
    # the state that publishes what an exchange without an exit asked
    said = F.get_json_object("output_text", "$.outgoing.content.message[0].value")
    asked = own.where(at(10, "entry")).select("c", "k", F.get_json_object("input_text", "$.message.content.message[0].value").alias("text"))
    state = own.where(at(10, "exit")).withColumn("ans", said).join(asked, ["c", "k"])
    key = F.concat_ws("-", F.col("c").cast("string"), "k")
    state = state.withColumns(
        {
            "trace_id": F.concat(lit("t-"), key), "span_id": F.concat(lit("state-"), key), "aef_kind": lit("chain"), "span_name": lit("step"), "input_text": lit(None).cast("string"),
            "output_text": _json(stage=lit("__end__"), product_agent=lit("gamma"), message_to_user=F.col("ans"), messages=F.array(F.struct(lit("user").alias("role"), F.col("text").alias("content")))),
        }
    )
    second = own.where((F.col("c") % 6 == 3) & (F.floor(F.col("c") / 6) % 3 == 1))
    twin = lambda column: F.regexp_replace(F.regexp_replace(column, '("value":"(?!(?:alpha|beta|gamma)"))', "$1twin "), '("query":"[a-z]+ )', "$1twin ")
    second = second.withColumns({"span_id": F.concat(lit("twin-"), "span_id"), "parent_span_id": F.concat(lit("twin-"), "parent_span_id"), "input_text": twin("input_text"), "output_text": twin("output_text")})
    return changed.select(*spans.columns).unionByName(state.select(*spans.columns)).unionByName(second.select(*spans.columns))


def climbing_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By user turn a started agent without an answer, under one to three chain spans and, above these, an HTTP boundary
    that has the same question and, where there is one, the answer."""
    rows = question_answer(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    key, lit, text = F.concat_ws("-", F.col("c").cast("string"), F.col("k").cast("string")), F.lit, F.col("text")
    depth = F.col("k") % 3 + 1

    def span(name: str, kind: str, title: str, inp: Column, out: Column, parent: Column, later: int) -> Column:
        return F.struct(
            F.concat(lit("t-"), key).alias("trace_id"), F.concat(lit(f"{name}-"), key).alias("span_id"), lit(AGENT).alias("agent_id"), F.concat(lit("s"), F.col("c").cast("string")).alias("session_id"),
            lit(kind).alias("aef_kind"), lit(title).alias("span_name"), inp.cast("string").alias("input_text"), out.cast("string").alias("output_text"), (F.col("t") + later).cast("bigint").alias("start_time_ns"),
            parent.cast("string").alias("parent_span_id"),
        )

    up = lambda name: F.concat(lit(f"{name}-"), key)
    none = lit(None)
    answered = F.when(F.col("ans").isNotNull(), _json(response=F.struct(F.struct(F.col("ans").alias("answer")).alias("body")))).otherwise(_json(status=lit("ok")))
    spans = [
        span("edge", "other", "POST /v1/chat", _json(body=F.struct(text.alias("query"))), answered, none, 0),
        span("mid1", "chain", "step", none, none, up("edge"), 1),
        F.when(depth >= 2, span("mid2", "chain", "step", none, none, up("mid1"), 2)),
        F.when(depth >= 3, span("mid3", "chain", "step", none, none, up("mid2"), 3)),
        span("leaf", "start_agent", "run", _json(query=text), lit("{}"), F.concat(lit("mid"), depth.cast("string"), lit("-"), key), 4),
    ]
    return rows.select(F.explode(F.array_compact(F.array(*spans))).alias("span")).select("span.*")
