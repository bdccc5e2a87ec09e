"""An extension, not part of the batch contract: query-answer pairs of a live span stream.

Entries and exits of message exchanges are paired by (conversation, request) in a
stream-stream left outer join.  The counterparts, which the batch extraction learns, are given.
State is bounded by the watermark and by `within`, the longest time from query to answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ladders import incoming, outgoing
from ..functions.payload import payload
from ..functions.text import strip
from ..operators.exchange import events
from ..plans.extract import mark, normalise


def pair_stream(spans: DataFrame, counterparts: DataFrame, watermark: str = "10 minutes", within: str = "1 hour") -> DataFrame:
    """Pairs of a streaming span table: turn_id, texts, route, times; an entry without an answer has nulls.

    `counterparts` is a static frame (party).  Replicas are not merged: a stream gives one
    row a pair of spans.
    """
    rows = mark(normalise(spans)).where("candidate and t is not null").withColumns({"pin": payload(F.col("input")), "pout": payload(F.col("output"))})
    rows = rows.withColumns({"i": incoming(F.col("pin")), "o": outgoing(F.col("pout"))}).where("i is not null or o is not null")
    conversation = strip(F.coalesce(F.col("i.env.raw_conversation"), F.col("o.env.raw_conversation"), F.lit("")))
    rows = rows.select("trace", "span", "session", "t", "ord", F.col("i.env").alias("inc"), F.col("i.path").alias("inc_path"), F.col("o.env").alias("out"), F.col("o.path").alias("out_path"), conversation.alias("conversation"))
    entries, exits = events(rows, counterparts)
    at = lambda: F.timestamp_micros(F.expr("t div 1000"))
    e = entries.where("state = 'complete'").select("conversation", "request", F.col("session").alias("session_id"), "input_query", "route_label", F.col("t").alias("entry_time_ns"), at().alias("asked_at")).withWatermark("asked_at", watermark)
    x = exits.where("state = 'complete'").select(F.col("conversation").alias("c"), F.col("request").alias("r"), "agent_response", F.col("t").alias("exit_time_ns"), at().alias("answered_at")).withWatermark("answered_at", watermark)
    near = F.expr(f"conversation = c AND request = r AND answered_at >= asked_at AND answered_at <= asked_at + INTERVAL {within}")
    return e.join(x, near, "leftOuter").select(
        F.concat_ws("|", "conversation", "request").alias("turn_id"), "session_id", "input_query", "agent_response", "route_label", "entry_time_ns", "exit_time_ns", ((F.col("exit_time_ns") - F.col("entry_time_ns")) / F.lit(1e6)).alias("turn_latency_ms")
    )
