"""Turns of traces that no boundary explains: closing-answer fields and final agent states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ladders import at, last_said
from ..functions.text import semantic, strip
from ..plans.schemas import STATE, TERMINAL
from .common import local_turn

FINAL_STAGES = ("exit", "__end__")


def terminal_turns(spans: DataFrame, labels: DataFrame) -> DataFrame:
    """A started agent's one query with the one closing answer of its trace and session.

    `labels` (label) are routes seen elsewhere: a first word among them is a route, not
    part of the query.
    """
    spans = spans.where("trace <> ''")
    starts = spans.where("kind = 'start_agent' and q.text <> ''")
    place = F.struct(F.col("t").isNull().alias("no"), F.coalesce("t", F.lit(0)).alias("t"), F.col("span"), F.col("ord"))
    one = starts.groupBy("trace").agg(F.count_distinct(semantic(F.col("q.text"))).alias("n"), F.min_by(F.struct("session", "span", "t", "q"), place).alias("s"))
    one = one.where("n = 1").select("trace", "s.*").where("session <> ''")
    word = F.substring_index(F.col("q.text"), " ", 1)
    tail = strip(F.expr("substring(q.text, length(substring_index(q.text, ' ', 1)) + 2)"))
    one = one.withColumns({"word": F.when(F.col("q.text").contains(" ") & (tail != ""), word), "tail": tail})
    one = one.join(labels.select(F.col("label").alias("known")), F.col("word") == F.col("known"), "left")
    one = one.withColumns({"route": F.coalesce("known", F.lit("")), "query": F.when(F.col("known").isNotNull(), F.col("tail")).otherwise(F.col("q.text"))})
    closing = spans.where(F.size("closing") > 0).select("trace", "session", "ord", F.posexplode("closing").alias("i", "c"))
    both = one.join(closing, ["trace", "session"]).withColumn("a", semantic(F.col("c.text")))
    both = both.where((F.col("a") != semantic(F.col("q.text"))) & (F.col("a") != semantic(F.col("query"))))
    keys = ["trace", "session", "span", "t", "query", "route", F.col("q.path").alias("q_path")]
    best = both.groupBy(*keys).agg(F.count_distinct("a").alias("n"), F.min_by("c", F.struct("ord", "i")).alias("c")).where("n = 1 and span <> '' and t is not null")
    c = F.col
    return best.select(
        *local_turn(
            TERMINAL, "terminal:", c("trace"), c("span"), c("span"), session_id=c("session"), input_query=c("query"), agent_response=c("c.text"), route_label=c("route"),
            entry_time_ns=c("t"), exit_time_ns=c("t"), query_source_path=c("q_path"), response_source_path=F.concat(F.lit("output_text."), "c.key"),
            route_source_path=F.when(c("route") != "", c("q_path")).otherwise(F.lit("")),
        )
    )


def final_state(pin: Column, pout: Column) -> Column:
    """struct(source, answer, route, query) of a payload at a final stage, outputs first, or null."""

    def of(p: Column, source: str) -> Column:
        read = F.struct(F.lit(source).alias("source"), at(p["fields"], "message_to_user").alias("answer"), at(p["fields"], "product_agent").alias("route"), last_said(p["messages"], "user", "human").alias("query"))
        return F.when(p["stage"].isin(*FINAL_STAGES), read)

    return F.coalesce(of(pout, "output_text"), of(pin, "input_text"))


def state_turns(spans: DataFrame) -> DataFrame:
    """The last final state of each trace; turns without a session are among them."""
    spans = spans.where("trace <> '' and state_likely and state is not null").select("trace", "span", "session", "ord", F.coalesce("t", F.lit(0)).alias("t"), "state.*")
    spans = spans.where((F.coalesce("answer", F.lit("")) != "") & (F.coalesce("query", F.lit("")) != "") & (semantic(F.col("answer")) != semantic(F.col("query"))))
    last = spans.groupBy("trace").agg(F.min_by(F.struct("span", "session", "source", "t", "answer", "route", "query"), F.struct(-F.col("t"), F.col("ord"))).alias("s")).select("trace", "s.*")
    c = F.col
    path = lambda what: F.concat("source", F.lit("." + what))
    return last.select(
        *local_turn(
            STATE, "state:", c("trace"), c("span"), c("span"), session_id=c("session"), input_query=c("query"), agent_response=c("answer"), route_label=F.coalesce("route", F.lit("")),
            entry_time_ns=c("t"), exit_time_ns=c("t"), query_source_path=path("messages[last user].content"), response_source_path=path("message_to_user"),
            route_source_path=F.when(c("route").isNotNull(), path("product_agent")).otherwise(F.lit("")),
        )
    )
