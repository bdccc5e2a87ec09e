"""Turns whose query and answer stand on one boundary span, or on its caller's boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ladders import at, choose, has_label, joined
from ..functions.text import semantic
from ..plans.schemas import BOUNDARY, FAMILY, PARENT, START_AGENT
from .common import issue, local_turn


def boundary_spans(rest: DataFrame, exchange_traces: DataFrame) -> DataFrame:
    """Of the spans that carry no exchange: outer ones, and agents started in traces without any outer span."""
    edges = rest.where("outer").select("trace").union(exchange_traces.select("trace")).distinct()
    inner = rest.where("not outer and kind = 'start_agent'").join(edges, "trace", "left_anti")
    return rest.where("outer").unionByName(inner)


def started(p: Column) -> Column:
    """(text, path) of a started agent's own fields in an input payload."""
    fields = F.when(p["shape"] == "object", p["fields"])
    return choose([(at(fields, k), f"input_text.{k}") for k in ("goal", "task", "text")])


def ended(p: Column) -> Column:
    """(text, path) of a started agent's own fields in an output payload."""
    fields = F.when(p["shape"] == "object", p["fields"])
    return choose([(at(fields, k), f"output_text.{k}") for k in ("summary", "error")])


def read_pairs(spans: DataFrame) -> DataFrame:
    """spans with q and r (text, path), version and `outcome`: turn, boundary_pair_incomplete or session_id_missing."""
    agent = F.col("kind") == "start_agent"
    spans = spans.withColumns({"q0": F.col("q"), "r0": F.col("r"), "q1": F.when(agent, F.col("started")), "r1": F.when(agent, F.col("ended"))})
    use_q = (F.coalesce("q0.text", F.lit("")) == "") & (F.col("q1.text") != "")
    use_r = (F.coalesce("r0.text", F.lit("")) == "") & (F.col("r1.text") != "")
    by_text = (F.col("kind") == "start_agent") & (F.col("q0.path") == "input_text.text")
    version = F.when(by_text | use_q | use_r, START_AGENT).otherwise(BOUNDARY)
    spans = spans.withColumns({"version": version, "q": F.when(use_q, F.col("q1")).otherwise(F.col("q0")), "r": F.when(use_r, F.col("r1")).otherwise(F.col("r0"))})
    good = (F.col("q.text") != "") & (F.col("r.text") != "") & (semantic(F.col("q.text")) != semantic(F.col("r.text"))) & (F.col("trace") != "") & (F.col("span") != "") & F.col("t").isNotNull()
    outcome = F.when(~F.coalesce(good, F.lit(False)), "boundary_pair_incomplete").when(F.col("session") == "", "session_id_missing").otherwise("turn")
    return spans.drop("q0", "r0", "q1", "r1").withColumn("outcome", outcome)


def turns(pairs: DataFrame) -> DataFrame:
    c = F.col
    return pairs.where("outcome = 'turn'").select(
        *local_turn(
            c("version"), "aef:", c("trace"), c("span"), c("span"), family=F.lit(FAMILY[BOUNDARY]), session_id=c("session"), input_query=c("q.text"), agent_response=c("r.text"),
            route_label=F.lit(""), entry_time_ns=c("t"), exit_time_ns=c("t"), query_source_path=c("q.path"), response_source_path=c("r.path"), route_source_path=F.lit(""),
        )
    )


def issues(pairs: DataFrame) -> DataFrame:
    incomplete = issue("boundary_pair_incomplete", BOUNDARY, trace_id=F.col("trace"), span_id=F.col("span"))
    homeless = issue("session_id_missing", BOUNDARY, turn_id=F.concat(F.lit("aef:"), "trace", F.lit(":"), "span"), trace_id=F.col("trace"), span_id=F.col("span"))
    return pairs.where("outcome <> 'turn'").select(F.when(F.col("outcome") == "boundary_pair_incomplete", incomplete).otherwise(homeless).alias("i")).select("i.*")


def parent_pairs(spans: DataFrame) -> DataFrame:
    """By trace with an agent started under an outer span: its first valid turn `c` and the number of variants.

    The agent's own query must be the whole text of its caller's boundary message; of spans
    that share an id the last in order counts.
    """
    spans = spans.where("trace <> ''")
    started = spans.where("kind = 'start_agent'").select("trace", "span", "session", "ord", "parent", F.coalesce("q.text", F.lit("")).alias("carried"))
    ids = started.select("trace", F.col("parent").alias("span")).distinct()
    callers = spans.where("span <> ''").join(ids, ["trace", "span"], "left_semi")
    callers = callers.groupBy("trace", F.col("span").alias("parent")).agg(F.max_by(F.struct("outer", "session", "t", "t_end", "i", "o"), "ord").alias("up")).where("up.outer")
    both = started.join(callers, ["trace", "parent"])
    both = both.withColumns({"inc": F.col("up.i"), "out": F.col("up.o")})
    parts = F.col("inc.env.parts")
    label = has_label(parts)
    both = both.withColumns(
        {
            "whole": joined(parts),
            "label": F.when(label, F.get(parts, F.lit(0))),
            "query": joined(F.when(label, F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts)),
            "answer": joined(F.col("out.env.parts")),
        }
    )
    both = both.withColumns({"sem_query": semantic(F.col("query")), "sem_answer": semantic(F.col("answer"))})
    good = (
        (F.col("carried") != "") & (semantic(F.col("carried")) == semantic(F.col("whole"))) & (F.col("query") != "") & (F.col("answer") != "")
        & (F.col("sem_query") != F.col("sem_answer")) & (F.col("session") != "") & (F.col("session") == F.col("up.session")) & F.col("up.t").isNotNull()
    )
    made = F.when(
        F.coalesce(good, F.lit(False)),
        F.struct("span", "parent", "session", "query", "answer", "label", F.col("up.t").alias("t"), F.col("up.t_end").alias("t_end"), F.col("inc.path").alias("inc_path"), F.col("out.path").alias("out_path")),
    )
    both = both.select("trace", "ord", made.alias("c"), "sem_query", "sem_answer")
    variant = F.when(F.col("c").isNotNull(), F.struct("sem_query", "sem_answer"))
    return both.groupBy("trace").agg(F.count_distinct(variant).alias("variants"), F.min_by("c", F.when(F.col("c").isNotNull(), F.col("ord"))).alias("c"))


def parent_turns(pairs: DataFrame) -> DataFrame:
    c = F.col
    path = lambda p: F.concat(c(p), F.lit(".content.message[*].value"))
    label_path = F.when(c("c.label").isNotNull(), F.concat("c.inc_path", F.lit(".content.message["), c("c.label.idx").cast("string"), F.lit("].value"))).otherwise(F.lit(""))
    ended = F.coalesce(F.nullif("c.t_end", F.lit(0)), "c.t")
    return pairs.where("variants = 1").select(
        *local_turn(
            PARENT, "parent:", c("trace"), c("c.parent"), c("c.span"), session_id=c("c.session"), input_query=c("c.query"), agent_response=c("c.answer"),
            route_label=F.coalesce("c.label.text", F.lit("")), entry_time_ns=c("c.t"), exit_time_ns=ended, query_source_path=path("c.inc_path"), response_source_path=path("c.out_path"), route_source_path=label_path,
        )
    )


def parent_issues(pairs: DataFrame) -> DataFrame:
    details = F.concat(F.lit("candidate_variants="), F.col("variants").cast("string"))
    return pairs.where("variants <> 1").select(issue("parent_boundary_incomplete", PARENT, trace_id=F.col("trace"), details=details).alias("i")).select("i.*")

