"""Turns from correlated message exchanges: (conversation id, request id) joins a query to its answer.

Who the users are is learned: a counterpart sends the first request in a strict
majority of the conversations it takes part in, and isn't the agent itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ladders import asks, has_label, joined, replies
from ..functions.text import filled, semantic
from ..plans.schemas import EXCHANGE, FAMILY
from .common import issue, turn

KEY = ["conversation", "request"]
ENTRY_FIELDS = ("input_query", "route_label", "downstream")
EXIT_FIELDS = ("agent_response", "returned")


def counterparts(rows: DataFrame) -> DataFrame:
    """(party, conversations): the senders that lead a strict majority of their conversations."""
    rows = rows.where(F.col("conversation") != "")
    when = F.struct(F.coalesce("t", F.lit(0)).alias("t"), F.col("trace"), F.col("span"))
    own = rows.where(F.col("inc").isNotNull()).groupBy(F.col("inc.receiver").alias("own")).agg(F.count("*").alias("n"), F.min(F.col("ord")).alias("o"))
    own = own.orderBy(F.desc("n"), "o").limit(1).select("own")
    first_in = rows.where(asks(F.col("inc")) & (F.col("inc.sender") != "")).groupBy("conversation", F.col("inc.sender").alias("party")).agg(F.min(when).alias("i"))
    first_out = rows.where(asks(F.col("out")) & (F.col("out.receiver") != "")).groupBy("conversation", F.col("out.receiver").alias("party")).agg(F.min(when).alias("o"))
    led = first_in.join(F.broadcast(own), F.col("party") == F.col("own"), "left_anti").join(first_out, ["conversation", "party"], "left")
    by = led.groupBy("party").agg(F.count("*").alias("n"), F.count_if(F.col("o").isNull() | (F.col("i") <= F.col("o"))).alias("conversations"))
    return by.where(2 * F.col("conversations") > F.col("n")).select("party", "conversations")


def events(rows: DataFrame, parties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, exits): candidate events with `state` complete, malformed or failure."""
    names = parties.select("party")
    asked = rows.where(asks(F.col("inc"))).join(names, F.col("inc.sender") == F.col("party"), "left_semi")
    label = has_label(F.col("inc.parts"))
    asked = asked.withColumn("label", label).withColumn("said", F.when(label, F.slice("inc.parts", F.lit(2), F.size("inc.parts"))).otherwise(F.col("inc.parts")))
    asked = asked.withColumn("input_query", joined(F.col("said")))
    asked = asked.join(names.withColumnRenamed("party", "to_party"), F.col("out.receiver") == F.col("to_party"), "left")
    parts = F.col("out.parts")
    # comparison forms once a row, not once an element
    asked = asked.withColumns({"query": semantic(F.col("input_query")), "sems": F.transform(parts, lambda x: semantic(x["text"]))})
    echo = (F.size(parts) >= 2) & F.array_contains("sems", F.col("query"))
    routed = F.when(echo, F.get(F.filter(parts, lambda x, i: F.get("sems", i) != F.col("query")), F.lit(0)))
    place = lambda path, i: F.concat(path, F.lit(".content.message["), i.cast("string"), F.lit("].value"))
    receiver = F.when((F.col("out.receiver") != "") & F.col("to_party").isNull(), F.col("out.receiver"))
    first = F.get(F.col("inc.parts"), F.lit(0))
    route = (
        F.when(F.col("label"), F.struct(first["text"].alias("r"), place(F.col("inc_path"), first["idx"]).alias("p")))
        .when(routed.isNotNull(), F.struct(routed["text"].alias("r"), place(F.col("out_path"), routed["idx"]).alias("p")))
        .when(receiver.isNotNull(), F.struct(receiver.alias("r"), F.concat("out_path", F.lit(".receiver")).alias("p")))
        .otherwise(F.struct(F.lit("").alias("r"), F.lit("").alias("p")))
    )
    base = ["conversation", "session", "trace", "span", "t", "ord"]
    whole = lambda text: (F.col("conversation") != "") & (F.col("request") != "") & (F.col(text) != "") & (F.col("trace") != "") & (F.col("span") != "")
    entries = asked.withColumn("route", route).select(
        *base,
        F.col("inc.reply_with").alias("request"),
        "input_query",
        F.col("route.r").alias("route_label"),
        F.coalesce("out.reply_with", F.lit("")).alias("downstream"),
        F.concat("inc_path", F.lit(".content.message[*].value")).alias("path"),
        F.col("route.p").alias("route_path"),
    )
    entries = entries.withColumn("state", F.when(whole("input_query"), "complete").otherwise("malformed"))
    answered = rows.where(replies(F.col("out"))).join(names, F.col("out.receiver") == F.col("party"), "left_semi")
    exits = answered.select(
        *base,
        F.col("out.in_reply_to").alias("request"),
        joined(F.col("out.parts")).alias("agent_response"),
        F.coalesce("inc.in_reply_to", F.lit("")).alias("returned"),
        F.concat("out_path", F.lit(".content.message[*].value")).alias("path"),
        (F.lower("out.performative") == "failure").alias("failed"),
    )
    state = F.when(whole("agent_response"), "complete").when(F.col("failed") & (F.col("agent_response") == ""), "failure").otherwise("malformed")
    return entries, exits.withColumn("state", state).drop("failed")


def merge_replicas(found: DataFrame, fields: tuple[str, ...], latest: bool) -> DataFrame:
    """One row per key: the earliest (latest) event, blanks of its fields filled from its replicas.

    `conflicts` lists the fields with more than one distinct comparison form.
    """
    t = F.coalesce("t", F.lit(0))
    order = F.struct((-t if latest else t).alias("t"), F.col("trace"), F.col("span"))
    paths = [c for c in ("path", "route_path") if c in found.columns]
    full = lambda f: F.col(f"sem_{f}") != ""
    found = found.withColumns({f"sem_{f}": semantic(F.col(f)) for f in fields})
    merged = found.groupBy(*KEY).agg(
        F.min_by(F.struct("session", "trace", "span", "t", *paths), order).alias("pick"),
        F.count("*").alias("replicas"),
        *[F.count_distinct(F.when(full(f), F.col(f"sem_{f}"))).alias(f"n_{f}") for f in fields],
        *[F.min_by(F.col(f), F.when(full(f), F.col("ord"))).alias(f) for f in fields],
    )
    conflicts = F.array_compact(F.array(*[F.when(F.col(f"n_{f}") > 1, F.lit(f)) for f in fields]))
    return merged.select(*KEY, "pick.*", *[F.coalesce(f, F.lit("")).alias(f) for f in fields], "replicas", F.array_join(conflicts, ",").alias("conflicts"))


#: Names under which conflicting fields are reported.
_REPORTED = {"downstream": "downstream_request_id", "returned": "returned_downstream_request_id"}


def pair(entries: DataFrame, exits: DataFrame) -> DataFrame:
    """Keys with their merged entry `e`, exit `x` and `outcome`.

    Outcomes: conflict, exit_without_entry, entry_without_exit, the gate that fails, turn or
    partial (a turn one of whose sides has no session).
    """
    e = merge_replicas(entries.where("state = 'complete'"), ENTRY_FIELDS, False)
    x = merge_replicas(exits.where("state = 'complete'"), EXIT_FIELDS, True)
    e = e.select(*KEY, F.struct(*[c for c in e.columns if c not in KEY]).alias("e"))
    x = x.select(*KEY, F.struct(*[c for c in x.columns if c not in KEY]).alias("x"))
    both = e.join(x, KEY, "full_outer")
    conflict = (F.coalesce(F.col("e.conflicts"), F.lit("")) != "") | (F.coalesce(F.col("x.conflicts"), F.lit("")) != "")
    se, sx = filled(F.col("e.session")), filled(F.col("x.session"))
    outcome = (
        F.when(conflict, "conflict")
        .when(F.col("e").isNull(), "exit_without_entry")
        .when(F.col("x").isNull(), "entry_without_exit")
        .when(F.coalesce(se, sx).isNull(), "session_id_missing")
        .when(se != sx, "session_id_mismatch")
        .when(F.col("e.t").isNull() | F.col("x.t").isNull(), "turn_timestamp_missing")
        .when(F.col("x.t") < F.col("e.t"), "negative_turn_latency")
        .otherwise("turn")
    )
    # a missing session on one side warns whatever gate comes after
    partial = F.col("outcome").isin("turn", "turn_timestamp_missing", "negative_turn_latency") & (se.isNull() | sx.isNull())
    return both.withColumn("outcome", outcome).withColumn("partial", F.coalesce(partial, F.lit(False))).withColumn("turn_id", F.concat_ws("|", *KEY))


def turns(pairs: DataFrame) -> DataFrame:
    same = filled(F.col("e.session")) == filled(F.col("x.session"))
    return pairs.where("outcome = 'turn'").select(
        *turn(
            turn_id=F.col("turn_id"),
            session_id=F.coalesce(filled(F.col("e.session")), F.col("x.session")),
            input_query=F.col("e.input_query"),
            agent_response=F.col("x.agent_response"),
            route_label=F.col("e.route_label"),
            schema_family=F.lit(FAMILY[EXCHANGE]),
            schema_version=F.lit(EXCHANGE),
            entry_trace_id=F.col("e.trace"),
            exit_trace_id=F.col("x.trace"),
            entry_span_id=F.col("e.span"),
            exit_span_id=F.col("x.span"),
            entry_time_ns=F.col("e.t"),
            exit_time_ns=F.col("x.t"),
            same_trace=F.col("e.trace") == F.col("x.trace"),
            same_session=F.coalesce(same, F.lit(False)),
            route_chain_complete=(F.col("e.downstream") != "") & (F.col("e.downstream") == F.col("x.returned")),
            turn_latency_ms=(F.col("x.t") - F.col("e.t")) / F.lit(1e6),
            query_source_path=F.col("e.path"),
            response_source_path=F.col("x.path"),
            route_source_path=F.col("e.route_path"),
        )
    )


def issues(pairs: DataFrame) -> DataFrame:
    """Every conflict, unmatched key, failed gate and warning."""
    id_ = F.col("turn_id")

    def conflicts(side: str, code: str) -> Column:
        names = F.transform(F.split(F.col(f"{side}.conflicts"), ","), lambda f: F.coalesce(*[F.when(f == k, F.lit(v)) for k, v in _REPORTED.items()], f))
        return F.when(F.coalesce(F.col(f"{side}.conflicts"), F.lit("")) != "", issue(code, EXCHANGE, turn_id=id_, details=F.concat(F.lit("conflicting_fields="), F.array_join(names, ","))))

    gates = [F.when(F.col("outcome") == g, issue(g, EXCHANGE, turn_id=id_)) for g in ("exit_without_entry", "session_id_missing", "session_id_mismatch", "turn_timestamp_missing", "negative_turn_latency")]
    alone = F.when(F.col("outcome") == "entry_without_exit", issue("entry_without_exit", EXCHANGE, turn_id=id_, trace_id=F.col("e.trace"), span_id=F.col("e.span")))
    warn = F.when(F.col("partial"), issue("session_id_partial", EXCHANGE, severity="warning", turn_id=id_))
    every = F.array_compact(F.array(conflicts("e", "conflicting_entry_replicas"), conflicts("x", "conflicting_exit_replicas"), *gates, alone, warn))
    return pairs.select(F.explode(every).alias("i")).select("i.*")
