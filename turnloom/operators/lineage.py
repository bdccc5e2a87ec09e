"""Lineage: one provable question and answer a trace, found by search, and datasets made of them.

Separate from the versioned strategies: payloads of any shape are searched, and the
caller chain of a span is walked up to the system's edge.  Grouping is by (session,
trace), null groups included.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import TERMINAL_KEYS
from ..functions.search import closing_values, messages, pair
from ..functions.tables import cut
from ..functions.text import casefold, ident, integer, strip

RESOLUTION_CONTRACT = "lineage-resolution.v1"
AGENT_KINDS = ("start_agent", "input_request")
#: Answers that only acknowledge, as the lineage path has them.
ACKS = ("success", "ok", "done", "completed", "true", "false", "accepted")
EDGE = r"^(get|post|put|patch|delete)\s+\S+|(^|[./])invoke$"
GROUP = ["g_session", "g_trace"]
#: So many rounds of hits are written as one table, so that the plan stays small however long a chain is.
ROUNDS = 50


def same(c: Column) -> Column:
    return casefold(strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\x1c-\x1f]+", " ")))


def distinct_pair(q: Column, a: Column) -> Column:
    return F.coalesce((q != "") & (a != "") & (same(q) != same(a)) & ~same(a).isin(*ACKS), F.lit(False))


def read_spans(spans: DataFrame) -> DataFrame:
    """Spans with group keys, order, edge test and, for agents and edges, their pair p."""
    kept = F.struct(*[F.col(f"`{c}`") for c in spans.columns]).alias("row")
    get = lambda c, t: F.col(c).cast(t) if c in spans.columns else F.lit(None).cast(t)
    text = lambda c: get(c, "string")
    key = lambda c: F.coalesce(F.concat(F.lit("v"), text(c)), F.lit("n"))
    kind = F.coalesce(text("aef_kind"), F.lit("None"))
    out = spans.select(
        kept, key("session_id").alias("g_session") if "session_id" in spans.columns else F.lit("").alias("g_session"), key("trace_id").alias("g_trace"), ident(text("trace_id")).alias("trace"),
        ident(text("span_id")).alias("span"), ident(text("parent_span_id")).alias("parent"), kind.alias("kind"), F.coalesce(text("span_name"), F.lit("")).alias("name"),
        text("input_text").alias("input"), text("output_text").alias("output"), F.coalesce(integer(text("start_time_ns")), F.lit(0)).alias("t"),
    )
    order = F.struct("t", "span", F.xxhash64("input", "output", "kind", "name").alias("h"))
    edge = F.lower(strip(F.col("kind"))).isin("input_request", "other") & F.lower(strip(F.col("name"))).rlike(EDGE)
    out = out.withColumns({"ord": order, "edge": edge, "agent": F.col("kind").isin(*AGENT_KINDS), "uid": F.monotonically_increasing_id()})
    return cut(out, "spans")


def nearest_edges(asked: DataFrame, spans: DataFrame) -> DataFrame:
    """For each asked span (uid, q) the nearest caller at the edge with the same question and a distinct answer.

    Every span's nearest such edge, whatever its question, is found by doubling the pointers to callers: rounds grow with
    the logarithm of a chain's length.  What is then climbed, level by level, are edges alone; one that was
    visited is not climbed again, so that cycles end.
    """
    by_id = spans.where("span <> ''").groupBy(*GROUP, F.col("span").alias("up")).agg(F.min_by(F.struct("uid", "parent", "edge", "p", "name", "ord"), "ord").alias("c"))
    valid = F.coalesce(F.col("c.edge") & distinct_pair(F.col("c.p.q"), F.col("c.p.a")), F.lit(False))
    by_id = cut(by_id.withColumn("valid", valid), "callers")
    above = _edges_above(by_id)
    edges = by_id.where("valid").select(*GROUP, F.col("up").alias("at"), "c")
    front = asked.select("uid", "q", *GROUP, F.col("parent").alias("up"), F.array().cast("array<string>").alias("seen"))
    found: list[DataFrame] = []
    while True:
        step = front.join(above, [*GROUP, "up"]).where(~F.array_contains("seen", F.col("at"))).join(edges, [*GROUP, "at"])
        step = cut(step.withColumn("hit", same(F.col("c.p.q")) == same(F.col("q"))), "climb")
        found.append(step.where("hit").select("uid", *GROUP, "q", F.col("c.p.a").alias("a"), F.col("c.name").alias("source"), F.col("c.ord").alias("source_ord")))
        if len(found) >= ROUNDS:
            found = [cut(reduce(DataFrame.unionByName, found), "hits")]
        rest = step.where("not hit")
        if rest.isEmpty():
            break
        front = rest.select("uid", "q", *GROUP, F.col("c.parent").alias("up"), F.array_append("seen", F.col("at")).alias("seen"))
    return reduce(DataFrame.unionByName, found)


def _edges_above(callers: DataFrame) -> DataFrame:
    """(group, up, at): the nearest valid caller at or above each span, by its id; spans without one are left out.

    A pointer that has met no valid caller is replaced by that of the span it points at.  In a cycle
    it never does: the rounds end at the logarithm of the largest group.
    """
    pointers = callers.select(*GROUP, "up", "valid", F.when(F.col("valid"), F.col("up")).otherwise(F.nullif("c.parent", F.lit(""))).alias("at"))
    largest = callers.groupBy(*GROUP).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(largest.bit_length() + 1):
        there = pointers.select(*GROUP, F.col("up").alias("at"), F.col("valid").alias("found"), F.col("at").alias("further"))
        pointers = pointers.join(there, [*GROUP, "at"], "left").select(*GROUP, "up", "valid", F.when(F.col("valid") | F.col("found"), F.col("at")).otherwise(F.col("further")).alias("at"), F.coalesce("found", F.lit(True)).alias("done"))
        pointers = cut(pointers, "pointers")
        if pointers.where("not done and at is not null").isEmpty():
            break
    ends = callers.where("valid").select(*GROUP, F.col("up").alias("at"))
    return pointers.where("at is not null").select(*GROUP, "up", "at").join(ends, [*GROUP, "at"], "left_semi")


def _unanimous(rows: DataFrame, order: str) -> DataFrame:
    """By group: its earliest candidate where all have one pair; n variants."""
    variant = F.struct(same(F.col("q")).alias("q"), same(F.col("a")).alias("a"))
    return rows.groupBy(*GROUP).agg(F.count_distinct(variant).alias("n"), F.min_by(F.struct("uid", "q", "a", "source"), order).alias("r"))


@dataclass(frozen=True)
class Resolution:
    spans: DataFrame
    groups: DataFrame
    agent_id: str

    def ordered(self) -> DataFrame:
        """The spans by session, start time, trace and span id: a presentation order, costs a range exchange."""
        get = lambda c: F.col(c) if c in self.spans.columns else F.lit(None)
        text = lambda c: F.coalesce(get(c).cast("string"), F.lit(""))
        return self.spans.orderBy(text("session_id"), F.coalesce(integer(get("start_time_ns").cast("string")), F.lit(0)), text("trace_id"), text("span_id"))

    def report(self) -> dict[str, Any]:
        methods = {r["method"]: r["count"] for r in self.groups.groupBy("method").count().orderBy("method").collect()}
        total, missed = sum(methods.values()), methods.get("unresolved", 0)
        chosen = total - missed - methods.get("non_eligible", 0)
        ids = [r["trace"] for r in self.groups.where("method = 'unresolved'").orderBy("trace").limit(20).collect()]
        return {
            "contract_version": RESOLUTION_CONTRACT,
            "agent_id": self.agent_id,
            "input_trace_groups": total,
            "overall_selected_rate": chosen / total if total else 0.0,
            "eligible_trace_groups": chosen + missed,
            "selected_groups": chosen,
            "coverage": chosen / (chosen + missed) if chosen + missed else 0.0,
            "methods": methods,
            "unresolved_trace_ids": ids,
            "unresolved_ids_truncated": missed > len(ids),
            "order_policy": "session_id,start_time_ns,trace_id,span_id",
        }


def resolve(spans: DataFrame, agent_id: str = "") -> Resolution:
    """Spans of resolved traces, each with its one carrier rewritten as a started agent."""
    if spans.isEmpty():
        raise ValueError("the span table is empty")
    if "agent_id" not in spans.columns:
        raise ValueError("the span table has no agent_id")
    target = agent_id.strip()
    agents = strip(F.coalesce(F.col("agent_id").cast("string"), F.lit("")))
    if not target:
        seen = [r[0] for r in spans.select(agents.alias("a")).where("a <> '' and lower(a) <> 'nan'").distinct().limit(2).collect()]
        if len(seen) != 1:
            raise ValueError(f"without an agent id the table must hold exactly one agent; found {sorted(seen)}")
        target = seen[0]
    spans = spans.where(F.upper(agents) == target.upper())
    if spans.isEmpty():
        raise ValueError(f"no spans of agent {target}")
    return Resolution(*_resolve(spans), target.upper())


def _resolve(original: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = read_spans(original)
    searched = rows.where("agent or edge").withColumn("p", pair(F.col("input"), F.col("output"))).select("uid", "p")
    spans = cut(rows.join(searched, "uid", "left"), "searched")
    every = spans.groupBy(*GROUP).agg(F.bool_or(F.col("agent") | F.col("edge")).alias("eligible"), F.min_by("trace", "ord").alias("trace"))
    primary = spans.where("agent and p.q <> ''").select("uid", *GROUP, "parent", "kind", "name", "ord", F.col("p.q").alias("q"), F.col("p.a").alias("a"))
    place = F.struct((F.col("kind") != "start_agent").alias("k"), "ord")
    first = primary.groupBy(*GROUP).agg(F.count_distinct(same(F.col("q"))).alias("n_q"), F.min_by(F.struct("uid", "q"), place).alias("f"))
    direct = _unanimous(primary.where(distinct_pair(F.col("q"), F.col("a"))).withColumn("source", F.col("name")), "ord")
    asked = primary.join(direct.select(*GROUP), GROUP, "left_anti")
    callers = _unanimous(nearest_edges(asked, spans), "source_ord")
    closing = spans.where(F.col("output").rlike("|".join(TERMINAL_KEYS))).withColumn("v", closing_values(F.col("output")))
    closing = closing.select(*GROUP, "name", "ord", F.posexplode("v").alias("i", "v")).join(first.where("n_q = 1"), GROUP)
    closing = closing.withColumn("s", same(F.col("v.text"))).where((F.col("s") != "") & (F.col("s") != same(F.col("f.q"))))
    source = F.array_join(F.slice(F.array_sort(F.collect_set(F.concat("name", F.lit(":"), "v.path"))), 1, 3), ", ")
    closing = closing.groupBy(*GROUP, "f").agg(F.count_distinct("s").alias("n"), F.min_by("v.text", F.struct("ord", "i")).alias("a"), source.alias("source"))
    closing = closing.select(*GROUP, "n", F.struct(F.col("f.uid").alias("uid"), F.col("f.q").alias("q"), "a", "source").alias("r"))
    edges = spans.where("edge").select("uid", *GROUP, "ord", F.col("name").alias("source"), F.col("p.q").alias("q"), F.col("p.a").alias("a"))
    edges = _unanimous(edges.where(distinct_pair(F.col("q"), F.col("a"))), "ord")
    one = lambda df, name: df.select(*GROUP, F.struct("n", "r").alias(name))
    groups = every
    for df, name in ((direct, "d"), (callers, "u"), (closing, "c"), (edges, "e")):
        groups = groups.join(one(df, name), GROUP, "left")
    groups = groups.join(first.select(*GROUP, F.lit(True).alias("primary")), GROUP, "left")
    ok = lambda name: F.coalesce(F.col(f"{name}.n") == 1, F.lit(False))
    has_direct, has_primary = F.col("d").isNotNull(), F.coalesce(F.col("primary"), F.lit(False))
    method = (
        F.when(~F.col("eligible"), "non_eligible").when(ok("d"), "direct_agent_span").when(has_direct, "unresolved").when(has_primary & ok("u"), "parent_boundary")
        .when(has_primary & ok("c"), "semantic_terminal").when(~has_primary & ok("e"), "external_boundary").otherwise("unresolved")
    )
    groups = groups.withColumn("method", method)
    won = F.when(F.col("method") == "direct_agent_span", F.col("d.r"))
    for name, how in (("u", "parent_boundary"), ("c", "semantic_terminal"), ("e", "external_boundary")):
        won = won.when(F.col("method") == how, F.col(f"{name}.r"))
    groups = cut(groups.select(*GROUP, "trace", "method", won.alias("won")), "groups")
    out = spans.join(groups.where("won is not null").select(*GROUP, "method", "won"), GROUP)
    chosen = F.col("uid") == F.col("won.uid")
    wrap = lambda k, v: F.regexp_replace(F.to_json(F.struct(v.alias(k))), rf'^\{{"{k}":', rf'{{"{k}": ')
    new = {
        "input_text": F.when(chosen, wrap("text", F.col("won.q"))).otherwise(F.col("row.input_text")),
        "output_text": F.when(chosen, wrap("answer", F.col("won.a"))).otherwise(F.col("row.output_text")),
        "aef_kind": F.when(chosen, "start_agent").when(F.col("agent"), "other").otherwise(F.col("kind")),
    }
    columns = [new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in original.columns]
    extra = [F.when(chosen, F.col("method")).otherwise("").alias("_extraction_method"), F.when(chosen, F.col("won.source")).otherwise("").alias("_answer_source_span")]
    return out.select(*columns, *extra), groups


# --- datasets by configuration -----------------------------------------------

BASE_FIELDS = ("session_id", "query_id", "input_query", "output_answer")
TYPES = ("string", "integer", "float")


def check_config(config: dict, spans: DataFrame) -> None:
    """ValueError where a dataset's configuration is incomplete or names a module no span has."""

    def fields(items: list, where: str, full: bool) -> set[str]:
        for item in items:
            if not item.get("field_name"):
                raise ValueError(f"{where}: field_name is missing")
            if full and not item.get("description"):
                raise ValueError(f"{where}: {item['field_name']} needs a description")
            if full and item.get("data_type") not in TYPES:
                raise ValueError(f"{where}: {item['field_name']} has the unknown data_type {item.get('data_type')}")
        return {item["field_name"] for item in items}

    main = config.get("main_fields") or []
    if not main:
        raise ValueError("main_fields must not be empty")
    lacking = set(BASE_FIELDS) - fields(main, "main_fields", True)
    if lacking:
        raise ValueError(f"main_fields lacks {sorted(lacking)}")
    fields(config.get("end2end_metrics") or [], "end2end_metrics", True)
    for m in config.get("modules") or []:
        if not m.get("module_name"):
            raise ValueError("a module needs a module_name")
        if spans.where(F.col("span_name") == m["module_name"]).isEmpty():
            raise ValueError(f"no span is named {m['module_name']!r}")
        for part in ("module_fields", "module_metrics"):
            fields(m.get(part) or [], f"{m['module_name']}.{part}", False)


class Datasets:
    """Question-answer and dialogue datasets of resolved spans.

    Arrival order is `order` where the spans have such a column, else start time and span id.
    """

    def __init__(self, spans: DataFrame, config: dict) -> None:
        check_config(config, spans)
        self.config = config
        self.metrics = [m["field_name"] for m in config.get("end2end_metrics") or []]
        self.modules = config.get("modules") or []
        names = {m["module_name"] for m in self.modules}
        key = [F.col("order")] if "order" in spans.columns else [F.coalesce(integer(F.col("start_time_ns")), F.lit(0))] if "start_time_ns" in spans.columns else []
        order = F.struct(*[k.alias(f"o{i}") for i, k in enumerate(key)], F.coalesce(F.col("span_id").cast("string"), F.lit("")).alias("span"), F.xxhash64("input_text", "output_text").alias("h"))
        rows = spans.where("coalesce(session_id, '') <> ''").select("session_id", F.coalesce("trace_id", F.lit("")).alias("query_id"), F.coalesce("aef_kind", F.lit("")).alias("kind"), F.col("span_name").alias("name"), "input_text", "output_text", order.alias("ord"))
        used = rows.where(F.col("kind").isin(*AGENT_KINDS) | F.col("name").isin(*names)) if names else rows.where(F.col("kind").isin(*AGENT_KINDS))
        said = used.withColumn("m", messages(F.col("kind"), F.col("input_text"), F.col("output_text")))
        agent = F.when(F.col("kind").isin(*AGENT_KINDS), F.struct((F.col("kind") != "start_agent").alias("k"), "ord"))
        of = {m["module_name"]: F.max_by("m", F.when(F.col("name") == m["module_name"], F.col("ord"))).alias(f"__m{i}") for i, m in enumerate(self.modules)}
        self.turns = said.groupBy("session_id", "query_id").agg(F.min_by("m", agent).alias("a"), F.min("ord").alias("ord"), *of.values())
        self.sessions = rows.groupBy("session_id").agg(F.min("ord").alias("first"))

    def _valid(self) -> DataFrame:
        return self.turns.where(F.coalesce(strip(F.col("a.q")) != "", F.lit(False)))

    def qa(self) -> DataFrame:
        """One row a trace; a module's columns are null where the trace lacks its span."""
        columns = [F.col("session_id"), F.col("query_id"), F.col("a.q").alias("input_query"), F.col("a.a").alias("output_answer")] + [F.lit("").alias(m) for m in self.metrics]
        for i, m in enumerate(self.modules):
            there = F.col(f"__m{i}").isNotNull()
            for f in m.get("module_fields") or []:
                name = f["field_name"]
                side = f"__m{i}.q" if name.endswith("_input_query") else f"__m{i}.a" if name.endswith("_output_answer") else None
                columns.append(F.when(there, F.col(side) if side else F.lit("")).alias(name))
            columns += [F.when(there, F.lit("")).alias(x["field_name"]) for x in m.get("module_metrics") or []]
        return self._valid().select(*columns)

    def dialogues(self) -> DataFrame:
        """One row a session; a session without a valid turn has an empty dialogue."""
        item = F.struct("ord", F.col("query_id"), F.col("a.q").alias("input_query"), F.col("a.a").alias("output_answer"))
        kind = "array<struct<query_id:string,input_query:string,output_answer:string>>"
        by = self._valid().groupBy("session_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
        triples = F.transform("items", lambda t: F.struct(t["query_id"].alias("query_id"), t["input_query"].alias("input_query"), t["output_answer"].alias("output_answer")))
        out = self.sessions.join(by, "session_id", "left")
        return out.select("session_id", F.coalesce(triples.cast(kind), F.array().cast(kind)).alias("dialogue"), *[F.lit("").alias(m) for m in self.metrics])
