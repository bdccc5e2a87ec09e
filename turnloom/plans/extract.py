"""The extraction: spans in; turns, issues and a conservation report out.

Strategies cascade: traces that message exchanges or boundaries explain aren't asked
by the later ones.  Payloads are decoded once, for the rows that any strategy can
use, and only slim columns go on.  The decoded rows and the result of each strategy
are written as tables in the shared folder, so that plans stay small, a lost executor costs
one stage, and the spans and whatever several results read are computed once.  Nothing is collected but the report.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ladders import incoming, outgoing, request, response
from ..functions.payload import TERMINAL_KEYS, payload
from ..functions.tables import cut
from ..functions.text import ident, integer, semantic, strip
from ..operators import boundary, exchange, fallback
from ..operators.common import HTTP, MARKER, issue, outer
from .schemas import CONTRACT, OPTIONAL_SPAN_COLUMNS, SPAN_COLUMNS, ExtractionError


#: The report names at most so many counterparts, those of most conversations, and tells how many there are.
MAX_PARTIES = 1000


@dataclass(frozen=True)
class Config:
    """agent_id: blank where the table holds one agent only; max_issue_examples caps the examples of trace-level issues, None leaves them all."""

    agent_id: str = ""
    max_issue_examples: int | None = 100

    def __post_init__(self) -> None:
        n = self.max_issue_examples
        if n is not None and (isinstance(n, bool) or not isinstance(n, int) or n < 1):
            raise ValueError("max_issue_examples must be a whole number of 1 or more")


def normalise(spans: DataFrame) -> DataFrame:
    """Spans with plain typed columns, and `ord`, a total order that stands for arrival.

    ord is (start time, nulls first; trace; span; hash of the payloads): rows have no order of
    their own in Spark, and equal rows are interchangeable.
    """
    missing = [c for c in SPAN_COLUMNS if c not in spans.columns]
    if missing:
        raise ExtractionError(f"missing columns: {', '.join(missing)}")
    for c in OPTIONAL_SPAN_COLUMNS:
        if c not in spans.columns:
            spans = spans.withColumn(c, F.lit(None).cast("bigint" if c.endswith("ns") else "string"))
    kinds = {f.name: f.dataType.typeName() for f in spans.schema}
    text = lambda c: F.to_json(c) if kinds[c] in ("struct", "map", "array", "variant") else F.col(c).cast("string")
    out = spans.select(
        ident(F.col("trace_id")).alias("trace"),
        ident(F.col("span_id")).alias("span"),
        ident(F.col("agent_id")).alias("agent"),
        ident(F.col("session_id")).alias("session"),
        F.lower(ident(F.col("aef_kind"))).alias("kind"),
        F.coalesce(F.col("span_name").cast("string"), F.lit("")).alias("name"),
        text("input_text").alias("input"),
        text("output_text").alias("output"),
        integer(F.col("start_time_ns")).alias("t"),
        integer(F.col("end_time_ns")).alias("t_end"),
        ident(F.col("parent_span_id")).alias("parent"),
    )
    order = F.struct(F.col("t").isNotNull().alias("has"), F.coalesce("t", F.lit(0)).alias("t"), F.col("trace"), F.col("span"), F.xxhash64("input", "output", "kind", "name").alias("h"))
    return out.withColumn("ord", order)


def select_agent(rows: DataFrame, agent_id: str, check: bool = True) -> tuple[DataFrame, str]:
    """(the agent's rows, its id in upper case); without an id the table must hold exactly one.

    With check=False the caller sees to it that the agent has rows.
    """
    wanted = agent_id.strip()
    if wanted:
        chosen = rows.where(F.upper("agent") == wanted.upper())
        if check:
            _some(chosen, wanted)
        return chosen, wanted.upper()
    found = [r["agent"] for r in rows.where("agent <> ''").select("agent").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ExtractionError(f"without an agent id the table must hold exactly one agent; found {sorted(found)}")
    return rows.where("agent <> ''"), found[0].upper()


def _some(rows: DataFrame, agent: str) -> None:
    if rows.isEmpty():
        raise ExtractionError(f"no spans of agent {agent}")


def mark(rows: DataFrame) -> DataFrame:
    """rows with `candidate`, `outer` and the cheap text tests that decide what is decoded."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    both = lambda c: text(c).contains('"message_to_user"') & text(c).contains('"stage"')
    candidate = F.col("kind").isin("input_request", "start_agent") | F.col("name").rlike(HTTP) | text("input").rlike(MARKER) | text("output").rlike(MARKER)
    return rows.withColumns(
        {
            "candidate": candidate,
            "outer": outer(F.col("kind"), strip(F.col("name"))),
            "state_likely": both("input") | both("output"),
            "closing_likely": text("output").rlike("|".join(TERMINAL_KEYS)),
        }
    )


def view(rows: DataFrame) -> DataFrame:
    """rows with what the strategies read of their decoded payloads `pin` and `pout`, each choice made once.

    i, o: the message an input or output carries; q, r: what is asked and answered; started, ended:
    the same of a started agent's own fields; closing: closing answers; state: an agent's final state.
    """
    pin, pout = F.col("pin"), F.col("pout")
    return rows.withColumns(
        {
            "i": incoming(pin),
            "o": outgoing(pout),
            "q": F.when(pin.isNotNull(), request(pin)),
            "r": F.when(pout.isNotNull(), response(pout)),
            "started": boundary.started(pin),
            "ended": boundary.ended(pout),
            "closing": pout["terminal"],
            "state": fallback.final_state(pin, pout),
        }
    )


@dataclass
class Extraction:
    """The frames of one extraction, each made when first asked for."""

    spans: DataFrame
    config: Config = field(default_factory=Config)

    @cached_property
    def agent_rows(self) -> DataFrame:
        return self._checked(self._chosen[0])

    def _checked(self, rows: DataFrame) -> DataFrame:
        """rows, of which a named agent must have some."""
        wanted = self.config.agent_id.strip()
        if wanted:
            _some(rows, wanted)
        return rows

    @property
    def agent_id(self) -> str:
        return self._chosen[1]

    @cached_property
    def _chosen(self) -> tuple[DataFrame, str]:
        rows, agent = select_agent(normalise(self.spans), self.config.agent_id, check=False)
        return mark(rows), agent

    @cached_property
    def seen(self) -> DataFrame:
        """All rows of the agent, from one pass over the spans: the payloads of those that a strategy can use are decoded, the others have nulls."""
        rows = self._chosen[0].withColumn("used", F.expr("candidate or state_likely or closing_likely"))
        rows = rows.withColumns({c: F.when(F.col("used"), F.col(c)) for c in ("input", "output")})
        rows = rows.withColumns({"pin": payload(F.col("input")), "pout": payload(F.col("output"))})
        return self._checked(cut(view(rows).drop("input", "output", "agent", "pin", "pout"), "decoded"))

    @cached_property
    def decoded(self) -> DataFrame:
        """The rows that a strategy can use, with what any of them reads of the payloads."""
        return self.seen.where("used").drop("used")

    # --- message exchanges -------------------------------------------------
    @cached_property
    def _read(self) -> DataFrame:
        return self.decoded.where("candidate")

    @cached_property
    def exchange_rows(self) -> DataFrame:
        rows = self._read.where("i is not null or o is not null")
        conversation = F.coalesce(F.col("i.env.raw_conversation"), F.col("o.env.raw_conversation"), F.lit(""))
        return rows.select("trace", "span", "session", "t", "ord", F.col("i.env").alias("inc"), F.col("i.path").alias("inc_path"), F.col("o.env").alias("out"), F.col("o.path").alias("out_path"), strip(conversation).alias("conversation"))

    @cached_property
    def counterparts(self) -> DataFrame:
        return cut(exchange.counterparts(self.exchange_rows), "counterparts")

    @cached_property
    def events(self) -> tuple[DataFrame, DataFrame]:
        entries, exits = exchange.events(self.exchange_rows, self.counterparts)
        return cut(entries, "entries"), cut(exits, "exits")

    @cached_property
    def exchange_pairs(self) -> DataFrame:
        return cut(exchange.pair(*self.events), "pairs")

    @cached_property
    def exchange_turns(self) -> DataFrame:
        return exchange.turns(self.exchange_pairs)

    # --- boundaries ----------------------------------------------------------
    @cached_property
    def boundary_pairs(self) -> DataFrame:
        rest = self._read.where("i is null and o is null")
        pairs = boundary.read_pairs(boundary.boundary_spans(rest, self.exchange_rows.select("trace").distinct()))
        return cut(pairs.select("trace", "span", "session", "t", "version", "q", "r", "outcome"), "boundaries")

    @cached_property
    def boundary_turns(self) -> DataFrame:
        return boundary.turns(self.boundary_pairs)

    # --- fallbacks -----------------------------------------------------------
    @cached_property
    def _rest(self) -> DataFrame:
        """The decoded rows of traces that neither exchanges nor boundaries explain: all that the fallbacks read."""
        return cut(self._uncovered(self.decoded, self.exchange_turns, self.boundary_turns), "rest")

    def _uncovered(self, rows: DataFrame, *covering: DataFrame) -> DataFrame:
        ids = [t.select(F.col(c).alias("trace")) for t in covering for c in ("entry_trace_id", "exit_trace_id")]
        covered = ids[0]
        for more in ids[1:]:
            covered = covered.union(more)
        return rows.join(covered.distinct(), "trace", "left_anti")

    @cached_property
    def parent_pairs(self) -> DataFrame:
        return cut(boundary.parent_pairs(self._rest), "parents")

    @cached_property
    def parent_turns(self) -> DataFrame:
        return boundary.parent_turns(self.parent_pairs)

    @cached_property
    def labels(self) -> DataFrame:
        seen = self.exchange_turns.select("route_label").union(self.parent_turns.select("route_label"))
        return seen.select(strip(F.col("route_label")).alias("label")).where("label <> ''").distinct()

    @cached_property
    def terminal_turns(self) -> DataFrame:
        return cut(fallback.terminal_turns(self._uncovered(self._rest, self.parent_turns), self.labels), "closings")

    @cached_property
    def _states(self) -> DataFrame:
        return cut(fallback.state_turns(self._uncovered(self._rest, self.parent_turns, self.terminal_turns)), "states")

    @cached_property
    def state_turns(self) -> DataFrame:
        return self._states.where("session_id <> ''")

    # --- results ---------------------------------------------------------------
    @cached_property
    def turns(self) -> DataFrame:
        """All turns, without an order of rows; see `ordered`."""
        out = self.exchange_turns
        for more in (self.boundary_turns, self.parent_turns, self.terminal_turns, self.state_turns):
            out = out.unionByName(more)
        return out

    @cached_property
    def _fallback(self) -> DataFrame:
        return self.parent_turns.unionByName(self.terminal_turns).unionByName(self.state_turns)

    @cached_property
    def resolved(self) -> DataFrame:
        """(turn_id, side): one-sided exchange keys whose text a fallback has published from the same trace."""
        keys = self.exchange_pairs.select("turn_id", *exchange.KEY, F.col("e").isNull().alias("no_e"), F.col("x").isNull().alias("no_x"))

        def side(events: DataFrame, alone: str, text: str, trace: str, said: str, name: str) -> DataFrame:
            found = events.where("state = 'complete'").join(keys.where(alone), exchange.KEY)
            # few keys are one-sided: only texts of their traces are compared
            near = self._fallback.select(F.col(trace).alias("trace"), F.col(said).alias("said")).join(found.select("trace").distinct(), "trace", "left_semi")
            published = near.select("trace", semantic(F.col("said")).alias("sem"))
            found = found.withColumn("sem", semantic(F.col(text)))
            return found.join(published, ["trace", "sem"], "left_semi").select("turn_id", F.lit(name).alias("side")).distinct()

        entries, exits = self.events
        a = side(entries, "no_x", "input_query", "entry_trace_id", "input_query", "entry")
        return cut(a.union(side(exits, "no_e", "agent_response", "exit_trace_id", "agent_response", "exit")), "resolved")

    @cached_property
    def trace_classes(self) -> DataFrame:
        """(trace, class, rows) of traces that nothing supports: no_boundary or unsupported."""
        supported = self.exchange_rows.select("trace").union(self.boundary_pairs.select("trace")).union(self.state_turns.select("entry_trace_id")).distinct()
        every = self.seen.groupBy("trace").agg(F.bool_or("candidate").alias("asked"), F.count("*").alias("rows"))
        return cut(every.join(supported, "trace", "left_anti").select("trace", F.when(F.col("asked"), "unsupported").otherwise("no_boundary").alias("class"), "rows"), "classes")

    @cached_property
    def issues(self) -> DataFrame:
        """Issues after retraction: what a fallback has resolved is no issue."""
        fixed = self._fallback.select(F.col("entry_trace_id").alias("trace_id")).distinct().withColumn("issue_code", F.lit("boundary_pair_incomplete"))
        of_boundaries = boundary.issues(self.boundary_pairs).join(fixed, ["trace_id", "issue_code"], "left_anti")
        ids = self.resolved.select("turn_id").distinct()
        codes = ids.withColumn("issue_code", F.explode(F.array(F.lit("entry_without_exit"), F.lit("exit_without_entry"))))
        of_exchanges = exchange.issues(self.exchange_pairs).join(codes, ["turn_id", "issue_code"], "left_anti")
        names = [f for f in of_exchanges.columns]
        out = of_exchanges.unionByName(of_boundaries).unionByName(boundary.parent_issues(self.parent_pairs))
        n = self.config.max_issue_examples
        kinds = (
            ("no_boundary", issue("no_boundary_span", severity="warning", trace_id=F.col("trace"), details=F.lit("trace has no input_request/start_agent/HTTP boundary span"))),
            ("unsupported", issue("unsupported_trace_schema", trace_id=F.col("trace"), details=F.lit("boundary span present but no supported FIPA or AEF pair"))),
        )
        for kind, row in kinds:
            of_kind = self.trace_classes.where(F.col("class") == kind)
            shown = of_kind if n is None else of_kind.orderBy("trace").limit(n)
            out = out.unionByName(shown.select(row.alias("i")).select("i.*"))
        from .schemas import ISSUES

        return cut(out.select(*ISSUES.names) if names else out, "issues")

    @cached_property
    def report(self) -> dict[str, Any]:
        return build_report(self)


def ordered(turns: DataFrame) -> DataFrame:
    """Turns by session, time and id: a presentation order, costs a range exchange."""
    return turns.orderBy("session_id", F.coalesce("entry_time_ns", F.lit(0)), "turn_id")


def extract_turns(spans: DataFrame, config: Config | None = None) -> Extraction:
    return Extraction(spans, config or Config())


def metrics(x: Extraction) -> DataFrame:
    """(metric, value): every number of the report, each from one aggregate over one frame."""

    def rows(frame: DataFrame, **aggregates) -> DataFrame:
        one = frame.agg(*[F.coalesce(a, F.lit(0)).cast("bigint").alias(k) for k, a in aggregates.items()])
        pairs = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in aggregates])
        return one.select(F.explode(pairs).alias("m")).select("m.*")

    count = F.count("*")
    when = lambda c: F.count_if(F.expr(c) if isinstance(c, str) else c)
    entries, exits = x.events
    fixed = x._fallback.select(F.col("entry_trace_id").alias("trace")).distinct().withColumn("fixed", F.lit(True))
    incomplete = x.boundary_pairs.where("outcome <> 'turn'").join(fixed, "trace", "left").where("not (outcome = 'boundary_pair_incomplete' and coalesce(fixed, false))")
    parts = [
        rows(x.seen, input_rows=count, input_trace_count=F.count_distinct("trace"), candidate_rows_scanned=when("candidate")),
        rows(x.exchange_rows, fipa_rows=count),
        rows(x.exchange_pairs, pair_keys=count, entry_without_exit_raw=when("outcome = 'entry_without_exit'"), exit_without_entry_raw=when("outcome = 'exit_without_entry'"),
             duplicate_entry_keys=when("e.replicas > 1"), duplicate_exit_keys=when("x.replicas > 1"), conflicting_entry_keys=when("e.conflicts <> ''"), conflicting_exit_keys=when("x.conflicts <> ''"),
             session_mismatches=when("outcome = 'session_id_mismatch'")),
        rows(x.exchange_turns, fipa_complete_turns=count, cross_trace_turns=when("not same_trace"), route_chain_complete_turns=when("route_chain_complete")),
        rows(x.resolved, resolved_entries=when("side = 'entry'"), resolved_exits=when("side = 'exit'")),
        rows(entries, malformed_entry_rows=when("state = 'malformed'")),
        rows(exits, malformed_exit_rows=when("state = 'malformed'"), failures_without_text=when("state = 'failure'")),
        rows(x.boundary_turns, aef_complete_turns=count),
        rows(incomplete, incomplete_boundary_rows=count),
        rows(x.parent_pairs, parent_boundary_candidate_turns=count, parent_boundary_complete_turns=when("variants = 1")),
        rows(x.terminal_turns, semantic_terminal_complete_turns=count),
        rows(x._states, state_json_candidate_turns=count, state_json_session_missing=when("session_id = ''"), state_json_complete_turns=when("session_id <> ''")),
        rows(x.exchange_rows.select("trace").union(x.boundary_pairs.select("trace")).distinct(), supported_trace_count=count),
        rows(x.trace_classes, no_boundary_trace_count=when("class = 'no_boundary'"), unsupported_trace_count=when("class = 'unsupported'"), unsupported_rows=F.sum(F.when(F.col("class") == "unsupported", F.col("rows")))),
        rows(x.issues, issue_rows=count),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def build_report(x: Extraction) -> dict[str, Any]:
    m = {r["metric"]: r["value"] for r in metrics(x).collect()}
    keys = m.pop("pair_keys") - m["resolved_entries"] - m["resolved_exits"]
    m["entry_without_exit"] = m.pop("entry_without_exit_raw") - m.pop("resolved_entries")
    m["exit_without_entry"] = m.pop("exit_without_entry_raw") - m.pop("resolved_exits")
    m["fipa_turn_keys"] = keys
    m["aef_candidate_boundaries"] = m["aef_complete_turns"] + m["incomplete_boundary_rows"]
    complete = sum(m[k] for k in ("fipa_complete_turns", "aef_complete_turns", "parent_boundary_complete_turns", "semantic_terminal_complete_turns", "state_json_complete_turns"))
    asked = (
        keys + m["malformed_entry_rows"] + m["malformed_exit_rows"] + m["failures_without_text"] + m["aef_candidate_boundaries"]
        + m["parent_boundary_complete_turns"] + m["semantic_terminal_complete_turns"] + m["state_json_candidate_turns"]
    )
    parties = {r["party"]: r["conversations"] for r in x.counterparts.orderBy(F.desc("conversations"), "party").limit(MAX_PARTIES).collect()}
    strategies = {r["schema_version"]: r["count"] for r in x.turns.groupBy("schema_version").count().orderBy("schema_version").collect()}
    return m | {
        "contract_version": CONTRACT,
        "agent_id": x.agent_id,
        "complete_turns": complete,
        "candidate_turn_keys": asked,
        "fipa_extraction_coverage": m["fipa_complete_turns"] / keys if keys else 0.0,
        "extraction_coverage": complete / asked if asked else 0.0,
        "counterpart_count": x.counterparts.count(),
        "counterparts": list(parties),
        "counterpart_conversations": parties,
        "strategies": strategies,
        "turn_key_policy": "FIPA conversation_id+reply_with/in_reply_to; AEF trace_id+span_id",
        "order_policy": "session_id,entry_time_ns,turn_id",
        "issue_examples_truncated": x.config.max_issue_examples is not None and max(m["unsupported_trace_count"], m["no_boundary_trace_count"]) > x.config.max_issue_examples,
    }
