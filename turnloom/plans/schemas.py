"""Column contracts of the engine: spans in; turns, issues and datasets out."""

from __future__ import annotations

from pyspark.sql import types as T

CONTRACT = "turn-extraction.v1"

SPAN_COLUMNS = ("trace_id", "span_id", "agent_id", "session_id", "aef_kind", "span_name", "input_text", "output_text", "start_time_ns")
OPTIONAL_SPAN_COLUMNS = ("parent_span_id", "end_time_ns")

#: Schema versions and families of published turns.
EXCHANGE, BOUNDARY, START_AGENT = "fipa_acl_v1", "aef_boundary_v1", "aef_start_agent_v1"
PARENT, TERMINAL, STATE = "aef_parent_boundary_v1", "aef_semantic_terminal_v1", "state_json_v1"
FAMILY = {
    EXCHANGE: "fipa_acl",
    BOUNDARY: "aef_boundary",
    START_AGENT: "aef_boundary",
    PARENT: "aef_parent_boundary",
    TERMINAL: "aef_semantic_terminal",
    STATE: "state_json",
}

TURNS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("turn_id", "session_id", "input_query", "agent_response", "route_label", "schema_family", "schema_version", "entry_trace_id", "exit_trace_id", "entry_span_id", "exit_span_id")]
    + [T.StructField(n, T.LongType()) for n in ("entry_time_ns", "exit_time_ns")]
    + [T.StructField(n, T.BooleanType()) for n in ("same_trace", "same_session", "route_chain_complete")]
    + [T.StructField("turn_latency_ms", T.DoubleType())]
    + [T.StructField(n, T.StringType()) for n in ("query_source_path", "response_source_path", "route_source_path")]
)
ISSUES = T.StructType([T.StructField(n, T.StringType()) for n in ("issue_code", "severity", "schema_version", "turn_id", "trace_id", "span_id", "details")])


class ExtractionError(ValueError):
    """The span table or the extraction's configuration can't be used."""


class ProjectionError(ValueError):
    """The turns can't be projected to a dataset."""
