"""The registered queries of the engine, over spans made from conversations, and their oracles.

Oracles are written directly over the conversations: they share no JSON, no decoding
and no join with the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import AGENT, spans_from_conversations, with_injected_faults
from ..functions.ladders import asks, has_label, joined, replies
from ..functions.text import semantic
from ..operators import lineage
from ..operators.project import flat, pack, repeated_answers
from ..sources.sinks import CELL_LIMIT, artifact_scope_column, sheet_safe
from .extract import Config, Extraction, extract_turns, metrics, normalise, select_agent

SHOWN = ("turn_id", "session_id", "input_query", "agent_response", "route_label", "schema_version", "entry_trace_id", "exit_trace_id", "entry_span_id", "exit_span_id", "entry_time_ns", "exit_time_ns", "same_trace", "route_chain_complete", "turn_latency_ms")

PAIRS = """
    WITH lead_rows AS (SELECT conv_id AS c, turn AS k, role, text,
        lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nt FROM conversations),
    p AS (SELECT c, k, text, CASE WHEN nr = 'assistant' THEN nt END AS ans, c % 6 AS f, c || '-' || k AS key,
        1700000000000000000 + c * 10000000000000 + k * 1000000000 AS t,
        CASE k % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS label FROM lead_rows WHERE role = 'user')
"""
_TURNS = """ turns AS (
    SELECT CASE f WHEN 0 THEN 'c' || c || '|r' || k WHEN 1 THEN 'aef:t-' || key || ':http-' || key WHEN 2 THEN 'aef:t-' || key || ':agent-' || key
            WHEN 3 THEN 'parent:t-' || key || ':agent-' || key WHEN 4 THEN 'terminal:t-' || key || ':agent-' || key ELSE 'state:t-' || key || ':state-' || key END AS turn_id,
        's' || c AS session_id, text AS input_query, ans AS agent_response,
        CASE f WHEN 0 THEN label WHEN 3 THEN label WHEN 4 THEN 'alpha' WHEN 5 THEN 'gamma' ELSE '' END AS route_label,
        CASE f WHEN 0 THEN 'fipa_acl_v1' WHEN 1 THEN 'aef_boundary_v1' WHEN 2 THEN 'aef_start_agent_v1' WHEN 3 THEN 'aef_parent_boundary_v1' WHEN 4 THEN 'aef_semantic_terminal_v1' ELSE 'state_json_v1' END AS schema_version,
        't-' || key AS entry_trace_id, CASE WHEN f = 0 AND k % 4 = 0 THEN 'x-' || key ELSE 't-' || key END AS exit_trace_id,
        CASE f WHEN 0 THEN 'in-' WHEN 1 THEN 'http-' WHEN 2 THEN 'agent-' WHEN 3 THEN 'edge-' WHEN 4 THEN 'agent-' ELSE 'state-' END || key AS entry_span_id,
        CASE f WHEN 0 THEN 'out-' WHEN 1 THEN 'http-' WHEN 2 THEN 'agent-' WHEN 3 THEN 'edge-' WHEN 4 THEN 'agent-' ELSE 'state-' END || key AS exit_span_id,
        t AS entry_time_ns, CASE f WHEN 0 THEN t + 500000000 WHEN 3 THEN t + 1000 ELSE t END AS exit_time_ns,
        NOT (f = 0 AND k % 4 = 0) AS same_trace, f = 0 AS route_chain_complete, CASE f WHEN 0 THEN 500.0 ELSE 0.0 END::DOUBLE AS turn_latency_ms
    FROM p WHERE ans IS NOT NULL)
"""
_ISSUES = """ issues AS (
    SELECT CASE f WHEN 0 THEN 'entry_without_exit' WHEN 3 THEN 'parent_boundary_incomplete' WHEN 5 THEN 'no_boundary_span' ELSE 'boundary_pair_incomplete' END AS issue_code,
        CASE f WHEN 5 THEN 'warning' ELSE 'error' END AS severity,
        CASE f WHEN 0 THEN 'c' || c || '|r' || k ELSE '' END AS turn_id, 't-' || key AS trace_id,
        CASE f WHEN 0 THEN 'in-' || key WHEN 1 THEN 'http-' || key WHEN 2 THEN 'agent-' || key WHEN 4 THEN 'agent-' || key ELSE '' END AS span_id,
        CASE f WHEN 3 THEN 'candidate_variants=0' WHEN 5 THEN 'trace has no input_request/start_agent/HTTP boundary span' ELSE '' END AS details
    FROM p WHERE ans IS NULL)
"""


def _extraction(spark: SparkSession, sf_dir: str, examples: int | None = 1_000_000) -> Extraction:
    return extract_turns(spans_from_conversations(spark, sf_dir), Config(AGENT, examples))


def q_all_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).turns.select(*SHOWN)


def q_exchange_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).exchange_turns.select(*SHOWN)


def q_boundary_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).boundary_turns.where("schema_version = 'aef_boundary_v1'").select(*SHOWN)


def q_start_agent_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).boundary_turns.where("schema_version = 'aef_start_agent_v1'").select(*SHOWN)


def q_parent_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).parent_turns.select(*SHOWN)


def q_terminal_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).terminal_turns.select(*SHOWN)


def q_state_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).state_turns.select(*SHOWN)


def q_counterparts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).counterparts


def q_exchange_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).events[0].select("conversation", "request", "session", "trace", "span", "input_query", "route_label", "downstream", "state")


def q_exchange_exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).events[1].select("conversation", "request", "session", "trace", "span", "agent_response", "returned", "state")


def q_pair_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir).exchange_pairs.groupBy("outcome").agg(F.count("*").alias("n"))


def q_request_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _extraction(spark, sf_dir).decoded.where("q is not null")
    return rows.select("span", F.col("q.text").alias("text"), F.col("q.path").alias("path"))


def q_response_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _extraction(spark, sf_dir).decoded.where("r is not null")
    return rows.select("span", F.col("r.text").alias("text"), F.col("r.path").alias("path"))


def q_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each exchange span carries: paths, acts, parts, label and joined text."""
    rows = _extraction(spark, sf_dir).exchange_rows
    none = F.lit("")
    return rows.select(
        "span", F.coalesce("inc_path", none).alias("in_path"), F.coalesce("out_path", none).alias("out_path"), asks(F.col("inc")).alias("asks"), replies(F.col("out")).alias("replies"),
        F.coalesce(F.size("inc.parts"), F.lit(0)).cast("bigint").alias("n_in"), F.coalesce(F.size("out.parts"), F.lit(0)).cast("bigint").alias("n_out"), has_label(F.col("out.parts")).alias("labelled"), joined(F.col("inc.parts")).alias("said"),
    )


def q_replicas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a fixture with replicas, conflicts and gaps."""
    x = extract_turns(with_injected_faults(spans_from_conversations(spark, sf_dir)), Config(AGENT))
    n = lambda side: F.coalesce(F.col(f"{side}.replicas"), F.lit(0)).alias(f"n_{side}")
    return x.exchange_pairs.select("turn_id", "outcome", n("e"), n("x"), F.coalesce("e.input_query", F.lit("")).alias("input_query"), F.coalesce("x.conflicts", F.lit("")).alias("conflicts"))


def q_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir, None).issues.select("issue_code", "severity", "turn_id", "trace_id", "span_id", "details")


def q_issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extraction(spark, sf_dir, None).issues.groupBy("issue_code").agg(F.count("*").alias("n"))


def q_issue_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most three examples of each trace-level issue: the cap is the feature."""
    return _extraction(spark, sf_dir, 3).issues.where("issue_code = 'no_boundary_span'").select("issue_code", "trace_id")


def q_extraction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(_extraction(spark, sf_dir))


def q_flat_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(_extraction(spark, sf_dir).turns).select("scenario", "session_id", "query_id", "input_query_count", "input_query", "output_answer")


def q_dialogue_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(flat(_extraction(spark, sf_dir).turns))
    text = F.array_join(F.transform("dialogue", lambda t: F.concat_ws(" / ", t["query_id"], t["input_query"], t["output_answer"])), " // ")
    return packed.select("session_id", F.size("dialogue").cast("bigint").alias("n_turns"), text.alias("dialogue"), (F.col("n_scenarios") == 1).alias("constant"))


def q_turn_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _extraction(spark, sf_dir).turns
    return turns.groupBy("session_id").agg(F.min("turn_latency_ms").alias("least"), F.max("turn_latency_ms").alias("most"), F.count("*").alias("n"))


def q_repeated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages and sources of documents as answers: those of five rows or more and of 1 % of all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.concat_ws(" ", "lang", "source").alias("output_answer"))
    return repeated_answers(docs, docs.count())


def q_semantic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison form of every text."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return rows.select("conv_id", "turn", semantic(F.col("text")).alias("text"))


def q_agent_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = select_agent(normalise(spans_from_conversations(spark, sf_dir)), AGENT.lower())
    return rows.groupBy("session").agg(F.count("*").alias("n"))


def q_span_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _extraction(spark, sf_dir).agent_rows
    return rows.groupBy(F.element_at(F.split("span", "-"), 1).alias("span"), "candidate", "outer", "state_likely", "closing_likely").agg(F.count("*").alias("n"))


def q_sheet_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts between control characters, as cells."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.concat(F.lit("=\x01"), "text", F.lit("\x0b.")).alias("cell"))
    return sheet_safe(rows)


def q_long_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rows.select("doc_id", F.length("text").cast("bigint").alias("length")).where(F.col("length") > CELL_LIMIT)


def q_artifact_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return rows.select("page_id", artifact_scope_column(F.lit("agent 1"), F.col("url")).alias("scope"))


def _resolution(spark: SparkSession, sf_dir: str) -> lineage.Resolution:
    return lineage.resolve(spans_from_conversations(spark, sf_dir), AGENT)


def q_lineage_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolution(spark, sf_dir).groups.groupBy("method").agg(F.count("*").alias("n"))


def _dataset(spans: DataFrame) -> lineage.Datasets:
    field = lambda n: {"field_name": n, "data_type": "string", "description": n}
    config = {"main_fields": [field(n) for n in lineage.BASE_FIELDS], "end2end_metrics": [field("score")], "modules": [{"module_name": "answer", "module_fields": [field("answer_output_answer")], "module_metrics": []}]}
    return lineage.Datasets(spans, config)


def q_lineage_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent spans of all sessions, with the answering span as a module."""
    return _dataset(spans_from_conversations(spark, sf_dir)).qa()


def _lengths(dialogues: DataFrame) -> DataFrame:
    return dialogues.select("session_id", F.size("dialogue").cast("bigint").alias("n_turns"), "score")


def q_lineage_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of every session's dialogue."""
    return _lengths(_dataset(spans_from_conversations(spark, sf_dir)).dialogues())


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

_SHOWN = ", ".join(SHOWN)
_BY_VERSION = {
    "q_exchange_turns": "fipa_acl_v1",
    "q_boundary_turns": "aef_boundary_v1",
    "q_start_agent_turns": "aef_start_agent_v1",
    "q_parent_turns": "aef_parent_boundary_v1",
    "q_terminal_turns": "aef_semantic_terminal_v1",
    "q_state_turns": "state_json_v1",
}
_SPANS_OF = """ SELECT CASE WHEN f = 0 THEN 1 + (ans IS NOT NULL)::INT WHEN f IN (1, 2) THEN 1 WHEN f = 3 THEN 2 WHEN f = 4 THEN 1 + (ans IS NOT NULL)::INT ELSE 1 + (ans IS NOT NULL)::INT END AS n, * FROM p """

ORACLES: dict[str, str] = {
    "q_all_turns": f"{PAIRS}, {_TURNS} SELECT {_SHOWN} FROM turns",
    **{name: f"{PAIRS}, {_TURNS} SELECT {_SHOWN} FROM turns WHERE schema_version = '{v}'" for name, v in _BY_VERSION.items()},
    "q_counterparts": f"{PAIRS} SELECT 'user' AS party, count(DISTINCT c) AS conversations FROM p WHERE f = 0 HAVING count(*) > 0",
    "q_exchange_entries": f"{PAIRS} SELECT 'c' || c AS conversation, 'r' || k AS request, 's' || c AS session, 't-' || key AS trace, 'in-' || key AS span, text AS input_query, label AS route_label, 'd' || k AS downstream, 'complete' AS state FROM p WHERE f = 0",
    "q_exchange_exits": f"{PAIRS} SELECT 'c' || c AS conversation, 'r' || k AS request, 's' || c AS session, CASE WHEN k % 4 = 0 THEN 'x-' ELSE 't-' END || key AS trace, 'out-' || key AS span, ans AS agent_response, 'd' || k AS returned, 'complete' AS state FROM p WHERE f = 0 AND ans IS NOT NULL",
    "q_request_text": f"""{PAIRS} SELECT span, text, path FROM (
        SELECT 'in-' || key AS span, '' AS text, '' AS path FROM p WHERE f = 0 UNION ALL SELECT 'out-' || key, '', '' FROM p WHERE f = 0 AND ans IS NOT NULL
        UNION ALL SELECT 'http-' || key, text, 'input_text.body.query' FROM p WHERE f = 1 UNION ALL SELECT 'agent-' || key, '', '' FROM p WHERE f = 2
        UNION ALL SELECT 'edge-' || key, '', '' FROM p WHERE f = 3 UNION ALL SELECT 'agent-' || key, label || ' ' || text, 'input_text.query' FROM p WHERE f = 3
        UNION ALL SELECT 'agent-' || key, 'alpha ' || text, 'input_text.query' FROM p WHERE f = 4)""",
    "q_response_text": f"""{PAIRS} SELECT span, text, path FROM (
        SELECT 'in-' || key AS span, '' AS text, '' AS path FROM p WHERE f = 0 UNION ALL SELECT 'out-' || key, '', '' FROM p WHERE f = 0 AND ans IS NOT NULL
        UNION ALL SELECT 'http-' || key, coalesce(ans, ''), CASE WHEN ans IS NULL THEN '' ELSE 'output_text.response.body.answer' END FROM p WHERE f = 1
        UNION ALL SELECT 'agent-' || key, '', '' FROM p WHERE f IN (2, 3, 4) UNION ALL SELECT 'edge-' || key, '', '' FROM p WHERE f = 3
        UNION ALL SELECT 'model-' || key, '', '' FROM p WHERE f = 4 AND ans IS NOT NULL
        UNION ALL SELECT 'plan-' || key, coalesce(ans, '...'), 'output_text.message_to_user' FROM p WHERE f = 5
        UNION ALL SELECT 'state-' || key, ans, 'output_text.message_to_user' FROM p WHERE f = 5 AND ans IS NOT NULL)""",
    "q_envelopes": f"""{PAIRS} SELECT * FROM (
        SELECT 'in-' || key AS span, 'input_text.message' AS in_path, 'output_text.outgoing' AS out_path, true AS asks, false AS replies, 1::BIGINT AS n_in, 2::BIGINT AS n_out, true AS labelled, text AS said FROM p WHERE f = 0
        UNION ALL SELECT 'out-' || key, 'input_text.incoming', 'output_text.outgoing', false, true, 1, 1, false, ans FROM p WHERE f = 0 AND ans IS NOT NULL
        UNION ALL SELECT 'edge-' || key, 'input_text.message', 'output_text.outgoing', false, false, 2, (ans IS NOT NULL)::BIGINT, false, label || chr(10) || chr(10) || text FROM p WHERE f = 3)""",
    "q_replicas": f"""{PAIRS} SELECT 'c' || c || '|r' || k AS turn_id,
            CASE WHEN ans IS NOT NULL AND c % 7 = 0 THEN 'conflict' WHEN c % 11 = 0 THEN 'exit_without_entry' WHEN ans IS NULL THEN 'entry_without_exit' ELSE 'turn' END AS outcome,
            CASE WHEN c % 11 = 0 THEN 0 WHEN c % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS n_e, CASE WHEN ans IS NULL THEN 0 WHEN c % 7 = 0 THEN 2 ELSE 1 END::BIGINT AS n_x,
            CASE WHEN c % 11 = 0 THEN '' ELSE text END AS input_query, CASE WHEN ans IS NOT NULL AND c % 7 = 0 THEN 'agent_response' ELSE '' END AS conflicts
        FROM p WHERE f = 0 AND NOT (c % 11 = 0 AND ans IS NULL)""",
    "q_pair_outcomes": f"{PAIRS} SELECT CASE WHEN ans IS NULL THEN 'entry_without_exit' ELSE 'turn' END AS outcome, count(*) AS n FROM p WHERE f = 0 GROUP BY 1",
    "q_issues": f"{PAIRS}, {_ISSUES} SELECT issue_code, severity, turn_id, trace_id, span_id, details FROM issues",
    "q_issue_summary": f"{PAIRS}, {_ISSUES} SELECT issue_code, count(*) AS n FROM issues GROUP BY 1",
    "q_issue_examples": f"{PAIRS}, {_ISSUES} SELECT issue_code, trace_id FROM issues WHERE issue_code = 'no_boundary_span' ORDER BY trace_id LIMIT 3",
    "q_flat_dataset": f"{PAIRS}, {_TURNS} SELECT route_label AS scenario, session_id, turn_id AS query_id, 1 AS input_query_count, input_query, agent_response AS output_answer FROM turns",
    "q_dialogue_dataset": f"{PAIRS}, {_TURNS} SELECT session_id, count(*) AS n_turns, string_agg(turn_id || ' / ' || input_query || ' / ' || agent_response, ' // ' ORDER BY entry_time_ns, turn_id) AS dialogue, count(DISTINCT route_label) = 1 AS constant FROM turns GROUP BY 1",
    "q_turn_latency": f"{PAIRS}, {_TURNS} SELECT session_id, min(turn_latency_ms) AS least, max(turn_latency_ms) AS most, count(*) AS n FROM turns GROUP BY 1",
    "q_repeated_answers": "SELECT concat_ws(' ', lang, source) AS output_answer, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) >= greatest((SELECT count(*) FROM documents) * 0.01, 5)",
    "q_semantic_text": r"SELECT conv_id, turn, replace(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), 'ß', 'ss') AS text FROM conversations",
    "q_agent_filter": f"{PAIRS}, s AS ({_SPANS_OF}) SELECT 's' || c AS session, sum(n)::BIGINT AS n FROM s GROUP BY 1",
    "q_span_marks": f"""{PAIRS}, s AS (
        SELECT 'in' AS span, true AS candidate, true AS outer_, false AS state_likely, false AS closing_likely FROM p WHERE f = 0
        UNION ALL SELECT 'out', true, false, false, false FROM p WHERE f = 0 AND ans IS NOT NULL
        UNION ALL SELECT 'http', true, true, false, false FROM p WHERE f = 1
        UNION ALL SELECT 'agent', true, false, false, false FROM p WHERE f IN (2, 3, 4)
        UNION ALL SELECT 'edge', true, true, false, false FROM p WHERE f = 3
        UNION ALL SELECT 'model', false, false, false, true FROM p WHERE f = 4 AND ans IS NOT NULL
        UNION ALL SELECT 'plan', false, false, true, true FROM p WHERE f = 5
        UNION ALL SELECT 'state', false, false, true, true FROM p WHERE f = 5 AND ans IS NOT NULL)
        SELECT span, candidate, outer_ AS "outer", state_likely, closing_likely, count(*) AS n FROM s GROUP BY ALL""",
    "q_sheet_safe": r"SELECT doc_id, '= ' || regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]', ' ', 'g') || ' .' AS cell FROM documents",
    "q_long_cells": f"SELECT doc_id, length(text)::BIGINT AS length FROM documents WHERE length(text) > {CELL_LIMIT}",
    "q_artifact_scope": """
        WITH u AS (SELECT page_id, rtrim(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)', 1), '/') AS source FROM pages),
        v AS (SELECT page_id, source, regexp_replace(regexp_replace(regexp_replace(string_split(source, '/')[-1], '(?i)\\.zip$', ''), '[^A-Za-z0-9._-]+', '-', 'g'), '^[-._]+|[-._]+$', '', 'g') AS leaf FROM u)
        SELECT page_id, 'agent-1_' || CASE WHEN leaf = '' THEN 'distributive' ELSE substr(leaf, 1, 80) END || '-' || substr(sha256(source), 1, 12) AS scope FROM v""",
}
