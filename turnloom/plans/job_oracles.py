"""SQL of the job's queries."""

from __future__ import annotations

from .job_queries import _REQUESTS, _RESPONSES
from .queries import _ISSUES, _TURNS, PAIRS

_V = f"{PAIRS}, w AS (SELECT *, CASE WHEN f = 0 THEN (c // 6) % 11 END AS v, (c // 6) % 3 = 1 AS twin, 'c' || c || '|r' || k AS id FROM p)"
_OUTCOMES = """ o AS (SELECT *, CASE WHEN has_e AND has_x THEN CASE v WHEN 1 THEN 'session_id_missing' WHEN 2 THEN 'session_id_mismatch' WHEN 4 THEN 'turn_timestamp_missing' WHEN 5 THEN 'negative_turn_latency' ELSE 'turn' END
        WHEN has_e THEN 'entry_without_exit' ELSE 'exit_without_entry' END AS outcome
    FROM (SELECT *, v <> 7 AS has_e, ans IS NOT NULL AND v NOT IN (6, 9, 10) AS has_x FROM w WHERE f = 0) WHERE has_e OR has_x)"""
_FAULTY_ISSUES = f"""{_V}, {_OUTCOMES}, faulty AS (
    SELECT outcome AS issue_code, 'error' AS severity, id AS turn_id, CASE WHEN outcome = 'entry_without_exit' THEN 't-' || key ELSE '' END AS trace_id, CASE WHEN outcome = 'entry_without_exit' THEN 'in-' || key ELSE '' END AS span_id, '' AS details
        FROM o WHERE outcome <> 'turn' AND NOT (v = 10 AND ans IS NOT NULL)
    UNION ALL SELECT 'session_id_partial', 'warning', id, '', '', '' FROM o WHERE v = 3 AND has_x
    UNION ALL SELECT 'parent_boundary_incomplete', 'error', '', 't-' || key, '', CASE WHEN ans IS NULL THEN 'candidate_variants=0' ELSE 'candidate_variants=2' END FROM w WHERE f = 3 AND (ans IS NULL OR twin)
    UNION ALL SELECT 'boundary_pair_incomplete', 'error', '', 't-' || key, CASE f WHEN 1 THEN 'http-' ELSE 'agent-' END || key, '' FROM w WHERE f IN (1, 2, 4) AND ans IS NULL
    UNION ALL SELECT 'no_boundary_span', 'warning', '', 't-' || key, '', 'trace has no input_request/start_agent/HTTP boundary span' FROM w WHERE f = 5 AND ans IS NULL)"""


def _counts(rows: str, parts: dict[str, str], kind: str = "BIGINT") -> str:
    """(metric, value) by one aggregate each."""
    return f"{rows} " + " UNION ALL ".join(f"SELECT '{name}' AS metric, ({sql})::{kind} AS value" for name, sql in parts.items())


def _of(condition: str, table: str = "p") -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


_REPORT = {
    "input_rows": "SELECT sum(CASE WHEN f = 3 THEN 2 WHEN f IN (1, 2) THEN 1 ELSE 1 + (ans IS NOT NULL)::INT END) FROM p",
    "input_trace_count": "SELECT sum(1 + (f = 0 AND ans IS NOT NULL AND k % 4 = 0)::INT) FROM p",
    "candidate_rows_scanned": "SELECT sum(CASE f WHEN 0 THEN 1 + (ans IS NOT NULL)::INT WHEN 3 THEN 2 WHEN 5 THEN 0 ELSE 1 END) FROM p",
    "fipa_rows": "SELECT sum(CASE f WHEN 0 THEN 1 + (ans IS NOT NULL)::INT WHEN 3 THEN 1 ELSE 0 END) FROM p",
    "pair_keys": _of("f = 0"), "entry_without_exit_raw": _of("f = 0 AND ans IS NULL"), "exit_without_entry_raw": "0", "duplicate_entry_keys": "0", "duplicate_exit_keys": "0",
    "conflicting_entry_keys": "0", "conflicting_exit_keys": "0", "session_mismatches": "0", "fipa_complete_turns": _of("f = 0 AND ans IS NOT NULL"),
    "cross_trace_turns": _of("f = 0 AND ans IS NOT NULL AND k % 4 = 0"), "route_chain_complete_turns": _of("f = 0 AND ans IS NOT NULL"), "resolved_entries": "0", "resolved_exits": "0",
    "malformed_entry_rows": "0", "malformed_exit_rows": "0", "failures_without_text": "0", "aef_complete_turns": _of("f IN (1, 2) AND ans IS NOT NULL"), "incomplete_boundary_rows": _of("f IN (1, 2, 4) AND ans IS NULL"),
    "parent_boundary_candidate_turns": _of("f = 3"), "parent_boundary_complete_turns": _of("f = 3 AND ans IS NOT NULL"), "semantic_terminal_complete_turns": _of("f = 4 AND ans IS NOT NULL"),
    "state_json_candidate_turns": _of("f = 5 AND ans IS NOT NULL"), "state_json_session_missing": "0", "state_json_complete_turns": _of("f = 5 AND ans IS NOT NULL"),
    "supported_trace_count": "SELECT sum((f <= 4)::INT + (f = 0 AND ans IS NOT NULL AND k % 4 = 0)::INT) FROM p", "no_boundary_trace_count": _of("f = 5 AND ans IS NULL"),
    "unsupported_trace_count": "0", "unsupported_rows": "0", "issue_rows": _of("ans IS NULL"),
}
_METHODS = """ m AS (SELECT 't-' || key AS trace, CASE WHEN f = 0 OR (f = 3 AND ans IS NOT NULL) THEN 'direct_agent_span' WHEN f = 1 AND ans IS NOT NULL THEN 'external_boundary'
        WHEN f = 4 AND ans IS NOT NULL THEN 'semantic_terminal' WHEN f = 5 THEN 'non_eligible' ELSE 'unresolved' END AS method FROM p
    UNION ALL SELECT 'x-' || key, 'non_eligible' FROM p WHERE f = 0 AND ans IS NOT NULL AND k % 4 = 0)"""
_SPANS = """ r AS (
    SELECT c, t, 't-' || key AS trace, 'in-' || key AS span_id, 'start_agent' AS aef_kind, text AS q, label || ' ' || text AS a, 'direct_agent_span' AS method, 'handle' AS source FROM p WHERE f = 0
    UNION ALL SELECT c, t + 500000000, 't-' || key, 'out-' || key, 'other', '', '', '', '' FROM p WHERE f = 0 AND ans IS NOT NULL AND k % 4 <> 0
    UNION ALL SELECT c, t, 't-' || key, 'http-' || key, 'start_agent', text, ans, 'external_boundary', 'POST /v1/chat' FROM p WHERE f = 1 AND ans IS NOT NULL
    UNION ALL SELECT c, t, 't-' || key, 'edge-' || key, 'start_agent', label || ' ' || text, ans, 'direct_agent_span', 'handle' FROM p WHERE f = 3 AND ans IS NOT NULL
    UNION ALL SELECT c, t + 1, 't-' || key, 'agent-' || key, 'other', '', '', '', '' FROM p WHERE f = 3 AND ans IS NOT NULL
    UNION ALL SELECT c, t, 't-' || key, 'agent-' || key, 'start_agent', 'alpha ' || text, ans, 'semantic_terminal', 'answer:$.final_response' FROM p WHERE f = 4 AND ans IS NOT NULL
    UNION ALL SELECT c, t + 1, 't-' || key, 'model-' || key, 'llm', '', '', '', '' FROM p WHERE f = 4 AND ans IS NOT NULL)"""


def _py(column: str) -> str:
    """A text as Python prints it within a container."""
    escaped = rf"replace(replace(replace(replace({column}, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t')"
    return f"CASE WHEN contains({column}, '''') AND NOT contains({column}, '\"') THEN '\"' || {escaped} || '\"' ELSE '''' || replace({escaped}, '''', '\\''') || '''' END"


def _rungs(rungs: list[str], side: str, role: str) -> str:
    names = ", ".join("'" + (f"{side}.messages[last {role}].content" if r == "messages" else f"{side}.{r}") + "'" for r in rungs)
    return f"{PAIRS} SELECT c, k, text, [{names}][((c + k) % {len(rungs)} + 1)::INT] AS path FROM p"


_COMPLETE = "SELECT count(*) FROM turns"
_ASKED = "SELECT count(*) FILTER (WHERE f IN (0, 1, 2)) + count(*) FILTER (WHERE f = 3 AND ans IS NOT NULL) + count(*) FILTER (WHERE f = 4) + count(*) FILTER (WHERE f = 5 AND ans IS NOT NULL) FROM p"
_SESSIONS = "SELECT count(DISTINCT session_id) FROM turns"
_OFTEN = f"SELECT agent_response AS a, count(*) AS n FROM turns GROUP BY 1 HAVING count(*) >= greatest(0.01 * ({_SESSIONS}), 5)"
_MIXED = "EXISTS (SELECT 1 FROM turns GROUP BY session_id HAVING count(DISTINCT route_label) > 1) OR EXISTS (SELECT 1 FROM turns WHERE route_label = '')"
_ANSWERS = {
    "table: a number": "TypeError", "table: bytes of no format": "ValueError", "table: no such file": "FileNotFoundError", "spans: a column less": "ExtractionError", "spans: two agents": "ExtractionError",
    "spans: unknown agent": "ExtractionError", "config: no examples": "ValueError", "convert: no spans": "ExtractionError", "project: unknown contract": "ProjectionError", "lineage: no spans": "ValueError",
    "lineage: no agent column": "ValueError", "dataset: no main fields": "ValueError", "metric: unknown method": "ValueError", "metric: a role twice": "ValueError", "metric: as it should be": "accepted",
    "verdict: none": "ValueError", "verdict: bypassed": "accepted", "verdict: passes": "accepted", "verdict: K3 is bad": "ValueError", "verdict: K7 is bad": "accepted", "selection: a list": "ValueError", "selection: none": "accepted",
}
_CONVERTED = {
    "candidate_turn_keys": _ASKED, "published_turns": _COMPLETE, "published_rows": _COMPLETE, "unpublished_turns": f"({_ASKED}) - ({_COMPLETE})", "extraction_coverage": f"({_COMPLETE}) / ({_ASKED})::DOUBLE",
    "status partial": "1", "ready False": "1", "mode qa": "1", "path traces_based_datasets/A1_agent-' || substr(sha256('/a b/agent.ZIP'), 1, 12) || '": "1",
}

ORACLES: dict[str, str] = {
    "q_extraction_report": _counts(PAIRS, _REPORT),
    "q_faulty_pairs": f"{_V}, {_OUTCOMES} SELECT id AS turn_id, outcome, has_e AND has_x AND v = 3 AS partial FROM o",
    "q_faulty_turns": f"""{_V}, {_OUTCOMES} SELECT id AS turn_id, 's' || c AS session_id, CASE v WHEN 8 THEN 'worker' ELSE label END AS route_label, v <> 3 AS same_session, 500.0::DOUBLE AS turn_latency_ms FROM o WHERE outcome = 'turn'
        UNION ALL SELECT CASE f WHEN 0 THEN 'state:t-' || key || ':state-' || key WHEN 1 THEN 'aef:t-' || key || ':http-' || key WHEN 2 THEN 'aef:t-' || key || ':agent-' || key WHEN 3 THEN 'parent:t-' || key || ':agent-' || key WHEN 4 THEN 'terminal:t-' || key || ':agent-' || key ELSE 'state:t-' || key || ':state-' || key END,
            's' || c, CASE f WHEN 0 THEN 'gamma' WHEN 3 THEN label WHEN 4 THEN 'alpha' WHEN 5 THEN 'gamma' ELSE '' END, true, 0.0 FROM w WHERE ans IS NOT NULL AND (f > 0 OR v = 10) AND NOT (f = 3 AND twin)""",
    "q_faulty_issues": f"{_FAULTY_ISSUES} SELECT * FROM faulty",
    "q_faulty_events": f"""{_V} SELECT side, state, count(*) AS n FROM (SELECT 'entry' AS side, CASE v WHEN 7 THEN 'malformed' ELSE 'complete' END AS state FROM w WHERE f = 0
        UNION ALL SELECT 'exit', CASE v WHEN 6 THEN 'failure' WHEN 9 THEN 'malformed' ELSE 'complete' END FROM w WHERE f = 0 AND ans IS NOT NULL AND v <> 10) GROUP BY ALL""",
    "q_retracted_keys": f"{_V} SELECT id AS turn_id, 'entry' AS side FROM w WHERE v = 10 AND ans IS NOT NULL",
    "q_faulty_report": _counts(_V, {
        "malformed_entry_rows": _of("v = 7", "w"), "malformed_exit_rows": _of("v = 9 AND ans IS NOT NULL", "w"), "failures_without_text": _of("v = 6 AND ans IS NOT NULL", "w"), "session_mismatches": _of("v = 2 AND ans IS NOT NULL", "w"),
        "resolved_entries": _of("v = 10 AND ans IS NOT NULL", "w"), "resolved_exits": "0", "parent_boundary_candidate_turns": _of("f = 3", "w"), "parent_boundary_complete_turns": _of("f = 3 AND ans IS NOT NULL AND NOT twin", "w"),
        "fipa_complete_turns": _of("v IN (0, 3, 8) AND ans IS NOT NULL", "w"), "pair_keys": _of("f = 0 AND NOT (v = 7 AND ans IS NULL)", "w"),
    }),
    "q_payload_forms": f"""{PAIRS} SELECT c, k, ['object', 'object', 'object', 'object', 'deep', 'text'][((c + k) % 6 + 1)::INT] AS shape, CASE (c + k) % 6 WHEN 5 THEN 'so: ' || text WHEN 4 THEN NULL ELSE text END AS text,
        CASE (c + k) % 6 WHEN 5 THEN 'input_text' WHEN 4 THEN '' ELSE 'input_text.query' END AS path FROM p""",
    "q_request_rungs": _rungs(_REQUESTS, "input_text", "human"),
    "q_response_rungs": _rungs(_RESPONSES, "output_text", "assistant"),
    "q_first_turns": f"{PAIRS}, {_TURNS} SELECT turn_id, session_id, entry_time_ns FROM turns ORDER BY session_id, entry_time_ns, turn_id LIMIT 20",
    "q_issue_report": f"""{_FAULTY_ISSUES} SELECT printf('%03d', place - 1) AS place, issue_code, trace_id, turn_id FROM (SELECT *, row_number() OVER (ORDER BY issue_code, trace_id, turn_id, span_id, details) AS place FROM faulty) WHERE place <= 100
        UNION ALL SELECT 'count', issue_code, count(*)::VARCHAR, '' FROM faulty GROUP BY issue_code""",
    "q_dialogue_literals": f"""{PAIRS}, {_TURNS} SELECT session_id, '[' || string_agg('(''' || turn_id || ''', ''' || translate(input_query, e'\\'\\\\\\n\\t\\r', '') || ''', ''' || translate(agent_response, e'\\'\\\\\\n\\t\\r', '') || ''')', ', ' ORDER BY entry_time_ns, turn_id) || ']' AS dialogue FROM turns GROUP BY 1""",
    "q_projection_report": _counts(f"{PAIRS}, {_TURNS}", {
        "rows": _SESSIONS, "groups": _SESSIONS, "candidate_turn_keys": _ASKED, "complete_turns": _COMPLETE, "source_coverage": f"({_COMPLETE}) / ({_ASKED})::DOUBLE", "ready_for_scoring": f"NOT ({_MIXED})",
        "exact_echo_pairs": "SELECT count(*) FROM turns WHERE lower(input_query) = lower(agent_response)", "repeated_answer_rows": f"SELECT coalesce(sum(n), 0) FROM ({_OFTEN})", "repeated_answer_values": f"SELECT count(*) FROM ({_OFTEN})",
    }, "DOUBLE") + f" UNION ALL SELECT 'missing route', 1 WHERE {_MIXED}",
    "q_converted": f"{PAIRS}, {_TURNS} SELECT 'v7' AS solution_version, route_label AS scenario, session_id, turn_id AS query_id, 1 AS input_query_count, input_query, agent_response AS output_answer FROM turns",
    "q_conversion_report": _counts(f"{PAIRS}, {_TURNS}, {_ISSUES}", _CONVERTED, "DOUBLE") + " UNION ALL SELECT 'issues ' || issue_code, count(*) FROM issues GROUP BY 1 UNION ALL SELECT 'turns ' || schema_version, count(*) FROM turns GROUP BY 1",
    "q_lineage_methods": f"{PAIRS}, {_METHODS} SELECT method, count(*) AS n FROM m GROUP BY 1",
    "q_lineage_report": _counts(f"{PAIRS}, {_METHODS}", {
        "input_trace_groups": "SELECT count(*) FROM m", "overall_selected_rate": "SELECT count(*) FILTER (WHERE method NOT IN ('unresolved', 'non_eligible')) / count(*)::DOUBLE FROM m", "eligible_trace_groups": _of("method <> 'non_eligible'", "m"),
        "selected_groups": _of("method NOT IN ('unresolved', 'non_eligible')", "m"), "coverage": "SELECT count(*) FILTER (WHERE method NOT IN ('unresolved', 'non_eligible')) / (count(*) FILTER (WHERE method <> 'non_eligible'))::DOUBLE FROM m",
        "unresolved_ids_truncated": "SELECT count(*) > 20 FROM m WHERE method = 'unresolved'",
    }, "DOUBLE") + " UNION ALL SELECT 'method ' || method, count(*) FROM m GROUP BY 1 UNION ALL SELECT 'unresolved ' || trace, place - 1 FROM (SELECT trace, row_number() OVER (ORDER BY trace) AS place FROM m WHERE method = 'unresolved') WHERE place <= 20",
    "q_lineage_spans": f"{PAIRS}, {_SPANS} SELECT span_id, aef_kind, q, a, method, source FROM r",
    "q_lineage_first_spans": f"{PAIRS}, {_SPANS} SELECT 's' || c AS session_id, trace AS trace_id, span_id FROM r ORDER BY 's' || c, t, trace, span_id LIMIT 50",
    "q_lineage_climb": f"{PAIRS} SELECT 't-' || key AS trace, CASE WHEN ans IS NULL THEN 'unresolved' ELSE 'parent_boundary' END AS method, CASE WHEN ans IS NULL THEN '' ELSE text END AS q, coalesce(ans, '') AS a FROM p",
    "q_lineage_qa": f"""{PAIRS}, x AS (SELECT *, {_py('text')} AS pt, CASE WHEN ans IS NOT NULL THEN {_py('ans')} END AS pa FROM p)
        SELECT 's' || c AS session_id, 't-' || key AS query_id,
            CASE f WHEN 0 THEN '{{''performative'': ''request'', ''conversation_id'': ''c' || c || ''', ''reply_with'': ''r' || k || ''', ''sender'': ''user'', ''receiver'': ''agent'', ''content'': {{''message'': [{{''type'': ''text'', ''value'': ' || pt || '}}]}}}}'
                WHEN 2 THEN text WHEN 3 THEN label || ' ' || text ELSE 'alpha ' || text END AS input_query,
            CASE f WHEN 0 THEN '{{''outgoing'': {{''performative'': ''request'', ''conversation_id'': ''c' || c || ''', ''reply_with'': ''d' || k || ''', ''sender'': ''agent'', ''receiver'': ''worker'', ''content'': {{''message'': [{{''type'': ''text'', ''value'': ''' || label || '''}}, {{''type'': ''text'', ''value'': ' || pt || '}}]}}}}}}'
                WHEN 2 THEN coalesce(ans, '{{}}') ELSE '{{}}' END AS output_answer, '' AS score,
            CASE WHEN f = 4 AND ans IS NOT NULL THEN '{{''final_response'': [' || pa || ']}}' END AS answer_output_answer FROM x WHERE f IN (0, 2, 3, 4)""",
    "q_lineage_dialogues": f"{PAIRS} SELECT 's' || c AS session_id, count(*) FILTER (WHERE f IN (0, 2, 3, 4)) AS n_turns, '' AS score FROM p GROUP BY 1",
    "q_blob_round_trip": "SELECT * FROM benchmark",
    "q_workbook_round_trip": "SELECT COLUMNS(*)::VARCHAR FROM nation",
    "q_folder_of_parts": "SELECT r_regionkey::VARCHAR AS r_regionkey, r_name FROM region",
    "q_table_errors": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _ANSWERS.items()) + ") t(input, answer)",
}
