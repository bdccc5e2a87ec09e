"""The climb has no greatest depth."""

from turnloom.operators import lineage

SCHEMA = "trace_id string, span_id string, agent_id string, session_id string, aef_kind string, span_name string, input_text string, output_text string, start_time_ns bigint, parent_span_id string"


def test_the_climb_ends_with_the_chain(spark, monkeypatch):
    monkeypatch.setattr(lineage, "MAX_DEPTH", 2, raising=False)
    monkeypatch.setattr(lineage, "ROUNDS", 2, raising=False)
    step = lambda t, i, parent, kind="llm", name="step", q=None, a=None: (t, i, "A", "s", kind, name, q, a, 1, parent)
    rows = [step("t", "e", None, "other", "POST /x", '{"query": "q"}', '{"answer": "edge"}'), step("t", "0", "3", "start_agent", "run", '{"query": "Q"}', '{"answer": "ok"}')]
    rows += [step("t", "3", "2"), step("t", "2", "1"), step("t", "1", "e")]
    rows += [step("c", "0", "1", "start_agent", "run", '{"query": "Q"}', '{"answer": "ok"}'), step("c", "1", "2"), step("c", "2", "0")]
    got = lineage.resolve(spark.createDataFrame(rows, SCHEMA).coalesce(1)).groups
    assert {r["trace"]: r["method"] for r in got.collect()} == {"t": "parent_boundary", "c": "unresolved"}
