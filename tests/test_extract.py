"""Golden traces: one frame, one extraction, checked case by case."""

import json

import pytest

from turnloom.plans.extract import Config, extract_turns
from turnloom.plans.schemas import ExtractionError

SCHEMA = "trace_id string, span_id string, agent_id string, session_id string, aef_kind string, span_name string, input_text string, output_text string, start_time_ns bigint, end_time_ns bigint, parent_span_id string"


def span(trace, sid, inp=None, out=None, kind="other", name="step", t=1000, session="s1", parent=None, end=None, agent="A"):
    text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    return (trace, sid, agent, session, kind, name, text(inp), text(out), t, end, parent)


def env(act, conv, sender, receiver, *texts, reply_with=None, in_reply_to=None, **more):
    e = {"performative": act, "conversation_id": conv, "sender": sender, "receiver": receiver, "content": {"message": [{"type": "text", "value": x} for x in texts]}}
    return e | ({"reply_with": reply_with} if reply_with else {}) | ({"in_reply_to": in_reply_to} if in_reply_to else {}) | more


def entry(conv, req, query, trace=None, t=1000, sid=None, out=None, session="s1", label=()):
    return span(trace or f"t{conv}", sid or f"in-{conv}-{req}", {"message": env("request", conv, "user", "agent", *label, query, reply_with=req)}, out, "input_request", t=t, session=session)


def leave(conv, req, *answer, trace=None, t=2000, sid=None, session="s1", act="inform", inp=None):
    return span(trace or f"t{conv}", sid or f"out-{conv}-{req}", inp, {"outgoing": env(act, conv, "agent", "user", *answer, in_reply_to=req)}, t=t, session=session)


def rows():
    out = [
        entry("g01", "r", "q one"), leave("g01", "r", "a one", "more"),
        entry("g02", "r", "q two", trace="g02a"), leave("g02", "r", "a two", trace="g02b"),
        entry("g03a", "r", "alone"), leave("g03b", "r", "orphan"),
        entry("g04", "r", "Same  Text"), entry("g04", "r", "same text", sid="z", t=1500), leave("g04", "r", "a"),
        entry("g05", "r", "one"), entry("g05", "r", "other", sid="z", t=1500), leave("g05", "r", "a"),
        entry("g06", "r", "one"), entry("g06", "r", "two", sid="z"), leave("g06", "r", "a"), leave("g06", "r", "b", sid="y"),
        entry("g07a", "r", "q", session="s1"), leave("g07a", "r", "a", session="s2"),
        entry("g07b", "r", "q", session=None), leave("g07b", "r", "a", session="s9"),
        entry("g07c", "r", "q", session=None), leave("g07c", "r", "a", session=" "),
        entry("g08", "r", "q", t=3000), leave("g08", "r", "a", t=2000),
        entry("g09", "r", "q", t=None), entry("g09", "r", "q", t=900, sid="z"), leave("g09", "r", "a"),
        entry("g11", "r", "the text", label=("lab",)), leave("g11", "r", "a"),
        entry("g12", "r", "the question", out={"outgoing": env("request", "g12", "agent", "worker", "route7", "the question", reply_with="d12")}),
        leave("g12", "r", "a", inp={"incoming": env("inform", "g12", "worker", "agent", "x", in_reply_to="d12")}),
        entry("g13", "r", "q", out={"outgoing": env("request", "g13", "agent", "workerX", "go", reply_with="d")}), leave("g13", "r", "a"),
        leave("g16a", "r", act="failure"), leave("g16b", "r"),
    ]
    triple = json.dumps(json.dumps({"message": env("request", "g18", "user", "agent", "enc", reply_with="r")}))
    out += [span("tg18", "in18", triple, None, "input_request"), span("tg18", "out18", None, repr({"outgoing": env("inform", "g18", "agent", "user", "dec", in_reply_to="r")}), t=2000)]
    out += [
        span("g20", "h", {"body": {"query": "http q"}}, {"response": {"body": {"answer": "http a"}}}, name="POST /v1"),
        span("g21a", "h", "question", "ok", "input_request"), span("g21b", "h", "question", {"answer": "ok"}, "input_request"),
        span("g23", "h", {"query": "outer"}, {"answer": "outer a"}, name="x.invoke"), span("g23", "sa", {"goal": "inner"}, {"summary": "inner a"}, "start_agent"),
        span("g24a", "sa", {"goal": "g"}, {"summary": "s"}, "start_agent"), span("g24b", "sa", {"text": "g"}, {"answer": "s"}, "start_agent"),
    ]
    bare = lambda who, *texts: {"message_id": "m", "sender": who, "receiver": "x", "content": {"message": [{"value": x} for x in texts]}}

    def parent(trace, query, carried, answer, n="", session="s1"):
        return [
            span(trace, f"p{n}", {"message": bare("user", "lab", query)}, {"outgoing": bare("agent", *answer)}, "input_request", session=session, end=5000),
            span(trace, f"c{n}", {"query": carried}, {}, "start_agent", t=1100 + len(n), parent=f"p{n}", session=session),
        ]

    out += parent("g26", "the query", "lab\n\nthe query", ["par answer"]) + parent("g27a", "the query", "else", ["x"])
    out += parent("g27b", "q one x", "lab\n\nq one x", ["a"], "1") + parent("g27b", "q two x", "lab\n\nq two x", ["b"], "2")
    out += [
        span("g28", "sa", {"query": "terminal q"}, {}, "start_agent"), span("g28", "m", None, {"final_response": ["", "term a"]}, "llm"),
        span("g29", "sa", {"query": "tq"}, {}, "start_agent"), span("g29", "m", None, {"final_response": "a1"}, "llm"), span("g29", "n", None, {"full_answer": "a2"}, "llm"),
        span("g30a", "sa", {"query": "lab rest of it"}, {}, "start_agent"), span("g30a", "m", None, {"final_response": "ta"}, "llm"),
        span("g30b", "sa", {"query": "unseen rest"}, {}, "start_agent"), span("g30b", "m", None, {"final_response": "ta"}, "llm"),
    ]
    state = lambda answer, stage="exit": {"stage": stage, "message_to_user": answer, "product_agent": "prod", "messages": [{"role": "user", "content": "state q"}]}
    out += [
        span("g31", "a", None, state("old"), "chain", t=10), span("g31", "b", None, state("new", "__END__"), "chain", t=20), span("g31", "c", None, state("plan", "plan"), "chain", t=30),
        span("g32", "a", None, state("x"), "chain", session=None),
        span("g33", "m", 'text "reply_with" here', None, "llm"), span("g34", "m", "x", "y", "llm"), span("g34b", "m", "x", "y", "llm"),
        span("other", "m", "x", "y", "llm", agent="B"),
    ]
    return out


@pytest.fixture(scope="module")
def found(spark):
    x = extract_turns(spark.createDataFrame(rows(), SCHEMA), Config("a"))
    turns = {r["turn_id"]: r for r in x.turns.collect()}
    return x, turns, [r.asDict() for r in x.issues.collect()]


def codes(issues, **where):
    return sorted(i["issue_code"] for i in issues if all(i[k] == v for k, v in where.items()))


def test_exchange_turns(found):
    _, turns, issues = found
    t = turns["g01|r"]
    assert (t["agent_response"], t["same_trace"], t["turn_latency_ms"], t["schema_family"]) == ("a one\n\nmore", True, 0.001, "fipa_acl")
    assert turns["g02|r"]["same_trace"] is False and turns["g02|r"]["exit_trace_id"] == "g02b"
    assert codes(issues, turn_id="g03a|r") == ["entry_without_exit"] and codes(issues, turn_id="g03b|r") == ["exit_without_entry"]
    assert turns["g04|r"]["input_query"] == "Same  Text"
    assert [i["details"] for i in issues if i["turn_id"] == "g05|r"] == ["conflicting_fields=input_query"] and "g05|r" not in turns
    assert codes(issues, turn_id="g06|r") == ["conflicting_entry_replicas", "conflicting_exit_replicas"]
    assert codes(issues, turn_id="g07a|r") == ["session_id_mismatch"] and codes(issues, turn_id="g07c|r") == ["session_id_missing"]
    assert codes(issues, turn_id="g07b|r") == ["session_id_partial"] and turns["g07b|r"]["session_id"] == "s9" and not turns["g07b|r"]["same_session"]
    assert codes(issues, turn_id="g08|r") == ["negative_turn_latency"] and codes(issues, turn_id="g09|r") == ["turn_timestamp_missing"]
    assert (turns["g11|r"]["route_label"], turns["g11|r"]["input_query"]) == ("lab", "the text")
    assert turns["g11|r"]["route_source_path"] == "input_text.message.content.message[0].value"
    assert turns["g12|r"]["route_label"] == "route7" and turns["g12|r"]["route_chain_complete"]
    assert turns["g13|r"]["route_label"] == "workerX" and turns["g13|r"]["route_source_path"] == "output_text.outgoing.receiver"
    assert turns["g18|r"]["input_query"] == "enc" and turns["g18|r"]["agent_response"] == "dec"


def test_boundary_turns(found):
    _, turns, issues = found
    t = turns["aef:g20:h"]
    assert (t["input_query"], t["agent_response"], t["response_source_path"], t["turn_latency_ms"]) == ("http q", "http a", "output_text.response.body.answer", 0.0)
    assert codes(issues, trace_id="g21a") == ["boundary_pair_incomplete"] and "aef:g21b:h" in turns
    assert "aef:g23:h" in turns and "aef:g23:sa" not in turns
    assert turns["aef:g24a:sa"]["schema_version"] == turns["aef:g24b:sa"]["schema_version"] == "aef_start_agent_v1"


def test_fallback_turns(found):
    _, turns, issues = found
    t = turns["parent:g26:c"]
    assert (t["route_label"], t["input_query"], t["agent_response"], t["exit_time_ns"], t["entry_span_id"]) == ("lab", "the query", "par answer", 5000, "p")
    assert [i["details"] for i in issues if i["trace_id"] == "g27a" and i["issue_code"] == "parent_boundary_incomplete"] == ["candidate_variants=0"]
    assert [i["details"] for i in issues if i["trace_id"] == "g27b" and i["issue_code"] == "parent_boundary_incomplete"] == ["candidate_variants=2"]
    assert turns["terminal:g28:sa"]["agent_response"] == "term a" and codes(issues, trace_id="g28") == []
    assert "terminal:g29:sa" not in turns and codes(issues, trace_id="g29") == ["boundary_pair_incomplete"]
    assert (turns["terminal:g30a:sa"]["route_label"], turns["terminal:g30a:sa"]["input_query"]) == ("lab", "rest of it")
    assert (turns["terminal:g30b:sa"]["route_label"], turns["terminal:g30b:sa"]["input_query"]) == ("", "unseen rest")
    assert (turns["state:g31:b"]["agent_response"], turns["state:g31:b"]["route_label"]) == ("new", "prod") and "state:g31:a" not in turns


def test_report(found):
    x, turns, issues = found
    r = x.report
    assert r["complete_turns"] == len(turns) and r["issue_rows"] == len(issues)
    assert r["counterparts"] == ["user"] and r["agent_id"] == "A"
    assert (r["failures_without_text"], r["malformed_exit_rows"], r["duplicate_entry_keys"]) == (1, 1, 4)
    assert (r["conflicting_entry_keys"], r["conflicting_exit_keys"], r["session_mismatches"], r["state_json_session_missing"]) == (2, 1, 1, 1)
    assert (r["entry_without_exit"], r["exit_without_entry"]) == (1, 1)
    assert codes(issues, trace_id="g33") == ["unsupported_trace_schema"] and r["unsupported_trace_count"] == 1 and r["unsupported_rows"] == 1
    assert codes(issues, trace_id="g34") == ["no_boundary_span"]
    assert r["candidate_turn_keys"] >= r["complete_turns"] and sum(r["strategies"].values()) == len(turns)


def test_counterparts_need_a_strict_majority(spark):
    data = [
        entry("c1", "r", "q"), leave("c1", "r", "a"),
        span("x1", "d1", {"message": env("request", "c1", "worker", "agent", "clarify", reply_with="w")}, {"outgoing": env("request", "c1", "agent", "worker", "do", reply_with="d")}, t=1500),
        span("x2", "d2", None, {"outgoing": env("request", "c2", "agent", "half", "do", reply_with="d")}, t=100),
        span("x2", "d3", {"message": env("request", "c2", "half", "agent", "hm", reply_with="w")}, None, t=200),
        span("x3", "d4", {"message": env("request", "c3", "half", "agent", "hm", reply_with="w")}, None, t=200),
    ]
    x = extract_turns(spark.createDataFrame(data, SCHEMA))
    # the worker's clarification and the agent's first request share a span: neither is earlier
    assert {r["party"] for r in x.counterparts.collect()} == {"user", "worker"}


def test_examples_are_capped_but_counted(spark):
    data = [span(f"t{i:03}", "m", 'a "reply_with" b', None, "llm") for i in range(7)]
    x = extract_turns(spark.createDataFrame(data, SCHEMA), Config("", 3))
    assert sorted(r["trace_id"] for r in x.issues.collect()) == ["t000", "t001", "t002"]
    assert x.report["unsupported_trace_count"] == 7 and x.report["issue_examples_truncated"] and x.report["complete_turns"] == 0


def test_agents_and_columns(spark):
    two = spark.createDataFrame([span("t", "a", agent="a"), span("t", "b", agent="A")], SCHEMA)
    with pytest.raises(ExtractionError, match="exactly one"):
        extract_turns(two).turns  # noqa: B018
    assert extract_turns(two, Config("A")).agent_rows.count() == 2
    with pytest.raises(ExtractionError, match="no spans"):
        extract_turns(two, Config("zz")).turns  # noqa: B018
    with pytest.raises(ExtractionError, match="missing columns"):
        extract_turns(two.drop("span_name"), Config("A")).turns  # noqa: B018
    for bad in (0, True, "3"):
        with pytest.raises(ValueError):
            Config("", bad)
