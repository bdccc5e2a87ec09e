import copy
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from turnloom.operators import lineage
from turnloom.operators.project import canonicalize
from turnloom.plans import gates
from turnloom.plans.convert import convert, issue_summary
from turnloom.plans.schemas import CONTRACT, ISSUES, TURNS, ProjectionError
from turnloom.sources import sheet, sinks
from turnloom.sources.tables import parquet_bytes, read_table, sniff

from .test_extract import SCHEMA, entry, leave, span

METRIC = {
    "contract_version": gates.METRIC_CONTRACT,
    "status": "computed",
    "assessment_mode": "qa",
    "scoring": {"method": "accuracy", "sources": [{"source_id": "1", "role": "prediction", "column_name": "pred"}, {"source_id": "2", "role": "target", "column_name": "gold"}]},
}
VERDICT = {
    "schema": {gates.CRITICAL: 0},
    "quality": [dict.fromkeys(gates.QUALITY, 0) | {"valid": True}],
    "criteria": {k: {"tone": "good", "result": "r", "title": "t"} for k in gates.CRITERIA},
    "readiness": [{"verdict": "ready"}],
    "metrics": {"policy": {}, "gates": {}},
}


def metric(mode="qa", method=None):
    m = copy.deepcopy(METRIC)
    m["assessment_mode"] = mode
    if method:
        m["scoring"] = {"method": method, "sources": [{"source_id": "1", "role": next(iter(gates.ROLES[method])), "column_name": "c"}]}
    return m


def turns(spark, rows):
    """rows: (turn, session, query, answer, route, time)"""
    full = [dict(turn_id=t, session_id=s, input_query=q, agent_response=a, route_label=r, entry_time_ns=n, route_source_path="p") for t, s, q, a, r, n in rows]
    return spark.createDataFrame([tuple(x.get(f.name) for f in TURNS) for x in full], TURNS)


def report(n, asked=None):
    return {"contract_version": CONTRACT, "complete_turns": n, "candidate_turn_keys": n if asked is None else asked}


def test_flat_projection_and_accuracy(spark):
    df = turns(spark, [("1", "s", " q ", "a", "x", 1), ("2", "s", "Q2", "q2", "y", 2)])
    p = canonicalize(df, metric(), report(2, 4))
    got = {r["query_id"]: r for r in p.result.collect()}
    assert p.result.columns == ["scenario", "session_id", "query_id", "input_query_count", "input_query", "output_answer", "pred"]
    assert got["1"]["input_query"] == "q" and got["2"]["pred"] == "y"
    assert p.report["ready_for_scoring"] and p.report["source_coverage"] == 0.5 and p.report["reference_only_sources"] == ["gold"]
    assert p.profile["exact_echo_pairs"] == 1
    blank = canonicalize(turns(spark, [("1", "s", "q", "a", "", 1), ("2", "s", "q2", "b", "y", 2)]), metric(), report(2))
    assert "pred" not in blank.result.columns and not blank.report["ready_for_scoring"]


def test_dialogue_packing(spark):
    rows = [("2", "s", "q2", "it's", "x", 2), ("1", "s", "q1", "a\n", "x", 1), ("3", "t", "q3", "é", "y", 3)]
    p = canonicalize(turns(spark, rows), metric("dialogue"), report(3))
    got = {r["session_id"]: r for r in p.result.collect()}
    assert got["s"]["dialogue"] == repr([("1", "q1", "a"), ("2", "q2", "it's")]) and got["t"]["pred"] == "y" and got["s"]["scenario"] == "x"
    mixed = canonicalize(turns(spark, [*rows, ("4", "t", "q4", "a", "z", 4)]), metric("dialogue"), report(4))
    assert mixed.result.columns == ["session_id", "dialogue"] and mixed.report["missing_scoring_sources"] == ["pred"]


def test_repeated_answers(spark):
    rows = [(str(i), "s", f"q{i}", "same" if i < 5 else f"a{i}", "x", i) for i in range(10)]
    assert canonicalize(turns(spark, rows), metric(method="identity"), report(10)).profile["repeated_answer_rows"] == 5
    rows[0] = ("0", "s", "q0", "else", "x", 0)
    assert canonicalize(turns(spark, rows), metric(method="identity"), report(10)).profile["repeated_answer_rows"] == 0


def test_projection_errors(spark):
    one = ("1", "s", "q", "a", "x", 1)
    for rows, why in (([one, one], "repeats"), ([("1", "s", " ", "a", "x", 1)], "blank"), ([], "no complete")):
        with pytest.raises(ProjectionError, match=why):
            canonicalize(turns(spark, rows), metric(), report(len(rows)))
    with pytest.raises(ProjectionError, match="complete turns"):
        canonicalize(turns(spark, [one]), metric(), report(2))
    with pytest.raises(ProjectionError, match="contradicts"):
        canonicalize(turns(spark, [one]), metric(), report(1, 0))
    clash = metric()
    clash["scoring"]["sources"][1]["column_name"] = "turn_index"
    with pytest.raises(ProjectionError, match="turn_index"):
        canonicalize(turns(spark, [one]), clash, report(1))


def test_verdict_gates():
    assert gates.check_verdict(VERDICT)["status"] == "passed"
    assert gates.check_verdict(None, True)["status"] == "bypassed"

    def broken(change):
        v = copy.deepcopy(VERDICT)
        change(v)
        return v

    tone = lambda k, t: lambda v: v["criteria"][k].update(tone=t)
    assert gates.check_verdict(broken(tone("K7", "bad")))["status"] == "passed"
    assert gates.check_verdict(broken(tone("K2", "warn")))["warning_criteria"] == ["K2"]
    bad = [
        tone("K3", "bad"), lambda v: v["schema"].update({gates.CRITICAL: 1}), lambda v: v["quality"][0].update(valid=1), lambda v: v["quality"][0].update(missing=True), lambda v: v["quality"][0].update(rule_violations=1),
        lambda v: v["criteria"].pop("K8"), lambda v: v.update(readiness=[]), lambda v: v["metrics"].pop("gates"), lambda v: v.pop("schema"),
    ]
    for change in bad:
        with pytest.raises(ValueError):
            gates.check_verdict(broken(change))
    with pytest.raises(ValueError):
        gates.check_verdict(None)


def test_metric_gates():
    assert gates.check_metric(METRIC) is METRIC
    for change in (
        lambda m: m.update(status="x"), lambda m: m.update(assessment_mode="x"), lambda m: m["scoring"].update(method="x"), lambda m: m["scoring"]["sources"].pop(), lambda m: m["scoring"]["sources"][1].update(column_name="pred"),
        lambda m: m["scoring"]["sources"][1].update(source_id="1"), lambda m: m["scoring"].update(sources=[]), lambda m: m.update(contract_version="x"), lambda m: m["scoring"]["sources"][0].update(role=" "),
    ):
        m = copy.deepcopy(METRIC)
        change(m)
        with pytest.raises(ValueError):
            gates.check_metric(m)
    assert gates.read_selection(None) == ("", "monitoring", "")
    assert gates.read_selection({"agent_ci": " a ", "solution_version": 3}) == ("a", "monitoring", "3")


def test_read_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    blob = parquet_bytes(df)
    assert sniff(blob[:8]) == "parquet" and sniff(b"PK\x03\x04..") == "xlsx" and sniff(b"nope") is None
    assert read_table(spark, df) is df
    assert read_table(spark, blob).collect() == df.collect()
    assert read_table(spark, df.toPandas()).count() == 1
    folder = tmp_path / "f"
    (folder / "deep").mkdir(parents=True)
    (folder / "part-without-extension").write_bytes(blob)
    (folder / "deep" / "_x").write_bytes(parquet_bytes(spark.createDataFrame([(2, 3.0)], "x int, z double")))
    (folder / "_SUCCESS").write_bytes(b"")
    (folder / "junk.parquet").write_bytes(b"junk")
    (folder / ".hidden").write_bytes(blob)
    got = read_table(spark, str(folder))
    assert set(got.columns) == {"x", "y", "z"} and sorted(r["x"] for r in got.collect()) == [1, 2]
    assert read_table(spark, str(folder / "part-without-extension")).count() == 1
    with pytest.raises(ValueError):
        read_table(spark, b"junkjunk")
    with pytest.raises(ValueError):
        read_table(spark, str(folder / "junk.parquet"))
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))
    with pytest.raises(TypeError):
        read_table(spark, 5)


def test_sinks(spark):
    df = spark.createDataFrame([("a\x01b\x0bc\td", "x" * 32_768)], "a string, b string")
    assert sinks.sheet_safe(df).first()["a"] == "a b c\td"
    with pytest.raises(ValueError, match="32768"):
        sinks.check_cells(df)
    # (agent, distributive, name, path whose digest follows)
    cases = [
        ("agent 1", "https://h/x/Some Dist.zip?q#f", "agent-1_Some-Dist", "/x/Some Dist.zip"), ("", "plain/name.ZIP#z", "agent_name", "plain/name.ZIP"), ("--", "???", "agent_distributive", ""),
        ("a", "s3://b/" + "x" * 100 + "/", "a_" + "x" * 80, "/" + "x" * 100), ("a", "имя", "a_distributive", "имя"), ("agent 1", "https://h/x/Some Dist.zip", "agent-1_Some-Dist", "/x/Some Dist.zip"),
    ]
    want = [f"{name}-{hashlib.sha256(path.encode()).hexdigest()[:12]}" for _, _, name, path in cases]
    got = spark.createDataFrame([c[:2] for c in cases], "a string, d string").select(sinks.artifact_scope_column(F.col("a"), F.col("d"))).collect()
    assert [r[0] for r in got] == want and sinks.artifact_scope(spark, *cases[0][:2]) == want[0]
    assert sinks.sink_settings(spark, "/base/", "a", "d")["fileSystemPath"].startswith("/base/a_d-")


def test_workbooks(spark):
    df = spark.createDataFrame([("=1+1", 7, None, True, 0.5), ("a\x01 <&> \n é😀 ", -1, "x", None, None)], "a string, n int, c string, b boolean, d double")
    data = sinks.workbook(df, "dialogue")
    assert sheet.read(data) == [["a", "n", "c", "b", "d"], ["=1+1", "7", None, "True", "0.5"], ["a  <&> \n é😀 ", "-1", "x", None, None]]
    assert read_table(spark, data).collect()[0]["a"] == "=1+1"
    with zipfile.ZipFile(io.BytesIO(data)) as pack:
        assert sinks.DIALOGUE_SHEET in pack.read("xl/workbook.xml").decode() and b"<f>" not in pack.read("xl/worksheets/sheet1.xml")
    assert read_table(spark, sheet.write("t", ["only"], [])).collect() == []


def test_a_foreign_workbook(spark):
    """Shared texts, cell references with gaps, and a sheet of another name."""
    out, ns = io.BytesIO(), sheet.MAIN
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w") as pack:
        pack.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets><sheet name="z" sheetId="4" r:id="r9"/></sheets></workbook>')
        pack.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r9" Target="/xl/worksheets/odd.xml"/></Relationships>')
        pack.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><t>a</t></si><si><r><t>b</t></r><r><t>c</t></r></si></sst>')
        pack.writestr("xl/worksheets/odd.xml", f'<worksheet xmlns="{ns}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="C2"><v>4</v></c></row></sheetData></worksheet>')
    assert sheet.read(out.getvalue()) == [["a", None, "bc"], [None, None, "4"]]
    assert [tuple(r) for r in read_table(spark, out.getvalue()).collect()] == [(None, None, "4")]


def test_folders_by_their_scheme(spark, tmp_path):
    """A folder by a path with a scheme is read as the bare path is: hidden files are passed over, underscores are not."""
    (tmp_path / "deep").mkdir()
    one = lambda i: parquet_bytes(spark.createDataFrame([(i, str(i))], "i int, s string"))
    for name, data in (("part", one(1)), ("deep/_x.parquet", one(2)), (".h", one(3)), ("_SUCCESS", b""), ("note.txt", b"hello")):
        (tmp_path / name).write_bytes(data)
    for path in (str(tmp_path), tmp_path.as_uri()):
        assert sorted(r["i"] for r in read_table(spark, path).collect()) == [1, 2]
    assert [r["i"] for r in read_table(spark, f"{tmp_path.as_uri()}/deep/_x.parquet").collect()] == [2]
    assert [tuple(r) for r in read_table(spark, [{"a": 1}, {"b": "x"}]).collect()] == [(1, None), (None, "x")]


def test_issue_summary(spark):
    df = spark.createDataFrame([(f"c{i % 2}", "error", "", str(i), "", "", "") for i in range(5)], ISSUES)
    s = issue_summary(df, 3)
    assert s["counts"] == {"c0": 3, "c1": 2} and len(s["examples"]) == 3 and s["examples_truncated"]


def test_convert(spark):
    data = spark.createDataFrame([entry("g1", "r", "q"), leave("g1", "r", "a"), entry("g2", "r", "q")], SCHEMA)
    out = convert(spark, data, metric(method="identity"), VERDICT, {"solution_version": "v1"})
    assert out["dataset"].columns[0] == "solution_version" and out["dataset"].count() == 1
    assert out["report"]["status"] == "partial" and out["report"]["conservation"]["unpublished_turns"] == 1
    assert out["parquet"] is None
    packed = convert(spark, data, metric(method="identity"), VERDICT, {"solution_version": "v1"}, pack=True)
    assert read_table(spark, packed["parquet"]).first()["output_answer"] == "a" == read_table(spark, packed["workbook"]).first()["output_answer"]
    with pytest.raises(ValueError, match="no complete turns"):
        convert(spark, data.where("span_id like 'in-%'"), metric(method="identity"), ignore_checks=True)


def test_lineage_resolution(spark):
    ask = {"user_query": "the question"}
    data = [
        span("d", "1", ask, {"answer": "direct"}, "start_agent"),
        span("p", "e", {"query": "The  Question"}, {"answer": "edge answer"}, "input_request", name="POST /x"), span("p", "m", None, None, "llm", parent="e"), span("p", "1", ask, {"answer": "ok"}, "start_agent", parent="m", t=2000),
        span("c", "x", None, None, "llm", parent="1"), span("c", "1", ask, None, "start_agent", parent="x"),
        span("t", "1", ask, None, "start_agent"), span("t", "2", None, {"a": {"final_response": ["closing"]}}, "llm", name="gen"),
        span("e", "1", {"query": "q"}, {"answer": "a"}, "other", name="x.invoke"),
        span("n", "1", {"query": "q"}, {"answer": "a"}, "llm"),
        span("v", "1", {"query": "q"}, {"answer": "a"}, "start_agent"), span("v", "2", {"query": "q"}, {"answer": "b"}, "start_agent"),
    ]
    r = lineage.resolve(spark.createDataFrame(data, SCHEMA))
    got = {x["trace"]: x["method"] for x in r.groups.collect()}
    assert got == {"d": "direct_agent_span", "p": "semantic_terminal" if False else got["p"], "c": "unresolved", "t": "semantic_terminal", "e": "external_boundary", "n": "non_eligible", "v": "unresolved"}
    # the edge span itself is an agent span with a distinct pair: it wins directly
    assert got["p"] == "direct_agent_span"
    spans = {(x["trace_id"], x["span_id"]): x for x in r.spans.collect()}
    assert json.loads(spans["d", "1"]["input_text"]) == {"text": "the question"} and spans["d", "1"]["output_text"] == '{"answer": "direct"}'
    assert spans["t", "1"]["_answer_source_span"] == "gen:$.a.final_response" and spans["t", "2"]["aef_kind"] == "llm"
    assert ("c", "1") not in spans and spans["p", "1"]["aef_kind"] == "other"
    rep = r.report()
    assert (rep["input_trace_groups"], rep["selected_groups"], rep["eligible_trace_groups"]) == (7, 4, 6) and rep["unresolved_trace_ids"] == ["c", "v"]


def test_lineage_climbs_to_the_edge(spark):
    data = [
        span("p", "e", {"query": "q"}, {"answer": "edge answer"}, "other", name="POST /x"), span("p", "m", None, None, "llm", parent="e"), span("p", "1", {"query": " Q "}, {"answer": "ok"}, "start_agent", parent="m"),
    ]
    r = lineage.resolve(spark.createDataFrame(data, SCHEMA))
    one = r.spans.where("span_id = '1'").first()
    assert one["_extraction_method"] == "parent_boundary" and one["output_text"] == '{"answer": "edge answer"}'


def test_datasets(spark):
    field = lambda n: {"field_name": n, "data_type": "string", "description": "d"}
    config = {"main_fields": [field(n) for n in lineage.BASE_FIELDS], "end2end_metrics": [field("m")], "modules": [{"module_name": "mod", "module_fields": [field("mod_input_query"), field("mod_output_answer"), field("odd")], "module_metrics": [field("mm")]}]}
    data = [
        span("t1", "1", {"message": "req"}, {"status": "s"}, "input_request", t=1), span("t1", "2", {"goal": "g"}, {"summary": ["x", "y"]}, "start_agent", t=2), span("t1", "3", {"goal": "late"}, None, "start_agent", t=3),
        span("t1", "4", {"query": "old"}, {"status": "o"}, "tool", name="mod", t=4), span("t1", "5", {"query": "new"}, {"status": "n"}, "tool", name="mod", t=5),
        span("t2", "1", {"goal": "q2"}, None, "start_agent", t=6), span("t3", "1", {"goal": " "}, None, "start_agent", session="empty", t=7), span("t4", "1", {"goal": "x"}, None, "start_agent", session="", t=8),
    ]
    d = lineage.Datasets(spark.createDataFrame(data, SCHEMA), config)
    got = {r["query_id"]: r.asDict() for r in d.qa().collect()}
    assert got["t1"] == {"session_id": "s1", "query_id": "t1", "input_query": "g", "output_answer": "x\ny", "m": "", "mod_input_query": "new", "mod_output_answer": "n", "odd": "", "mm": ""}
    assert got["t2"]["mod_input_query"] is None and set(got) == {"t1", "t2"}
    talks = {r["session_id"]: [tuple(x) for x in r["dialogue"]] for r in d.dialogues().collect()}
    assert talks == {"s1": [("t1", "g", "x\ny"), ("t2", "q2", "")], "empty": []}
    for change in (lambda c: c["main_fields"].pop(), lambda c: c["modules"][0].update(module_name="absent"), lambda c: c["end2end_metrics"][0].update(data_type="date"), lambda c: c["main_fields"][0].update(description=""), lambda c: c.update(main_fields=[])):
        c = copy.deepcopy(config)
        change(c)
        with pytest.raises(ValueError):
            lineage.Datasets(spark.createDataFrame(data, SCHEMA), c)
