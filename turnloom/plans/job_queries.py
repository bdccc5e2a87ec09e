"""Registered queries of the job round the extraction: failing gates, forms of payloads, lineage, projection, tables, conversion.

As in `queries`, oracles are written over the conversations and share nothing with the engine.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import AGENT, climbing_spans, question_answer, spans_from_conversations, with_failing_gates
from ..functions.ladders import ANSWER_KEYS, NESTED_QUERY_KEYS, QUERY_KEYS, request, response
from ..functions.payload import payload
from ..functions.tables import shared_dir
from ..operators import lineage
from ..operators.project import canonicalize, dialogue_text, flat, pack
from ..sources import sheet
from ..sources.tables import parquet_bytes, read_table
from .convert import convert, issue_summary
from .extract import Config, Extraction, extract_turns, metrics, ordered
from .gates import check_metric, check_verdict, read_selection
from .schemas import ExtractionError, ProjectionError

METRIC = {"contract_version": "monitoring-metric.v2", "status": "computed", "assessment_mode": "qa", "scoring": {"method": "accuracy", "sources": [{"source_id": "p", "role": "prediction", "column_name": "route"}, {"source_id": "t", "role": "target", "column_name": "wanted"}]}}


def _extraction(spark: SparkSession, sf_dir: str) -> Extraction:
    return extract_turns(spans_from_conversations(spark, sf_dir), Config(AGENT, None))


def _faulty(spark: SparkSession, sf_dir: str) -> Extraction:
    return extract_turns(with_failing_gates(spans_from_conversations(spark, sf_dir)), Config(AGENT, None))


def _numbers(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    return spark.createDataFrame([(k, None if v is None else float(v)) for k, v in values.items()], "metric string, value double")


# --- gates that fail -----------------------------------------------------------


def q_faulty_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faulty(spark, sf_dir).exchange_pairs.select("turn_id", "outcome", "partial")


def q_faulty_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faulty(spark, sf_dir).turns.select("turn_id", "session_id", "route_label", "same_session", "turn_latency_ms")


def q_faulty_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faulty(spark, sf_dir).issues.select("issue_code", "severity", "turn_id", "trace_id", "span_id", "details")


def q_faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries and exits by their completeness."""
    entries, exits = _faulty(spark, sf_dir).events
    return entries.select(F.lit("entry").alias("side"), "state").union(exits.select(F.lit("exit"), "state")).groupBy("side", "state").agg(F.count("*").alias("n"))


def q_retracted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-sided exchanges that a fallback has published."""
    return _faulty(spark, sf_dir).resolved


# --- forms of payloads -----------------------------------------------------------


def _quoted(c: Column) -> Column:
    """A JSON text of a text, by hand."""
    return F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def q_payload_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question as JSON, as JSON in JSON, three encodings deep, as a Python literal, four deep (not undone), and as bare text."""
    rows = question_answer(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    once = F.to_json(F.struct(F.col("text").alias("query")))
    twice, thrice = _quoted(once), _quoted(_quoted(once))
    inner = F.replace(F.replace(F.replace(F.col("text"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("\n"), F.lit("\\n"))
    literal = F.concat(F.lit("{'query': '"), inner, F.lit("', 'n': (1, None)}"))
    form = (F.col("c") + F.col("k")) % 6
    text = F.when(form == 0, once).when(form == 1, twice).when(form == 2, thrice).when(form == 3, literal).when(form == 4, _quoted(thrice)).otherwise(F.concat(F.lit("so: "), "text"))
    found = rows.select("c", "k", payload(text).alias("p")).select("c", "k", F.col("p.shape").alias("shape"), request(F.col("p")).alias("q"))
    return found.select("c", "k", "shape", F.when(F.col("shape") != "deep", F.col("q.text")).alias("text"), F.col("q.path").alias("path"))


_REQUESTS = [*QUERY_KEYS, "messages", "body", *(f"body.{k}" for k in NESTED_QUERY_KEYS), "request", *(f"request.{k}" for k in NESTED_QUERY_KEYS)]
_RESPONSES = [*ANSWER_KEYS, "messages", *(f"body.{k}" for k in ANSWER_KEYS), "body", *(f"response.body.{k}" for k in ANSWER_KEYS), *(f"response.{k}" for k in ANSWER_KEYS), "response.body"]


def _on_rung(rung: str, text: Column, role: str) -> Column:
    """JSON that holds the text on one rung of a ladder."""
    if rung == "messages":
        message = lambda r, t: F.struct(F.lit(r).alias("role"), t.alias("content"))
        return F.to_json(F.struct(F.array(message(role, F.lit("earlier")), message("system", F.lit("other")), message(role, text), message("tool", F.lit("later"))).alias("messages")))
    for key in reversed(rung.split(".")):
        text = F.struct(text.alias(key))
    return F.to_json(text)


def _rungs(spark: SparkSession, sf_dir: str, rungs: list[str], role: str, ladder: Any) -> DataFrame:
    rows = question_answer(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    made = F.lit(None).cast("string")
    for i, rung in enumerate(rungs):
        made = F.when((F.col("c") + F.col("k")) % len(rungs) == i, _on_rung(rung, F.col("text"), role)).otherwise(made)
    found = rows.select("c", "k", payload(made).alias("p")).select("c", "k", ladder(F.col("p")).alias("x"))
    return found.select("c", "k", "x.text", "x.path")


def q_request_rungs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rungs(spark, sf_dir, _REQUESTS, "human", request)


def q_response_rungs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rungs(spark, sf_dir, _RESPONSES, "ai", response)


# --- results and their orders ------------------------------------------------------


def q_first_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 turns in order: the cap is the feature."""
    return ordered(_extraction(spark, sf_dir).turns).limit(20).select("turn_id", "session_id", "entry_time_ns")


def q_issue_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 issues in order (the cap is the feature), and counts by code."""
    found = issue_summary(_faulty(spark, sf_dir).issues)
    rows = [(f"{i:03d}", e["issue_code"], e["trace_id"], e["turn_id"]) for i, e in enumerate(found["examples"])]
    rows += [("count", code, str(n), "") for code, n in found["counts"].items()]
    return spark.createDataFrame(rows, "place string, issue_code string, trace_id string, turn_id string")


def q_dialogue_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed dialogues as literals of a list of triples; texts without quotes, backslashes and control characters, which SQL can quote."""
    rows = pack(flat(_extraction(spark, sf_dir).turns.withColumns({c: F.translate(c, "'\\\n\t\r", "") for c in ("input_query", "agent_response")})))
    return rows.select("session_id", dialogue_text("dialogue").alias("dialogue"))


def q_projection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of a projection's report and profile."""
    x = _extraction(spark, sf_dir)
    made = canonicalize(x.turns, METRIC | {"assessment_mode": "dialogue"}, x.report)
    keys = ("rows", "groups", "candidate_turn_keys", "complete_turns", "source_coverage", "ready_for_scoring")
    values = {k: made.report[k] for k in keys} | {k: made.profile[k] for k in ("exact_echo_pairs", "repeated_answer_rows", "repeated_answer_values")}
    return _numbers(spark, values | {f"missing {c}": 1 for c in made.report["missing_scoring_sources"]})


def q_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset of a whole conversion."""
    return _convert(spark, sf_dir)["dataset"]


def _convert(spark: SparkSession, sf_dir: str) -> dict[str, Any]:
    return convert(spark, spans_from_conversations(spark, sf_dir), METRIC, selection={"agent_ci": f" {AGENT.lower()} ", "distributive": "https://host/a b/agent.ZIP?x=1", "solution_version": "v7"}, ignore_checks=True)


def q_conversion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a whole conversion: what is conserved, issues by code, strategies, status and sink."""
    made = _convert(spark, sf_dir)
    report = made["report"]
    values: dict[str, Any] = dict(report["conservation"])
    values |= {f"issues {k}": v for k, v in report["issues"]["counts"].items()} | {f"turns {k}": v for k, v in report["extraction"]["strategies"].items()}
    values |= {f"status {report['status']}": 1, f"ready {report['ready_for_scoring']}": 1, f"mode {report['assessment_mode']}": 1, f"path {made['settings']['fileSystemPath']}": 1}
    return _numbers(spark, values)


# --- lineage ---------------------------------------------------------------------


def _resolution(spark: SparkSession, sf_dir: str) -> lineage.Resolution:
    return lineage.resolve(spans_from_conversations(spark, sf_dir), AGENT)


def q_lineage_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of the resolved traces, their carriers as started agents."""
    spans = _resolution(spark, sf_dir).spans
    said = lambda c, k: F.when(F.col("_extraction_method") != "", F.get_json_object(c, f"$.{k}")).otherwise("")
    return spans.select("span_id", "aef_kind", said("input_text", "text").alias("q"), said("output_text", "answer").alias("a"), F.col("_extraction_method").alias("method"), F.col("_answer_source_span").alias("source"))


def q_lineage_first_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 resolved spans in order: the cap is the feature."""
    return _resolution(spark, sf_dir).ordered().limit(50).select("session_id", "trace_id", "span_id")


def q_lineage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _resolution(spark, sf_dir).report()
    values = {k: report[k] for k in ("input_trace_groups", "overall_selected_rate", "eligible_trace_groups", "selected_groups", "coverage", "unresolved_ids_truncated")}
    values |= {f"method {k}": v for k, v in report["methods"].items()} | {f"unresolved {t}": i for i, t in enumerate(report["unresolved_trace_ids"])}
    return _numbers(spark, values)


def q_lineage_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents whose caller, two to four levels up, has the same question and the answer."""
    found = lineage.resolve(climbing_spans(spark, sf_dir), AGENT).groups
    return found.select("trace", "method", F.coalesce("won.q", F.lit("")).alias("q"), F.coalesce("won.a", F.lit("")).alias("a"))


# --- tables ----------------------------------------------------------------------


def q_blob_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table as one Parquet blob and back."""
    return read_table(spark, parquet_bytes(spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def q_workbook_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table as a workbook and back, as text."""
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return read_table(spark, sheet.write("one", rows.columns, map(tuple, rows.toLocalIterator())))


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(data))
    out.close()


def q_folder_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of parts that lie at several depths, one without a suffix, one whose name begins with an underscore and one workbook,
    beside a marker, a hidden file and a note."""
    rows = spark.read.parquet(f"{sf_dir}/region.parquet").select(F.col("r_regionkey").cast("string").alias("r_regionkey"), "r_name")
    root = f"{shared_dir(spark).rstrip('/')}/folder-{uuid.uuid4().hex}"
    part = lambda i: rows.where(F.col("r_regionkey") % 4 == i)
    for i, name in enumerate(("a.parquet", "deep/er/part", "deep/_part.parquet")):
        _put(spark, f"{root}/{name}", parquet_bytes(part(i)))
    _put(spark, f"{root}/deep/book", sheet.write("s", rows.columns, map(tuple, part(3).toLocalIterator())))
    for name in ("_SUCCESS", ".hidden.parquet", "note.txt"):
        _put(spark, f"{root}/{name}", parquet_bytes(rows) if "hidden" in name else b"")
    return read_table(spark, root).select("r_regionkey", "r_name")


def q_table_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each unusable input of the job is answered with."""
    good = spans_from_conversations(spark, sf_dir)
    turns = lambda: extract_turns(good, Config(AGENT)).turns
    cases = {
        "table: a number": lambda: read_table(spark, 7),
        "table: bytes of no format": lambda: read_table(spark, b"text"),
        "table: no such file": lambda: read_table(spark, f"{sf_dir}/none.parquet"),
        "spans: a column less": lambda: extract_turns(good.drop("aef_kind"), Config(AGENT)).agent_rows,
        "spans: two agents": lambda: extract_turns(good).agent_rows,
        "spans: unknown agent": lambda: extract_turns(good, Config("nobody")).agent_rows,
        "config: no examples": lambda: Config(AGENT, 0),
        "convert: no spans": lambda: convert(spark, good.limit(0), METRIC, ignore_checks=True),
        "project: unknown contract": lambda: canonicalize(turns(), METRIC, {}),
        "lineage: no spans": lambda: lineage.resolve(good.limit(0)),
        "lineage: no agent column": lambda: lineage.resolve(good.drop("agent_id")),
        "dataset: no main fields": lambda: lineage.check_config({}, good),
        "metric: unknown method": lambda: check_metric(METRIC | {"scoring": METRIC["scoring"] | {"method": "luck"}}),
        "metric: a role twice": lambda: check_metric(METRIC | {"scoring": METRIC["scoring"] | {"sources": [*METRIC["scoring"]["sources"], {"source_id": "q", "role": "target", "column_name": "z"}]}}),
        "metric: as it should be": lambda: check_metric(METRIC),
        "verdict: none": lambda: check_verdict(None),
        "verdict: bypassed": lambda: check_verdict(None, True),
        "verdict: passes": lambda: check_verdict(_verdict()),
        "verdict: K3 is bad": lambda: check_verdict(_verdict(K3="bad")),
        "verdict: K7 is bad": lambda: check_verdict(_verdict(K7="bad")),
        "selection: a list": lambda: read_selection([]),
        "selection: none": lambda: read_selection(None),
    }
    return spark.createDataFrame([(name, _answer(case)) for name, case in cases.items()], "input string, answer string")


def _answer(case: Any) -> str:
    for kind in (ExtractionError, ProjectionError, FileNotFoundError, TypeError, ValueError):
        try:
            case()
        except kind as e:
            if type(e) is kind:
                return kind.__name__
        except Exception:  # noqa: BLE001, S112 - the next kind is tried
            continue
        else:
            return "accepted"
    return "other"


def _verdict(**tones: str) -> dict[str, Any]:
    counts = dict.fromkeys(("null_violations", "missing", "trash_cells", "rule_violations", "blocking_rule_violations", "advisory_rule_violations", "duplicate_keys", "trace_breaks"), 0)
    criteria = {f"K{i}": {"tone": tones.get(f"K{i}", "good"), "result": "r", "title": "t"} for i in range(1, 9)}
    return {"schema": {"критичных нарушено": 0}, "quality": [counts | {"valid": True}], "criteria": criteria, "readiness": [{"verdict": "ready"}], "metrics": {"policy": {}, "gates": {}}}


def q_faulty_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("malformed_entry_rows", "malformed_exit_rows", "failures_without_text", "session_mismatches", "resolved_entries", "resolved_exits", "parent_boundary_candidate_turns", "parent_boundary_complete_turns", "fipa_complete_turns", "pair_keys")
    return metrics(_faulty(spark, sf_dir)).where(F.col("metric").isin(*names))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}
