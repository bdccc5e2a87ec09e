"""The whole job: check the configuration, read, extract, project, pack and report."""

from __future__ import annotations

from time import perf_counter
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.project import canonicalize
from ..sources.sinks import sink_settings, workbook
from ..sources.tables import parquet_bytes, read_table
from .extract import Config, extract_turns
from .gates import METRIC_CONTRACT, check_metric, check_verdict, read_selection
from .schemas import ExtractionError

REPORT_CONTRACT = "trace-conversion.v1"
MAX_EXAMPLES = 100
#: A worksheet holds so many rows, its header among them.
MAX_PACKED = 1_048_575


def issue_summary(issues: DataFrame, limit: int = MAX_EXAMPLES) -> dict[str, Any]:
    """Counts by code, and the first examples by code, trace and turn."""
    counts = {r["issue_code"]: r["count"] for r in issues.groupBy("issue_code").count().orderBy("issue_code").collect()}
    examples = [r.asDict() for r in issues.orderBy("issue_code", "trace_id", "turn_id", "span_id", "details").limit(limit).collect()]
    return {"counts": counts, "examples": examples, "examples_truncated": sum(counts.values()) > limit}


def convert(
    spark: SparkSession,
    traces: object,
    metric: dict,
    verdict: dict | None = None,
    selection: dict | None = None,
    ignore_checks: bool = False,
    output_base: str = "traces_based_datasets",
    metric_contract: str = METRIC_CONTRACT,
    pack: bool = False,
) -> dict[str, Any]:
    """{dataset, report, issues, counterparts, parquet, workbook, settings}; without `pack` the two blobs are None.

    `issues` and `counterparts` are frames of all rows: the report counts them all and shows the first of them.
    Blobs are made in this process, of at most MAX_PACKED rows; larger results are written with `dataset.write`.
    """
    if not isinstance(ignore_checks, bool):
        raise ValueError("ignore_checks must be a boolean")
    metric = check_metric(metric, metric_contract)
    checked = check_verdict(verdict, ignore_checks)
    agent, distributive, version = read_selection(selection)
    clock = [perf_counter()]
    spans = read_table(spark, traces, "traces")
    clock.append(perf_counter())
    found = extract_turns(spans, Config(agent, None))
    try:
        report = found.report
    except ExtractionError:
        # asked only now: where rows are derived, the first of them may cost as much as all
        if spans.isEmpty():
            raise ExtractionError("the span table is empty") from None
        raise
    clock.append(perf_counter())
    if not report["complete_turns"]:
        raise ExtractionError("no complete turns: " + ", ".join(f"{k}={report[k]}" for k in ("candidate_turn_keys", "entry_without_exit", "exit_without_entry", "unsupported_trace_count")))
    open_turns = report["candidate_turn_keys"] - report["complete_turns"]
    partial = bool(open_turns or report["unsupported_trace_count"] or report["conflicting_entry_keys"] or report["conflicting_exit_keys"])
    projected = canonicalize(found.turns, metric, report)
    clock.append(perf_counter())
    dataset = projected.result.select(F.lit(version).alias("solution_version"), "*") if version else projected.result
    parquet = book = None
    if pack:
        if projected.report["rows"] > MAX_PACKED:
            raise ValueError(f"{projected.report['rows']} rows are too many to pack; write the dataset instead")
        parquet = parquet_bytes(dataset)
        book = workbook(dataset, metric["assessment_mode"])
    clock.append(perf_counter())
    lacking = projected.report["missing_scoring_sources"]
    warnings = [f"not ready for direct scoring: missing {', '.join(lacking)}"] * bool(lacking) + ["partial: only proven complete turns are published"] * partial
    seconds = [round(b - a, 3) for a, b in zip(clock, clock[1:], strict=False)]
    return {
        "dataset": dataset,
        "issues": found.issues,
        "counterparts": found.counterparts,
        "parquet": parquet,
        "workbook": book,
        "settings": sink_settings(spark, output_base, report["agent_id"], distributive),
        "report": {
            "contract_version": REPORT_CONTRACT,
            "status": "partial" if partial else "complete" if projected.report["ready_for_scoring"] else "not_ready",
            "agent_id": report["agent_id"],
            "assessment_mode": metric["assessment_mode"],
            "ready_for_scoring": projected.report["ready_for_scoring"],
            "warnings": warnings,
            "traces_validation": checked,
            "semantics": {
                "input_query": "user transport text",
                "output_answer": "final agent response",
                "scenario": "observed routing label, separate from the answer",
                "unknown_schema_policy": "report_and_publish_complete_turns",
            },
            "stage_timings_seconds": dict(zip(("read_input", "extract_turns", "canonicalization", "serialization"), seconds, strict=True)) | {"total": round(clock[-1] - clock[0], 3)},
            "conservation": {
                "candidate_turn_keys": report["candidate_turn_keys"],
                "published_turns": report["complete_turns"],
                "published_rows": projected.report["rows"],
                "unpublished_turns": open_turns,
                "extraction_coverage": report["extraction_coverage"],
            },
            "extraction": report,
            "issues": issue_summary(found.issues),
            "semantic_profile": projected.profile,
            "canonicalization": projected.report,
        },
    }
