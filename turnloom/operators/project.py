"""Turns to datasets: one row a turn, or one row a session with its turns in order."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefold, strip
from ..plans.schemas import CONTRACT, TURNS, ProjectionError

PROJECTION_CONTRACT, PROFILE_CONTRACT = "turn-projection.v1", "dataset-profile.v1"
#: Names that a prediction or target column must not take.
RESERVED = frozenset(("session_id", "query_id", "input_query", "output_answer", "scenario", "input_query_count", "reference_group_id", "turn_index"))
REPEATED_SHARE, REPEATED_LEAST = 0.01, 5
#: One turn of a packed dialogue.
TRIPLE = "struct<query_id:string,input_query:string,output_answer:string>"


@dataclass(frozen=True)
class Projection:
    result: DataFrame
    report: dict[str, Any]
    profile: dict[str, Any]


def flat(turns: DataFrame) -> DataFrame:
    """One row a turn, with `entry_time` and `route_path` for what comes after."""
    return turns.select(
        strip(F.coalesce("route_label", F.lit(""))).alias("scenario"),
        "session_id",
        F.col("turn_id").alias("query_id"),
        F.lit(1).alias("input_query_count"),
        strip(F.col("input_query")).alias("input_query"),
        strip(F.col("agent_response")).alias("output_answer"),
        F.coalesce("entry_time_ns", F.lit(0)).alias("entry_time"),
        F.col("route_source_path").alias("route_path"),
    )


FLAT = ("scenario", "session_id", "query_id", "input_query_count", "input_query", "output_answer")


def pack(rows: DataFrame) -> DataFrame:
    """(session_id, dialogue, scenario, n_scenarios): a session's turns by time and id, as an array of TRIPLE."""
    item = F.struct("entry_time", "query_id", "input_query", "output_answer")
    order = F.struct("entry_time", "query_id")
    by = rows.groupBy("session_id").agg(F.array_sort(F.collect_list(item)).alias("items"), F.min_by("scenario", order).alias("scenario"), F.count_distinct("scenario").alias("n_scenarios"))
    dialogue = F.transform("items", lambda t: F.struct(t["query_id"].alias("query_id"), t["input_query"].alias("input_query"), t["output_answer"].alias("output_answer")))
    return by.select("session_id", dialogue.cast(f"array<{TRIPLE}>").alias("dialogue"), "scenario", "n_scenarios")


def dialogue_text(dialogue: Column | str) -> Column:
    """A dialogue as the Python literal of a list of triples."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if d is None else repr([tuple(t.values()) for t in d]) for d in column.to_pylist()], pa.string())

    return run(dialogue)


def repeated_answers(rows: DataFrame, n_result: int) -> DataFrame:
    """(output_answer, n) of the answers given at least max(1 % of the result's rows, 5) times."""
    counts = rows.groupBy("output_answer").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= max(n_result * REPEATED_SHARE, REPEATED_LEAST))


def canonicalize(turns: DataFrame, metric: dict[str, Any], report: dict[str, Any]) -> Projection:
    """Project complete turns by a checked metric; an extraction's report must vouch for them."""
    if report.get("contract_version") != CONTRACT:
        raise ProjectionError("the extraction report has an unknown contract")
    missing = sorted(set(TURNS.names) - set(turns.columns))
    if missing:
        raise ProjectionError(f"the turns lack {missing}")
    needed = ("turn_id", "session_id", "input_query", "agent_response")
    blank = lambda c: F.coalesce(strip(F.col(c)) == "", F.lit(True))
    one = turns.agg(
        F.count("*").alias("n"), *[F.count_if(blank(c)).alias(f"blank_{c}") for c in needed], F.count_distinct("session_id").alias("sessions"),
        F.count_if(blank("route_label")).alias("no_route"), F.array_sort(F.collect_set(F.coalesce("route_source_path", F.lit("")))).alias("paths"),
    ).first()
    if not one["n"]:
        raise ProjectionError("no complete turns")
    for c in needed:
        if one[f"blank_{c}"]:
            raise ProjectionError(f"{c} has blank values")
    if not turns.groupBy("session_id", "turn_id").count().where("count > 1").isEmpty():
        raise ProjectionError("(session_id, turn_id) repeats")
    asked, complete = report.get("candidate_turn_keys"), report.get("complete_turns")
    if complete != one["n"]:
        raise ProjectionError(f"the report has {complete} complete turns, the table {one['n']}")
    if not isinstance(asked, int) or asked < complete:
        raise ProjectionError("candidate_turn_keys contradicts complete_turns")
    mode, method = metric["assessment_mode"], metric["scoring"]["method"]
    rows = flat(turns)
    column = mapping = None
    lacking: list[str] = []
    reference: list[str] = []
    if method == "accuracy":
        names = {s["role"]: s["column_name"].strip() for s in metric["scoring"]["sources"]}
        column, target = names["prediction"], names["target"]
        if column in RESERVED and column != "scenario":
            raise ProjectionError(f"the prediction column {column!r} is a dataset field")
        if target in RESERVED:
            raise ProjectionError(f"the target column {target!r} is a dataset field")
        reference.append(target)
        if one["no_route"]:
            lacking.append(column)
            column = None
        else:
            mapping = {"column_name": column, "source": "route_label", "source_paths": list(one["paths"])}
    if mode == "dialogue":
        packed = pack(rows)
        constant = packed.where("n_scenarios > 1").isEmpty()
        result = packed.select(*(["scenario"] if constant else []), "session_id", dialogue_text("dialogue").alias("dialogue"), F.col("scenario").alias("__p"))
        if column is not None and constant and column != "scenario":
            result = result.withColumn(column, F.col("__p"))
        elif column is not None and not constant:
            lacking.append(column)
            mapping = None
        result = result.drop("__p")
        n = one["sessions"]
    else:
        result = rows.select(*FLAT, *([F.col("scenario").alias(column)] if column not in (None, "scenario") else []))
        n = one["n"]
    repeated = repeated_answers(rows, n).agg(F.count("*").alias("values"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    echo = rows.where(casefold(F.col("input_query")) == casefold(F.col("output_answer"))).count()
    return Projection(
        result,
        {
            "contract_version": PROJECTION_CONTRACT,
            "assessment_mode": mode,
            "rows": n,
            "groups": one["sessions"],
            "candidate_turn_keys": asked,
            "complete_turns": complete,
            "source_coverage": complete / asked if asked else 0.0,
            "response_semantics": "final_agent_response",
            "route_semantics": "separate_observed_label",
            "prediction_mapping": mapping,
            "missing_scoring_sources": lacking,
            "reference_only_sources": reference,
            "ready_for_scoring": not lacking,
            "weight_policy": "one_per_observed_dialogue" if mode == "dialogue" else "one_per_observed_turn",
        },
        {"contract_version": PROFILE_CONTRACT, "rows": n, "exact_echo_pairs": echo, "repeated_answer_rows": repeated["rows"], "repeated_answer_values": repeated["values"], "policy": "observe_without_rewriting"},
    )
