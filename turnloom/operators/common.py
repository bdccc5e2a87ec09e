"""Row builders shared by the strategies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.schemas import FAMILY, ISSUES, TURNS

#: A request's HTTP verb and path, or an invoke call.
HTTP = r"(?i)^(?:get|post|put|patch|delete)\s+\S+|(?:^|[./])invoke$"
MARKER = r"""["'](?:conversation_id|reply_with|in_reply_to)["']"""


def turn(**values: Column) -> list[Column]:
    """The columns of TURNS, in order and type."""
    return [values[f.name].cast(f.dataType).alias(f.name) for f in TURNS]


def local_turn(version: str | Column, prefix: str, trace: Column, span: Column, id_span: Column, **values: Column) -> list[Column]:
    """A turn whose two ends lie in one trace and session, and that has no measured latency."""
    v = F.lit(version) if isinstance(version, str) else version
    fixed = {"schema_family": F.lit(FAMILY[version]) if isinstance(version, str) else values.pop("family"), "schema_version": v}
    fixed |= {"turn_id": F.concat(F.lit(prefix), trace, F.lit(":"), id_span), "entry_trace_id": trace, "exit_trace_id": trace, "entry_span_id": span, "exit_span_id": span}
    fixed |= {"same_trace": F.lit(True), "same_session": F.lit(True), "route_chain_complete": F.lit(False), "turn_latency_ms": F.lit(0.0)}
    return turn(**fixed, **values)


def issue(code: str, version: str = "", severity: str = "error", **values: Column) -> Column:
    """struct of ISSUES; absent texts are ''."""
    fixed = {"issue_code": F.lit(code), "severity": F.lit(severity), "schema_version": F.lit(version)} | values
    return F.struct(*[F.coalesce(fixed[f.name], F.lit("")).alias(f.name) if f.name in fixed else F.lit("").alias(f.name) for f in ISSUES])


def outer(kind: Column, name: Column) -> Column:
    """A span at the system's outer edge."""
    return (kind == "input_request") | name.rlike(HTTP)
