"""Checks of configuration objects; plain Python on the driver, before any data is read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from typing import Any

METRIC_CONTRACT = "monitoring-metric.v2"
#: Roles that a scoring method needs, and how many (None: one or more).
ROLES: dict[str, dict[str, int | None]] = {
    "identity": {"final_score": 1},
    "accuracy": {"prediction": 1, "target": 1},
    "mean_criteria": {"criterion": None},
    "all_criteria": {"criterion": None},
    "majority": {"assessor_vote": None},
    "all_assessors": {"assessor_vote": None},
}
#: The verdict's fields.
CRITICAL = "критичных нарушено"
QUALITY = ("null_violations", "missing", "trash_cells", "rule_violations", "blocking_rule_violations", "advisory_rule_violations", "duplicate_keys", "trace_breaks")
CRITERIA = tuple(f"K{i}" for i in range(1, 9))
BLOCKING = CRITERIA[:6]
MODES = ("qa", "dialogue", "turn_with_history")


def clean(value: object) -> str:
    return "" if value is None else str(value).strip()


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def _count(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _at(value: Any, path: str) -> Any:
    """What lies at a path of keys and places, or None."""
    for key in path.split("/") if path else ():
        if isinstance(value, list):
            value = value[int(key)] if key.isdigit() and int(key) < len(value) else None
        else:
            value = value.get(key) if isinstance(value, dict) else None
    return value


def _criterion(c: Any) -> bool:
    return isinstance(c, dict) and c.get("tone") in ("good", "warn", "bad") and bool(clean(c.get("result"))) and bool(clean(c.get("title")))


def _graded(items: Any) -> bool:
    return isinstance(items, list) and bool(items) and all(_at(r, "verdict") in ("ready", "pilot", "not_ready") for r in items)


#: What a verdict must satisfy: (path, test of what lies there, message).  Shapes come before what is read of them.
VERDICT_RULES: tuple[tuple[str, Callable[[Any], bool], str], ...] = (
    ("", lambda v: isinstance(v, dict), "the verdict is not an object"),
    *((k, lambda v: v is not None, f"the verdict lacks {k}") for k in ("schema", "quality", "criteria", "readiness", "metrics")),
    (f"schema/{CRITICAL}", _count, "needs a whole number"),
    ("quality", lambda q: isinstance(q, list) and len(q) == 1 and isinstance(q[0], dict), "needs one object"),
    *((f"quality/0/{f}", lambda n: _count(n) and n >= 0, "must be a whole number of 0 or more") for f in QUALITY),
    ("quality/0", lambda q: q["rule_violations"] == q["blocking_rule_violations"] + q["advisory_rule_violations"], "violations don't add up"),
    *((f"criteria/{k}", _criterion, "is malformed") for k in CRITERIA),
    ("readiness", _graded, "is malformed"),
    *((f"metrics/{k}", lambda m: isinstance(m, dict), "is needed") for k in ("policy", "gates")),
    (f"schema/{CRITICAL}", lambda n: n == 0, "the traces fail the schema check K1"),
    ("quality/0/valid", lambda v: v is True, "the traces fail the quality check"),
    *((f"criteria/{k}/tone", lambda tone: tone != "bad", f"the traces fail {k}") for k in BLOCKING),
)


def check_verdict(verdict: object, ignore: bool = False) -> dict[str, Any]:
    """What the trace validation allows; ValueError where it blocks or is malformed."""
    if ignore:
        return {"scope": "bypassed", "status": "bypassed", "non_gating_criteria": {}}
    _need(verdict is not None, "no trace verdict; set ignore to go without one")
    for path, test, message in VERDICT_RULES:
        _need(test(_at(verdict, path)), f"verdict{'.' * bool(path)}{path.replace('/', '.')}: {message}")
    criteria = verdict["criteria"]
    warned = [k for k in BLOCKING if criteria[k]["tone"] == "warn"]
    return {
        "scope": "K1-K6",
        "status": "passed_with_warnings" if warned else "passed",
        "warning_criteria": warned,
        "non_gating_criteria": {k: criteria[k] for k in CRITERIA if k not in BLOCKING},
        "readiness": verdict["readiness"],
    }


def check_metric(metric: object, contract: str = METRIC_CONTRACT) -> dict[str, Any]:
    """The metric specification, checked."""
    _need(isinstance(metric, dict), "the metric is not an object")
    _need(metric.get("contract_version") == contract, f"the metric must follow {contract}")
    _need(metric.get("status") == "computed", "the metric must have the status computed")
    _need(metric.get("assessment_mode") in MODES, f"assessment_mode must be one of {', '.join(MODES)}")
    scoring = metric.get("scoring")
    _need(isinstance(scoring, dict), "metric.scoring is not an object")
    sources = scoring.get("sources")
    _need(isinstance(sources, list) and bool(sources), "metric.scoring.sources must be a filled list")
    method = clean(scoring.get("method"))
    _need(method in ROLES, f"unknown scoring method {method!r}")
    for s in sources:
        _need(isinstance(s, dict) and all(clean(s.get(k)) for k in ("source_id", "role", "column_name")), "a scoring source needs source_id, role and column_name")
    for key in ("source_id", "column_name"):
        values = [clean(s[key]) for s in sources]
        _need(len(values) == len(set(values)), f"{key} must not repeat")
    roles = Counter(clean(s["role"]) for s in sources)
    _need(set(roles) == set(ROLES[method]), f"{method} needs the roles {sorted(ROLES[method])}, not {sorted(roles)}")
    for role, n in ROLES[method].items():
        _need(n is None or roles[role] == n, f"{method} needs {n} source of the role {role}")
    return metric


def read_selection(selection: object) -> tuple[str, str, str]:
    """(agent, distributive, solution version)."""
    if selection is None:
        return "", "monitoring", ""
    _need(isinstance(selection, dict), "the selection is not an object")
    return clean(selection.get("agent_ci")), clean(selection.get("distributive")) or "monitoring", clean(selection.get("solution_version"))
