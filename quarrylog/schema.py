"""The event table: columns, enumerations and what is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: name -> type; order is the table's.
EVENT_FIELDS = {
    "event_id": "bigint", "tool_name": "string", "event_type": "string", "ref_file": "string", "ref_line": "int", "ref_column": "int", "function_name": "string",
    "status": "string", "severity": "string", "category": "string", "error_code": "string", "message": "string", "suggestion": "string", "log_content": "string",
    "structured_data": "string", "log_line_start": "int", "log_line_end": "int", "log_file": "string", "test_name": "string", "execution_time": "double",
    "principal": "string", "origin": "string", "target": "string", "actor_type": "string", "started_at": "string", "external_id": "string",
    "scope": "string", "scope_id": "string", "scope_status": "string", "group": "string", "group_id": "string", "group_status": "string", "unit": "string", "unit_id": "string",
    "unit_status": "string", "subunit": "string", "subunit_id": "string", "fingerprint": "string", "similarity_score": "double", "pattern_id": "bigint",
}
#: Text columns whose empty text stands (the others turn it to null).
KEPT_EMPTY = {"tool_name", "ref_file", "function_name", "category", "error_code", "message", "suggestion", "structured_data", "test_name"}
EVENT_SCHEMA = ", ".join(f"`{n}` {t}" for n, t in EVENT_FIELDS.items())
#: Columns that parsing leaves to later steps.
LATER = ("event_id", "log_file", "fingerprint", "similarity_score", "pattern_id")
WORKFLOW_FIELDS = {n: t for n, t in EVENT_FIELDS.items() if n != "log_file"} | {"workflow_type": "string", "hierarchy_level": "int", "parent_id": "string", "job_order": "int", "job_name": "string"}
STATUSES = ("PASS", "FAIL", "SKIP", "ERROR", "WARNING", "INFO")
EVENT_TYPES = (
    "test_result", "lint_issue", "type_error", "security_finding", "build_error", "performance_issue", "memory_error", "memory_leak", "thread_error",
    "performance_metric", "summary", "debug_event", "crash_signal", "debug_info", "unknown",
)
RANKS = {"debug": 0, "trace": 0, "info": 1, "warning": 2, "warn": 2, "error": 3, "critical": 4, "fatal": 4}


def severity_rank(severity: Column) -> Column:
    """0 debug to 4 critical; anything else ranks as a warning."""
    s = F.lower(F.coalesce(severity, F.lit("")))
    out = F.lit(2)
    for name, rank in RANKS.items():
        out = F.when(s == name, rank).otherwise(out)
    return out


def threshold_rank(name: str) -> int:
    """Unknown names silently mean warning; all means debug."""
    return 0 if name.lower() == "all" else RANKS.get(name.lower(), 2)
