"""Formats that users define: a regular expression with named groups, or a JSON description.

Both compile to the same rules as built-in line formats, so no Python runs per line.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

from .. import registry
from ..parsers.spec import Lines, Rule, level_status
from ..schema import EVENT_TYPES

#: Group names and the event column they fill.
SYNONYMS = {
    "severity": ("severity", "level"), "message": ("message", "msg", "description", "text"), "ref_file": ("file", "file_path", "path", "filename"), "ref_line": ("line", "line_number", "lineno", "line_num"),
    "ref_column": ("column", "col", "ref_column", "colno"), "error_code": ("code", "error_code", "rule", "rule_id"), "category": ("category", "type", "class"), "test_name": ("test_name", "test", "name"),
    "suggestion": ("suggestion", "fix", "hint"), "tool_name": ("tool", "tool_name"),
}
COLUMN_OF = {n: c for c, names in SYNONYMS.items() for n in names}
ERROR_WORDS, WARNING_WORDS, INFO_WORDS = ("error", "fatal", "fail", "failed"), ("warning", "warn"), ("info", "note", "debug")


def named_groups(pattern: str) -> tuple[str, dict[str, int]]:
    """The pattern with plain groups, and each group name's number. (?P<n>...) and (?<n>...) are the same."""
    names, out, number, i, in_class = {}, [], 0, 0, False
    while i < len(pattern):
        if pattern[i] == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        if pattern[i] in "[]":
            in_class = pattern[i] == "["
        if pattern[i] == "(" and not in_class:
            m = re.match(r"\((?:\?P?<([A-Za-z_]\w*)>|(?!\?))", pattern[i:])
            if m:
                number += 1
                if m[1]:
                    names[m[1]] = number
                out.append("(")
                i += len(m[0])
                continue
        out.append(pattern[i])
        i += 1
    return "".join(out), names


def _word_status(level: str) -> str:
    inside = lambda w: ", ".join(f"'{x}'" for x in w)
    return f"CASE WHEN lower({level}) IN ({inside(ERROR_WORDS)}) THEN 'ERROR' WHEN lower({level}) IN ({inside(INFO_WORDS)}) THEN 'INFO' ELSE 'WARNING' END"


_NO_LINE = {"log_line_start": "NULL", "log_line_end": "NULL"}
NO_MATCH = Rule("", {**_NO_LINE, "category": "=regexp_summary", "message": "=No matches found for the provided pattern", "status": "=INFO", "severity": "=info"})


def regexp_outcomes(pattern: str) -> registry.Entry:
    """As regexp_format, but a text in which nothing matches gives one event that says so, and a pattern that doesn't compile one error a text."""
    try:
        found = regexp_format(pattern)
        (spec,) = found.specs
        spec = Lines(spec.tool, spec.type, spec.category, rules=spec.rules, otherwise=NO_MATCH)
    except ValueError as problem:
        said = Rule("", {**_NO_LINE, "event_type": "=build_error", "category": "=parse_error", "message": f"=Invalid regex pattern '{pattern}': {problem.__cause__}", "status": "=ERROR", "severity": "=error"})
        spec = Lines("regexp", "lint_issue", "regexp_match", rules=(Rule("(?!)", {}),), otherwise=said)
    return registry.Entry("regexp:" + pattern, 0, "custom", "regular expression", (), (), 10_000, (spec,), (), False)


def regexp_format(pattern: str, include_unparsed: bool = False) -> registry.Entry:
    """A format whose one rule is the pattern. Raises ValueError for a pattern that doesn't compile."""
    plain, names = named_groups(pattern)
    try:
        re.compile(plain)
    except re.error as e:
        raise ValueError(f"bad pattern: {e}") from e
    columns: dict = {}
    for name, number in names.items():
        column = COLUMN_OF.get(name.lower())
        if column and column not in columns:
            columns[column] = number
    level = columns.pop("severity", None)
    if level:
        columns |= {"status": _word_status(f"{{{level}}}"), "severity": f"lower({{{level}}})"}
    else:
        columns |= {"status": "=WARNING", "severity": "=warning"}
    columns.setdefault("message", "{line}")
    if "ref_line" not in columns:
        columns["ref_line"] = "x.line_no"
    rules = [Rule(plain, columns)]
    if include_unparsed:
        rules.append(Rule(r"\S", {"event_type": "=unknown", "message": "{line}"}))
    spec = Lines("regexp", "lint_issue", "regexp_match", rules=tuple(rules))
    return registry.Entry("regexp:" + pattern, 0, "custom", "regular expression", (), (), 10_000, (spec,), (), False)


def config_format(text: str) -> registry.Entry:
    """A format from a JSON description: name, patterns [{regex, event_type, severity, severity_map, status_map}]."""
    config = json.loads(text)
    if not isinstance(config, dict) or not config.get("name"):
        raise ValueError("a parser description needs a name")
    if not config.get("patterns"):
        raise ValueError("a parser description needs patterns")
    rules = []
    for p in config["patterns"]:
        if "regex" not in p or "event_type" not in p:
            raise ValueError("a pattern needs regex and event_type")
        kind = p["event_type"].lower()
        if kind not in EVENT_TYPES:
            raise ValueError(f"unknown event type: {kind}")
        plain, names = named_groups(p["regex"])
        re.compile(plain)
        columns: dict = {"event_type": f"={kind}"}
        for name, number in names.items():
            column = COLUMN_OF.get(name.lower(), name if name in ("function_name", "execution_time", "status") else None)
            if column:
                columns.setdefault(column, number)
        captured = columns.pop("severity", None)
        seen = columns.pop("status", None) or captured
        default = {"build_error": "ERROR", "test_result": "INFO", "lint_issue": "WARNING", "security_finding": "WARNING"}.get(kind, "INFO")
        status = f"'{default}'"
        if captured:
            status = level_status(f"{{{captured}}}")
        severity = f"lower({status})"
        if p.get("severity"):
            severity = f"'{p['severity'].lower()}'"
            status = level_status(severity)
        if p.get("severity_map") and seen:
            severity = "CASE {%d} " % seen + " ".join(f"WHEN '{k}' THEN '{v.lower()}'" for k, v in p["severity_map"].items()) + f" ELSE {severity} END"
            status = level_status(f"({severity})")
        if p.get("status_map") and seen:
            status = "CASE {%d} " % seen + " ".join(f"WHEN '{k}' THEN '{v.upper()}'" for k, v in p["status_map"].items()) + f" ELSE {status} END"
            if not p.get("severity_map") and not p.get("severity"):
                severity = f"CASE {status} WHEN 'PASS' THEN 'info' WHEN 'INFO' THEN 'info' WHEN 'SKIP' THEN 'warning' WHEN 'WARNING' THEN 'warning' ELSE 'error' END"
        columns.setdefault("message", "{line}")
        rules.append(Rule(plain, columns | {"status": status, "severity": severity}))
    detection = config.get("detection") or {}
    marks: list[str] = list(detection.get("contains_all", []))
    if detection.get("contains"):
        marks.append("||".join(detection["contains"]))
    if detection.get("regex"):
        marks.append("re:" + detection["regex"])
    spec = Lines(config.get("tool_name", config["name"]), "debug_info", config.get("category", "tool_output"), rules=tuple(rules), detect=tuple(marks) or ("\u0000",))
    return registry.Entry(config["name"].lower(), int(config.get("priority", 50)), config.get("category", "tool_output"), config.get("description", ""), tuple(config.get("aliases", ())), tuple(config.get("groups", ("custom",))), 10_000, (spec,), (), False)


def config_file(path: str) -> registry.Entry:
    """The format that a JSON file describes, for one call: nothing is registered. Raises ValueError where there is none."""
    from ..sources.files import read_docs

    # One small file of the user's.
    found = read_docs(SparkSession.active(), path, size_limit=1 << 20).limit(1).collect()
    if not found:
        raise ValueError(f"no parser description: {path}")
    return config_format(found[0]["content"])


def load_parser_config(text: str) -> str:
    return registry.register(config_format(text))


def unload_parser(name: str) -> bool:
    return registry.unregister(name)
