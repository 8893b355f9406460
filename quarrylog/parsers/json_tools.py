"""Formats that are JSON documents, JSON lines or XML."""

from __future__ import annotations

from .spec import Json, Xml



def flat(outer: str, inner: str, more: str = "") -> str:
    """One hit for each inner item of each outer one: x.f and x.m."""
    return f"flatten(transform({outer}, f -> transform(f.{inner}, m -> struct(f AS f, m AS m{more}))))"


def each(array: str) -> str:
    return f"transform({array}, m -> struct(m AS m))"


def ladder(value: str, errors: tuple, infos: tuple = (), otherwise: str = "WARNING") -> dict:
    """status and severity: ERROR for some values, INFO for others."""
    inside = lambda v: ", ".join(f"'{x}'" for x in v)
    status = f"CASE WHEN {value} IN ({inside(errors)}) THEN 'ERROR'" + (f" WHEN {value} IN ({inside(infos)}) THEN 'INFO'" if infos else "") + f" ELSE '{otherwise}' END"
    return {"status": status, "severity": f"lower({status})"}


WARN = {"status": "=WARNING", "severity": "=warning"}
ESLINT_ROWS = (
    "concat(" + "flatten(transform(j, f -> transform(f.messages, m -> struct(false AS total, f.filePath AS file, m AS m, 0L AS errors, 0L AS issues)))), "
    "transform(filter(array(flatten(transform(j, f -> f.messages))), a -> a IS NOT NULL), a -> struct(true AS total, '' AS file, get(a, -1) AS m, size(filter(a, m -> m.severity = 2)) + 0L AS errors, size(a) + 0L AS issues)))"
)
LINTERS = {
    "eslint_json": Json(
        "eslint", "lint_issue", "", schema="array<struct<filePath: string, messages: array<struct<line: int, column: int, message: string, ruleId: string, severity: int>>>>",
        rows=ESLINT_ROWS,
        columns={
            "event_type": "CASE WHEN x.total THEN 'summary' ELSE 'lint_issue' END", "ref_file": "x.file", "ref_line": "x.m.line", "ref_column": "x.m.column", "error_code": "x.m.ruleId", "function_name": "x.m.ruleId",
            "status": "CASE WHEN x.total THEN CASE WHEN x.issues = 0 THEN 'INFO' ELSE 'WARNING' END WHEN x.m.severity = 2 THEN 'ERROR' WHEN x.m.severity = 1 OR x.m.severity IS NULL THEN 'WARNING' ELSE 'INFO' END",
            "severity": "CASE WHEN x.total THEN CASE WHEN x.issues = 0 THEN 'info' ELSE 'warning' END WHEN x.m.severity = 2 THEN 'error' WHEN x.m.severity = 1 OR x.m.severity IS NULL THEN 'warning' ELSE 'info' END",
            "category": "CASE WHEN x.total THEN 'lint_summary' WHEN x.m.severity = 2 THEN 'lint_error' WHEN x.m.severity = 1 OR x.m.severity IS NULL THEN 'lint_warning' ELSE 'lint_info' END",
            "message": "CASE WHEN x.total THEN concat(x.issues, ' issue(s) found') ELSE x.m.message END",
        },
        detect=('"filePath"', '"messages"'),
    ),
    "stylelint_json": Json(
        "stylelint", "lint_issue", "css_style", schema="array<struct<source: string, warnings: array<struct<line: int, column: int, severity: string, rule: string, text: string>>>>", rows=flat("j", "warnings"),
        columns={"ref_file": "x.f.source", "ref_line": "x.m.line", "ref_column": "x.m.column", "error_code": "x.m.rule", "message": "x.m.text", **ladder("x.m.severity", ("error",))},
        detect=('"source"', '"warnings"', '"rule"', '"text"'),
    ),
    "rubocop_json": Json(
        "rubocop", "lint_issue", "code_quality", schema="struct<files: array<struct<path: string, offenses: array<struct<severity: string, message: string, cop_name: string, correctable: boolean, location: struct<start_line: int, start_column: int>>>>>>", rows=flat("j.files", "offenses"),
        columns={"ref_file": "x.f.path", "ref_line": "x.m.location.start_line", "ref_column": "x.m.location.start_column", "error_code": "x.m.cop_name", "message": "x.m.message", "suggestion": "CASE WHEN x.m.correctable THEN 'Auto-correctable with `rubocop -a`' ELSE '' END",
                 "structured_data": "concat('{\"tool\": \"rubocop\", \"cop_name\": \"', coalesce(x.m.cop_name, ''), '\", \"correctable\": ', CASE WHEN x.m.correctable THEN 'true' ELSE 'false' END, '}')",
                 "status": "CASE WHEN x.m.severity IN ('error', 'fatal') THEN 'ERROR' WHEN x.m.severity IN ('warning', 'convention') THEN 'WARNING' ELSE 'INFO' END", "severity": "CASE WHEN x.m.severity IN ('error', 'fatal') THEN 'error' WHEN x.m.severity IN ('warning', 'convention') THEN 'warning' ELSE 'info' END"},
        detect=('"files"', '"offenses"', '"cop_name"'),
    ),
    "swiftlint_json": Json(
        "swiftlint", "lint_issue", "code_quality", schema="array<struct<file: string, line: int, column: int, severity: string, reason: string, rule_id: string, type: string>>", rows=each("j"),
        columns={"ref_file": "x.m.file", "ref_line": "x.m.line", "ref_column": "x.m.column", "error_code": "x.m.rule_id", "message": "x.m.reason", "suggestion": "x.m.type", "status": "CASE lower(x.m.severity) WHEN 'error' THEN 'ERROR' WHEN 'warning' THEN 'WARNING' ELSE 'INFO' END", "severity": "CASE lower(x.m.severity) WHEN 'error' THEN 'error' WHEN 'warning' THEN 'warning' ELSE 'info' END"},
        detect=('"file"', '"rule_id"', '"reason"', '"severity"'),
    ),
    "phpstan_json": Json(
        "phpstan", "lint_issue", "static_analysis", schema="struct<files: map<string, struct<messages: array<struct<message: string, line: int, ignorable: boolean, tip: string>>>>>",
        rows="flatten(transform(map_entries(j.files), f -> transform(f.value.messages, m -> struct(f.key AS file, m AS m))))",
        columns={"ref_file": "x.file", "ref_line": "x.m.line", "message": "x.m.message", "suggestion": "x.m.tip", "status": "CASE WHEN x.m.ignorable THEN 'WARNING' ELSE 'ERROR' END", "severity": "CASE WHEN x.m.ignorable THEN 'warning' ELSE 'error' END"},
        detect=('"files"', '"messages"', '"ignorable"'),
    ),
    "shellcheck_json": Json(
        "shellcheck", "lint_issue", "shell_script", schema="array<struct<file: string, line: int, column: int, level: string, code: string, message: string>>", rows=each("j"),
        columns={"ref_file": "x.m.file", "ref_line": "x.m.line", "ref_column": "x.m.column", "error_code": "concat('SC', x.m.code)", "message": "x.m.message", **ladder("x.m.level", ("error",), ("info",))},
        detect=('"file"', '"level"', '"code"', '"message"', '!"DL', "!Dockerfile"),
    ),
    "clippy_json": Json(
        "clippy", "lint_issue", "code_quality", per_line=True, schema="struct<message: struct<level: string, message: string, code: struct<code: string>, spans: array<struct<is_primary: boolean, file_name: string, line_start: int, column_start: int, suggested_replacement: string>>>>", keep="size(x.j.message.spans) > 0",
        columns={"ref_file": "get(filter(x.j.message.spans, s -> s.is_primary), 0).file_name", "ref_line": "get(filter(x.j.message.spans, s -> s.is_primary), 0).line_start", "ref_column": "get(filter(x.j.message.spans, s -> s.is_primary), 0).column_start",
                 "error_code": "x.j.message.code.code", "message": "x.j.message.message", "suggestion": "get(filter(x.j.message.spans, s -> s.is_primary), 0).suggested_replacement", **ladder("x.j.message.level", ("error",), ("note", "info"))},
        detect=('"message"', '"spans"', '"is_primary"'),
    ),
    "markdownlint_json": Json(
        "markdownlint", "lint_issue", "documentation", schema="array<struct<fileName: string, lineNumber: int, errorRange: array<int>, ruleNames: array<string>, ruleDescription: string, errorDetail: string>>", rows=each("j"),
        columns={"ref_file": "x.m.fileName", "ref_line": "x.m.lineNumber", "ref_column": "get(x.m.errorRange, 0)", "error_code": "get(x.m.ruleNames, 0)", "message": "x.m.ruleDescription", "suggestion": "x.m.errorDetail", **WARN},
        detect=('"fileName"', '"lineNumber"', '"ruleNames"', '"ruleDescription"'),
    ),
    "yamllint_json": Json(
        "yamllint", "lint_issue", "configuration", schema="array<struct<file: string, line: int, column: int, level: string, rule: string, message: string, type: string>>", rows=each("j"),
        columns={"ref_file": "x.m.file", "ref_line": "x.m.line", "ref_column": "x.m.column", "error_code": "x.m.rule", "message": "x.m.message", "suggestion": "x.m.type", **ladder("x.m.level", ("error",))},
        detect=('"file"', '"line"', '"column"', '"rule"', '"level"'),
    ),
    "spotbugs_json": Json(
        "spotbugs", "lint_issue", "", schema="struct<BugCollection: struct<BugInstance: array<struct<type: string, category: string, priority: string, ShortMessage: string, LongMessage: string, SourceLine: struct<sourcepath: string, start: int>, Method: struct<name: string, classname: string>>>>>", rows=each("j.BugCollection.BugInstance"),
        columns={"event_type": "CASE x.m.category WHEN 'SECURITY' THEN 'security_finding' WHEN 'PERFORMANCE' THEN 'performance_issue' ELSE 'lint_issue' END",
                 "category": "CASE x.m.category WHEN 'SECURITY' THEN 'security' WHEN 'PERFORMANCE' THEN 'performance' WHEN 'CORRECTNESS' THEN 'correctness' WHEN 'BAD_PRACTICE' THEN 'code_quality' ELSE 'static_analysis' END",
                 "error_code": "x.m.type", "message": "x.m.ShortMessage", "suggestion": "x.m.LongMessage", "ref_file": "x.m.SourceLine.sourcepath", "ref_line": "x.m.SourceLine.start", "function_name": "concat_ws('.', x.m.Method.classname, x.m.Method.name)",
                 "status": "CASE x.m.priority WHEN '1' THEN 'ERROR' WHEN '3' THEN 'INFO' ELSE 'WARNING' END", "severity": "CASE x.m.priority WHEN '1' THEN 'error' WHEN '3' THEN 'info' ELSE 'warning' END"},
        detect=('"BugCollection"', '"BugInstance"'),
    ),
    "ktlint_json": Json(
        "ktlint", "lint_issue", "code_style", schema="array<struct<file: string, errors: array<struct<line: int, column: int, rule: string, message: string, detail: string>>>>", rows=flat("j", "errors"),
        columns={"ref_file": "x.f.file", "ref_line": "x.m.line", "ref_column": "x.m.column", "error_code": "x.m.rule", "message": "x.m.message", "suggestion": "x.m.detail", **WARN},
        detect=('"file"', '"errors"', '"rule"'),
    ),
    "hadolint_json": Json(
        "hadolint", "lint_issue", "dockerfile", schema="array<struct<file: string, line: int, column: int, code: string, message: string, level: string>>", rows=each("j"),
        columns={"ref_file": "x.m.file", "ref_line": "x.m.line", "ref_column": "x.m.column", "error_code": "x.m.code", "message": "x.m.message", "structured_data": "=hadolint_json", **ladder("x.m.level", ("error",), ("info",))},
        detect=('"file"', '"line"', '"code"', '"DL'),
    ),
    "lintr_json": Json(
        "lintr", "lint_issue", "r_code_style", schema="array<struct<filename: string, line_number: int, column_number: int, linter: string, message: string, type: string, line: string>>", rows=each("j"),
        columns={"ref_file": "x.m.filename", "ref_line": "x.m.line_number", "ref_column": "x.m.column_number", "error_code": "x.m.linter", "message": "x.m.message", "suggestion": "x.m.line", "structured_data": "=lintr_json",
                 "status": "CASE WHEN x.m.type = 'error' THEN 'ERROR' WHEN x.m.type IN ('warning', 'style') OR x.m.type IS NULL THEN 'WARNING' ELSE 'INFO' END", "severity": "CASE WHEN x.m.type = 'error' THEN 'error' WHEN x.m.type IN ('warning', 'style') OR x.m.type IS NULL THEN 'warning' ELSE 'info' END"},
        detect=('"filename"', '"line_number"', '"linter"'),
    ),
    "sqlfluff_json": Json(
        "sqlfluff", "lint_issue", "sql_style", schema="array<struct<filepath: string, violations: array<struct<line_no: int, line_pos: int, code: string, rule: string, description: string>>>>", rows=flat("j", "violations"),
        columns={"ref_file": "x.f.filepath", "ref_line": "x.m.line_no", "ref_column": "x.m.line_pos", "error_code": "x.m.code", "function_name": "x.m.rule", "message": "x.m.description", "structured_data": "=sqlfluff_json", **WARN},
        detect=('"filepath"', '"violations"', '"line_no"'),
    ),
    "tflint_json": Json(
        "tflint", "lint_issue", "infrastructure", schema="struct<issues: array<struct<rule: struct<name: string, severity: string, link: string>, message: string, range: struct<filename: string, start: struct<line: int, column: int>>>>>", rows=each("j.issues"),
        columns={"error_code": "x.m.rule.name", "function_name": "x.m.rule.name", "message": "x.m.message", "ref_file": "x.m.range.filename", "ref_line": "x.m.range.start.line", "ref_column": "x.m.range.start.column", "structured_data": "=tflint_json", **ladder("x.m.rule.severity", ("error",), ("notice",))},
        detect=('"issues"', '"rule"', '"range"'),
    ),
    "kube_score_json": Json(
        "kube-score", "lint_issue", "kubernetes", schema="array<struct<object_name: string, type_meta: struct<kind: string>, file_name: string, file_row: int, checks: array<struct<check: struct<id: string, name: string, comment: string>, grade: string, comments: array<struct<path: string, summary: string, description: string>>>>>>",
        rows="flatten(transform(j, f -> flatten(transform(filter(f.checks, c -> c.grade IS NOT NULL AND (c.grade <> 'OK' OR size(c.comments) > 0)), c -> transform(CASE WHEN size(c.comments) > 0 THEN c.comments ELSE array(named_struct('path', cast(NULL AS string), 'summary', cast(NULL AS string), 'description', c.check.comment)) END, m -> struct(f.object_name AS object, f.type_meta.kind AS kind, f.file_name AS file, f.file_row AS row, c.check AS check, c.grade AS grade, m AS m))))))",
        columns={"ref_file": "x.file", "ref_line": "x.row", "error_code": "x.check.id", "function_name": "concat(coalesce(x.object, ''), ' (', coalesce(x.kind, ''), ')')", "message": "coalesce(x.m.summary, x.check.name)", "suggestion": "x.m.description", "test_name": "x.m.path", "structured_data": "=kube_score_json",
                 "status": "CASE x.grade WHEN 'CRITICAL' THEN 'ERROR' WHEN 'WARNING' THEN 'WARNING' ELSE 'INFO' END", "severity": "CASE x.grade WHEN 'CRITICAL' THEN 'critical' WHEN 'WARNING' THEN 'warning' ELSE 'info' END"},
        detect=('"object_name"', '"checks"', '"grade"'),
    ),
    "bandit_json": Json(
        "bandit", "security_finding", "security", schema="struct<results: array<struct<filename: string, line_number: int, col_offset: int, test_id: string, test_name: string, issue_severity: string, issue_text: string, issue_cwe: struct<id: int, link: string>>>>", rows=each("j.results"),
        columns={"ref_file": "x.m.filename", "ref_line": "x.m.line_number", "ref_column": "x.m.col_offset", "error_code": "x.m.test_id", "function_name": "x.m.test_name", "message": "x.m.issue_text", "suggestion": "CASE WHEN x.m.issue_cwe.id IS NOT NULL THEN concat_ws(': ', concat('CWE-', x.m.issue_cwe.id), x.m.issue_cwe.link) ELSE '' END",
                 "structured_data": "concat('{\"tool\": \"bandit\", \"test_id\": \"', coalesce(x.m.test_id, ''), '\", \"severity\": \"', CASE x.m.issue_severity WHEN 'HIGH' THEN 'error' WHEN 'LOW' THEN 'info' ELSE 'warning' END, '\"', coalesce(concat(', \"cwe_id\": ', x.m.issue_cwe.id), ''), '}')",
                 "status": "CASE x.m.issue_severity WHEN 'HIGH' THEN 'ERROR' WHEN 'LOW' THEN 'INFO' ELSE 'WARNING' END", "severity": "CASE x.m.issue_severity WHEN 'HIGH' THEN 'error' WHEN 'LOW' THEN 'info' ELSE 'warning' END"},
        detect=('"results"', '"test_id"', '"issue_severity"'),
    ),
    "trivy_json": Json(
        "trivy", "security_finding", "", schema="struct<Results: array<struct<Target: string, Vulnerabilities: array<struct<VulnerabilityID: string, PkgName: string, Severity: string, Title: string, Description: string, FixedVersion: string, InstalledVersion: string>>, Misconfigurations: array<struct<ID: string, Type: string, Severity: string, Title: string, Message: string>>>>>",
        rows="flatten(transform(j.Results, f -> concat(coalesce(transform(f.Vulnerabilities, m -> struct(f.Target AS file, 'vulnerability' AS kind, m.VulnerabilityID AS id, m.PkgName AS name, m.Severity AS level, coalesce(m.Title, m.Description) AS text, CASE WHEN m.FixedVersion <> '' THEN concat('Update from ', m.InstalledVersion, ' to ', m.FixedVersion) ELSE '' END AS hint)), array()), coalesce(transform(f.Misconfigurations, m -> struct(f.Target AS file, 'misconfiguration' AS kind, m.ID AS id, m.Type AS name, m.Severity AS level, coalesce(m.Title, m.Message) AS text, '' AS hint)), array()))))",
        columns={"category": "x.kind", "ref_file": "x.file", "error_code": "x.id", "function_name": "x.name", "message": "x.text", "suggestion": "x.hint", "status": "CASE WHEN x.level IN ('CRITICAL', 'HIGH') THEN 'ERROR' WHEN x.level = 'MEDIUM' THEN 'WARNING' ELSE 'INFO' END", "severity": "CASE WHEN x.level IN ('CRITICAL', 'HIGH') THEN 'error' WHEN x.level = 'MEDIUM' THEN 'warning' ELSE 'info' END"},
        detect=('"ArtifactName"', '"Results"'),
    ),
    "tfsec_json": Json(
        "tfsec", "security_finding", "infrastructure_security", schema="struct<results: array<struct<rule_id: string, rule_description: string, description: string, resource: string, severity: string, resolution: string, location: struct<filename: string, start_line: int>>>>", rows=each("j.results"),
        columns={"error_code": "x.m.rule_id", "message": "coalesce(x.m.description, x.m.rule_description)", "function_name": "x.m.resource", "ref_file": "x.m.location.filename", "ref_line": "x.m.location.start_line", "suggestion": "x.m.resolution",
                 "status": "CASE WHEN x.m.severity IN ('CRITICAL', 'HIGH') THEN 'ERROR' WHEN x.m.severity = 'MEDIUM' OR x.m.severity IS NULL THEN 'WARNING' ELSE 'INFO' END", "severity": "CASE WHEN x.m.severity IN ('CRITICAL', 'HIGH') THEN 'error' WHEN x.m.severity = 'MEDIUM' OR x.m.severity IS NULL THEN 'warning' ELSE 'info' END"},
        detect=('"results"', '"rule_id"', '"location"', '"resource"'),
    ),
    "ruff_json": Json(
        "ruff", "lint_issue", "ruff_json", schema="array<struct<filename: string, code: string, message: string, url: string, location: struct<row: int, column: int>, fix: struct<message: string>>>",
        rows="CASE WHEN j IS NOT NULL THEN concat(transform(j, m -> struct(m AS m, -1 AS issues)), array(struct(get(slice(j, 1, 0), 0) AS m, size(j) AS issues))) END",
        columns={"event_type": "CASE WHEN x.issues >= 0 THEN 'summary' ELSE 'lint_issue' END", "ref_file": "x.m.filename", "ref_line": "x.m.location.row", "ref_column": "x.m.location.column", "error_code": "x.m.code", "function_name": "x.m.code", "suggestion": "concat_ws(' | ', nullif(x.m.url, ''), x.m.fix.message)",
                 "message": "CASE WHEN x.issues = 0 THEN 'All checks passed!' WHEN x.issues > 0 THEN concat('Found ', x.issues, ' error', CASE WHEN x.issues = 1 THEN '' ELSE 's' END) ELSE x.m.message END", "structured_data": "CASE WHEN x.issues >= 0 THEN concat('{\"errors\":', x.issues, '}') ELSE '' END",
                 "status": "CASE WHEN x.issues = 0 THEN 'PASS' WHEN x.issues > 0 THEN 'FAIL' WHEN x.m.code RLIKE '^[EF]' THEN 'ERROR' ELSE 'WARNING' END", "severity": "CASE WHEN x.issues = 0 THEN 'info' WHEN x.issues > 0 THEN 'error' WHEN x.m.code RLIKE '^[EF]' THEN 'error' ELSE 'warning' END"},
        detect=('"code"', '"filename"', '"location"', '"url"'),
    ),
}
OUTCOME = "CASE {o} WHEN 'passed' THEN 'PASS' WHEN 'failed' THEN 'FAIL' WHEN 'skipped' THEN 'SKIP' ELSE 'ERROR' END"
TEST_SEVERITY = "CASE {s} WHEN 'PASS' THEN 'info' WHEN 'SKIP' THEN 'warning' WHEN 'INFO' THEN 'info' ELSE 'error' END"
PYTEST = OUTCOME.format(o="x.m.outcome")
GOTEST = "CASE x.m.Action WHEN 'pass' THEN 'PASS' WHEN 'fail' THEN 'FAIL' ELSE 'SKIP' END"
CARGO = "CASE x.j.event WHEN 'ok' THEN 'PASS' WHEN 'failed' THEN 'FAIL' ELSE 'SKIP' END"
JUNIT = "CASE WHEN x.m.failure IS NOT NULL THEN 'FAIL' WHEN x.m.error IS NOT NULL THEN 'ERROR' WHEN x.m.skipped IS NOT NULL THEN 'SKIP' ELSE 'PASS' END"
NUNIT = "CASE x.m._result WHEN 'Passed' THEN 'PASS' WHEN 'Failed' THEN 'FAIL' WHEN 'Skipped' THEN 'SKIP' WHEN 'Inconclusive' THEN 'WARNING' ELSE 'INFO' END"
SUITE = "struct<_name: string, testcase: array<struct<_name: string, _classname: string, _file: string, _time: double, failure: struct<_message: string, _type: string, _VALUE: string>, error: struct<_message: string, _type: string, _VALUE: string>, skipped: struct<_message: string>>>>"
NCASES = "array<struct<_name: string, _fullname: string, _methodname: string, _classname: string, _result: string, _duration: double, failure: struct<message: string, `stack-trace`: string>, reason: struct<message: string>>>"


def _nested(depth: int) -> str:
    """NUnit suites nest; so many levels are read."""
    deeper = f", `test-suite`: array<{_nested(depth - 1)}>" if depth else ""
    return f"struct<_name: string, `test-case`: {NCASES}{deeper}>"


def _cases(value: str, depth: int, level: int = 0) -> str:
    own = f"coalesce({value}.`test-case`, array())"
    if not depth:
        return own
    v = f"s{level}"
    return f"concat({own}, coalesce(flatten(transform({value}.`test-suite`, {v} -> {_cases(v, depth - 1, level + 1)})), array()))"


def _playwright(depth: int) -> str:
    deeper = f", suites: array<{_playwright(depth - 1)}>" if depth else ""
    return f"struct<title: string, specs: array<struct<title: string, file: string, line: int, column: int, ok: boolean, tests: array<struct<projectName: string, results: array<struct<status: string, duration: double, error: struct<message: string>>>>>>>{deeper}>"


def _specs(value: str, depth: int, level: int = 0) -> str:
    own = f"coalesce({value}.specs, array())"
    if not depth:
        return own
    v = f"s{level}"
    return f"concat({own}, coalesce(flatten(transform({value}.suites, {v} -> {_specs(v, depth - 1, level + 1)})), array()))"


PLAYWRIGHT = "CASE x.r.status WHEN 'passed' THEN 'PASS' WHEN 'failed' THEN 'FAIL' WHEN 'timedOut' THEN 'FAIL' WHEN 'skipped' THEN 'SKIP' WHEN 'interrupted' THEN 'ERROR' ELSE 'INFO' END"
TESTS = {
    "pytest_json": Json(
        "pytest", "test_result", "", schema="struct<tests: array<struct<nodeid: string, outcome: string, duration: double, longrepr: string, call: struct<duration: double, longrepr: string>>>, summary: struct<passed: int, failed: int, skipped: int>>", rows=each("j.tests"),
        columns={"ref_file": "substring_index(x.m.nodeid, '::', 1)", "test_name": "CASE WHEN instr(x.m.nodeid, '::') > 0 THEN substring(x.m.nodeid, instr(x.m.nodeid, '::') + 2) ELSE x.m.nodeid END", "function_name": "CASE WHEN instr(x.m.nodeid, '::') > 0 THEN substring(x.m.nodeid, instr(x.m.nodeid, '::') + 2) ELSE x.m.nodeid END",
                 "status": PYTEST, "severity": TEST_SEVERITY.format(s=PYTEST), "execution_time": "coalesce(x.m.duration, x.m.call.duration, 0.0D)", "category": f"CASE {PYTEST} WHEN 'PASS' THEN 'test_success' WHEN 'FAIL' THEN 'test_failure' WHEN 'SKIP' THEN 'test_skipped' ELSE 'test_error' END",
                 "message": f"coalesce(nullif(x.m.longrepr, ''), nullif(x.m.call.longrepr, ''), concat('Test ', CASE {PYTEST} WHEN 'PASS' THEN 'passed' WHEN 'FAIL' THEN 'failed' WHEN 'SKIP' THEN 'skipped' ELSE 'error' END))"},
        detect=('"tests"', '"nodeid"', '"outcome"'),
    ),
    "gotest_json": Json(
        "go_test", "test_result", "", schema="struct<Action: string, Package: string, Test: string, Elapsed: double>", per_line=True, keep="x.j.Action IN ('run', 'pass', 'fail', 'skip') AND x.j.Test IS NOT NULL",
        detect=('"Action"', '"Package"'),
    ),
    "cargo_test_json": Json(
        "cargo_test", "test_result", "test", after="filter(_hits, x -> x.j.event <> 'started' AND exists(_hits, y -> y.j.event = 'started' AND y.j.name = x.j.name AND y.line_no < x.line_no))", schema="struct<type: string, event: string, name: string, exec_time: double, stdout: string>", per_line=True, keep="x.j.type = 'test' AND x.j.event IN ('started', 'ok', 'failed', 'ignored')",
        columns={"test_name": "x.j.name", "function_name": "x.j.name", "execution_time": "coalesce(x.j.exec_time, 0.0D)", "status": CARGO, "severity": TEST_SEVERITY.format(s=CARGO), "message": "CASE x.j.event WHEN 'ok' THEN 'Test passed' WHEN 'failed' THEN coalesce(nullif(x.j.stdout, ''), 'Test failed') ELSE 'Test ignored' END", "structured_data": "=cargo_test_json"},
        detect=('"type"', '"event"', '"test"'),
    ),
    "playwright_json": Json(
        "playwright", "test_result", "playwright_json", schema=f"struct<suites: array<{_playwright(4)}>, stats: struct<expected: int, unexpected: int, skipped: int>>",
        rows=f"flatten(transform(flatten(transform(j.suites, q -> {_specs('q', 4)})), f -> flatten(transform(f.tests, t -> transform(t.results, r -> struct(f AS f, t.projectName AS project, r AS r))))))",
        columns={"ref_file": "x.f.file", "ref_line": "x.f.line", "ref_column": "x.f.column", "test_name": "x.f.title", "execution_time": "coalesce(x.r.duration, 0.0D)", "status": PLAYWRIGHT, "severity": TEST_SEVERITY.format(s=PLAYWRIGHT), "message": "coalesce(x.r.error.message, x.f.title)", "structured_data": "x.project"},
        detect=('"suites"', '"stats"', '"expected"'),
    ),
    "junit_xml": Xml(
        "junit", "test_result", "", schema=f"struct<_name: string, testsuite: array<{SUITE}>, testcase: array<struct<_name: string, _classname: string, _file: string, _time: double, failure: struct<_message: string, _type: string, _VALUE: string>, error: struct<_message: string, _type: string, _VALUE: string>, skipped: struct<_message: string>>>>",
        rows="transform(concat(coalesce(flatten(transform(j.testsuite, s -> s.testcase)), array()), coalesce(j.testcase, array())), m -> struct(m AS m))",
        columns={"test_name": "x.m._name", "function_name": "concat_ws('.', x.m._classname, x.m._name)", "ref_file": "x.m._file", "execution_time": "coalesce(x.m._time, 0.0D)", "status": JUNIT, "severity": TEST_SEVERITY.format(s=JUNIT),
                 "category": f"CASE {JUNIT} WHEN 'FAIL' THEN 'test_failure' WHEN 'ERROR' THEN 'test_error' WHEN 'SKIP' THEN 'test_skipped' ELSE 'test_pass' END", "error_code": "coalesce(x.m.failure._type, x.m.error._type)",
                 "message": "coalesce(x.m.failure._message, x.m.error._message, x.m.skipped._message, 'Test passed')", "log_content": "coalesce(x.m.failure._VALUE, x.m.error._VALUE)"},
        detect=("<testsuite",),
    ),
    "unity_test_xml": Xml(
        "unity_test", "test_result", "", schema=f"struct<_name: string, `test-suite`: array<{_nested(6)}>>",
        rows=f"transform(flatten(transform(j.`test-suite`, q -> {_cases('q', 6)})), m -> struct(m AS m))",
        columns={"test_name": "x.m._fullname", "function_name": "x.m._methodname", "ref_file": "x.m._classname", "execution_time": "coalesce(x.m._duration, 0.0D)", "status": NUNIT, "severity": TEST_SEVERITY.format(s=NUNIT),
                 "category": "CASE x.m._result WHEN 'Passed' THEN 'test_pass' WHEN 'Failed' THEN 'test_failure' WHEN 'Skipped' THEN 'test_skipped' WHEN 'Inconclusive' THEN 'test_inconclusive' ELSE 'test_unknown' END", "message": "coalesce(x.m.failure.message, x.m.reason.message, concat('Test ', lower(x.m._result)))", "log_content": "x.m.failure.`stack-trace`"},
        detect=("<test-run", "<test-suite"),
    ),
}
# A test's run has to come before its outcome; an outcome without one is left out.
_RUN = "filter(_hits, y -> y.j.Action = 'run' AND y.j.Package <=> x.j.Package AND y.j.Test = x.j.Test AND y.line_no < x.line_no)"
TESTS["gotest_json"].columns = {
    "ref_file": "x.j.Package", "test_name": "x.j.Test", "function_name": "x.j.Test", "execution_time": "coalesce(x.j.Elapsed, 0.0D)", "status": GOTEST.replace("x.m", "x.j"), "severity": TEST_SEVERITY.format(s=GOTEST.replace("x.m", "x.j")),
    "category": "CASE x.j.Action WHEN 'pass' THEN 'test_success' WHEN 'fail' THEN 'test_failure' ELSE 'test_skipped' END", "message": "CASE x.j.Action WHEN 'pass' THEN 'Test passed' WHEN 'fail' THEN 'Test failed' ELSE 'Test skipped' END",
}
TESTS["gotest_json"].after = f"filter(_hits, x -> x.j.Action <> 'run' AND size({_RUN}) > 0)"

def _plain(value: str) -> str:
    """A text, or the `value` of an object that stands in its place."""
    return f"coalesce(get_json_object({value}, '$.value'), {value})"


#: Names of calls that change something.
CHANGES = "x.j.eventName RLIKE 'Delete|Terminate|Modify|Update|Put'"
AZURE_BAD = f"(x.j.level IN ('Critical', 'Error') OR coalesce(x.j.level, '') <> 'Warning' AND {_plain('x.j.status')} IN ('Failed', 'Failure'))"
LEVEL_NUMBER = "CASE WHEN {n} >= 50 THEN 'error' WHEN {n} >= 40 THEN 'warning' ELSE 'info' END"
LEVEL_STATUS = "CASE WHEN {n} >= 50 THEN 'ERROR' WHEN {n} >= 40 THEN 'WARNING' ELSE 'INFO' END"


LOGS = {
    "jsonl": Json(
        "jsonl", "debug_info", "", per_line=True,
        schema="struct<level: string, severity: string, lvl: string, loglevel: string, message: string, msg: string, text: string, timestamp: string, time: string, ts: string, `@timestamp`: string, error: string, err: string, exception: string, file: string, filename: string, line: int, lineno: int, logger: string, name: string, category: string, component: string, service: string, module: string>",
        columns={"status": "CASE WHEN coalesce(x.j.error, x.j.err, x.j.exception) IS NOT NULL AND coalesce(x.j.level, x.j.severity, x.j.lvl, x.j.loglevel) IS NULL THEN 'ERROR' ELSE {L} END", "severity": "CASE WHEN coalesce(x.j.error, x.j.err, x.j.exception) IS NOT NULL AND coalesce(x.j.level, x.j.severity, x.j.lvl, x.j.loglevel) IS NULL THEN 'error' ELSE lower({L}) END",
                 "message": "coalesce(x.j.message, x.j.msg, x.j.text)", "function_name": "coalesce(x.j.timestamp, x.j.time, x.j.ts, x.j.`@timestamp`)", "suggestion": "coalesce(x.j.error, x.j.err, x.j.exception)", "ref_file": "coalesce(x.j.file, x.j.filename)", "ref_line": "coalesce(x.j.line, x.j.lineno)",
                 "category": "coalesce(x.j.logger, x.j.name, x.j.category, x.j.component, x.j.service, x.j.module, 'log_entry')", "structured_data": "x.line"},
        detect=("re:(?m)^\\s*\\{.*\"(level|severity|message|msg|timestamp|time|ts)\"\\s*:",),
    ),
    "aws_cloudtrail": Json(
        "aws_cloudtrail", "debug_info", "", per_line=True, wrappers=("Records",), keep="x.j.eventName <> ''",
        schema="struct<eventTime: string, eventName: string, eventSource: string, awsRegion: string, sourceIPAddress: string, userAgent: string, errorCode: string, errorMessage: string, eventID: string, userIdentity: struct<type: string, userName: string, arn: string, accountId: string, principalId: string>>",
        columns={"started_at": "x.j.eventTime", "function_name": "x.j.eventName", "category": "x.j.eventSource", "error_code": "x.j.errorCode", "principal": "x.j.userIdentity.arn", "origin": "x.j.sourceIPAddress", "message": "x.j.eventName",
                 "status": f"CASE WHEN x.j.errorCode <> '' THEN 'ERROR' WHEN {CHANGES} THEN 'WARNING' ELSE 'INFO' END", "severity": f"CASE WHEN x.j.errorCode <> '' THEN 'error' WHEN {CHANGES} THEN 'warning' ELSE 'info' END",
                 "structured_data": "to_json(named_struct('aws_region', coalesce(x.j.awsRegion, ''), 'source_ip', x.j.sourceIPAddress, 'account_id', x.j.userIdentity.accountId, 'user_name', x.j.userIdentity.userName, 'user_type', x.j.userIdentity.type, 'principal_id', x.j.userIdentity.principalId, 'event_id', x.j.eventID, 'user_agent', x.j.userAgent, 'error_message', x.j.errorMessage))"},
        detect=('"eventName"', '"eventSource"||"awsRegion"||"userIdentity"'),
    ),
    "gcp_cloud_logging": Json(
        "gcp_cloud_logging", "debug_info", "", per_line=True, wrappers=("entries",), keep="coalesce(x.j.logName, x.j.severity, x.j.timestamp, '') <> ''",
        schema="struct<timestamp: string, severity: string, logName: string, insertId: string, textPayload: string, protoPayload: struct<methodName: string, serviceName: string, authenticationInfo: struct<principalEmail: string>, status: struct<code: string>>, resource: struct<type: string, labels: struct<project_id: string, zone: string>>>",
        columns={"started_at": "x.j.timestamp", "function_name": "x.j.protoPayload.methodName", "category": "coalesce(nullif(x.j.protoPayload.serviceName, ''), nullif(x.j.resource.type, ''), 'gcp')", "principal": "x.j.protoPayload.authenticationInfo.principalEmail", "error_code": "x.j.protoPayload.status.code",
                 "message": "coalesce(nullif(x.j.protoPayload.methodName, ''), nullif(x.j.textPayload, ''), x.j.logName)", "status": "CASE WHEN x.j.severity IN ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY') THEN 'ERROR' WHEN x.j.severity IN ('WARNING', 'NOTICE') THEN 'WARNING' ELSE 'INFO' END",
                 "severity": "CASE WHEN x.j.severity IN ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY') THEN 'error' WHEN x.j.severity IN ('WARNING', 'NOTICE') THEN 'warning' ELSE 'info' END",
                 "structured_data": "to_json(named_struct('log_name', x.j.logName, 'insert_id', x.j.insertId, 'resource_type', x.j.resource.type, 'project_id', x.j.resource.labels.project_id, 'zone', x.j.resource.labels.zone, 'severity', x.j.severity, 'principal_email', x.j.protoPayload.authenticationInfo.principalEmail, 'service_name', x.j.protoPayload.serviceName))"},
        detect=('"logName"', '"resource"'),
    ),
    "azure_activity": Json(
        "azure_activity", "debug_info", "", per_line=True, wrappers=("records", "value"), keep="coalesce(x.j.operationName, x.j.resourceId, '') <> ''",
        schema="struct<time: string, eventTimestamp: string, operationName: string, status: string, caller: string, callerIpAddress: string, category: string, level: string, resourceId: string, correlationId: string, subscriptionId: string, resourceGroupName: string, resourceProviderName: string, resultType: string, description: string>",
        columns={"started_at": "coalesce(nullif(x.j.time, ''), x.j.eventTimestamp)", "function_name": _plain("x.j.operationName"), "category": f"coalesce(nullif({_plain('x.j.category')}, ''), nullif({_plain('x.j.resourceProviderName')}, ''), 'azure')", "principal": "x.j.caller", "origin": "x.j.callerIpAddress",
                 "error_code": f"coalesce(nullif({_plain('x.j.status')}, ''), x.j.resultType)", "message": _plain("x.j.operationName"),
                 "status": f"CASE WHEN {AZURE_BAD} THEN 'ERROR' WHEN x.j.level = 'Warning' THEN 'WARNING' ELSE 'INFO' END", "severity": f"CASE WHEN {AZURE_BAD} THEN 'error' WHEN x.j.level = 'Warning' THEN 'warning' ELSE 'info' END",
                 "structured_data": f"to_json(named_struct('resource_id', x.j.resourceId, 'subscription_id', x.j.subscriptionId, 'resource_group', x.j.resourceGroupName, 'resource_provider', {_plain('x.j.resourceProviderName')}, 'caller_ip', x.j.callerIpAddress, 'correlation_id', x.j.correlationId, 'level', x.j.level, 'description', x.j.description))"},
        detect=('"operationName"', '"resourceId"||"caller"||"subscriptionId"||"correlationId"'),
    ),
    "winston": Json(
        "winston", "debug_info", "", per_line=True, schema="struct<level: string, message: string, timestamp: string, service: string>", keep="x.j.level IS NOT NULL OR x.j.message IS NOT NULL",
        columns={"started_at": "x.j.timestamp", "message": "x.j.message", "category": "x.j.service", "level": "x.j.level", "structured_data": "x.line"},
        detect=('re:"level"\\s*:\\s*"(error|warn|info|http|verbose|debug|silly)"', '"message"'),
    ),
    "pino": Json(
        "pino", "debug_info", "", per_line=True, schema="struct<level: int, time: bigint, msg: string, hostname: string, name: string, err: struct<message: string>>", keep="x.j.level IS NOT NULL AND x.j.time IS NOT NULL",
        columns={"started_at": "date_format(timestamp_millis(x.j.time), \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")", "message": "x.j.msg", "origin": "x.j.hostname", "category": "x.j.name", "error_code": "x.j.err.message", "status": LEVEL_STATUS.format(n="x.j.level"), "severity": LEVEL_NUMBER.format(n="x.j.level"), "structured_data": "x.line"},
        detect=('re:"level"\\s*:\\s*\\d+.*"time"\\s*:\\s*\\d+|"time"\\s*:\\s*\\d+.*"level"\\s*:\\s*\\d+',),
    ),
    "bunyan": Json(
        "bunyan", "debug_info", "", per_line=True, schema="struct<v: int, name: string, level: int, time: string, msg: string, hostname: string, err: struct<message: string>>", keep="x.j.v IS NOT NULL AND x.j.name IS NOT NULL",
        columns={"started_at": "x.j.time", "message": "x.j.msg", "origin": "x.j.hostname", "category": "x.j.name", "error_code": "x.j.err.message", "status": LEVEL_STATUS.format(n="x.j.level"), "severity": LEVEL_NUMBER.format(n="x.j.level"), "structured_data": "x.line"},
        detect=('re:"v"\\s*:\\s*\\d+.*"name"\\s*:|"name"\\s*:.*"v"\\s*:\\s*\\d+',),
    ),
    "serilog": Json(
        "serilog", "debug_info", "", per_line=True, schema="struct<`@t`: string, `@mt`: string, `@m`: string, `@l`: string, `@x`: string, SourceContext: string>", keep="x.j.`@t` IS NOT NULL",
        columns={"started_at": "x.j.`@t`", "message": "coalesce(x.j.`@m`, x.j.`@mt`)", "category": "x.j.SourceContext", "error_code": "x.j.`@x`", "level": "coalesce(x.j.`@l`, 'information')", "structured_data": "x.line"},
        detect=('re:"@t"\\s*:|"@mt"\\s*:',),
    ),
}
_LEVEL = "coalesce(x.j.level, x.j.severity, x.j.lvl, x.j.loglevel, 'info')"


def _fill():
    from .spec import level_status

    for k in ("status", "severity"):
        LOGS["jsonl"].columns[k] = LOGS["jsonl"].columns[k].replace("{L}", level_status(_LEVEL))


_fill()
