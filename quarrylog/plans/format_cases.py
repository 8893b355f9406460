"""One query a family of formats: a text of several lines for each customer, and the events it has to give.

Texts and expected values are templates over the customer's key and nation: `@k@` and `@n@`. Spark writes the
texts from the table and parses them, DuckDB takes the expected values from the same table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.parse import parse_log

#: The columns of a case's events, in the order of its tuples.
COLUMNS = ("event_type", "tool_name", "category", "status", "severity", "error_code", "ref_file", "ref_line", "ref_column", "message", "test_name")
NUMBERS = ("ref_line", "ref_column")
VALUES = {"@k@": "c_custkey", "@n@": "c_nationkey"}
CASES: dict[str, dict] = {}


def _pieces(template: str) -> list[str]:
    out, rest = [], template
    while rest:
        at = min((rest.find(v) for v in VALUES if v in rest), default=-1)
        if at < 0:
            return [*out, rest]
        if at:
            out.append(rest[:at])
        out.append(rest[at : at + 3])
        rest = rest[at + 3 :]
    return out


def sql_of(template: str, backslashes: bool) -> str:
    """The template as an SQL expression over customer; Spark's literals need backslashes doubled."""

    def literal(x: str) -> str:
        x = x.replace("\\", "\\\\") if backslashes else x
        return "'" + x.replace("'", "\\'" if backslashes else "''") + "'"

    return "concat(" + ", ".join([VALUES[p] if p in VALUES else literal(p) for p in _pieces(template)] or ["''"]) + ", '')"


def family(name: str, cases: dict) -> tuple:
    """(query, SQL) of the formats in `cases`: format -> (text, events as tuples of COLUMNS)."""
    CASES[name] = cases

    def query(spark, sf: str) -> DataFrame:
        # A file of few splits holds keys for very many texts: the keys are dealt out first.
        table = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_nationkey").repartition(4 * spark.sparkContext.defaultParallelism, "c_custkey")
        parts = [parse_log(table.select(F.expr(sql_of(text, True)).alias("content")), "content", fmt).select(F.lit(fmt).alias("format"), *COLUMNS) for fmt, (text, _) in cases.items()]
        return reduce(DataFrame.unionAll, parts).groupBy("format", *COLUMNS).agg(F.count(F.lit(1)).alias("n"))

    query.__name__ = name
    events = [f"SELECT '{fmt}' AS format, " + ", ".join(_value(c, v) for c, v in zip(COLUMNS, event, strict=True)) + " FROM customer" for fmt, (_, found) in cases.items() for event in found]
    return query, f"SELECT format, {', '.join(COLUMNS)}, count(*) AS n FROM ({' UNION ALL '.join(events)}) GROUP BY ALL"


def _value(column: str, value) -> str:
    kind = "INTEGER" if column in NUMBERS else "VARCHAR"
    return f"CAST({'NULL' if value is None else sql_of(str(value), False)} AS {kind}) AS {column}"


def _lint(tool: str, category: str, *events: tuple, kind: str = "lint_issue") -> list:
    """Lint events: (status, code, file, line, column, message[, test])."""
    return [(kind, tool, category, e[0], e[0].lower(), *e[1:6], e[6] if len(e) > 6 else "") for e in events]


JSON_LINTERS = {
    "eslint_json": (
        '[{"filePath": "src/a@k@.js", "messages": [{"line": @n@, "column": 3, "message": "bad @k@", "ruleId": "no-undef", "severity": 2}, {"line": 2, "column": 1, "message": "meh", "ruleId": "semi", "severity": 1}]}]',
        [("lint_issue", "eslint", "lint_error", "ERROR", "error", "no-undef", "src/a@k@.js", "@n@", 3, "bad @k@", ""), ("lint_issue", "eslint", "lint_warning", "WARNING", "warning", "semi", "src/a@k@.js", 2, 1, "meh", ""),
         ("summary", "eslint", "lint_summary", "WARNING", "warning", "", "", None, None, "2 issue(s) found", "")],
    ),
    "stylelint_json": (
        '[{"source": "a@k@.css", "warnings": [{"line": @k@, "column": 7, "severity": "error", "rule": "color-no-hex", "text": "No hex"}, {"line": 2, "column": 1, "severity": "warning", "rule": "indent", "text": "Indent @n@"}]}]',
        _lint("stylelint", "css_style", ("ERROR", "color-no-hex", "a@k@.css", "@k@", 7, "No hex"), ("WARNING", "indent", "a@k@.css", 2, 1, "Indent @n@")),
    ),
    "rubocop_json": (
        '{"files": [{"path": "lib/a@k@.rb", "offenses": [{"severity": "convention", "message": "Long @n@", "cop_name": "Layout/LineLength", "location": {"start_line": @k@, "start_column": 81}}, {"severity": "error", "message": "Oops", "cop_name": "Lint/Syntax", "location": {"start_line": 1, "start_column": 1}}, {"severity": "refactor", "message": "Split", "cop_name": "Metrics/AbcSize", "location": {"start_line": 5, "start_column": 2}}]}]}',
        _lint("rubocop", "code_quality", ("WARNING", "Layout/LineLength", "lib/a@k@.rb", "@k@", 81, "Long @n@"), ("ERROR", "Lint/Syntax", "lib/a@k@.rb", 1, 1, "Oops"), ("INFO", "Metrics/AbcSize", "lib/a@k@.rb", 5, 2, "Split")),
    ),
    "swiftlint_json": (
        '[{"file": "/A@k@.swift", "line": @k@, "column": 5, "severity": "Warning", "reason": "Too long @n@", "rule_id": "line_length", "type": "Line Length"}, {"file": "/B.swift", "line": 1, "column": 2, "severity": "Error", "reason": "Cast", "rule_id": "force_cast", "type": "Force Cast"}]',
        _lint("swiftlint", "code_quality", ("WARNING", "line_length", "/A@k@.swift", "@k@", 5, "Too long @n@"), ("ERROR", "force_cast", "/B.swift", 1, 2, "Cast")),
    ),
    "phpstan_json": (
        '{"files": {"src/A@k@.php": {"messages": [{"message": "Undefined $x@n@", "line": @k@, "ignorable": true}, {"message": "Fatal", "line": 3, "ignorable": false}]}}}',
        _lint("phpstan", "static_analysis", ("WARNING", "", "src/A@k@.php", "@k@", None, "Undefined $x@n@"), ("ERROR", "", "src/A@k@.php", 3, None, "Fatal")),
    ),
    "shellcheck_json": (
        '[{"file": "s@k@.sh", "line": @k@, "column": 9, "level": "warning", "code": 2086, "message": "Quote @n@"}, {"file": "s@k@.sh", "line": 2, "column": 1, "level": "info", "code": 2034, "message": "Unused"}, {"file": "s@k@.sh", "line": 3, "column": 1, "level": "error", "code": 1009, "message": "Parse"}]',
        _lint("shellcheck", "shell_script", ("WARNING", "SC2086", "s@k@.sh", "@k@", 9, "Quote @n@"), ("INFO", "SC2034", "s@k@.sh", 2, 1, "Unused"), ("ERROR", "SC1009", "s@k@.sh", 3, 1, "Parse")),
    ),
    "clippy_json": (
        '{"message": {"message": "needless @n@", "code": {"code": "clippy::needless_return"}, "level": "warning", "spans": [{"file_name": "src/m@k@.rs", "line_start": @k@, "column_start": 5, "is_primary": true}]}}\n'
        '{"message": {"message": "mismatched", "code": {"code": "E0308"}, "level": "error", "spans": [{"file_name": "src/x.rs", "line_start": 9, "column_start": 1, "is_primary": true}]}}',
        _lint("clippy", "code_quality", ("WARNING", "clippy::needless_return", "src/m@k@.rs", "@k@", 5, "needless @n@"), ("ERROR", "E0308", "src/x.rs", 9, 1, "mismatched")),
    ),
    "markdownlint_json": (
        '[{"fileName": "R@k@.md", "lineNumber": @k@, "errorRange": [4, 2], "ruleNames": ["MD013", "line-length"], "ruleDescription": "Line length @n@"}]',
        _lint("markdownlint", "documentation", ("WARNING", "MD013", "R@k@.md", "@k@", 4, "Line length @n@")),
    ),
    "yamllint_json": (
        '[{"file": "c@k@.yml", "line": @k@, "column": 3, "level": "error", "rule": "indentation", "message": "wrong @n@"}, {"file": "c@k@.yml", "line": 2, "column": 1, "level": "warning", "rule": "document-start", "message": "missing"}]',
        _lint("yamllint", "configuration", ("ERROR", "indentation", "c@k@.yml", "@k@", 3, "wrong @n@"), ("WARNING", "document-start", "c@k@.yml", 2, 1, "missing")),
    ),
    "spotbugs_json": (
        '{"BugCollection": {"BugInstance": [{"type": "NP_NULL", "category": "CORRECTNESS", "priority": "1", "ShortMessage": "Null @n@", "SourceLine": {"sourcepath": "A@k@.java", "start": @k@}}, {"type": "SQL_INJ", "category": "SECURITY", "priority": "2", "ShortMessage": "SQL", "SourceLine": {"sourcepath": "B.java", "start": 4}}, {"type": "SLOW", "category": "PERFORMANCE", "priority": "3", "ShortMessage": "Slow", "SourceLine": {"sourcepath": "C.java", "start": 5}}]}}',
        [("lint_issue", "spotbugs", "correctness", "ERROR", "error", "NP_NULL", "A@k@.java", "@k@", None, "Null @n@", ""), ("security_finding", "spotbugs", "security", "WARNING", "warning", "SQL_INJ", "B.java", 4, None, "SQL", ""), ("performance_issue", "spotbugs", "performance", "INFO", "info", "SLOW", "C.java", 5, None, "Slow", "")],
    ),
    "ktlint_json": (
        '[{"file": "A@k@.kt", "errors": [{"line": @k@, "column": 2, "rule": "no-wildcard-imports", "message": "Wildcard @n@"}]}]',
        _lint("ktlint", "code_style", ("WARNING", "no-wildcard-imports", "A@k@.kt", "@k@", 2, "Wildcard @n@")),
    ),
    "hadolint_json": (
        '[{"file": "Dockerfile.@k@", "line": @k@, "column": 1, "code": "DL3008", "message": "Pin @n@", "level": "warning"}, {"file": "Dockerfile.@k@", "line": 2, "column": 1, "code": "DL3020", "message": "Use COPY", "level": "error"}, {"file": "Dockerfile.@k@", "line": 3, "column": 1, "code": "DL3059", "message": "Join", "level": "info"}]',
        _lint("hadolint", "dockerfile", ("WARNING", "DL3008", "Dockerfile.@k@", "@k@", 1, "Pin @n@"), ("ERROR", "DL3020", "Dockerfile.@k@", 2, 1, "Use COPY"), ("INFO", "DL3059", "Dockerfile.@k@", 3, 1, "Join")),
    ),
    "lintr_json": (
        '[{"filename": "a@k@.R", "line_number": @k@, "column_number": 8, "linter": "object_name_linter", "message": "Name @n@", "type": "style", "line": "x <- 1"}, {"filename": "a@k@.R", "line_number": 2, "column_number": 1, "linter": "error", "message": "Bad", "type": "error", "line": "("}]',
        _lint("lintr", "r_code_style", ("WARNING", "object_name_linter", "a@k@.R", "@k@", 8, "Name @n@"), ("ERROR", "error", "a@k@.R", 2, 1, "Bad")),
    ),
    "sqlfluff_json": (
        '[{"filepath": "q@k@.sql", "violations": [{"line_no": @k@, "line_pos": 4, "code": "L010", "rule": "capitalisation", "description": "Keywords @n@"}]}]',
        _lint("sqlfluff", "sql_style", ("WARNING", "L010", "q@k@.sql", "@k@", 4, "Keywords @n@")),
    ),
    "tflint_json": (
        '{"issues": [{"rule": {"name": "aws_bad_type", "severity": "error"}, "message": "Bad @n@", "range": {"filename": "m@k@.tf", "start": {"line": @k@, "column": 5}}}, {"rule": {"name": "naming", "severity": "notice"}, "message": "Name", "range": {"filename": "m@k@.tf", "start": {"line": 2, "column": 1}}}]}',
        _lint("tflint", "infrastructure", ("ERROR", "aws_bad_type", "m@k@.tf", "@k@", 5, "Bad @n@"), ("INFO", "naming", "m@k@.tf", 2, 1, "Name")),
    ),
    "bandit_json": (
        '{"results": [{"filename": "a@k@.py", "line_number": @k@, "col_offset": 4, "test_id": "B602", "test_name": "shell", "issue_severity": "HIGH", "issue_text": "Shell @n@"}, {"filename": "a@k@.py", "line_number": 2, "col_offset": 0, "test_id": "B101", "test_name": "assert", "issue_severity": "LOW", "issue_text": "Assert"}]}',
        _lint("bandit", "security", ("ERROR", "B602", "a@k@.py", "@k@", 4, "Shell @n@"), ("INFO", "B101", "a@k@.py", 2, 0, "Assert"), kind="security_finding"),
    ),
    "trivy_json": (
        '{"ArtifactName": "img", "Results": [{"Target": "img@k@ (debian)", "Class": "os-pkgs", "Vulnerabilities": [{"VulnerabilityID": "CVE-2024-@k@", "PkgName": "zlib", "Severity": "CRITICAL", "Title": "Overflow @n@", "InstalledVersion": "1.0", "FixedVersion": "1.1"}, {"VulnerabilityID": "CVE-2024-2", "PkgName": "ssl", "Severity": "MEDIUM", "Title": "Leak"}]}]}',
        _lint("trivy", "vulnerability", ("ERROR", "CVE-2024-@k@", "img@k@ (debian)", None, None, "Overflow @n@"), ("WARNING", "CVE-2024-2", "img@k@ (debian)", None, None, "Leak"), kind="security_finding"),
    ),
    "kube_score_json": (
        '[{"object_name": "web@k@", "type_meta": {"kind": "Deployment"}, "file_name": "d@k@.yml", "file_row": @k@, "checks": [{"check": {"id": "pod-probes", "name": "Probes", "comment": "Add"}, "grade": "CRITICAL", "comments": [{"path": "app@n@", "summary": "No probe @n@", "description": "Set one"}]}, {"check": {"id": "net", "name": "Network", "comment": "c"}, "grade": "WARNING", "comments": []}, {"check": {"id": "fine", "name": "Fine"}, "grade": "OK", "comments": []}]}]',
        [("lint_issue", "kube-score", "kubernetes", "ERROR", "critical", "pod-probes", "d@k@.yml", "@k@", None, "No probe @n@", "app@n@"), ("lint_issue", "kube-score", "kubernetes", "WARNING", "warning", "net", "d@k@.yml", "@k@", None, "Network", "")],
    ),
    "ruff_json": (
        '[{"filename": "a@k@.py", "code": "F401", "message": "unused @n@", "url": "u", "location": {"row": @k@, "column": 8}, "fix": {"message": "Remove"}}, {"filename": "b.py", "code": "B006", "message": "mutable", "url": "u", "location": {"row": 2, "column": 1}}]',
        [*_lint("ruff", "ruff_json", ("ERROR", "F401", "a@k@.py", "@k@", 8, "unused @n@"), ("WARNING", "B006", "b.py", 2, 1, "mutable")), ("summary", "ruff", "ruff_json", "FAIL", "error", "", "", None, None, "Found 2 errors", "")],
    ),
    "tfsec_json": (
        '{"results": [{"rule_id": "AVD-AWS-0086", "description": "Public @n@", "resource": "aws_s3.b@k@", "severity": "HIGH", "location": {"filename": "m@k@.tf", "start_line": @k@, "end_line": @k@}, "resolution": "Block"}, {"rule_id": "AVD-2", "description": "Meh", "resource": "r", "severity": "LOW", "location": {"filename": "n.tf", "start_line": 2}}]}',
        _lint("tfsec", "infrastructure_security", ("ERROR", "AVD-AWS-0086", "m@k@.tf", "@k@", None, "Public @n@"), ("INFO", "AVD-2", "n.tf", 2, None, "Meh"), kind="security_finding"),
    ),
}



def _total(tool: str, status: str, message: str) -> tuple:
    return ("summary", tool, "lint_summary", status, status.lower(), "", "", None, None, message, "")


TEXT_LINTERS = {
    "mypy_text": (
        'app/m@k@.py:@k@: error: Name "foo" is not defined  [name-defined]\napp/m@k@.py:7: note: See @n@\nFound 1 error in 1 file (checked @k@ source files)\nFound 1 error in 1 file (checked @k@ files)',
        [("build_error", "mypy", "type_checking", "ERROR", "error", "name-defined", "app/m@k@.py", "@k@", None, 'Name "foo" is not defined', ""), ("lint_issue", "mypy", "type_checking", "INFO", "info", "", "app/m@k@.py", 7, None, "See @n@", ""),
         ("build_error", "mypy", "type_checking", "ERROR", "error", "", "", None, None, "Found 1 errors in 1 files (checked @k@ files)", "")],
    ),
    "flake8_text": (
        "a@k@.py:@k@:1: F401 'os' imported @n@\na@k@.py:2:80: E501 line too long\na@k@.py:3:1: W291 trailing",
        [("build_error", "flake8", "style_guide", "ERROR", "error", "F401", "a@k@.py", "@k@", 1, "'os' imported @n@", ""), *_lint("flake8", "style_guide", ("ERROR", "E501", "a@k@.py", 2, 80, "line too long"), ("WARNING", "W291", "a@k@.py", 3, 1, "trailing"))],
    ),
    "pylint_text": (
        "************* Module pkg.m@k@\npkg/m@k@.py:@k@:4: C0114: Missing @n@ (missing-module-docstring)\npkg/m@k@.py:2:0: E0602: Undefined variable (undefined-variable)\nW: 12,4: Unused (unused-import)\nYour code has been rated at 7.@n@/10",
        [*_lint("pylint", "code_quality", ("INFO", "C0114", "pkg/m@k@.py", "@k@", 4, "Missing @n@ (missing-module-docstring)"), ("WARNING", "unused-import", "pkg.m@k@", 12, 4, "Unused")),
         ("build_error", "pylint", "code_quality", "ERROR", "error", "E0602", "pkg/m@k@.py", 2, 0, "Undefined variable (undefined-variable)", ""), ("summary", "pylint", "code_quality", "INFO", "info", "", "", None, None, "Code quality rating: 7.@n@/10", "")],
    ),
    "black_text": (
        "would reformat a@k@.py\nAll done! ✨ 🍰 ✨\n@k@ files would be reformatted, @n@ files would be left unchanged.",
        [("lint_issue", "black", "code_formatting", "INFO", "info", "", "a@k@.py", None, None, "File would be reformatted by Black", ""), ("summary", "black", "code_formatting", "PASS", "info", "", "", None, None, "Black formatting check completed successfully", ""),
         ("build_error", "black", "code_formatting", "WARNING", "warning", "", "", None, None, "@k@ files would be reformatted, @n@ files would be left unchanged", "")],
    ),
    "isort_text": (
        "Fixing /src/a@k@.py\nSkipped @n@ files\n--- b@k@.py:before\n-import os\n+from a import b",
        [("lint_issue", "isort", "import_sorting", "INFO", "info", "", "/src/a@k@.py", None, None, "isort fixed import ordering", ""), ("summary", "isort", "import_sorting", "INFO", "info", "", "", None, None, "Skipped @n@ files", ""), ("lint_issue", "isort", "import_sorting", "INFO", "info", "", "b@k@.py", None, None, "isort would reorder imports", ""),
         ("lint_issue", "isort", "import_sorting", "INFO", "info", "", "b@k@.py", None, None, "Remove: import os", ""), ("lint_issue", "isort", "import_sorting", "INFO", "info", "", "b@k@.py", None, None, "Add: from a import b", "")],
    ),
    "eslint_text": (
        "/src/a@k@.js\n  @k@:10  error  'x' is not defined  no-undef\n  3:1   warning  Unexpected @n@  no-console\n\n/src/b.ts\n  1:1  error  Parsing error  parse",
        [*_lint("eslint", "lint", ("ERROR", "no-undef", "/src/a@k@.js", "@k@", 10, "'x' is not defined"), ("WARNING", "no-console", "/src/a@k@.js", 3, 1, "Unexpected @n@"), ("ERROR", "parse", "/src/b.ts", 1, 1, "Parsing error")), _total("eslint", "ERROR", "3 problem(s) (2 error(s), 1 warning(s))")],
    ),
    "rubocop_text": (
        "Inspecting 2 files\nlib/a@k@.rb:@k@:81: C: Layout/LineLength: Line is too long @n@\nlib/b.rb:2:1: W: Lint/Useless: Useless\nlib/b.rb:3:1: E: Lint/Syntax: Bad",
        [*_lint("rubocop", "lint", ("INFO", "Layout/LineLength", "lib/a@k@.rb", "@k@", 81, "Line is too long @n@"), ("WARNING", "Lint/Useless", "lib/b.rb", 2, 1, "Useless"), ("ERROR", "Lint/Syntax", "lib/b.rb", 3, 1, "Bad")), _total("rubocop", "ERROR", "3 offense(s) detected")],
    ),
    "shellcheck_text": (
        "In s@k@.sh line @k@:\necho $x\n     ^-- SC2086 (info): Double quote @n@\n\nIn s@k@.sh line 9:\nif then\n^-- SC1009 (error): Parse",
        [*_lint("shellcheck", "lint", ("INFO", "SC2086", "s@k@.sh", "@k@", 6, "Double quote @n@"), ("ERROR", "SC1009", "s@k@.sh", 9, 1, "Parse")), _total("shellcheck", "ERROR", "2 issue(s) found")],
    ),
    "hadolint_text": (
        "Dockerfile:@k@ DL3008 warning: Pin versions @n@\nDockerfile:2 DL3020 error: Use COPY\nDockerfile:3 DL3059 info: Join",
        [*_lint("hadolint", "lint", ("WARNING", "DL3008", "Dockerfile", "@k@", 0, "Pin versions @n@"), ("ERROR", "DL3020", "Dockerfile", 2, 0, "Use COPY"), ("INFO", "DL3059", "Dockerfile", 3, 0, "Join")), _total("hadolint", "ERROR", "3 issue(s) found")],
    ),
    "ruff_text": (
        "F401 [*] `os` imported @n@\n --> a@k@.py:@k@:8\n  |\nhelp: Remove import\n\nW291 Trailing\n --> b.py:2:1\n\nFound 2 errors.",
        [("lint_issue", "ruff", "ruff_text", "FAIL", "error", "F401", "a@k@.py", "@k@", 8, "`os` imported @n@", ""), ("lint_issue", "ruff", "ruff_text", "WARNING", "warning", "W291", "b.py", 2, 1, "Trailing", ""), ("summary", "ruff", "ruff_text", "FAIL", "error", "", "", None, None, "Found 2 errors", "")],
    ),
    "clang_tidy_text": (
        "src/a@k@.cpp:@k@:7: warning: use nullptr @n@ [modernize-use-nullptr]\nsrc/a@k@.cpp:3:1: error: bad [clang-diagnostic-error]\nsrc/a@k@.cpp:4:2: note: here\n@n@ warnings generated.",
        [*_lint("clang-tidy", "static_analysis", ("WARNING", "modernize-use-nullptr", "src/a@k@.cpp", "@k@", 7, "use nullptr @n@"), ("INFO", "", "src/a@k@.cpp", 4, 2, "here")),
         ("build_error", "clang-tidy", "static_analysis", "ERROR", "error", "clang-diagnostic-error", "src/a@k@.cpp", 3, 1, "bad", ""), ("summary", "clang-tidy", "static_analysis", "WARNING", "warning", "", "", None, None, "@n@ warnings generated by clang-tidy", "")],
    ),
    "bandit_text": (
        ">> Issue: [B602:subprocess_popen] shell @n@\n   Severity: High   Confidence: High\n   CWE: CWE-78 (https://cwe)\n   Location: a@k@.py:@k@\n>> Issue: [B101:assert_used] assert\n   Severity: Low   Confidence: High\n   Location: b.py:12:5\nCode scanned: @n@ files\nTotal issues: 2",
        [("security_finding", "bandit", "bandit_text", "FAIL", "error", "B602:subprocess_popen", "a@k@.py", "@k@", None, "shell @n@ (CWE-78: https://cwe)", ""), ("security_finding", "bandit", "bandit_text", "INFO", "info", "B101:assert_used", "b.py:12", 5, None, "assert", ""),
         ("summary", "bandit", "bandit_text", "INFO", "info", "", "", None, None, "Scanned @n@ files", ""), ("summary", "bandit", "bandit_text", "WARNING", "warning", "", "", None, None, "Total security issues: 2", "")],
    ),
    "generic_lint": (
        "a@k@.x:@k@:3: error: bad @n@\nb.x:4: warning: meh\nc.x:5:1: note: see",
        [("lint_issue", "lint", "lint_error", "ERROR", "error", "", "a@k@.x", "@k@", 3, "bad @n@", ""), ("lint_issue", "lint", "lint_warning", "WARNING", "warning", "", "b.x", 4, None, "meh", ""), ("lint_issue", "lint", "lint_info", "INFO", "info", "", "c.x", 5, 1, "see", "")],
    ),
}


def _log(tool: str, *events: tuple) -> list:
    """Log events: (status, category, code, message)."""
    return [("debug_info", tool, e[1], e[0], e[0].lower(), e[2], "", None, None, e[3], "") for e in events]


CLOUD_AND_APP_LOGS = {
    "aws_cloudtrail": (
        '{"eventTime":"2025-01-15T10:30:45Z","eventName":"CreateUser","eventSource":"iam.amazonaws.com","awsRegion":"us-east-1","userIdentity":{"arn":"arn:@k@"}}\n{"eventTime":"2025-01-15T10:30:45Z","eventName":"DeleteBucket@k@","eventSource":"s3.amazonaws.com"}\n{"eventName":"PutItem","eventSource":"db","errorCode":"AccessDenied@n@"}',
        _log("aws_cloudtrail", ("INFO", "iam.amazonaws.com", "", "CreateUser"), ("WARNING", "s3.amazonaws.com", "", "DeleteBucket@k@"), ("ERROR", "db", "AccessDenied@n@", "PutItem")),
    ),
    "gcp_cloud_logging": (
        '{"entries":[{"timestamp":"2025-01-15T10:30:45Z","severity":"ERROR","logName":"projects/p/logs/@k@","textPayload":"boom @n@"},{"timestamp":"t","severity":"NOTICE","logName":"l","protoPayload":{"methodName":"Insert@k@","serviceName":"compute"},"resource":{"type":"gce"}},{"severity":"INFO","logName":"only@n@","resource":{"type":"gce"}}]}',
        _log("gcp_cloud_logging", ("ERROR", "gcp", "", "boom @n@"), ("WARNING", "compute", "", "Insert@k@"), ("INFO", "gce", "", "only@n@")),
    ),
    "azure_activity": (
        '{"time":"2025-01-15T10:30:45Z","operationName":"Create@k@","caller":"a@b","level":"Informational","category":"Administrative"}\n{"operationName":"Delete","resourceId":"/r/@n@","level":"Error","status":"Failed"}\n{"operationName":"Start","level":"Warning","resourceProviderName":"Microsoft.Compute"}',
        _log("azure_activity", ("INFO", "Administrative", "", "Create@k@"), ("ERROR", "azure", "Failed", "Delete"), ("WARNING", "Microsoft.Compute", "", "Start")),
    ),
    "serilog": (
        '{"@t":"2025-01-15T10:30:45Z","@mt":"User @k@ in","@l":"Error","@x":"E@n@","SourceContext":"App.Svc"}\n[10:30:45 WRN] Disk @n@\n{"@t":"t","@mt":"plain"}\n[2025-01-15 10:30:45.123 +00:00] [INF] Started @k@',
        _log("serilog", ("ERROR", "App.Svc", "E@n@", "User @k@ in"), ("WARNING", "", "", "Disk @n@"), ("INFO", "", "", "plain"), ("INFO", "", "", "Started @k@")),
    ),
    "ruby_logger": (
        "I, [2025-01-15T10:30:45.123456 #@k@]  INFO -- myapp: User @n@ in\nE, [2025-01-15T10:30:46.456789 #1234] ERROR -- my::app: Failed\nW, [2025-01-15T10:30:46.456789 #1234]  WARN -- : no program",
        _log("ruby_logger", ("INFO", "myapp", "", "User @n@ in"), ("ERROR", "my::app", "", "Failed")),
    ),
    "pino": ('{"level":50,"time":1705315845123,"msg":"bad @k@","name":"api","hostname":"h"}\n{"level":30,"time":1705315845123,"msg":"ok @n@"}\n{"level":40,"time":1705315845123,"msg":"slow"}', _log("pino", ("ERROR", "api", "", "bad @k@"), ("INFO", "", "", "ok @n@"), ("WARNING", "", "", "slow"))),
    "bunyan": ('{"v":0,"name":"api@n@","level":50,"time":"2025-01-15T10:30:45Z","msg":"bad @k@"}\n{"v":0,"name":"web","level":40,"time":"t","msg":"slow"}', _log("bunyan", ("ERROR", "api@n@", "", "bad @k@"), ("WARNING", "web", "", "slow"))),
    "nlog": ("2025-01-15 10:30:45.123|ERROR|App.Svc@n@|Failed @k@|E1\n2025-01-15 10:30:46.123|WARN|App|Slow\n2025-01-15 10:30:46.123|INFO|App|Fine", _log("nlog", ("ERROR", "App.Svc@n@", "E1", "Failed @k@"), ("WARNING", "App", "", "Slow"), ("INFO", "App", "", "Fine"))),
    "hdfs": ("081109 203615 148 INFO dfs.DataNode$PacketResponder: PacketResponder @k@ terminating\n081109 203615 148 WARN dfs.FSNamesystem: Low @n@", _log("hdfs", ("INFO", "dfs.DataNode$PacketResponder", "", "PacketResponder @k@ terminating"), ("WARNING", "dfs.FSNamesystem", "", "Low @n@"))),
    "spark": ("17/06/09 20:10:40 INFO executor.Executor: Running task @k@\n17/06/09 20:10:41 ERROR storage.Block: Lost @n@", _log("spark", ("INFO", "executor.Executor", "", "Running task @k@"), ("ERROR", "storage.Block", "", "Lost @n@"))),
    "zookeeper": ("2015-07-29 17:41:44,747 - INFO  [QuorumPeer[myid=1]/0:0:0:0:0:0:0:0:2181:FastLeaderElection@774] - Round @k@\n2015-07-29 17:41:45,747 - WARN  [main:Peer@1] - Slow @n@", _log("zookeeper", ("INFO", "zookeeper", "", "Round @k@"), ("WARNING", "zookeeper", "", "Slow @n@"))),
}

SYSTEM_LOGS = {
    "winston": ('{"level":"error","message":"bad @k@","timestamp":"t","service":"api"}\n2025-01-15T10:30:45.123Z [web@n@] warn: slow @k@\n{"level":"info","message":"fine"}', _log("winston", ("ERROR", "api", "", "bad @k@"), ("WARNING", "web@n@", "", "slow @k@"), ("INFO", "", "", "fine"))),
    "logrus": ('time="2025-01-15T10:30:45Z" level=error msg="Failed @k@" error=timeout\nWARN[0012] Slow @n@\ntime="2025-01-15T10:30:45Z" level=info msg="ok"', _log("logrus", ("ERROR", "", "timeout", "Failed @k@"), ("WARNING", "", "", "Slow @n@"), ("INFO", "", "", "ok"))),
    "android": ("03-17 16:13:38.811  1702  2395 D WindowManager: print @k@\n03-17 16:13:38.819  1702  8671 E Power: boom @n@\n03-17 16:13:38.820  1702  8671 W Net: slow", _log("android", ("INFO", "WindowManager", "", "print @k@"), ("ERROR", "Power", "", "boom @n@"), ("WARNING", "Net", "", "slow"))),
    "bgl": ("- 1117838570 2005.06.03 R02-M1 2005-06-03-15.42.50.675872 R02-M1 RAS KERNEL INFO cache @k@\nKERNDTLB 1117838571 2005.06.03 R02 2005-06-03-15.42.51.1 R02 RAS APP FATAL tlb @n@", _log("bgl", ("INFO", "RAS/KERNEL", "", "cache @k@"), ("ERROR", "RAS/APP", "", "tlb @n@"))),
    "openstack": ("nova-api.log.1 2017-05-16 00:00:00.008 25746 INFO nova.osapi [req-38101a0b - default] GET @k@\n2017-05-16 00:00:01.008 2931 ERROR nova.compute [-] Lost @n@", _log("openstack", ("INFO", "nova.osapi", "", "GET @k@"), ("ERROR", "nova.compute", "", "Lost @n@"))),
    "iptables": (
        "Jan 15 10:30:45 fw@n@ kernel: [1.2] [UFW BLOCK] IN=eth0 OUT= SRC=10.0.0.@n@ DST=10.0.0.2 PROTO=TCP SPT=@k@ DPT=22\nJan 15 10:30:46 fw kernel: ACCEPT IN=eth1 SRC=10.1.1.1 DST=10.1.1.2",
        _log("iptables", ("WARNING", "fw@n@", "", "block: 10.0.0.@n@:@k@ -> 10.0.0.2:22 (TCP)"), ("INFO", "fw", "", "log: 10.1.1.1 -> 10.1.1.2")),
    ),
    "pf": ("Jan 15 10:30:45.123 rule 5/0(match): block in on em@n@: 10.0.0.1.@k@ > 10.0.0.2.22: Flags [S]\nJan 15 10:30:46 rule 6/0(match): pass out on em1: 10.0.0.3.80 > 10.0.0.4.443: ", _log("pf", ("WARNING", "em@n@", "", "block in: 10.0.0.1:@k@ -> 10.0.0.2:22 [Flags [S]]"), ("INFO", "em1", "", "pass out: 10.0.0.3:80 -> 10.0.0.4:443"))),
    "cisco_asa": ("Jan 15 2025 10:30:45 asa@n@ : %ASA-4-106023: Deny tcp src outside:10.0.0.1/@k@ dst inside:10.0.0.2/22\n%ASA-6-302013: Built @n@\n%ASA-3-710003: denied", _log("cisco_asa", ("WARNING", "asa@n@", "ASA-4-106023", "Deny tcp src outside:10.0.0.1/@k@ dst inside:10.0.0.2/22"), ("INFO", "", "ASA-6-302013", "Built @n@"), ("ERROR", "", "ASA-3-710003", "denied"))),
    "s3_access": (
        'own bkt@n@ [06/Feb/2019:00:00:38 +0000] 192.0.2.3 arn:x REQ1 REST.GET.OBJECT key@k@.txt "GET /k HTTP/1.1" 200 - 113 - 7 - "-" "S3" -\nown bkt [06/Feb/2019:00:00:39 +0000] 192.0.2.4 - REQ2 REST.PUT.OBJECT - "PUT / HTTP/1.1" 403 AccessDenied 243 - 1 - "-" "x" -',
        _log("s3_access", ("INFO", "bkt@n@", "", "REST.GET.OBJECT key@k@.txt -> 200"), ("WARNING", "bkt", "AccessDenied", "REST.PUT.OBJECT -> 403 (AccessDenied)")),
    ),
    "syslog": ("Jan 15 10:30:45 host@n@ sshd[@k@]: Accepted key\nJan 15 10:30:46 host cron: job @k@", _log("syslog", ("INFO", "sshd", "", "Accepted key"), ("INFO", "cron", "", "job @k@"))),
    "logfmt": ('ts=2025-01-15T10:30:45Z level=error msg="bad @k@" component=api@n@\nlevel=warn msg=slow\nlevel=info msg="fine @k@"', _log("logfmt", ("ERROR", "api@n@", "", "bad @k@"), ("WARNING", "log_entry", "", "slow"), ("INFO", "log_entry", "", "fine @k@"))),
}



def _test(tool: str, category: str, *events: tuple) -> list:
    """Test events: (status, severity, file, line, message, test[, kind])."""
    return [(e[6] if len(e) > 6 else "test_result", tool, category, e[0], e[1], "", e[2], e[3], None, e[4], e[5]) for e in events]


TESTS_AND_TRACES = {
    "pytest_text": (
        "tests/test_a@k@.py::test_one PASSED\ntests/test_a@k@.py::test_two FAILED [ 50%]\n=================================== FAILURES ===================================\n___________ test_two ___________\n    def test_two():\n>       assert 1 == 2\nE       assert 1 == @n@\n\ntests/test_a@k@.py:@k@: AssertionError\n"
        "=========================== short test summary info ============================\nFAILED tests/test_a@k@.py::test_two - assert 1 == 2\n=========== 1 passed, 1 failed in 0.12s ============",
        [*_test("pytest", "test", ("PASS", "info", "tests/test_a@k@.py", None, "Test passed", "test_one"), ("FAIL", "error", "tests/test_a@k@.py", "@k@", "assert 1 == @n@", "test_two")), *_test("pytest", "test_summary", ("ERROR", "error", "", None, "1 passed, 1 failed in 0.12s", "", "summary"))],
    ),
    "gtest_text": (
        "[==========] Running 3 tests from 1 test suite.\n[----------] 3 tests from Suite@n@\n[ RUN      ] Suite.One\n[       OK ] Suite.One@k@ (@n@ ms)\n[  FAILED  ] Suite.Two (1 ms)\n[  PASSED  ] @k@ tests.\n[  FAILED  ] 1 tests, listed below:\n[==========] 3 tests from 2 test suites ran. (9 ms total)",
        _test("gtest", "gtest_text", ("PASS", "info", "", 0, "Test passed: Suite.One@k@ ", "Suite.One@k@ "), ("FAIL", "error", "", 0, "Test failed: Suite.Two ", "Suite.Two "), ("PASS", "info", "", 0, "Tests passed: @k@ tests", "", "summary"), ("FAIL", "error", "", 0, "Tests failed: 1 tests", "", "summary"), ("INFO", "info", "", 0, "Test execution completed: 3 tests from 2 test suites", "", "summary")),
    ),
    "gotest_text": (
        "=== RUN   TestA@k@\n--- PASS: TestA@k@ (0.01s)\n=== RUN   TestB\n    b@k@_test.go:@k@: want @n@\n    b_test.go:9: again\n--- FAIL: TestB (0.02s)\n=== RUN   TestC\n--- SKIP: TestC (0.00s)\nFAIL\nFAIL\texample.com/p\t0.1s",
        _test("go_test", "test", ("PASS", "info", "", None, "TestA@k@ passed", "TestA@k@"), ("FAIL", "error", "b@k@_test.go", "@k@", "want @n@", "TestB"), ("SKIP", "info", "", None, "TestC skipped", "TestC")),
    ),
    "cargo_test_json": (
        '{"type":"test","event":"started","name":"a::t@k@"}\n{"type":"test","event":"ok","name":"a::t@k@","exec_time":0.1}\n{"type":"test","event":"started","name":"b"}\n{"type":"test","event":"failed","name":"b","stdout":"boom @n@"}\n{"type":"test","event":"ok","name":"never started"}',
        _test("cargo_test", "test", ("PASS", "info", "", None, "Test passed", "a::t@k@"), ("FAIL", "error", "", None, "boom @n@", "b")),
    ),
    "coverage_text": (
        "Name        Stmts   Miss  Cover   Missing\n---------------------------------------\na@k@.py        10      1    90%   @k@-9\nb.py        10      8    20%\nTOTAL       20      9    75%\ncoverage run t@n@.py",
        [("summary", "coverage", "report_header", "INFO", "info", "", "", None, None, "Coverage report table started", ""), ("summary", "coverage", "line_coverage", "INFO", "info", "", "a@k@.py", None, None, "Stmts: 10, Miss: 1, Cover: 90%", ""), ("summary", "coverage", "line_coverage", "ERROR", "error", "", "b.py", None, None, "Stmts: 10, Miss: 8, Cover: 20%", ""),
         ("summary", "coverage", "line_coverage", "WARNING", "warning", "", "TOTAL", None, None, "Stmts: 20, Miss: 9, Cover: 75%", ""), ("summary", "coverage", "command", "INFO", "info", "", "", None, None, "Coverage run: t@n@.py", "")],
    ),
    "strace": (
        'execve("/bin/a@k@", ["a"], 0x7f) = 0\n[pid @k@] openat(AT_FDCWD, "/etc/x") = -1 ENOENT (No such file)\n--- SIGCHLD {si_signo=SIGCHLD, si_pid=@k@} ---\n+++ exited with 3 +++\nnothing here',
        [("debug_event", "strace", "process", "INFO", "info", "", "", None, None, "execve (incomplete)", ""), ("debug_event", "strace", "file", "INFO", "info", "", "", None, None, "openat (incomplete)", ""), ("crash_signal", "strace", "signal", "WARNING", "warning", "SIGCHLD", "", None, None, "Signal SIGCHLD: si_signo=SIGCHLD, si_pid=@k@", ""), ("summary", "strace", "exit", "FAIL", "info", "3", "", None, None, "Process exited with code 3", "")],
    ),
    "duckdb_test": (
        "[1/2] (50%): test/a@k@.test\nWrong result in query! (test/a@k@.test:@k@)!\n====\nSELECT @n@\nMismatch on row 1, column x@n@\nFAILED:\nFAILED:\ntest cases: 2 | @n@ passed | 1 failed",
        _test("duckdb_test", "test_failure", ("FAIL", "error", "test/a@k@.test", "@k@", "Wrong result in query! (test/a@k@.test:@k@)! | Mismatch on row 1, column x@n@", "")) + _test("duckdb_test", "test_summary", ("INFO", "info", "", None, "Test summary: @n@ tests passed", "")),
    ),
}

def _of(tool: str, *events: tuple) -> list:
    """Events: (kind, category, status, severity, code, file, line, column, message, test)."""
    return [(e[0], tool, *e[1:]) for e in events]


STATE_MACHINES = {
    "rspec_text": (
        "User\n  validations\n    is valid @k@\n    needs a name (FAILED - 1)\n    waits (PENDING: later)\n  #save\n    keeps @n@ (FAILED - 2)\n\nFailures:\n\n  1) User validations needs a name\n     Failure/Error: expect(user).to be_valid\n\n       expected true\n            got: nil @k@\n     # ./spec/a@k@_spec.rb:@n@:in `block'\n\n"
        "  2) User #save keeps\n     Failure/Error: save\n     # ./spec/b_spec.rb:7:in `block'\n\nFinished in 2.5 seconds\n3 examples, 2 failures, 1 pending\n\nFailed examples:\n\nrspec ./spec/a_spec.rb:@k@ # User validations needs a name\n",
        _of("RSpec", ("test_result", "test_success", "PASS", "info", "", "", None, None, "Test passed: is valid @k@", "is valid @k@"), ("test_result", "test_failure", "FAIL", "error", "", "./spec/b_spec.rb", 7, None, "save", "needs a name"),
            ("test_result", "test_pending", "SKIP", "warning", "", "", None, None, "Test pending: waits", "waits"), ("test_result", "test_failure", "FAIL", "error", "", "./spec/a@k@_spec.rb", "@n@", None, "expect(user).to be_valid | Expected: true | Got: nil @k@", "keeps @n@"),
            ("test_result", "test_failure", "FAIL", "error", "", "./spec/a_spec.rb", "@k@", None, "Test failed: User validations needs a name", "User validations needs a name")),
    ),
    "mocha_chai_text": (
        "  User Model\n    #create\n      ✓ makes @k@ (45ms)\n      1) sets time\n\n  1 passing (1.8s)\n  2 pending\n  1 failing\n\n  1) User Model\n       #create\n         sets time:\n     TypeError: no @n@\n      at Context.<anonymous> (test/a@k@.js:@n@:41)\n",
        _of("mocha", ("test_result", "mocha_chai_text", "PASS", "info", "", "", 0, 0, "Test passed: makes @k@ ", "User Model #create makes @k@ "), ("summary", "mocha_chai_text", "INFO", "info", "", "", 0, 0, "Test execution completed with 1 passing tests", ""),
            ("summary", "mocha_chai_text", "WARNING", "warning", "", "", 0, 0, "Test execution completed with 2 pending tests", ""), ("summary", "mocha_chai_text", "FAIL", "error", "", "", 0, 0, "Test execution completed with 1 failing tests", ""),
            ("test_result", "mocha_chai_text", "FAIL", "error", "", "", 0, 0, "sets time failed", "sets time"), ("test_result", "mocha_chai_text", "FAIL", "error", "", "test/a@k@.js", "@n@", 41, "TypeError: no @n@", "User Model sets time")),
    ),
    "valgrind": (
        "==@k@== Memcheck, a memory error detector\n==@k@== Invalid read of size @n@\n==@k@==    at 0x1092: process_item (proc@k@.cpp:45)\n==@k@==    by 0x1095: main (main.cpp:78)\n==@k@==  Address 0x4a is 0 bytes after\n==@k@==    at 0x48: malloc (m.c:381)\n==@k@== @n@ bytes in 4 blocks are definitely lost in loss record 1 of 3\n==@k@==    at 0x4A: operator new\n"
        "==@k@==     in use at exit: 1,234 bytes in @n@ blocks\n==@k@==      possibly lost: 466 bytes in 8 blocks\n==@k@== Process terminating with default action of signal 11 (SIGSEGV)\n==@k@== ERROR SUMMARY: 5 errors from 5 contexts (suppressed: 0 from 0)",
        _of("Memcheck", ("memory_error", "Invalid read", "FAIL", "error", "", "proc@k@.cpp", 45, None, "Invalid read of size @n@", ""), ("memory_error", "Memory leak", "FAIL", "error", "", "", None, None, "@n@ bytes in 4 blocks are definitely lost", ""),
            ("summary", "heap_summary", "INFO", "info", "", "", None, None, "In use at exit: 1,234 bytes in @n@ blocks", ""), ("summary", "leak_summary", "WARNING", "warning", "", "", None, None, "Possibly lost: 466 bytes in 8 blocks", ""),
            ("memory_error", "process_termination", "FAIL", "error", "", "", None, None, "Process terminating with signal 11 (SIGSEGV)", ""), ("summary", "error_summary", "FAIL", "error", "", "", None, None, "Error summary: 5 errors from 5 contexts", "")),
    ),
    "nunit_xunit_text": (
        "NUnit 3.@n@.3\nTest Count: 10, Passed: 8, Failed: 1, Warnings: 0, Inconclusive: 0, Skipped: 1\nOverall result: Failed\nSource: C:/a@k@.cs:line 12\nSource: C:/late.cs:line 13\nDuration: 2.5 seconds\n  My.Tests.One@k@ [PASS]\n  My.Tests.Two [FAIL]\n   at My.Tests.Two() in /src/b@k@.cs:line @n@\nTotal tests: @k@",
        _of("nunit", ("debug_info", "nunit_xunit_text", "INFO", "info", "", "", 0, 0, "NUnit version 3.@n@.3", ""), ("summary", "nunit_xunit_text", "FAIL", "error", "", "", 0, 0, "Test summary: 10 total, 8 passed, 1 failed, 1 skipped", ""),
            ("test_result", "nunit_xunit_text", "FAIL", "error", "", "C:/a@k@.cs", 12, 0, "Overall test result: Failed", ""), ("performance_metric", "nunit_xunit_text", "INFO", "info", "", "", 0, 0, "Test execution time: 2.5 seconds", ""))
        + _of("xunit", ("test_result", "nunit_xunit_text", "PASS", "info", "", "", 0, 0, "Test passed: My.Tests.One@k@ ", "My.Tests.One@k@ "), ("test_result", "nunit_xunit_text", "FAIL", "error", "", "/src/b@k@.cs", "@n@", 0, "Test failed: My.Tests.Two ", "My.Tests.Two "), ("summary", "nunit_xunit_text", "INFO", "info", "", "", 0, 0, "Total tests: @k@", "")),
    ),
    "pytest_cov_text": (
        "===== test session starts =====\nplatform linux -- Python 3.11.0, pytest-7.4, pluggy-1.0\ncollected @k@ items\ntests/test_a@k@.py::test_one PASSED [ 50%]\n===== FAILURES =====\nE       AssertionError: not @n@\n===== short test summary info =====\n----------- coverage: platform linux, python 3.11.0 -----------\nName      Stmts   Miss  Cover\nsrc/a@k@.py     50     10    80%   3-4\nTOTAL       100     40    60%\n"
        "Required test coverage of 90% not met. Total coverage: 60%\nE       AssertionError: outside\nCoverage XML written to c@n@.xml",
        _of("pytest-cov", ("summary", "test_session", "INFO", "info", "", "", None, None, "Test session started", ""), ("summary", "environment", "INFO", "info", "", "", None, None, "Platform: linux, Python: 3.11.0, pytest: 7.4", ""), ("summary", "test_collection", "INFO", "info", "", "", None, None, "Collected @k@ test items", ""),
            ("test_result", "test_execution", "PASS", "info", "", "tests/test_a@k@.py", None, None, "Test test_one PASSED", ""), ("test_result", "assertion_error", "FAIL", "error", "", "", None, None, "AssertionError: not @n@", ""), ("summary", "coverage_section", "INFO", "info", "", "", None, None, "Coverage analysis started - Platform: linux, Python: 3.11.0", ""),
            ("performance_metric", "file_coverage", "WARNING", "warning", "", "src/a@k@.py", None, None, "Coverage: 80% (50 statements, 10 missed) - Missing lines: 3-4", ""), ("performance_metric", "file_coverage", "FAIL", "error", "", "TOTAL", None, None, "Coverage: 60% (100 statements, 40 missed)", ""),
            ("lint_issue", "coverage_threshold", "FAIL", "error", "", "", None, None, "Required coverage not met: Expected 90%, got 60%", ""), ("summary", "report_generation", "INFO", "info", "", "", None, None, "Coverage XML report written to: c@n@.xml", "")),
    ),
    "autopep8_text": (
        "autopep8 --diff --aggressive src/\nApplied configuration:\n  max_line: @n@\n\n  other: 3\n--- original/m@k@.py\n+++ fixed/m@k@.py\nERROR: bad.py:@k@:5: E999 SyntaxError: invalid\nINFO: c.py: already formatted correctly\nfixed m@k@.py\nFiles processed: @n@",
        _of("autopep8", ("summary", "configuration", "INFO", "info", "", "", None, None, "Command: autopep8 --diff --aggressive src/", ""), ("summary", "configuration", "INFO", "info", "", "", None, None, "Configuration applied", ""), ("summary", "configuration", "INFO", "info", "", "", None, None, "max_line: @n@", ""),
            ("lint_issue", "formatting", "INFO", "info", "", "m@k@.py", None, None, "File formatting changes detected", ""), ("lint_issue", "syntax", "ERROR", "error", "E999", "bad.py", "@k@", 5, "SyntaxError: invalid", ""), ("summary", "formatting", "INFO", "info", "", "c.py", None, None, "already formatted correctly", ""),
            ("summary", "formatting", "INFO", "info", "", "m@k@.py", None, None, "File formatting applied", ""), ("summary", "summary", "INFO", "info", "", "", None, None, "Files processed: @n@", "")),
    ),
    "yapf_text": (
        "--- a/m@k@.py (original)\n+++ b/m@k@.py (reformatted)\nReformatted src/u.py\nyapf: error: no such file @n@\nLine length: 100\n@n@ files reformatted, @k@ files left unchanged.\nWARNING: w.py: cannot determine encoding",
        _of("yapf", ("lint_issue", "formatting", "INFO", "info", "", "m@k@.py", None, None, "File formatting changes detected", ""), ("summary", "formatting", "INFO", "info", "", "src/u.py", None, None, "File reformatted", ""), ("lint_issue", "command_error", "ERROR", "error", "", "", None, None, "no such file @n@", ""),
            ("summary", "configuration", "INFO", "info", "", "", None, None, "Line length: 100", ""), ("summary", "summary", "INFO", "info", "", "", None, None, "Files reformatted: @n@", ""), ("summary", "summary", "INFO", "info", "", "", None, None, "Files left unchanged: @k@", ""), ("lint_issue", "encoding", "WARNING", "warning", "", "w.py", None, None, "Cannot determine encoding", "")),
    ),
    "make_error": (
        "a.c:1:2: error: other tool\ngmake[3]: *** [build.make:121: x@k@.o] Error 1\nmake[1]: Entering directory '/b@n@'\nmake: *** [Makefile:@n@: all@k@] Error 2\nmake: *** No rule to make target",
        _of("make", ("build_error", "build_failure", "ERROR", "error", "", "build.make", None, None, "gmake[3]: *** [build.make:121: x@k@.o] Error 1", "x@k@.o"), ("debug_info", "build_context", "INFO", "info", "", "/b@n@", None, None, "make[1]: Entering directory '/b@n@'", ""), ("build_error", "build_failure", "ERROR", "error", "", "Makefile", None, None, "make: *** [Makefile:@n@: all@k@] Error 2", "all@k@")),
    ),
}

FAMILIES = {"q52_json_linters": JSON_LINTERS, "q53_text_linters": TEXT_LINTERS, "q54_cloud_and_app_logs": CLOUD_AND_APP_LOGS, "q55_system_logs": SYSTEM_LOGS, "q56_tests_and_traces": TESTS_AND_TRACES, "q60_state_machines": STATE_MACHINES}
