"""Formats whose lines mean something else in each part of a text: automata over lines."""

from __future__ import annotations

from .line_tools import ERROR, FAIL, INFO, PASS, SKIP, WARNING
from .spec import Lines, Machine, Rule, between, closed_by, quoted, told

ANY2, ANY4 = (0, 1), (0, 1, 2, 3)

# --- RSpec. State 1: behind `Failures:`, 2: behind `Failed examples:`, 3: behind both.
TOP, SUB, METHOD = r"^([A-Z][\w:]+)\s*$", r"^ {2}(#?\w.*\S)\s*$", r"^\s{4,}#(.*?)\s*$"
RAISED, EXPECTED, GOT, RAISED_AT = r"Failure/Error:\s*(\S.*)", r"expected\s*(.+)", r"got:\s*(.+)", r"# (\S.*):(\d+):in"
_DOC = r"^\s{4,}(\S.*?)\s*"
_TOP, _SUB = told(TOP, 3), f"coalesce({told(SUB, 4, since=3)}, '')"
_METHOD = f"CASE WHEN get(o.last, 5) > get(o.last, 4) THEN {told(METHOD, 5, since=3)} ELSE {_SUB} END"


def _line(pattern: str, group: int = 1, line: str = "y.line") -> str:
    return f"regexp_extract({line}, {quoted(pattern)}, {group})"


#: What a failure's block tells, with what was expected and what came.
_WHY = f"CASE WHEN get(q.last, 12) >= 0 THEN concat({told(RAISED, 12, o='q')}, array_join(" + between({13: f"concat(' | Expected: ', {_line(EXPECTED)})", 14: f"concat(' | Got: ', {_line(GOT)})"}, 12, o="q") + ", '')) END"
_PLACED = {"ref_file": "{v2}", "ref_line": "try_cast(nullif({v3}, '') AS int)"}
_LOST = {**FAIL, **_PLACED, "category": "=test_failure", "test_name": 1, "message": "coalesce(nullif({v4}, ''), concat('Test failed: ', {1}))"}
RSPEC = Machine(
    "RSpec", "test_result", "test_failure", states=4, opens=(6, 10), closes=(15,),
    moves={0: {0: 1, 1: 1, 2: 3, 3: 3}, 1: {0: 2, 1: 3, 2: 2, 3: 3}, 2: {2: 2, 3: 3}, **{r: {0: 0} for r in (5, 6, 7, 8)}},
    emits={r: () for r in (0, 1, 3, 4, 5, 12, 13, 14, 15)},
    values=(
        f"concat_ws(' ', nullif({_TOP}, ''), nullif({_SUB}, ''))",
        f"CASE WHEN {_TOP} <> '' THEN concat_ws('::', {_TOP}, nullif({_METHOD}, '')) END",
        closed_by(_line(RAISED_AT, 1, "q.line")), closed_by(_line(RAISED_AT, 2, "q.line")), closed_by(_WHY),
    ),
    rules=(
        Rule(r"Failures:", {}),
        Rule(r"Failed examples:", {}),
        Rule(r"rspec (\S.*?):(\d+) # (\S.*)", {**FAIL, "ref_file": 1, "ref_line": 2, "test_name": 3, "message": "concat('Test failed: ', {3})"}),
        Rule(TOP, {}),
        Rule(SUB, {}),
        Rule(METHOD, {}),
        Rule(_DOC + r"\(FAILED - \d+\)\s*$", {**_LOST, "function_name": "{v0}"}),
        Rule(_DOC + r"\(PENDING.*\)\s*$", {**SKIP, "category": "=test_pending", "test_name": 1, "function_name": "{v0}", "message": "concat('Test pending: ', {1})"}),
        Rule(_DOC + "$", {**PASS, "category": "=test_success", "test_name": 1, "function_name": "{v0}", "message": "concat('Test passed: ', {1})"}),
        Rule(r"✓\s*(\S.*)", {**PASS, "category": "=test_success", "test_name": 1, "function_name": "{v0}", "message": "concat('Test passed: ', {1})"}),
        Rule(r"✗\s*(\S.*)", {**_LOST, "function_name": "{v1}"}),
        Rule(r"pending:\s*(\S.*?)\s*\(PENDING:\s*(\S.*)\)", {**SKIP, "category": "=test_pending", "test_name": 1, "function_name": "{v1}", "message": "concat('Test pending: ', {2})"}),
        Rule(RAISED, {}),
        Rule(EXPECTED, {}),
        Rule(GOT, {}),
        Rule(RAISED_AT, {}),
        Rule(r"Finished in (\S+) seconds .*?(\d+) examples?, (\d+) failures?(?:, (\d+) pending)?", {**INFO, "event_type": "=summary", "category": "=test_summary", "execution_time": 1, "message": "concat('Test run completed: ', {2}, ' examples, ', {3}, ' failures, ', coalesce(nullif({4}, ''), '0'), ' pending')"}),
    ),
)

# --- Mocha. State 1: in a numbered failure without a place, 2: with one, 3: behind a cross, 4: behind a cross and its error.
SUITE, NESTED, CROSSED = r"^\s*([A-Z][A-Za-z\d\s]+)$", r"^\s{2,}([a-z#][A-Za-z\d\s#]+)$", r"^\s*✗\s*(.+)$"
THROWN, NUMBERED, FURTHER, STACKED = r"((?:Assertion|Type|Reference)?Error):\s*(.+)", r"^\s*(\d+)\)\s+(\S.*?):?\s*$", r"^\s{6,}(\S.*?):?\s*$", r"\((.+):(\d+):(\d+)\)"
_NAME = f"concat_ws(' ', {told(NUMBERED, 8, 2)}, nullif(array_join({between({9: _line(FURTHER)}, 8)}, ' '), ''))"
_ERROR = f"concat({told(THROWN, 5, 1)}, ': ', {told(THROWN, 5, 2)})"
#: The last place since the failure began and since a test passed.
_AT = "CASE WHEN greatest(get(o.last, 6), get(o.last, 7)) > greatest(get(o.last, 8), get(o.last, 0)) THEN get(_spots, greatest(get(o.last, 6), get(o.last, 7))).line END"
_HERE = {"ref_file": "{v2}", "ref_line": "coalesce(try_cast(nullif({v3}, '') AS int), 0)", "ref_column": "coalesce(try_cast(nullif({v4}, '') AS int), 0)"}
_NOWHERE = {"ref_line": "0", "ref_column": "0", "structured_data": "={}"}
_UNLINED = {"log_line_start": "NULL", "log_line_end": "NULL"}
_FAILURE = {**FAIL, **_HERE, "structured_data": "={}", "test_name": "{v0}", "log_content": "=", "log_line_start": "cast({v5} AS int)"}


def _full(name: str) -> str:
    return f"concat({{v6}}, ' ', {{v7}}, ' ', {name})"


def _counted(status: dict, kind: str, more: str = "") -> dict:
    return {**status, "event_type": "=summary", "ref_line": "0", "ref_column": "0", **_UNLINED, "message": f"concat('Test execution completed with ', {{1}}, ' {kind} tests')", "structured_data": f"concat('{{\"{kind}_tests\": ', {{1}}, '{more}}}')"}


MOCHA = Machine(
    "mocha", "test_result", "mocha_chai_text", states=5,
    moves={0: {0: 0, 1: 1, 2: 1, 3: 3, 4: 4}, 1: {0: 3, 1: 1, 2: 2, 3: 3, 4: 4}, 5: {0: 0, 1: 1, 2: 2, 3: 4, 4: 4}, 6: {0: 0, 1: 2, 2: 2, 3: 3, 4: 0}, 7: {1: 2}, 8: dict.fromkeys(range(5), 1), 9: {1: 1, 2: 2}, 13: {1: 1, 2: 2}},
    emits={**{r: () for r in (1, 3, 4, 5, 7, 9)}, 6: (4,), 8: (1, 2)},
    values=(_NAME, f"CASE WHEN get(o.last, 5) > get(o.last, 8) THEN {_ERROR} END", *[_line(STACKED, g, _AT) for g in (1, 2, 3)], "cast(get(_spots, get(o.last, 8)).i AS string)", told(SUITE, 3), told(NESTED, 4, since=3), told(CROSSED, 1), _ERROR),
    rules=(
        Rule(r"^\s*✓\s*(.+)\((\d+)ms\)$", {**PASS, **_HERE, "structured_data": "={}", "test_name": _full("{1}"), "function_name": "{v6}", "execution_time": 2, "message": "concat('Test passed: ', {1})"}),
        Rule(CROSSED, {}),
        Rule(r"^\s*-\s*(.+)\(pending\)$", {**SKIP, **_NOWHERE, "test_name": _full("{1}"), "function_name": "{v6}", "message": "concat('Test pending: ', {1})"}),
        Rule(SUITE, {}),
        Rule(NESTED, {}),
        Rule(THROWN, {}),
        Rule(rf"^\s*at Context\.<anonymous> {STACKED}$", {**FAIL, "ref_file": 1, "ref_line": 2, "ref_column": 3, "structured_data": "={}", **_UNLINED, "test_name": _full("{v8}"), "function_name": "{v6}", "message": "{v9}"}),
        Rule(rf"\bat \S.* {STACKED}", {}),
        Rule(NUMBERED, {**_FAILURE, "message": "coalesce(nullif({v1}, ''), concat({v0}, ' failed'))", "log_line_end": "x.line_no - 1"}),
        Rule(FURTHER, {}),
        Rule(r"^\s*(\d+)\s+passing\s*\(([\d.]+s?)\)$", _counted(INFO, "passing", ", \"total_time\": \"', {2}, '\"")),
        Rule(r"^\s*(\d+)\s+failing$", _counted(FAIL, "failing")),
        Rule(r"^\s*(\d+)\s+pending$", _counted(WARNING, "pending")),
    ),
    end=Rule("", {**_FAILURE, "message": "coalesce(nullif({v1}, ''), 'Test failed')", "log_line_end": "x.line_no"}),
)

# --- Valgrind. State 1: behind an error's head, whose first stack line makes the event.
_P, _N, _ADDRESS = r"==\d+== ", r"([\d,]+)", r"0x[\dA-Fa-f]+"
TOOL = _P + r"(Memcheck|Helgrind|Cachegrind|Massif|DRD), "
HEAD = _P + r"(Invalid (?:read|write) of size \d+|(?:Invalid|Mismatched) free\(\) / delete / delete\[\]|Use of uninitialised value of size \d+|\d+ bytes in \d+ blocks are (?:definitely|possibly) lost(?= in loss record \d+ of \d+)|Possible data race during .+ of size \d+ at 0x[\dA-Fa-f]+ by thread #\d+|Lock order violation: .+)"
_KIND = (
    "CASE WHEN {v1} RLIKE '^[0-9]+ bytes.*definitely' THEN 'Memory leak' WHEN {v1} RLIKE '^[0-9]+ bytes' THEN 'Possible memory leak' WHEN {v1} LIKE 'Possible data race%' THEN 'Data race' WHEN {v1} LIKE 'Lock order%' THEN 'Lock order violation' "
    "WHEN {v1} LIKE 'Use of%' THEN 'Use of uninitialised value' ELSE substring_index(substring_index({v1}, '(', 1), ' of', 1) END"
)
_BLOCK = {**FAIL, "category": _KIND, "message": "regexp_replace(regexp_replace({v1}, ' at 0x[0-9A-Fa-f]+', ''), '^Lock order violation: ', '')", "function_name": 1}


def _sum(status: dict, category: str, message: str) -> dict:
    return {"event_type": "=summary", "category": f"={category}", "message": message, **status, **_UNLINED}


VALGRIND = Machine(
    "Valgrind", "memory_error", "", states=2, columns={"tool_name": "coalesce(nullif({v0}, ''), 'Valgrind')", "structured_data": "=valgrind"},
    moves={1: {0: 1, 1: 1}, 2: {1: 0}, 3: {1: 0}}, emits={0: (), 1: ()}, values=(told(TOOL, 0), told(HEAD, 1)),
    rules=(
        Rule(TOOL, {}),
        Rule(HEAD, {}),
        Rule(_P + rf" +at {_ADDRESS}: (\S.*) \((\S.*):(\d+)\)", {**_BLOCK, "ref_file": 2, "ref_line": 3}),
        Rule(_P + rf" +at {_ADDRESS}: (\S.*)", _BLOCK),
        Rule(_P + rf" +in use at exit: {_N} bytes in {_N} blocks", _sum(INFO, "heap_summary", "concat('In use at exit: ', {1}, ' bytes in ', {2}, ' blocks')")),
        Rule(_P + rf" +total heap usage: {_N} allocs, {_N} frees, {_N} bytes allocated", _sum(INFO, "heap_summary", "concat('Total heap usage: ', {1}, ' allocs, ', {2}, ' frees, ', {3}, ' bytes allocated')")),
        Rule(_P + rf" +definitely lost: {_N} bytes in {_N} blocks", _sum(FAIL, "leak_summary", "concat('Definitely lost: ', {1}, ' bytes in ', {2}, ' blocks')")),
        Rule(_P + rf" +possibly lost: {_N} bytes in {_N} blocks", _sum(WARNING, "leak_summary", "concat('Possibly lost: ', {1}, ' bytes in ', {2}, ' blocks')")),
        Rule(_P + r"Process terminating with default action of signal (\d+) \((.+)\)", {**FAIL, "category": "=process_termination", **_UNLINED, "message": "concat('Process terminating with signal ', {1}, ' (', {2}, ')')"}),
        Rule(_P + r"ERROR SUMMARY: (\d+) errors from (\d+) contexts", {**_sum({}, "error_summary", "concat('Error summary: ', {1}, ' errors from ', {2}, ' contexts')"), "status": "CASE WHEN cast({1} AS bigint) > 0 THEN 'FAIL' ELSE 'PASS' END", "severity": "CASE WHEN cast({1} AS bigint) > 0 THEN 'error' ELSE 'info' END"}),
    ),
)

# --- NUnit and xUnit. State 1: the last event has no place yet, which the next source or stack line tells.
SOURCE, STACK = r"Source:\s*(\S.*):line\s*(\d+)", r"at\s+\S.*\s+in\s+(\S.*):line\s+(\d+)"
_BY = "CASE q.rule WHEN 12 THEN {0} ELSE {1} END"
_SITE = {"ref_file": "{v0}", "ref_line": "coalesce(try_cast(nullif({v1}, '') AS int), 0)", "ref_column": "0"}


def _unit(tool: str, outcome: dict, kind: str, message: str, **more) -> dict:
    return {**outcome, **_SITE, "tool_name": f"={tool}", "event_type": f"={kind}", "message": message, **more}


NUNIT = Machine(
    "nunit", "test_result", "nunit_xunit_text", states=2, opens=tuple(range(12)), closes=(12, 13), emits={12: (), 13: ()},
    moves={**{r: {0: 1, 1: 1} for r in range(12)}, 12: {1: 0}, 13: {1: 0}},
    values=tuple(closed_by(_BY.format(_line(SOURCE, g, "q.line"), _line(STACK, g, "q.line"))) for g in (1, 2)),
    rules=(
        Rule(r"NUnit\s+([\d.]+)", _unit("nunit", INFO, "debug_info", "concat('NUnit version ', {1})")),
        Rule(r"xUnit\.net VSTest Adapter\s+v([\d.]+)", _unit("xunit", INFO, "debug_info", "concat('xUnit.net VSTest Adapter version ', {1})")),
        Rule(r"Test Count: *(\d+), *Passed: *(\d+), *Failed: *(\d+), *Warnings: *\d+, *Inconclusive: *\d+, *Skipped: *(\d+)", _unit("nunit", {}, "summary", "concat('Test summary: ', {1}, ' total, ', {2}, ' passed, ', {3}, ' failed, ', {4}, ' skipped')", status="CASE WHEN {3} RLIKE '[1-9]' THEN 'FAIL' ELSE 'PASS' END", severity="CASE WHEN {3} RLIKE '[1-9]' THEN 'error' ELSE 'info' END")),
        Rule(r"Overall result: *(\w+)", _unit("nunit", {}, "test_result", "concat('Overall test result: ', {1})", status="CASE {1} WHEN 'Failed' THEN 'FAIL' ELSE 'PASS' END", severity="CASE {1} WHEN 'Failed' THEN 'error' ELSE 'info' END")),
        Rule(r"Duration: *([\d.]+) *seconds", _unit("nunit", INFO, "performance_metric", "concat('Test execution time: ', {1}, ' seconds')", execution_time="cast(coalesce(try_cast({1} AS double), 0.0D) * 1000 AS bigint)")),
        Rule(r"Starting: *(\S.*)", _unit("xunit", INFO, "debug_info", "concat('Starting test suite: ', {1})")),
        Rule(r"Finished: *(\S.*)", _unit("xunit", INFO, "debug_info", "concat('Finished test suite: ', {1})")),
        *[Rule(rf"(\S.*)\[{mark}\]", _unit("xunit", status, "test_result", f"concat('Test {word}: ', {{1}})", test_name=1)) for mark, word, status in (("PASS", "passed", PASS), ("FAIL", "failed", FAIL), ("SKIP", "skipped", SKIP))],
        Rule(r"Total tests: *(\d+)", _unit("xunit", INFO, "summary", "concat('Total tests: ', {1})")),
        Rule(r"Time: *([\d.]+)s", _unit("xunit", INFO, "performance_metric", "concat('Test execution time: ', {1}, ' seconds')", execution_time="cast(coalesce(try_cast({1} AS double), 0.0D) * 1000 AS bigint)")),
        Rule(SOURCE, {}),
        Rule(STACK, {}),
    ),
)

# --- pytest-cov. States: 0 before all, 1 in tests, 2 in failures, 3 in the coverage section, 4 in its table, 5 in a table with branches;
# 6 to 8 as 3 to 5, with failures open.
_TABLE = (3, 4, 5, 6, 7, 8)
_SHARE = r"(\d+(?:\.\d+)?%)"


def _share(group: int, kind: str, category: str, message: str, **more) -> dict:
    # The share is told by different groups of rules 11 to 14; as one expression it makes one branch.
    assert group == (4, 6, 3, 5)[("file_coverage", "file_branch_coverage", "total_coverage", "total_branch_coverage").index(category)]
    value = "try_cast(rtrim('%', get(x.g, get(array(3, 5, 2, 4), x.rule - 11))) AS double)"
    level = lambda a, b, c: f"CASE WHEN {value} >= 90 THEN '{a}' WHEN {value} >= 75 THEN '{b}' ELSE '{c}' END"
    return {"event_type": f"={kind}", "category": f"={category}", "message": message, "status": level("PASS", "WARNING", "FAIL"), "severity": level("info", "warning", "error"), **_UNLINED, **more}


def _told(kind: str, outcome: dict, category: str, message: str, **more) -> dict:
    return {**outcome, "event_type": f"={kind}", "category": f"={category}", "message": message, **_UNLINED, **more}


PYTEST_COV = Machine(
    "pytest-cov", "test_result", "test_execution", states=9, columns={"structured_data": "=pytest_cov_text"},
    moves={
        3: {0: 1, 1: 1, 2: 2, **{s: s for s in _TABLE}}, 4: {1: 1}, 5: {0: 2, 1: 2, 2: 2, 3: 6, 4: 7, 5: 8, 6: 6, 7: 7, 8: 8}, 6: {0: 0, 1: 1, 2: 0, 3: 3, 4: 4, 5: 5, 6: 3, 7: 4, 8: 5},
        8: {0: 3, 1: 3, 2: 6, **{s: s for s in _TABLE}}, 9: {3: 5, 4: 5, 5: 5, 6: 8, 7: 8, 8: 8}, 10: {3: 4, 4: 4, 5: 4, 6: 7, 7: 7, 8: 7}, 11: {4: 4, 7: 7}, 12: {5: 5, 8: 8}, 13: {s: s for s in _TABLE}, 14: {s: s for s in _TABLE}, 19: {2: 2, 6: 6, 7: 7, 8: 8},
    },
    emits={r: () for r in (5, 6, 9, 10)},
    rules=(
        Rule(r"={3,} test session starts ={3,}", _told("summary", INFO, "test_session", "=Test session started")),
        Rule(r"platform (\S.*) -- Python (\S+), pytest-(\S+), pluggy-\S", _told("summary", INFO, "environment", "concat('Platform: ', {1}, ', Python: ', {2}, ', pytest: ', {3})")),
        Rule(r"plugins: cov-(\S.*)", _told("summary", INFO, "plugin", "concat('pytest-cov plugin version: ', {1})")),
        Rule(r"collected (\d+) items?", _told("summary", INFO, "test_collection", "concat('Collected ', {1}, ' test items')")),
        Rule(r"(\S.*\.py)::(\S.*?)\s+(PASSED|FAILED|SKIPPED|ERROR)\s+\[[^\]]+\]", {**_UNLINED, "ref_file": 1, "message": "concat('Test ', {2}, ' ', {3})", "status": "CASE {3} WHEN 'PASSED' THEN 'PASS' WHEN 'FAILED' THEN 'FAIL' WHEN 'SKIPPED' THEN 'SKIP' ELSE 'ERROR' END", "severity": "CASE {3} WHEN 'PASSED' THEN 'info' WHEN 'SKIPPED' THEN 'warning' ELSE 'error' END"}),
        Rule(r"={3,} FAILURES ={3,}", {}),
        Rule(r"={3,} short test summary info ={3,}", {}),
        Rule(r"={3,} (\d+) failed, (\d+) passed(?:, (\d+) skipped)? in ([\d.]+)s ={3,}", _told("summary", {}, "test_summary", "concat('Tests completed: ', {1}, ' failed, ', {2}, ' passed, ', coalesce(nullif({3}, ''), '0'), ' skipped in ', {4}, 's')", execution_time=4, status="CASE {1} WHEN '0' THEN 'PASS' ELSE 'FAIL' END", severity="CASE {1} WHEN '0' THEN 'info' ELSE 'error' END")),
        Rule(r"-{11} coverage: platform (\S.*), python (\S+) -{11}", _told("summary", INFO, "coverage_section", "concat('Coverage analysis started - Platform: ', {1}, ', Python: ', {2})")),
        Rule(r"Name\s+Stmts\s+Miss\s+Branch\s+BrPart\s+Cover", {}),
        Rule(r"Name\s+Stmts\s+Miss\s+Cover", {}),
        Rule(rf"^(\S+)\s+(\d+)\s+(\d+)\s+{_SHARE}\s*(.*)$", _share(4, "performance_metric", "file_coverage", "concat('Coverage: ', {4}, ' (', {2}, ' statements, ', {3}, ' missed)', CASE WHEN {5} <> '' THEN concat(' - Missing lines: ', {5}) ELSE '' END)", ref_file=1)),
        Rule(rf"^(\S+)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+{_SHARE}\s*(.*)$", _share(6, "performance_metric", "file_branch_coverage", "concat('Branch coverage: ', {6}, ' (', {2}, ' statements, ', {3}, ' missed, ', {4}, ' branches, ', {5}, ' partial)', CASE WHEN {7} <> '' THEN concat(' - Missing: ', {7}) ELSE '' END)", ref_file=1)),
        Rule(rf"^TOTAL\s+(\d+)\s+(\d+)\s+{_SHARE}", _share(3, "summary", "total_coverage", "concat('Total coverage: ', {3}, ' (', {1}, ' statements, ', {2}, ' missed)')")),
        Rule(rf"^TOTAL\s+(\d+)\s+(\d+)\s+(\d+)\s+(\d+)\s+{_SHARE}", _share(5, "summary", "total_branch_coverage", "concat('Total branch coverage: ', {5}, ' (', {1}, ' statements, ', {2}, ' missed, ', {3}, ' branches, ', {4}, ' partial)')")),
        Rule(r"Coverage threshold check failed\. Expected: >= (\d+)%, got: ([\d.]+%)", _told("lint_issue", FAIL, "coverage_threshold", "concat('Coverage threshold failed: Expected >= ', {1}, '%, got ', {2})")),
        Rule(r"Required test coverage of (\d+)% not met\. Total coverage: ([\d.]+%)", _told("lint_issue", FAIL, "coverage_threshold", "concat('Required coverage not met: Expected ', {1}, '%, got ', {2})")),
        Rule(r"Coverage XML written to (\S.*)", _told("summary", INFO, "report_generation", "concat('Coverage XML report written to: ', {1})")),
        Rule(r"Coverage HTML written to dir (\S.*)", _told("summary", INFO, "report_generation", "concat('Coverage HTML report written to: ', {1})")),
        Rule(r"E\s+(AssertionError: \S.*)", _told("test_result", FAIL, "assertion_error", "{1}")),
        Rule(r"pytest-cov: Coverage data was not found for source '(.+)'", _told("build_error", WARNING, "configuration", "concat('Coverage data not found for source: ', {1})")),
        Rule(r"pytest-cov: Module '(.+)' was never imported\.", _told("build_error", WARNING, "configuration", "concat('Module never imported: ', {1})")),
    ),
)

# --- Formatters of Python. autopep8's state 1: behind `Applied configuration:`, up to an empty line.
_PY = r"([^:]+\.py)"


def _note(category: str, message: str, **more) -> dict:
    return {**INFO, "event_type": "=summary", "category": f"={category}", "message": message, **_UNLINED, **more}


AUTOPEP8 = Machine(
    "autopep8", "lint_issue", "formatting", states=2, columns={"structured_data": "=autopep8_text"},
    moves={6: {0: 1, 1: 1}, 14: {1: 0}, 15: {1: 1}}, emits={14: ()},
    rules=(
        Rule(r"--- original/(\S.*)", {**INFO, **_UNLINED, "ref_file": 1, "message": "=File formatting changes detected"}),
        Rule(rf"ERROR: {_PY}:(\d+):(\d+): (E\d+) (\S.*)", {**ERROR, **_UNLINED, "category": "=syntax", "ref_file": 1, "ref_line": 2, "ref_column": 3, "error_code": 4, "message": 5}),
        Rule(rf"WARNING: {_PY}:(\d+):(\d+): (E\d+) (\S.*)", {**WARNING, **_UNLINED, "category": "=style", "ref_file": 1, "ref_line": 2, "ref_column": 3, "error_code": 4, "message": 5}),
        Rule(rf"INFO: {_PY}: (\S.*)", _note("formatting", "{2}", ref_file=1)),
        Rule(rf"fixed {_PY}", _note("formatting", "=File formatting applied", ref_file=1)),
        Rule(r"autopep8 (--\S+ *\S.*)", _note("configuration", "concat('Command: autopep8 ', {1})")),
        Rule(r"Applied configuration:", _note("configuration", "=Configuration applied")),
        Rule(r"Files processed: (\d+)", _note("summary", "concat('Files processed: ', {1})")),
        Rule(r"Files modified: (\d+)", _note("summary", "concat('Files modified: ', {1})")),
        Rule(r"Files with errors: (\d+)", {**_note("summary", "concat('Files with errors: ', {1})"), **ERROR}),
        Rule(r"Total fixes applied: (\d+)", _note("summary", "concat('Total fixes applied: ', {1})")),
        Rule(r"Execution time: ([\d.]+)s", _note("performance", "concat('Execution time: ', {1}, 's')", execution_time=1)),
        Rule(rf"ERROR: {_PY}:(\d+):(\d+): SyntaxError: (\S.*)", {**ERROR, **_UNLINED, "category": "=syntax", "ref_file": 1, "ref_line": 2, "ref_column": 3, "error_code": "=SyntaxError", "message": 4}),
        Rule(rf"WARNING: {_PY}: could not determine file encoding", {**WARNING, **_UNLINED, "category": "=encoding", "ref_file": 1, "message": "=Could not determine file encoding"}),
        Rule(r"^$", {}),
        Rule(r"^ .*:", _note("configuration", "substring(x.line, 3)")),
    ),
)

YAPF = Lines(
    "yapf", "lint_issue", "formatting", columns={"structured_data": "=yapf_text"},
    # A closing line with both numbers tells two events.
    after="flatten(transform(_hits, x -> CASE WHEN x.rule = 0 THEN array(x, named_struct('rule', 1, 'line_no', x.line_no, 'line_end', x.line_end, 'line', x.line, 'g', x.g, 'carry', x.carry, 'carry_no', x.carry_no)) ELSE array(x) END))",
    rules=(
        Rule(r"(\d+) files reformatted, (\d+) files left unchanged\.", _note("summary", "concat('Files reformatted: ', {1})")),
        Rule(r"(\d+) files reformatted, (\d+) files left unchanged\.", _note("summary", "concat('Files left unchanged: ', {2})")),
        Rule(r"--- a/(\S.*) \(original\)", {**INFO, **_UNLINED, "ref_file": 1, "message": "=File formatting changes detected"}),
        Rule(r"Reformatted (\S.*)", _note("formatting", "=File reformatted", ref_file=1)),
        Rule(r"yapf (--\S+ *\S.*)", _note("configuration", "concat('Command: yapf ', {1})")),
        Rule(r"Processing (\S.*)", _note("processing", "=Processing file", ref_file=1)),
        Rule(r"(Style configuration: \S.*|Line length: \d+|Indent width: \d+)", _note("configuration", "{1}")),
        Rule(r"(Files processed: \d+|Files reformatted: \d+|Files with no changes: \d+)", _note("summary", "{1}")),
        Rule(r"Total execution time: ([\d.]+)s", _note("performance", "concat('Execution time: ', {1}, 's')", execution_time=1)),
        Rule(r"ERROR: Files would be reformatted but yapf was run with --check", {**ERROR, **_UNLINED, "category": "=check_mode", "message": "=Files would be reformatted but yapf was run with --check"}),
        Rule(r"yapf: error: (\S.*)", {**ERROR, **_UNLINED, "category": "=command_error", "message": 1}),
        Rule(rf"ERROR: {_PY}:(\d+):(\d+): (\S.*)", {**ERROR, **_UNLINED, "category": "=syntax", "ref_file": 1, "ref_line": 2, "ref_column": 3, "error_code": "=SyntaxError", "message": 4}),
        Rule(rf"WARNING: {_PY}: cannot determine encoding", {**WARNING, **_UNLINED, "category": "=encoding", "ref_file": 1, "message": "=Cannot determine encoding"}),
        Rule(rf"INFO: {_PY}: no changes needed", _note("formatting", "=No changes needed", ref_file=1)),
    ),
)

MACHINES = {"rspec_text": RSPEC, "mocha_chai_text": MOCHA, "valgrind": VALGRIND, "nunit_xunit_text": NUNIT, "pytest_cov_text": PYTEST_COV, "autopep8_text": AUTOPEP8, "yapf_text": YAPF}
