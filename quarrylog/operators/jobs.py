"""Job logs of GitHub Actions as workflow, job, step and event, and reading of workflow logs with their archives.

Markers open and close steps: a step ends with its closing marker, or where another one opens while it is open. Lines
outside belong to the step that opens next (which then has no name of its own), and those behind the last step to the
"Job Level". Where a step begins is told by neighbouring markers, in one array expression over the row's lines, so nothing is
shuffled; steps are exploded, and the bodies of those whose command names a format are parsed by it. A step whose format
finds nothing, or that has none, gives its telling lines.

Level 4 are events of tools (parent: the step), level 3 lines of a step (parent: the job), level 1 the one event of a text without any
telling line. Ids of workflows and steps are hashes of the text's first 100 characters and of the step's name.

Defined results: null and empty texts give nothing; repeated rows each have their events; a step's lines are one value, so a step is
parsed by one task, however long the log is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registry
from ..parsers.spec import bound
from ..schema import EVENT_FIELDS, KEPT_EMPTY, LATER, WORKFLOW_FIELDS
from ..sources.files import read_docs, read_zip_logs
from .catalog import best_command_format
from .parse import _events_of
from .workflow import ALIASES, detect_engine, parse_workflow

OPEN, CLOSE = "##[group]", "##[endgroup]"
#: What makes a line tell something.
TELLING = (OPEN, CLOSE, "##[error]", "##[warning]", "##[notice]", "ERROR", "FAIL", "WARN", "PASS", "✓", "actions/", "Complete job name:")
STAMP = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]+Z"
SHOWN = 500


def _has(line: str, *texts: str) -> str:
    return "(" + " OR ".join(f"contains({line}, '{t}')" for t in texts) + ")"


def _lines() -> str:
    """The text's lines; what follows the last line break is no line if it is empty."""
    return bound("_l", r"split(_text, '\\r?\\n')", "CASE WHEN element_at(_l, -1) = '' THEN slice(_l, 1, size(_l) - 1) ELSE _l END")


def _steps_sql() -> str:
    marks = f"filter(transform(_lines, (x, i) -> CASE WHEN {_has('x', OPEN)} THEN named_struct('i', i, 'opens', true) WHEN {_has('x', CLOSE)} THEN named_struct('i', i, 'opens', false) END), m -> m IS NOT NULL)"
    starts = "array_distinct(concat(array(0), filter(transform(_marks, (m, j) -> CASE WHEN j > 0 AND get(_marks, j - 1).opens THEN CASE WHEN m.opens THEN m.i ELSE m.i + 1 END END), s -> s IS NOT NULL)))"
    outside = "j = size(_starts) - 1 AND NOT coalesce(get(_marks, size(_marks) - 1).opens, false)"
    step = f"named_struct('lines', slice(_lines, s + 1, coalesce(get(_starts, j + 1), size(_lines)) - s), 'outside', {outside})"
    steps = f"filter(transform(_starts, (s, j) -> {step}), t -> size(t.lines) > 0)"
    return bound("_lines", _lines(), bound("_marks", marks, bound("_starts", starts, steps)))


def job_steps(docs: DataFrame, text: str = "content", keep: tuple = ()) -> DataFrame:
    """keep, scope, scope_id, step_no, unit, unit_id, unit_status, started_at, command, lines for each step of each text."""
    row = F.struct(*keep) if keep else F.struct(F.lit(0).alias("_none"))
    base = docs.select(row.alias("_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).where("_text <> ''")
    scope = "coalesce(nullif(regexp_extract(_text, r'##\\[group\\]Run ([^\\r\\n]*)', 1), ''), 'GitHub Actions Workflow')"
    spread = base.select("_row", F.expr(scope).alias("scope"), F.expr("cast(xxhash64(left(_text, 100)) AS string)").alias("scope_id"), F.posexplode(F.expr(_steps_sql())).alias("step_no", "_s"))
    head = F.expr("get(_s.lines, 0)")
    name = F.when(F.col("_s.outside"), F.lit("Job Level")).when(F.contains(head, F.lit(OPEN)), F.substring_index(head, OPEN, -1)).otherwise(F.coalesce(F.nullif(F.regexp_extract(head, "(actions/[^@]*)@", 1), F.lit("")), F.lit("Unnamed Step")))
    named = spread.withColumn("unit", name).withColumn("lines", F.col("_s.lines"))
    whole = "array_join(lines, '\\n')"
    bad, poor = f"{whole} RLIKE '(?i)error|fail'", f"{whole} RLIKE '(?i)warn'"
    status = f"CASE WHEN _s.outside THEN CASE WHEN {_has(whole, '##[error]', 'FAIL')} THEN 'failure' WHEN {_has(whole, '##[warning]')} THEN 'warning' ELSE 'info' END WHEN {bad} THEN 'failure' WHEN {poor} THEN 'warning' ELSE 'success' END"
    return named.select(
        *[F.col("_row")[c].alias(c) for c in keep], "scope", "scope_id", "step_no", "unit",
        F.expr("CASE WHEN _s.outside THEN 'job_level' ELSE concat('step_', pmod(xxhash64(unit), 10000)) END").alias("unit_id"), F.expr(status).alias("unit_status"),
        F.expr(f"nullif(regexp_extract({whole}, '{STAMP}', 0), '')").alias("started_at"),
        F.when(~F.col("_s.outside"), F.nullif(F.trim(F.regexp_extract("unit", "^Run (.*)$", 1)), F.lit(""))).alias("command"), "lines",
    )


def _struct(values: dict) -> str:
    """SQL for an event with these columns; the others are empty."""
    one = lambda n, t: f"cast({values.get(n, chr(39) * 2 if n in KEPT_EMPTY else 'NULL')} AS {t}) AS `{n}`"
    return "struct(" + ", ".join(one(n, t) for n, t in EVENT_FIELDS.items() if n not in LATER) + ")"


def _telling_sql() -> str:
    bad, poor, good = _has("x", "##[error]", "ERROR", "FAIL"), _has("x", "##[warning]", "WARN"), _has("x", "PASS", "✓")
    event = {
        "tool_name": "'github_actions'", "event_type": "'summary'", "category": "'workflow'", "message": "x", "log_content": "x", "execution_time": "0.0D",
        "status": f"CASE WHEN {bad} THEN 'ERROR' WHEN {poor} THEN 'WARNING' WHEN {good} THEN 'PASS' ELSE 'INFO' END", "severity": f"CASE WHEN {bad} THEN 'error' WHEN {poor} THEN 'warning' ELSE 'info' END",
    }
    return f"transform(filter(lines, x -> {_has('x', *TELLING)}), x -> {_struct(event)})"


def parse_jobs(docs: DataFrame, text: str = "content", keep: tuple = (), job_order: str | None = None, job_name: str | None = None) -> DataFrame:
    """Workflow events of job logs; `job_order` and `job_name` are columns of docs, if it has them."""
    carried = tuple(dict.fromkeys((*keep, *[c for c in (job_order, job_name) if c])))
    steps = job_steps(docs, text, carried).withColumn("_format", best_command_format(F.col("command")))
    # What a tool printed: without the step's head, closing marks and time stamps.
    body = F.expr(f"array_join(transform(filter(slice(lines, 2, size(lines)), x -> NOT {_has('x', CLOSE)}), x -> regexp_replace(x, '^{STAMP} ?', '')), '\\n')")
    # The formats that occur, at most as many as there are formats: only they get a branch of the plan.
    present = {r[0] for r in steps.select("_format").distinct().collect()}
    known = [e for e in registry.entries() if e.name in present and e.specs]
    rest = steps.where(F.col("_format").isNull() | ~F.col("_format").isin([e.name for e in known] or [""]))
    parts = [_events_of(steps.where(F.col("_format") == e.name).withColumn("_text", body), e).drop("_text") for e in known]
    parts.append(rest.withColumn("_events", F.expr(f"filter(array({_struct({})}), x -> false)")))
    found = reduce(lambda a, b: a.unionByName(b), parts)
    own = F.size("_events") > 0
    rows = found.withColumn("_own", own).select("*", F.posexplode(F.when(own, F.col("_events")).otherwise(F.expr(_telling_sql()))).alias("_at", "_e"))
    e = F.col("_e")
    fixed = {
        "event_id": F.col("step_no").cast("bigint") * 1_000_000 + F.col("_at") + 1, "scope": F.col("scope"), "scope_id": F.col("scope_id"), "scope_status": F.lit("running"), "group": F.lit("build"), "group_id": F.lit("job_1"), "group_status": F.lit("running"),
        "unit": F.col("unit"), "unit_id": F.col("unit_id"), "unit_status": F.col("unit_status"), "started_at": F.coalesce(e["started_at"], F.col("started_at")), "structured_data": F.when(F.col("_own"), F.col("_format")).otherwise(e["structured_data"]),
        "workflow_type": F.lit("github_actions"), "hierarchy_level": F.when(F.col("_own"), 4).otherwise(3), "parent_id": F.when(F.col("_own"), F.col("unit_id")).otherwise(F.lit("job_1")),
        "fingerprint": F.lit(None), "similarity_score": F.lit(None), "pattern_id": F.lit(None), "job_order": F.col(job_order) if job_order else F.lit(None), "job_name": F.col(job_name) if job_name else F.lit(None),
    }
    events = rows.select(*keep, *[(fixed[n] if n in fixed else e[n]).cast(t).alias(n) for n, t in WORKFLOW_FIELDS.items()])
    return events.unionByName(_silent(docs, text, keep, job_order, job_name))


def _silent(docs: DataFrame, text: str, keep: tuple, job_order: str | None, job_name: str | None) -> DataFrame:
    """The one event of texts in which no line tells anything."""
    telling = reduce(lambda a, b: a | b, (F.contains(F.col(text), F.lit(t)) for t in TELLING))
    quiet = docs.where((F.coalesce(F.col(text), F.lit("")) != "") & ~telling)
    values = {
        "event_id": F.lit(1), "tool_name": F.lit("github_actions"), "event_type": F.lit("summary"), "status": F.lit("INFO"), "severity": F.lit("info"), "message": F.lit("Workflow log processed"), "log_content": F.substring(text, 1, SHOWN), "execution_time": F.lit(0.0),
        "workflow_type": F.lit("github_actions"), "hierarchy_level": F.lit(1), "parent_id": F.lit("workflow_1"), "job_order": F.col(job_order) if job_order else F.lit(None), "job_name": F.col(job_name) if job_name else F.lit(None),
    }
    return quiet.select(*keep, *[values.get(n, F.lit("" if n in KEPT_EMPTY else None)).cast(t).alias(n) for n, t in WORKFLOW_FIELDS.items()])


def read_workflow(spark: SparkSession, path: str, engine: str = "auto") -> DataFrame:
    """log_file and workflow events of a file, a glob or a folder, or of the jobs of an archive (.zip, or engine github_actions_zip)."""
    name = ALIASES.get(engine.lower(), engine.lower())
    if name == "github_actions_zip" or path.lower().endswith(".zip"):
        return parse_jobs(read_zip_logs(spark, path), "content", ("log_file",), "job_order", "job_name")
    docs = read_docs(spark, path)
    if name == "github_actions":
        return parse_jobs(docs, "content", ("log_file",))
    if name != "auto":
        return parse_workflow(docs, "content", name, ("log_file",))
    docs = docs.withColumn("_engine", detect_engine(F.col("content")))
    ours = parse_jobs(docs.where("_engine = 'github_actions'"), "content", ("log_file",))
    return ours.unionByName(parse_workflow(docs.where("_engine <> 'github_actions'"), "content", "auto", ("log_file",)))
