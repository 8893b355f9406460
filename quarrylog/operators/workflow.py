"""CI logs as a hierarchy: workflow, job, step, and the events of the tools inside steps.

Steps are cut inside a row (a split before each step's head), so nothing is shuffled; each step's command
picks the format of its body, and bodies are parsed per format.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import registry
from ..schema import WORKFLOW_FIELDS
from .catalog import best_command_format
from .parse import _events_of

#: Engine -> (marker, head of a step with its name as group 1, name of the workflow, prefix to strip).
ENGINES = {
    "github_actions": (r"##\[group\]|::group::", r"(?:##\[group\]|::group::)(.*)", "GitHub Actions Workflow", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d+Z ?"),
    "gitlab_ci": (r"gitlab-runner|section_start:", r"section_start:\d+:(\w+)", "GitLab CI Pipeline", r"\x1b\[[\d;]*[mK]"),
    "jenkins": (r"\[Pipeline\]|Started by|Finished: ", r"\[Pipeline\] \{ \((.*)\)", "Jenkins Build", r"^\[\d{4}-[^\]]*\] "),
    "docker_build": (r"(?m)^Step \d+/\d+ : |^#\d+ \[", r"(?:^Step \d+/\d+ : |^#\d+ \[[^\]]*\] )(.*)", "Docker Build", r"^\x00"),
    "spack": (r"==> .*Executing phase", r"Executing phase: '([^']*)'", "Spack Build", r"^\x00"),
}
ALIASES = {"github": "github_actions", "gitlab": "gitlab_ci", "docker": "docker_build", "spack_build": "spack"}
MEANINGFUL = r"ERROR|FAIL|WARN|PASS|✓|Error|error:|warning:|##\[error\]|##\[warning\]|exit code"


def detect_engine(text):
    out = F.lit(None).cast("string")
    for name in reversed(list(ENGINES)):
        out = F.when(text.rlike(ENGINES[name][0]), name).otherwise(out)
    return out


def steps(docs: DataFrame, text: str = "content", engine: str = "auto", keep: tuple = ()) -> DataFrame:
    """keep, engine, workflow, step_no, step, command, body, first_line for each step."""
    base = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    name = detect_engine(F.col("_text")) if engine == "auto" else F.lit(ALIASES.get(engine, engine))
    parts = []
    for e, (_, head, workflow, prefix) in ENGINES.items():
        if engine != "auto" and ALIASES.get(engine, engine) != e:
            continue
        own = base.withColumn("engine", name).where(F.col("engine") == e)
        clean = F.regexp_replace("_text", "(?m)" + prefix, "")
        own = own.withColumn("_pieces", F.split(clean, f"(?m)(?=^.*?{head}$)", -1))
        spread = own.select(*keep, "engine", F.posexplode("_pieces").alias("_at", "body")).where(F.trim("body") != "")
        named = spread.withColumn("step", F.trim(F.regexp_extract("body", f"(?m){head}$", 1)))
        parts.append(named.select(*keep, "engine", F.lit(workflow).alias("workflow"), F.col("_at").alias("step_no"), "step", "body"))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    command = F.coalesce(F.nullif(F.regexp_extract("step", r"^Run (.*)$", 1), F.lit("")), F.nullif(F.regexp_extract("body", r"(?m)^(?:\$|\+|\[command\]) ?(.*)$", 1), F.lit("")), F.col("step"))
    return out.withColumn("command", command)


def parse_workflow(docs: DataFrame, text: str = "content", engine: str = "auto", keep: tuple = ()) -> DataFrame:
    """Events of all steps: those of the delegated format (level 4), else the telling raw lines (level 3)."""
    cut = steps(docs, text, engine, keep).withColumn("_format", best_command_format(F.col("command")))
    # The formats that occur, at most as many as there are formats: only they get a branch of the plan.
    present = {r[0] for r in cut.select("_format").distinct().collect()}
    known = [e for e in registry.entries() if e.name in present and e.specs]
    lines = registry.Entry("raw", 0, "workflow", "", (), (), 0, (_raw(),))
    parts = []
    for e in [*known, lines]:
        mine = cut.where(F.col("_format") == e.name) if e is not lines else cut.where(F.col("_format").isNull())
        row = F.struct(*keep, "engine", "workflow", "step_no", "step", "command").alias("_row")
        found = _events_of(mine.select(row, F.col("body").alias("_text")), e)
        parts.append(found.select("_row", F.lit(e.name if e is not lines else "").alias("_delegated"), F.posexplode("_events").alias("_at", "_e")))
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    fixed = {
        "event_id": (F.col("_row.step_no").cast("bigint") * 1_000_000 + F.col("_at") + 1), "scope": F.col("_row.workflow"), "group": F.lit("build"), "unit": F.col("_row.step"),
        "structured_data": F.when(F.col("_delegated") != "", F.col("_delegated")).otherwise(F.col("_e.structured_data")), "workflow_type": F.col("_row.engine"),
        "hierarchy_level": F.when(F.col("_delegated") != "", 4).otherwise(3), "parent_id": F.concat(F.lit("step_"), F.col("_row.step_no")), "fingerprint": F.lit(None), "similarity_score": F.lit(None), "pattern_id": F.lit(None), "job_order": F.lit(None), "job_name": F.lit(None),
    }
    columns = [(fixed[n] if n in fixed else F.col("_e")[n]).cast(t).alias(n) for n, t in WORKFLOW_FIELDS.items()]
    return rows.select(*[F.col("_row")[c].alias(c) for c in keep], *columns)


def _raw():
    from ..parsers.spec import Lines, Rule

    level = "CASE WHEN {1} RLIKE '(?i)error|fail' THEN 'error' WHEN {1} RLIKE '(?i)warn' THEN 'warning' ELSE 'info' END"
    return Lines("workflow", "debug_info", "workflow_step", rules=(Rule(f"^(.*(?:{MEANINGFUL}).*)$", {"message": 1}, level=level),))
