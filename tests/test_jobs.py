import zipfile

import pytest

from quarrylog.operators import jobs

T = "2024-01-15T10:00:0{}.0000000Z "
LOG = "\n".join([
    T.format(0) + "##[group]Run make release", T.format(1) + "main.c:15:5: error: expected", T.format(2) + "make: *** [Makefile:10: main.o] Error 1", T.format(3) + "##[endgroup]",
    T.format(4) + "##[error]Process completed with exit code 2.", T.format(5) + "##[group]Setup", T.format(5) + "nothing", T.format(6) + "##[group]Run actions/checkout@v4", T.format(6) + "WARN slow", T.format(7) + "##[endgroup]", T.format(8) + "done PASS",
])


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, content string")


def test_steps_by_their_markers(spark):
    got = jobs.job_steps(docs(spark, LOG), keep=("id",)).orderBy("step_no").collect()
    assert [(r.unit, len(r.lines), r.unit_status) for r in got] == [("Run make release", 4, "failure"), ("Unnamed Step", 3, "failure"), ("Run actions/checkout@v4", 3, "warning"), ("Job Level", 1, "info")]
    assert [r.command for r in got] == ["make release", None, "actions/checkout@v4", None]
    assert got[0].started_at == "2024-01-15T10:00:00.0000000Z" and len({r.scope for r in got}) == 1 and got[0].scope == "make release"


def test_levels_parents_and_states(spark):
    got = jobs.parse_jobs(docs(spark, LOG), keep=("id",)).orderBy("event_id").collect()
    assert [(r.hierarchy_level, r.tool_name, r.status, r.unit) for r in got] == [
        (4, "make", "ERROR", "Run make release"), (3, "github_actions", "ERROR", "Unnamed Step"), (3, "github_actions", "INFO", "Unnamed Step"), (3, "github_actions", "INFO", "Run actions/checkout@v4"),
        (3, "github_actions", "WARNING", "Run actions/checkout@v4"), (3, "github_actions", "INFO", "Run actions/checkout@v4"), (3, "github_actions", "PASS", "Job Level"),
    ]
    assert got[0].structured_data == "make_error" and got[0].parent_id == got[0].unit_id and got[0].test_name == "main.o"
    assert {r.parent_id for r in got[1:]} == {"job_1"} and {r.group for r in got} == {"build"} and {r.group_id for r in got} == {"job_1"}


def test_texts_that_tell_nothing(spark):
    got = jobs.parse_jobs(docs(spark, "hello\nworld", "", None, "hello\nworld"), keep=("id",)).orderBy("id").collect()
    assert [(r.id, r.hierarchy_level, r.message, r.parent_id) for r in got] == [(i, 1, "Workflow log processed", "workflow_1") for i in (0, 3)]


def test_a_format_that_finds_nothing_leaves_the_lines(spark):
    got = jobs.parse_jobs(docs(spark, "##[group]Run make all\nall fine\nWARN later\n##[endgroup]\n"), keep=("id",)).collect()
    assert {(r.hierarchy_level, r.status) for r in got} == {(3, "INFO"), (3, "WARNING")} and len(got) == 3


@pytest.mark.parametrize("engine", ["auto", "github_actions_zip"])
def test_archives_with_jobs(spark, tmp_path, engine):
    with zipfile.ZipFile(tmp_path / "run.zip", "w") as z:
        z.writestr("0_Build.txt", LOG)
        z.writestr("1_Unit tests.txt", "##[group]Run pytest\ntests/a.py::test_one PASSED\n##[endgroup]\n")
        z.writestr("Build/system.txt", "ERROR not read")
    got = jobs.read_workflow(spark, str(tmp_path / "run.zip"), engine).collect()
    assert {(r.job_order, r.job_name) for r in got} == {(0, "Build"), (1, "Unit tests")}
    assert [r.tool_name for r in got if r.job_order == 1] == ["pytest"] and all("run.zip" in r.log_file for r in got)


def test_files_of_several_engines(spark, tmp_path):
    (tmp_path / "a.log").write_text(LOG)
    (tmp_path / "b.log").write_text("Started by user\n[Pipeline] { (Build)\n+ make all\nmake: *** [Makefile:3: x] Error 1\n[Pipeline] }\nFinished: FAILURE\n")
    got = jobs.read_workflow(spark, str(tmp_path) + "/").collect()
    assert {r.workflow_type for r in got} == {"github_actions", "jenkins"}
