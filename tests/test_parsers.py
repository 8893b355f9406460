import pytest
from pyspark.sql import functions as F

from quarrylog import registry
from quarrylog.operators import catalog, custom, patterns, post, workflow
from quarrylog.operators.detect import detect_format
from quarrylog.operators.parse import parse_log
from quarrylog.schema import EVENT_FIELDS

# format, text, (columns, values) of the first event
SAMPLES = [
    ("gcc_text", "src/a.c: In function 'main':\nsrc/a.c:3:5: error: bad thing [-Wall]\n", dict(ref_file="src/a.c", ref_line=3, ref_column=5, status="ERROR", error_code="-Wall", function_name="main", message="bad thing", log_line_start=2)),
    ("eslint_json", 'start\n[{"filePath":"a.js","messages":[{"line":1,"column":2,"message":"m","ruleId":"no-x","severity":2}]}]', dict(ref_file="a.js", status="ERROR", category="lint_error", error_code="no-x")),
    ("jsonl", '{"timestamp":"t","level":"ERROR","message":"boom","service":"s"}\nnot json', dict(status="ERROR", message="boom", category="s", function_name="t")),
    ("logfmt", 'ts=1 level=warn msg="hello w" service=api', dict(status="WARNING", message="hello w", category="api")),
    ("syslog", "<11>1 2024-01-01T00:00:00Z h app 1 ID - msg", dict(status="ERROR", origin="h", started_at="2024-01-01T00:00:00Z", message="msg")),
    ("apache_access", '1.2.3.4 - bob [10/Oct/2000:13:55:36 -0700] "GET /a HTTP/1.0" 404 12', dict(status="WARNING", ref_file="/a", error_code="404", origin="1.2.3.4")),
    ("vpc_flow", "2 123456789010 eni-1235 172.31.16.139 172.31.16.21 20641 22 6 20 4249 1418530010 1418530070 REJECT OK", dict(status="WARNING", principal="123456789010", message="REJECT: 172.31.16.139:20641 -> 172.31.16.21:22 (TCP) 20 pkts 4249 bytes", started_at="2014-12-14T04:06:50Z")),
    ("cargo_build", "error[E0308]: mismatched types\n  --> src/main.rs:4:5\n", dict(ref_file="src/main.rs", ref_line=4, ref_column=5, error_code="E0308")),
    ("log4j", "2024-01-01 00:00:00,123 ERROR [main] c.F - oops\njava.lang.XException: why\n\tat a.b.C(D.java:5)\n", dict(message="why", error_code="java.lang.XException", ref_file="D.java", ref_line=5)),
    ("eslint_text", "/x/a.js\n  1:2  error  Bad thing  no-bad\n\n1 problem (1 error, 0 warnings)", dict(ref_file="/x/a.js", ref_line=1, ref_column=2, error_code="no-bad", status="ERROR")),
    ("hdfs", "081109 203615 148 INFO dfs.DataNode: done", dict(started_at="2008-11-09 20:36:15", category="dfs.DataNode", message="done")),
    ("junit_xml", '<testsuites><testsuite name="s"><testcase name="b"><failure message="no" type="T">x</failure></testcase><testcase name="a"/></testsuite></testsuites>', dict(status="FAIL", message="no", error_code="T")),
]


@pytest.mark.parametrize("name,text,want", SAMPLES, ids=[s[0] for s in SAMPLES])
def test_first_event(spark, name, text, want):
    docs = spark.createDataFrame([(text,)], "content string")
    got = parse_log(docs, "content", name)
    assert got.columns == list(EVENT_FIELDS)
    first = got.orderBy("event_id").first().asDict()
    assert {k: first[k] for k in want} == want
    assert first["event_id"] == 1


def test_samples_are_detected(spark):
    docs = spark.createDataFrame([(n, t) for n, t, _ in SAMPLES] + [("none", "plain words"), ("null", None), ("empty", "")], "name string, content string")
    got = dict(docs.select("name", detect_format(F.col("content")).alias("f")).collect())
    assert got["null"] is None and got["empty"] == got["none"] == "unknown"
    assert {n: got[n] for n, _, _ in SAMPLES} == {n: n for n, _, _ in SAMPLES}


def test_every_format_has_a_parser_and_takes_null_and_empty_texts(spark):
    assert len(registry.BUILT_IN) == 109
    assert all(e.specs for e in registry.BUILT_IN.values())
    docs = spark.createDataFrame([("",), (None,)], "content string")
    for name in ("gcc_text", "eslint_json", "jsonl", "junit_xml", "gotest_json", "lcov"):
        assert parse_log(docs, "content", name).count() == 0


def test_gotest_needs_a_run(spark):
    text = '{"Action":"run","Package":"p","Test":"A"}\n{"Action":"pass","Package":"p","Test":"A","Elapsed":0.5}\n{"Action":"fail","Package":"p","Test":"B"}'
    assert [(r.test_name, r.status) for r in parse_log(spark.createDataFrame([(text,)], "content string"), "content", "gotest_json").collect()] == [("A", "PASS")]


def test_groups_take_the_first_format_that_fits(spark):
    rows = [('{"tests":[{"nodeid":"test_pass","outcome":"passed"}]}', ["pytest"]), ('main.py:10: error: Name "foo" is not defined', ["mypy"]), ("this is not valid python output", []), ("", []), (None, [])]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, content string")
    got = parse_log(docs, "content", "python", keep=("i",)).select("i", "tool_name").collect()
    assert sorted((r.i, r.tool_name) for r in got) == [(i, t) for i, (_, tools) in enumerate(rows) for t in tools]


def test_all_formats_are_diagnosed_in_one_step(spark):
    docs = spark.createDataFrame([('a.py:1: error: Name "x" is not defined',), (None,)], "content string")
    got = catalog.diagnose(docs).where("can_parse").select("format", "events_produced", "is_selected").collect()
    assert ("mypy_text", 1) in {(r.format, r.events_produced) for r in got} and sum(r.is_selected for r in got) == 1


def test_format_arguments(spark):
    docs = spark.createDataFrame([("syslog", "Jan 15 10:30:45 host cron: job"), ("gcc", "a.c:1:2: error: bad"), (None, "a.c:1:2: error: bad [-Wx]"), ("nope", "x")], "f string, content string")
    assert sorted(r.tool_name for r in parse_log(docs, "content", format_column="f", ignore_errors=True).collect()) == ["compiler", "compiler", "syslog"]
    with pytest.raises(ValueError, match="nope"):
        parse_log(docs, "content", "nope")
    assert parse_log(docs, "content", "nope", ignore_errors=True).count() == 0
    found = parse_log(docs, "content", "regexp:(?P<file>[^:]+):(?P<line>\\d+):\\d+: (?P<severity>\\w+)").where("ref_file = 'a.c'").collect()
    assert [(r.ref_line, r.status) for r in found] == [(1, "ERROR")] * 2
    assert parse_log(docs, "content", "gcc", severity_threshold="critical").count() == 0


def test_long_lines(spark):
    access = '1.2.3.4 - bob [10/Oct/2000:13:55:36 -0700] "GET /' + "a" * 5000 + ' HTTP/1.0" 404 12'
    docs = spark.createDataFrame([(access,)], "content string")
    assert parse_log(docs, "content", "apache_access").first().error_code == "404"
    docs = spark.createDataFrame([("a.c:1:2: error: " + "b" * 5000,)], "content string")
    content = parse_log(docs, "content", "gcc").first().log_content
    assert len(content) == 2000 and content.endswith("...")


def test_further_names():
    for name, want in {"python_log": "python_logging", "logback": "log4j", "serilog_text": "serilog", "azure_activity_log": "azure_activity", "k8s": "kubernetes", "rails": "rails_log"}.items():
        assert registry.resolve(name)[0].name == want


def test_names_resolve():
    assert registry.resolve("gcc")[0].name == "gcc_text"
    assert registry.resolve("gotest")[0].name == "gotest_json"
    assert [e.name for e in registry.resolve("gcc_text, syslog")] == ["gcc_text", "syslog"]
    assert {e.name for e in registry.resolve("mobile")} == {"android"}
    assert registry.resolve("nunit_xml") == []
    with pytest.raises(registry.UnknownFormat, match="Did you mean 'pytest'"):
        registry.resolve("pytset")
    with pytest.raises(registry.UnknownFormat):
        registry.resolve("auto,gcc")


def test_custom_formats(spark):
    assert custom.load_parser_config('{"name": "mine", "patterns": [{"regex": "^(?P<severity>\\\\w+): (?P<message>.*)$", "event_type": "lint_issue"}]}') == "mine"
    try:
        row = parse_log(spark.createDataFrame([("warning: careful",)], "content string"), "content", "mine").first()
        assert (row.status, row.message, row.tool_name) == ("WARNING", "careful", "mine")
    finally:
        assert custom.unload_parser("mine")
    assert not custom.unload_parser("mine")
    with pytest.raises(ValueError):
        custom.unload_parser("gcc_text")
    with pytest.raises(ValueError):
        custom.regexp_format("(unclosed")
    assert custom.named_groups(r"(a)(?P<x>b[(])\((?<y>c)(?:d)") == (r"(a)(b[(])\((c)(?:d)", {"x": 2, "y": 3})


def test_messages_cluster(spark):
    d = spark.createDataFrame([("Error in line 5: 'abc' at 0x1F",), ("just  words",)], "m string")
    assert [r[0] for r in d.select(patterns.normalise(F.col("m"))).collect()] == ["error in line <num>: '<var>' at <addr>", "just  words"]


def test_context_and_content(spark):
    d = spark.createDataFrame([("a\nb\nc\nd",)], "t string")
    got = d.select(post.context(F.col("t"), F.lit(2), F.lit(2), 1).alias("c")).first().c
    assert [(x.line_number, x.content, x.is_event) for x in got] == [(1, "a", False), (2, "b", True), (3, "c", False)]
    assert d.select(post.content(F.col("t"), 3)).first()[0] == "a\nb..."
    assert d.select(post.content(F.col("t"), "none")).first()[0] is None
    with pytest.raises(ValueError):
        post.context(F.col("t"), F.lit(1), F.lit(1), -1)


def test_workflow_levels(spark):
    text = "##[group]Run gcc -c a.c\na.c:3:4: error: bad\n##[group]Post\nWARN late\n"
    got = workflow.parse_workflow(spark.createDataFrame([(text,)], "content string"), "content").orderBy("event_id").collect()
    assert [(r.hierarchy_level, r.tool_name, r.unit) for r in got] == [(4, "compiler", "Run gcc -c a.c"), (3, "workflow", "Post")]


def test_commands(spark):
    d = spark.createDataFrame([("/usr/bin/GCC -c a.c",), ("nothing",)], "command string")
    assert [r[0] for r in d.select(catalog.best_command_format(F.col("command"))).collect()] == ["gcc_text", None]
    assert catalog.formats(spark).count() == 110
