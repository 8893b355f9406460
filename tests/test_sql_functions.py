import pytest

from quarrylog.functions import sql
from quarrylog.operators.parse import parse_log
from quarrylog.operators.patterns import with_pattern_ids

TEXTS = {
    "gcc_text": "a.c: In function 'main':\na.c:3:5: error: bad 12\nb.c:9:1: warning: odd [-Wodd]\nb.c:10:1: warning: odd [-Wodd]",
    "logfmt": 'time=2024-01-01T00:00:00Z level=error msg="lost 3 hosts" host=a\nlevel=info msg=fine',
    "jsonl": '{"level": "warn", "message": "slow"}\n{"level": "error", "message": "gone"}',
    "winston": '{"level":"error","message":"x","timestamp":"2024-01-01T00:00:00Z"}',
    "log4j": "2024-01-15 10:30:45,123 ERROR [main] com.acme.App - lost\njava.lang.Error: x\n\tat com.acme.App.run(App.java:9)",
}


@pytest.fixture(scope="module")
def ready(spark):
    sql.register(spark, tuple(TEXTS))
    rows = [(i, n, t) for i, (n, t) in enumerate(TEXTS.items())] + [(90, "gcc_text", None), (91, "gcc_text", ""), (92, "gcc_text", "nothing here"), (93, "no_such_format", "a.c:1:1: error: x"), (94, "gcc", TEXTS["gcc_text"])]
    spark.createDataFrame(rows, "id int, format string, content string").createOrReplaceTempView("texts")
    return spark


def rows(df, *drop):
    return sorted((tuple(str(x) for x in r) for r in df.drop(*drop).collect()))


@pytest.mark.parametrize("name", TEXTS)
def test_table_function_equals_the_library(ready, name):
    got = ready.sql(f"SELECT * FROM parse_log({sql.quoted(TEXTS[name])}, '{name}')")
    want = parse_log(ready.createDataFrame([(TEXTS[name],)], "content string"), "content", name)
    assert got.columns == want.columns and got.count() > 0
    assert rows(got, "pattern_id") == rows(want, "pattern_id")
    assert rows(got.select("event_id", "pattern_id")) == rows(with_pattern_ids(want).select("event_id", "pattern_id"))


def test_lateral_views_and_joins_agree(ready):
    lateral = ready.sql("SELECT id, e.message, e.ref_line FROM texts t, LATERAL parse_log(t.content, t.format) e")
    view = ready.sql("SELECT id, e.message, e.ref_line FROM (SELECT id, log_events(content, format) AS found FROM texts) LATERAL VIEW explode(found) AS e")
    assert rows(lateral) == rows(view) and lateral.count() > 8
    left = ready.sql("SELECT id, e.event_id FROM texts t LEFT JOIN LATERAL parse_log(t.content, t.format) e ON true")
    assert {r.id for r in left.where("event_id IS NULL").collect()} == {90, 91, 92, 93}
    assert ready.sql("SELECT count(*) FROM texts t, LATERAL parse_log(t.content, t.format) e WHERE id = 94").first()[0] == 3


def test_no_shuffle_of_texts_in_the_array_form(ready, capsys):
    ready.sql("SELECT id, size(log_events(content, format)) FROM texts").explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan


def test_auto_and_default(ready):
    found = ready.sql("SELECT format, detect_format(content) AS found, size(log_events(content)) AS n, size(log_events(content, NULL)) AS m FROM texts WHERE id < 5").collect()
    assert all(r.n > 0 and r.n == r.m for r in found)
    assert {r.format: r.found for r in found}["gcc_text"] == "gcc_text"
    assert ready.sql("SELECT detect_format(NULL), detect_format('')").first()[:] == (None, "unknown")


def test_scalars(ready):
    got = ready.sql("SELECT status_badge('Passed'), status_badge('odd'), status_badge(NULL), count_badge(0, 2), count_badge(1, 0, true), count_badge(NULL, 1), count_badge(0, 0)").first()
    assert list(got) == ["[ OK ]", "[ ?? ]", None, "[WARN]", "[ .. ]", None, "[ OK ]"]
    assert ready.sql("SELECT normalise_message('Lost 3 of 12 at 0x1F')").first()[0] == "lost <num> of <num> at <addr>"
    assert ready.sql("SELECT count(*) FROM log_formats() WHERE format = 'gcc_text'").first()[0] == 1


def test_all_formats_at_once(ready):
    sql.register(ready)
    assert ready.sql("SELECT id, size(log_events(content, format)) AS n FROM texts WHERE id IN (0, 93)").orderBy("id").collect()[0].n == 3
    sql.register(ready, tuple(TEXTS))
