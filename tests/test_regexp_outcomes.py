from quarrylog.operators.parse import parse_log


def docs(spark):
    return spark.createDataFrame([(1, "a.c:3: bad\nnothing"), (2, "nothing at all"), (3, ""), (4, None)], "id int, content string")


def test_texts_without_a_match_say_so(spark):
    got = parse_log(docs(spark), "content", r"regexp:(?P<file>\w+\.c):(?P<line>\d+): (?P<message>.*)", keep=("id",)).orderBy("id").collect()
    assert [(r.id, r.status, r.category, r.ref_file, r.ref_line) for r in got] == [(1, "WARNING", "regexp_match", "a.c", 3), (2, "INFO", "regexp_summary", "", None)]
    assert got[1].message == "No matches found for the provided pattern" and got[1].event_type == "lint_issue" and got[1].log_line_start is None


def test_a_bad_pattern_is_an_event_of_each_text(spark):
    got = parse_log(docs(spark), "content", "regexp:(open['", keep=("id",)).orderBy("id").collect()
    assert [(r.id, r.event_type, r.status, r.severity, r.category) for r in got] == [(i, "build_error", "ERROR", "error", "parse_error") for i in (1, 2)]
    assert got[0].message.startswith("Invalid regex pattern '(open['': ")
