import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quarrylog.operators.parse import parse_log
from quarrylog.parsers import spec
from quarrylog.parsers.spec import Machine, Rule, between, closed_by, told

A, B, P, Q, X = r"^a(\d+)", r"^b(\d+)", r"^p(\d+)", r"^q(\d+)", r"^[abx](\d+)"
TOY = Machine(
    "toy", "test_result", "toy", states=2, opens=(2,), closes=(3,), emits={0: (), 3: ()}, moves={0: {0: 1, 1: 1}, 1: {1: 0}, 3: {0: 0, 1: 1}},
    values=(told(A, 0), told(X, 4, since=0), f"array_join({between({4: f'regexp_extract(y.line, {spec.quoted(X)}, 1)'}, 0)}, '+')", closed_by(f"regexp_extract(q.line, {spec.quoted(Q)}, 1)")),
    rules=(Rule(A, {}), Rule(B, {"message": "concat_ws('/', 'b', {1}, {v0}, {v1}, {v2})"}), Rule(P, {"message": "concat_ws('/', 'p', {1}, {v0}, {v3})"}), Rule(Q, {}), Rule(X, {"message": "concat('x', {1})"})),
    end=Rule("", {"message": "concat('end', {v0})"}),
)


def by_hand(text):
    """The toy's events, line by line."""
    state, heads, xs, x_since, stack, out = 0, "", [], "", [], []
    for line in text.split("\n") if text else []:
        kind, number = line[:1], re.match(r"\D*(\d*)", line)[1]
        if kind == "a":
            state, heads, xs, x_since = 1, number, [], ""
        elif kind == "b" and state == 1:
            state = 0
            out.append(f"b/{number}/{heads}/{x_since}/{'+'.join(xs)}")
        elif kind == "p":
            out.append(["p", number, heads, ""])
            stack.append(out[-1])
        elif kind == "q":
            if stack:
                stack.pop()[3] = number
        elif kind in ("b", "x"):
            out.append(f"x{number}")
            xs.append(number)
            x_since = number
    return [x if isinstance(x, str) else "/".join(x) for x in out] + ([f"end{heads}"] if text else [])


@pytest.mark.parametrize("folded", [3, 256])
def test_fold_equals_a_walk_over_lines(spark, monkeypatch, folded):
    monkeypatch.setattr(spec, "FOLDED", folded)
    rng = random.Random(folded)
    texts = [""] + ["a0\n" + "\n".join(f"{rng.choice('abpqx-')}{i}" for i in range(1, n)) for n in (1, 2, 5, 40, 300, 700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, _text string")
    got = docs.select("i", F.expr(TOY.events_sql()).alias("e")).select("i", F.posexplode_outer("e").alias("at", "e")).orderBy("i", "at").select("i", "e.message").collect()
    for i, text in enumerate(texts):
        assert [r.message for r in got if r.i == i and r.message is not None] == by_hand(text), i


def counts(spark, text, name, column="status"):
    return {r[0]: r[1] for r in parse_log(spark.createDataFrame([(text,)], "content string"), "content", name).groupBy(column).count().collect()}


@pytest.mark.parametrize("name, text, number", [
    ("make_error", "gmake[3]: *** [build.make:121: a.o] Error 1\ngmake[2]: *** [Makefile2:9413: all] Error 2\ngmake[1]: *** [Makefile:136: all] Error 2\nmake: *** [x.Makefile:169: release] Error 2", 4),
    ("autopep8_text", "autopep8 --diff --aggressive src/\n--- original/module.py\n+++ fixed/module.py\nfixed module.py\nFiles processed: 3\nFiles modified: 1", 5),
    ("yapf_text", "5 files reformatted, 3 files left unchanged.", 2),
    ("pytest_cov_text", "----------- coverage: platform linux, python 3.11.0 -----------\nName      Stmts   Miss  Cover\nTOTAL       100     15    85%", 2),
    ("nunit", "Overall result: Passed", 1), ("xunit", "Overall result: Passed", 1),
])
def test_event_numbers(spark, name, text, number):
    assert sum(counts(spark, text, name).values()) == number


def test_suggestions_and_structured_data_of_linters(spark):
    text = '{"files": [{"path": "a.rb", "offenses": [{"severity": "error", "message": "m", "cop_name": "C", "correctable": true, "location": {"start_line": 1, "start_column": 2}}, {"severity": "error", "message": "n", "cop_name": "D", "correctable": false}]}]}'
    got = parse_log(spark.createDataFrame([(text,)], "content string"), "content", "rubocop_json").select("suggestion", "structured_data").collect()
    assert "correctable" in got[0].suggestion and not got[1].suggestion
    assert got[1].structured_data == '{"tool": "rubocop", "cop_name": "D", "correctable": false}'
    text = '{"results": [{"filename": "t.py", "line_number": 1, "test_id": "B608", "issue_severity": "HIGH", "issue_text": "x", "issue_cwe": {"id": 89, "link": "http://c"}}]}'
    got = parse_log(spark.createDataFrame([(text,)], "content string"), "content", "bandit_json").first()
    assert got.suggestion == "CWE-89: http://c" and '"cwe_id": 89' in got.structured_data


def test_long_texts_stay_linear(spark):
    """50,000 heads carried to 500,000 hits of one text, and 200,000 lines through an automaton."""
    text = "\n".join(f"a.c: In function 'f{i}':\n" + "\n".join(f"a.c:{i}:{j}: error: e" for j in range(10)) for i in range(50_000))
    docs = spark.createDataFrame([(text,)], "content string")
    began = time.time()
    got = parse_log(docs, "content", "gcc_text").agg(F.count(F.lit(1)), F.countDistinct("function_name")).first()
    assert tuple(got) == (500_000, 50_000) and time.time() - began < 60
    text = "\n".join(f"  Suite A\n      ✓ ok {i} (3ms)\n      {i}) bad\n     Error: e{i}" for i in range(50_000))
    began = time.time()
    assert counts(spark, text, "mocha_chai_text") == {"PASS": 50_000, "FAIL": 50_000}
    assert time.time() - began < 60
