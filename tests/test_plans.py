"""What plans may cost: texts are parsed once, unread columns are never made, cheap tests stand before patterns."""

import random

import pytest
from pyspark.sql import functions as F

from quarrylog.operators.parse import parse_log
from quarrylog.parsers import spec
from quarrylog.plans import format_cases


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", list(format_cases.STATE_MACHINES))
def test_texts_are_taken_apart_once_and_only_for_what_is_read(spark, name):
    docs = spark.createDataFrame([("a\nb",)], "content string").repartition(2)
    told = plan(parse_log(docs, "content", name).select("message"))
    assert told.count("translate(") == 1 and "event_type" not in told


@pytest.mark.parametrize("pattern, texts", [
    ("ab+c", ("a",)), ("(ab)?cd", ("cd",)), ("(?:err|warn)ing x", ("ing x",)), (r"(?:err|warn)\d", ("err", "warn")), (r"\d(?=ab)", ()), ("(?i)ab", ()), ("(?i:ab)cde", ("cde",)), (r"\[[^:\[\]]+xy\]", ("xy]",)), (r"a{0,2}", ()),
    (r"\Qa.b\E", ()), (r"a\v", ()), ("[a-z&&[^x]]y", ()), ("[[a]b]zz", ()), ("[]a]b", ()), (r"(?<n>foo)\k<n>", ()), ("a++bc", ("bc",)), ("^$", ()),
])
def test_what_a_match_cannot_lack(pattern, texts):
    assert spec.needed(pattern) == texts


def test_cheap_tests_let_every_match_through(spark):
    rng = random.Random(7)
    patterns = [r"(?:err|warn)\d", "ab+c", "(ab)?cd", r"\Qa.b\E", "[a-z&&[^x]]y", "[[a]b]zz", "(?i)AB", "(?i:AB)c", r"a\vb", "(a|b|cd)+d", r"^\s*ab", "a{2}b", "(?:a|)b", r"\x61b", "a(?!b)", "(?<n>a)b"]
    texts = ["".join(rng.choices(["a", "b", "c", "d", "zz", "xy", "y", "AB", ".", "err", "warn", "1", " ", "\x0b", "\n"], k=rng.randint(0, 6))) for _ in range(400)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(*[F.expr(f"sum(int(({spec.meets('t', p)}) <> (t RLIKE {spec.quoted('(?s)' + p)})))").alias(f"p{i}") for i, p in enumerate(patterns)]).first()
    assert set(got) == {0}
