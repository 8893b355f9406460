import random

from pyspark.sql import functions as F

import __spark_entry__
from quarrylog.operators import patterns

SF = "/root/testdata/sf0.001"


def test_patterns_are_counted_without_parsing_twice(spark):
    assert __spark_entry__.queries()["q24_pattern_ids"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_counts_equal_those_of_numbered_events(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "c"]), i, rng.choice(["f", "g", "h", "i"])) for i in range(200)]
    events = spark.createDataFrame(rows, "d string, event_id bigint, fingerprint string").withColumn("pattern_id", F.lit(None).cast("bigint"))
    want = patterns.with_pattern_ids(events, "d").groupBy("d", "pattern_id", "fingerprint").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(tuple, patterns.pattern_counts(events, "d").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert {tuple(r) for r in patterns.pattern_counts(events).select("pattern_id", "n").collect()} == {tuple(r) for r in patterns.with_pattern_ids(events).groupBy("pattern_id").count().collect()}


def test_plain_messages_take_the_same_steps(spark):
    rng = random.Random(11)
    parts = ["line", " ", "  ", "\t", "7", "123456", "12", "0x", "0X", "ff", "/", "a/b/", ".c:", ":", "1:2:", "'v'", '"w"', ".", "3.5", "column", "2024-01-02 03:04:05", "\\d\\", "Err", "İ", "\n", "\r"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(2000)]
    low, m = F.lower("m"), F.col("m")
    every = low
    for pattern, text in patterns.STEPS:
        every = F.regexp_replace(every, pattern, text)
    want = F.trim(F.when(m.rlike(r"[/\\:'\"\d\t\n]"), every).otherwise(low))
    docs = spark.createDataFrame([(t,) for t in texts], "m string")
    assert docs.where((patterns.normalise(m) != want) | (F.expr(patterns.normalised_sql("m")) != want)).count() == 0
    assert docs.where(~m.rlike(patterns.MARKED)).count() > 200
