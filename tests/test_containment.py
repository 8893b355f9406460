import random

from quarrylog.operators.containment import contains_join


def test_contains_join_matches_brute_force(spark):
    rng = random.Random(3)
    word = lambda a, b: "".join(rng.choice("aab\U0001f600%_.") for _ in range(rng.randrange(a, b)))
    texts = [(i, word(0, 40)) for i in range(300)] + [(900, None), (901, ""), (901, ""), (902, "aaa" * 20000 + "xyz")] + [(i, "aaaa hot") for i in range(1000, 1200)]
    patterns = [(i, word(0, 6)) for i in range(60)] + [(70, None), (71, ""), (72, "aaa"), (72, "aaa"), (73, "xyz"), (74, "nowhere")]
    left, right = spark.createDataFrame(texts, "id int, s string"), spark.createDataFrame(patterns, "id int, s string")
    expected = sorted((a, b, t, p) for a, t in texts for b, p in patterns if t is not None and p and p in t)
    for rows in (1000, 0):
        met = contains_join(left, right, "s", "s", broadcast_rows=rows)
        assert sorted((r[0].id, r[1].id, r[0].s, r[1].s) for r in met.collect()) == expected
        assert "NestedLoop" not in met._jdf.queryExecution().toString() and "Cartesian" not in met._jdf.queryExecution().toString()
    assert contains_join(left.limit(0), right, "s", "s").count() == 0 and contains_join(left, right.limit(0), "s", "s").count() == 0
