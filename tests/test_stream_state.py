import random

import pytest

from quarrylog.operators.parse import parse_log
from quarrylog.operators.patterns import with_pattern_ids
from quarrylog.schema import EVENT_FIELDS
from quarrylog.streaming.state import follow, with_running_ids

SCHEMA = "log_file string, part long, content string"


def started(df, sink, mark):
    q = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", mark).trigger(availableNow=True).start(sink)
    if not q.awaitTermination(60):
        q.stop()
        raise TimeoutError(sink)


def arrive(spark, tmp_path, batches, format, number_at):
    """Each batch arrives while no query runs; the queries start again from their checkpoints."""
    source, events, out = (str(tmp_path / x) for x in ("in", "events", "out"))
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        started(follow(spark.readStream.schema(SCHEMA).parquet(source), format), events, str(tmp_path / "ck1"))
        if k in number_at:
            stream = spark.readStream.schema(spark.read.parquet(events).schema).parquet(events)
            started(with_running_ids(stream), out, str(tmp_path / "ck2"))
    return spark.read.parquet(out).orderBy("log_file", "event_id").collect()


def whole(spark, texts, format):
    docs = spark.createDataFrame(list(texts.items()), "log_file string, content string")
    return with_pattern_ids(parse_log(docs, "content", format, log_file="log_file"), "log_file").select(*EVENT_FIELDS).orderBy("log_file", "event_id").collect()


def test_files_in_batches_give_the_events_of_whole_files(spark, tmp_path):
    rng = random.Random(2)
    texts = {}
    for name in ("a", "b"):
        lines = []
        for i in range(40):
            lines.append(rng.choice([f"TASK [step {i % 7}] ****", f"ok: [host{i % 3}]", f"changed: [host{i}]", "plain", 'fatal: [h]: FAILED! => {"msg": "no"}', ""]))
        texts[name] = "\n".join(lines) + "\n"
    cut = {n: sorted(rng.sample(range(len(t)), 8)) for n, t in texts.items()}
    parts = [(n, k, t[a:b]) for n, t in texts.items() for k, (a, b) in enumerate(zip([0, *cut[n]], [*cut[n], len(t)], strict=True))]
    batches = [[p for p in parts if p[1] % 9 // 3 == k] for k in range(3)]
    batches[1].append(("c", 0, None))
    assert all(batches)
    got, expected = arrive(spark, tmp_path, batches, "ansible_text", (0, 2)), whole(spark, texts, "ansible_text")
    assert len(expected) > 20 and len({r.pattern_id for r in expected}) > 2 and any(r.unit for r in expected)
    assert [r.asDict() for r in got] == [r.asDict() for r in expected]


def test_formats_of_whole_texts_are_refused(spark):
    for format in ("pytest_text", "junit_xml", "eslint_json", "shellcheck_text", "lint"):
        with pytest.raises(ValueError, match="whole text"):
            follow(spark.createDataFrame([], SCHEMA), format)
