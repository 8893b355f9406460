import gzip
import json
import zipfile

import pytest
import zstandard

from quarrylog.sources import files
from quarrylog.sources.read import read_log
from quarrylog.streaming.tail import tail_logs

LINE = "a.c:3:4: error: bad\n"


def test_files_globs_and_compression(spark, tmp_path):
    (tmp_path / "a.log").write_text(LINE)
    (tmp_path / "b.log.gz").write_bytes(gzip.compress(LINE.encode()))
    (tmp_path / "c.log.zst").write_bytes(zstandard.ZstdCompressor().compress(LINE.encode()))
    assert read_log(spark, f"{tmp_path}/*", "gcc_text").count() == 3
    assert read_log(spark, f"{tmp_path}/a.log", "gcc_text", severity_threshold="critical").count() == 0
    assert read_log(spark, f"{tmp_path}/missing.log", "gcc_text").count() == 0
    row = read_log(spark, f"{tmp_path}/a.log", "gcc_text", content=5, context=1).first()
    assert row.log_content == "a.c:3..." and row.context[0].is_event and row.pattern_id == 1


def test_paths_are_checked():
    for path in ("", "x" * 5000, "a/../b", "a\0b"):
        with pytest.raises(ValueError):
            files.checked(path)


def test_zip_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "run.zip", "w") as z:
        z.writestr("2_build.txt", LINE)
        z.writestr("1_set up.txt", "x")
        z.writestr("inner/3_no.txt", "x")
    got = files.read_zip_logs(spark, str(tmp_path / "run.zip")).orderBy("job_order").collect()
    assert [(r.job_order, r.job_name) for r in got] == [(1, "set up"), (2, "build")]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text(LINE)
    q = tail_logs(spark, f"{tmp_path}/in", "gcc_text").writeStream.format("memory").queryName("tailed").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/ck").start()
    q.awaitTermination(60)
    assert spark.table("tailed").count() == 1


def test_folders_are_walked(spark, tmp_path):
    for name in ("a.log", "x/b.log", "x/y/c.log", "x/y/c.txt", "z/x/d.log"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(LINE)
    names = lambda p: sorted(r.log_file.split(tmp_path.name + "/")[1] for r in files.read_docs(spark, f"{tmp_path}/{p}").collect())
    assert names("**/*.log") == ["a.log", "x/b.log", "x/y/c.log", "z/x/d.log"]
    assert names("**/x/*.log") == ["x/b.log", "z/x/d.log"]
    assert names("x/**/[bc].{log,txt}") == ["x/b.log", "x/y/c.log", "x/y/c.txt"]
    assert names("none/**/*.log") == []


def test_size_limit_and_broken_files(spark, tmp_path):
    (tmp_path / "bomb.gz").write_bytes(gzip.compress(b"\0" * 50_000_000))
    (tmp_path / "bomb.zst").write_bytes(zstandard.ZstdCompressor().compress(b"\0" * 50_000_000))
    (tmp_path / "broken.gz").write_bytes(b"no gzip")
    (tmp_path / "large.log").write_text("x" * 3000)
    (tmp_path / "two.gz").write_bytes(gzip.compress(LINE.encode()) * 2)
    (tmp_path / "fine.log").write_text(LINE)
    got = {r.log_file.rsplit("/", 1)[1]: r.content for r in files.read_docs(spark, f"{tmp_path}/*", 1000, skip_large=True).collect()}
    assert got == {"fine.log": LINE, "two.gz": LINE * 2}
    problems = {r.log_file.rsplit("/", 1)[1]: r.problem for r in files.unreadable(spark, f"{tmp_path}/*", 1000).collect()}
    assert sorted(problems) == ["bomb.gz", "bomb.zst", "broken.gz", "large.log"]
    with pytest.raises(Exception, match="large.log"):
        files.read_docs(spark, f"{tmp_path}/large.log", 1000).collect()
    assert len(files.unpacked("a.gz", (tmp_path / "bomb.gz").read_bytes(), 1000)) == 1001
    with pytest.raises(Exception, match="broken.gz"):
        read_log(spark, f"{tmp_path}/broken.gz", "gcc_text").collect()
    assert read_log(spark, f"{tmp_path}/broken.gz", "gcc_text", ignore_errors=True).count() == 0
    assert read_log(spark, f"{tmp_path}/fine.log", "no such format", ignore_errors=True).count() == 0


def test_config_files_and_unparsed_lines(spark, tmp_path):
    config = {"name": "mine", "patterns": [{"regex": r"^BAD (?P<message>.*)$", "event_type": "build_error", "severity": "error"}]}
    (tmp_path / "mine.json").write_text(json.dumps(config))
    (tmp_path / "a.log").write_text("BAD one\nfine\n\nBAD two\n")
    for format in (f"config:{tmp_path}/mine.json", f"{tmp_path}/mine.json"):
        assert [r.message for r in read_log(spark, f"{tmp_path}/a.log", format).orderBy("event_id").collect()] == ["one", "two"]
    with pytest.raises(ValueError, match="no parser description"):
        read_log(spark, f"{tmp_path}/a.log", "config:/nowhere.json")
    got = read_log(spark, f"{tmp_path}/a.log", "regexp:BAD (?P<message>.*)", include_unparsed=True).orderBy("event_id").collect()
    assert [(r.event_type, r.message) for r in got] == [("lint_issue", "one"), ("unknown", "fine"), ("lint_issue", "two")]
