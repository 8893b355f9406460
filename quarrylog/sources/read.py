"""read_log: files to events, with threshold, content mode and lines around."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.custom import regexp_format
from ..operators.parse import parse_log
from ..operators.patterns import with_pattern_ids
from ..operators.post import at_least
from ..operators.post import content as cut
from ..operators.post import context as around
from .files import read_docs


def read_log(
    spark: SparkSession, path: str, format: str = "auto", severity_threshold: str = "all", content: str | int = "full", context: int = 0, ignore_errors: bool = False, include_unparsed: bool = False
) -> DataFrame:
    """Events of files, a glob or a folder. A missing file gives no rows.

    With `ignore_errors`, files that can't be read are left out (`files.unreadable` lists them) and an unknown format has no
    events. With `include_unparsed` and a `regexp:` format, lines that the pattern doesn't meet are events of type unknown.
    """
    docs = read_docs(spark, path, skip_large=ignore_errors)
    if include_unparsed and format.startswith("regexp:"):
        format = regexp_format(format[len("regexp:") :], include_unparsed=True)
    events = with_pattern_ids(parse_log(docs, "content", format, ignore_errors=ignore_errors, log_file="log_file", keep=("content",) if context else ()), "log_file")
    if context:
        events = events.withColumn("context", around(F.col("content"), F.col("log_line_start"), F.col("log_line_end"), context)).drop("content")
    events = at_least(events, severity_threshold)
    return events.withColumn("log_content", cut(F.col("log_content"), content, F.col("log_line_start"), F.col("log_line_end")))
