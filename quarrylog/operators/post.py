"""What happens to events after parsing: severity threshold, content modes, lines around."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import severity_rank, threshold_rank

CONTEXT_LIMIT, SMART_LIMIT = 50, 200


def at_least(events: DataFrame, threshold: str) -> DataFrame:
    """Events of the severity and above. Pattern numbers are given before, so they keep gaps."""
    return events.where(severity_rank(F.col("severity")) >= threshold_rank(threshold))


def content(text: Column, mode: str | int = "full", start: Column | None = None, end: Column | None = None) -> Column:
    """full, none, a number of characters (0 and less is none), or smart: the lines around the event."""
    if isinstance(mode, str) and mode.lower() == "full":
        return text
    if isinstance(mode, str) and mode.lower() == "smart":
        return _smart(text, start if start is not None else F.lit(None), end if end is not None else F.lit(None))
    limit = 0 if isinstance(mode, str) and mode.lower() == "none" else int(mode)
    if limit <= 0:
        return F.lit(None).cast("string")
    return _cut(text, limit)


def _cut(text: Column, limit: int) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def _smart(text: Column, start: Column, end: Column) -> Column:
    """Lines start - 2 to end + 2 of the text itself, with ... where lines are left out."""
    lines = F.split(text, "\n")
    first = F.greatest(F.lit(0), F.coalesce(start, F.lit(1)) - 3).cast("int")
    last = F.least(F.size(lines), F.coalesce(end, start, F.lit(1)) + 2).cast("int")
    some = F.array_join(F.slice(lines, first + 1, F.greatest(last - first, F.lit(0))), "\n")
    some = F.concat(F.when(first > 0, F.lit("...\n")).otherwise(""), some, F.when(last < F.size(lines), F.lit("\n...")).otherwise(""))
    return F.when(F.length(text) <= SMART_LIMIT, text).otherwise(_cut(some, SMART_LIMIT))


def context(document: Column, start: Column, end: Column, n: int) -> Column:
    """array<struct(line_number, content, is_event)> of n lines before and behind; null without a line."""
    if n < 0:
        raise ValueError("context can't be negative")
    n = min(n, CONTEXT_LIMIT)
    end = F.coalesce(end, start)

    def around(lines):
        first = F.greatest(F.lit(1), start - n)
        last = F.least(F.size(lines), end + n)
        return F.when(
            (start > 0) & (last >= first),
            F.transform(F.slice(lines, first, F.greatest(last - first + 1, F.lit(0))), lambda x, i: F.struct((first + i).cast("int").alias("line_number"), x.alias("content"), ((first + i >= start) & (first + i <= end)).alias("is_event"))),
        )

    return F.get(F.transform(F.array(F.split(document, "\n")), around), F.lit(0))
