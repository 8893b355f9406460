"""Which format a text is in: the first of all formats, by priority and registration, whose markers it has."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import registry
from ..parsers.markers import MARKERS
from ..parsers.spec import Lines, bound, quoted

#: Characters that detection looks at.
SNIFF = 8192


def marks_of(entry: registry.Entry) -> list[str]:
    """What a text of this format must have, all of it: `re:` patterns, literals, `||` between alternatives, `!` for what must be missing."""
    marks = MARKERS.get(entry.name)
    if marks is None:
        marks = next((s.detect for s in entry.specs if getattr(s, "detect", None)), None)
    if marks is not None:
        return list(marks)
    patterns = [r.pattern for s in entry.specs if isinstance(s, Lines) for r in s.rules if r.span == 1]
    if not patterns:
        patterns = [r.pattern for s in entry.specs if isinstance(s, Lines) for r in s.rules[:1]]
    return ["re:(?m)" + "|".join(f"(?:{p})" for p in patterns)] if patterns else ["\u0000"]


def test_of(entry: registry.Entry, text: Column) -> Column:
    """True where the text has the format's marks."""
    return reduce(lambda a, b: a & b, (_mark(m, text) for m in marks_of(entry)))


def _pattern(mark: str) -> str:
    return mark[3:] if mark[3:].startswith("(?") else "(?m)" + mark[3:]


def _mark(mark: str, text: Column) -> Column:
    if mark.startswith("re:"):
        return text.rlike(_pattern(mark))
    if mark.startswith("!"):
        return ~F.contains(text, F.lit(mark[1:]))
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in mark.split("||")))


def test_sql(entry: registry.Entry, text: str) -> str:
    """`test_of` as SQL over a name."""

    def one(mark: str) -> str:
        if mark.startswith("re:"):
            return f"{text} RLIKE {quoted(_pattern(mark))}"
        if mark.startswith("!"):
            return f"NOT contains({text}, {quoted(mark[1:])})"
        return "(" + " OR ".join(f"contains({text}, {quoted(p)})" for p in mark.split("||")) + ")"

    return " AND ".join(one(m) for m in marks_of(entry))


def detect_sql(text: str, chosen: list[registry.Entry]) -> str:
    """`detect_format` as SQL over a name that isn't null."""
    tests = " ".join(f"WHEN {test_sql(e, '_head')} THEN {quoted(e.name)}" for e in chosen)
    return bound("_head", f"left({text}, {SNIFF})", f"CASE WHEN {text} = '' THEN 'unknown' {tests} ELSE 'unknown' END")


def detect_format(text: Column, names: list[str] | None = None) -> Column:
    """The format's name, 'unknown' where none fits, null for null. `names` bounds the candidates."""
    chosen = [e for e in registry.entries() if e.specs and (names is None or e.name in names)]
    head = F.substring(text, 1, SNIFF)
    out = F.lit("unknown")
    for e in reversed(chosen):
        out = F.when(test_of(e, head), F.lit(e.name)).otherwise(out)
    return F.when(text.isNull(), F.lit(None).cast("string")).when(text == "", F.lit("unknown")).otherwise(out)


def command_regex(kind: str, pattern: str) -> str:
    """A command pattern as a Java regex: literal and LIKE match the whole command, regexp any part."""
    if kind == "regexp":
        return pattern
    body = "".join(".*" if c == "%" else "." if c == "_" and kind == "like" else re.escape(c) for c in pattern) if kind == "like" else re.escape(pattern)
    return f"^{body}$"
