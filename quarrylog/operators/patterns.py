"""Clustering of like messages: normal form, fingerprint, dense pattern numbers, similarity, root causes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..parsers.spec import quoted

#: Fixed values: (regex, replacement), in this order, over the lower-cased message.
STEPS = (
    (r"[/\\][\w/\\.-]+\.(?:cpp|hpp|py|js|java|go|rs|rb|php|c|h)[:\s]", " <file> "),
    (r"/[\w/.-]+/", "/<path>/"),
    (r"\\[\w\\.-]+\\", r"\\<path>\\"),
    (r"\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2}", "<timestamp>"),
    (r"\d{2}:\d{2}:\d{2}", "<time>"),
    (r":(\d+):(\d+):", ":<line>:<col>:"),
    (r"line\s+\d+", "line <num>"),
    (r"column\s+\d+", "column <num>"),
    (r"0x[0-9a-fA-F]+", "<addr>"),
    (r"\b\d{6,}\b", "<id>"),
    (r"'[\w.-]+'", "'<var>'"),
    (r"\"[\w.-]+\"", "\"<var>\""),
    (r"\b\d+\.\d+\b", "<decimal>"),
    (r"\b\d+\b", "<num>"),
    (r"\s+", " "),
)
#: What a message needs for any step to change it, and for any but those of PLAIN: the others each look for one of these.
NEEDED, MARKED = r"[/\\:'\"\d\t\n]", r"[/\\:'\".]|0[xX]"
PLAIN = tuple(s for s in STEPS if s[0] in (r"line\s+\d+", r"column\s+\d+", r"\b\d{6,}\b", r"\b\d+\b", r"\s+"))
#: Words that make two messages alike.
KEYWORDS = ("error", "warning", "failed", "exception", "timeout", "permission", "not found")
#: Root cause by the first list of which the lower-cased message has a part.
ROOT_CAUSES = (
    ("network", ("connection", "timeout", "unreachable", "network", "dns", "socket")),
    ("permission", ("permission", "access denied", "unauthorized", "forbidden")),
    ("configuration", ("config", "not found", "missing", "invalid option", "no such file")),
    ("resource", ("memory", "disk", "space", "quota", "limit exceeded", "out of")),
    ("syntax", ("syntax", "parse error", "unexpected token", "undeclared", "undefined")),
    ("build", ("compile", "build", "link", "dependency")),
    ("test_logic", ("assert", "expected", "test failed")),
)


def normalise(message: Column) -> Column:
    """Lower case first, then the steps: ISO times with T are therefore not seen as timestamps.

    Messages with no digit, quote, slash, colon or white space but blanks are only lower-cased and trimmed.
    """
    low = F.lower(message)

    def after(steps):
        return reduce(lambda out, step: F.regexp_replace(out, *step), steps, low)

    return F.trim(F.when(~message.rlike(NEEDED), low).when(message.rlike(MARKED), after(STEPS)).otherwise(after(PLAIN)))


def normalised_sql(message: str) -> str:
    """`normalise` as SQL over a name."""
    low = f"lower({message})"

    def after(steps):
        return reduce(lambda out, step: f"regexp_replace({out}, {quoted(step[0])}, {quoted(step[1])})", steps, low)

    return f"trim(CASE WHEN NOT {message} RLIKE {quoted(NEEDED)} THEN {low} WHEN {message} RLIKE {quoted(MARKED)} THEN {after(STEPS)} ELSE {after(PLAIN)} END)"


def fingerprint_sql(tool: str, category: str, message: str) -> str:
    return f"concat_ws('_', {tool}, {category}, lower(hex(xxhash64(concat_ws(':', {tool}, {category}, {normalised_sql(message)})))))"


def fingerprint(tool: Column, category: Column, message: Column) -> Column:
    text = F.concat_ws(":", tool, category, normalise(message))
    return F.concat_ws("_", tool, category, F.lower(F.hex(F.xxhash64(text))))


def with_patterns_in_rows(e: Column | dict[str, Column]) -> dict[str, Column]:
    """What an event tells by itself. pattern_id needs the whole document: see with_pattern_ids."""
    return {"fingerprint": fingerprint(e["tool_name"], e["category"], e["message"]), "similarity_score": F.when(e["message"] != "", F.lit(1.0)), "pattern_id": F.lit(None).cast("bigint")}


def with_pattern_ids(events: DataFrame, *document: str) -> DataFrame:
    """pattern_id: 1, 2, ... by first sight of the fingerprint within a document.

    One shuffle by document and fingerprint; numbers are given over the documents' distinct fingerprints, which
    are few, and joined back, so that a document with very many events is never sorted as one.
    """
    keys = list(document)
    numbered = _numbered(events, keys).drop("n")
    joined = events.drop("pattern_id").alias("e").join(numbered.alias("p"), [F.col(f"e.{k}").eqNullSafe(F.col(f"p.{k}")) for k in (*keys, "fingerprint")], "left")
    return joined.select(*[F.col(f"e.{c}") if c != "pattern_id" else F.col("p._id").alias("pattern_id") for c in events.columns])


def pattern_counts(events: DataFrame, *document: str) -> DataFrame:
    """`document`, pattern_id as in with_pattern_ids, fingerprint and n, the number of its events: texts are parsed once, as nothing is joined back."""
    return _numbered(events, list(document)).select(*document, F.col("_id").alias("pattern_id"), "fingerprint", "n")


def _numbered(events: DataFrame, keys: list[str]) -> DataFrame:
    first = events.groupBy(*keys, "fingerprint").agg(F.min("event_id").alias("_first"), F.count(F.lit(1)).alias("n"))
    return first.withColumn("_id", F.row_number().over(Window.partitionBy(*(keys or [F.lit(1)])).orderBy("_first")).cast("bigint")).drop("_first")


def similarity(a: Column, b: Column) -> Column:
    """Equal characters by position over the longer length, and 0.1 for each keyword both have; at most 1."""
    same = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    longest = F.greatest(F.length(a), F.length(b))
    bonus = sum((F.when(F.contains(F.lower(a), F.lit(k)) & F.contains(F.lower(b), F.lit(k)), 0.1).otherwise(0.0) for k in KEYWORDS), F.lit(0.0))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(F.least(F.lit(1.0), same / longest + bonus))


def root_cause(message: Column, event_type: Column) -> Column:
    low = F.lower(message)
    out = F.lit("unknown")
    for name, parts in reversed(ROOT_CAUSES):
        test = low.rlike("|".join(parts))
        if name == "syntax":
            test = test | event_type.isin("lint_issue", "type_error")
        if name == "build":
            test = test | (event_type == "build_error")
        out = F.when(test, name).otherwise(out)
    return out


def build_id(path: Column) -> Column:
    found = [F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in (r"build[-_]?(\d+)", r"run[-_]?(\d+)", r"/(\d{4}-\d{2}-\d{2})", r"[-_](\d+)\.\w+$")]
    return F.coalesce(*found)


ENVIRONMENTS = ("dev", "development", "staging", "stage", "prod", "production", "test", "qa")


def environment(path: Column) -> Column:
    """The first of the names that stands in the path between slashes, dashes or underscores."""
    out = F.lit(None).cast("string")
    for name in reversed(ENVIRONMENTS):
        out = F.when(path.rlike(rf"/{name}/|-{name}-|_{name}_"), name).otherwise(out)
    return out
