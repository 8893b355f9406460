"""The engine for spark.sql: temporary functions whose bodies are the generated column expressions.

`register(spark)` makes, for this session:

* `log_events(content, format)`: the text's events as an array of structs, an expression of the plan, so that nothing is
  shuffled and no Python runs. The form for large tables (generators take no SQL functions, so it is bound first):
  `FROM (SELECT id, log_events(content, format) AS found FROM t) LATERAL VIEW [OUTER] inline(found)`;
* `parse_log(content, format)`: the same as a table function, for `FROM parse_log(..)`, `, LATERAL parse_log(t.content, ..)`
  and `LEFT JOIN LATERAL .. ON true`. Spark evaluates a correlated generator over the distinct texts and joins them
  back, which shuffles them;
* `detect_format(content)`, `log_formats()`, `normalise_message(message)`, `log_fingerprint(tool, category, message)`,
  `status_badge(status)`, `count_badge(errors, warnings, running)`.

A format is a name, an alias, or auto (also null), and may come from a column. A group or a list isn't taken here, since the
functions' plans would hold each parser several times; `parse_log` of `operators.parse` takes them. Null and empty texts have no
events; an unknown format gives none. Only `formats` (all by default) can be named, and their sum is the plan's size: sessions
that know their formats should name them: with all of them, a query takes half a minute to plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import registry
from ..operators.catalog import FORMATS_DDL, formats
from ..operators.detect import detect_sql
from ..operators.patterns import fingerprint_sql, normalised_sql
from ..parsers.spec import bound, quoted
from ..schema import EVENT_FIELDS, EVENT_SCHEMA
from .badges import FAIL, OK, RUNNING, UNKNOWN, WARN, WORDS


def _events(entry: registry.Entry) -> str:
    """SQL over `_text` for a format's events: those of its first parser that yields any, or of all parsers, by line."""
    own = [x.events_sql() for x in entry.specs]
    if len(own) == 1:
        return own[0]
    if entry.name in registry.MERGED:
        return f"array_sort(concat({', '.join(own)}), (a, b) -> a.log_line_start - b.log_line_start)"
    return "coalesce(" + ", ".join(f"nullif({x}, array())" for x in own[:-1]) + f", {own[-1]})"


def names_of(entry: registry.Entry) -> list[str]:
    """All names that mean this format."""
    known = {entry.name, *entry.aliases, *registry.FIRST_ALIASES, *registry.MORE_ALIASES}
    return sorted(n for n in known if registry.find(n) is entry)


def events_sql(content: str, format: str, chosen: list[registry.Entry]) -> str:
    """SQL over two names for the array of whole events."""
    named = " ".join(f"WHEN lower(trim({format})) IN ({', '.join(quoted(n) for n in names_of(e))}) THEN {quoted(e.name)}" for e in chosen)
    auto = f"CASE WHEN {format} IS NULL OR lower(trim({format})) IN ('auto', 'unknown', '') THEN {detect_sql('_text', chosen)} {named} END"
    found = f"CASE {auto} " + " ".join(f"WHEN {quoted(e.name)} THEN {_events(e)}" for e in chosen) + " END"
    values = {
        "event_id": "i + 1", "log_file": "NULL", "fingerprint": "get(_prints, i)", "similarity_score": "CASE WHEN e.message <> '' THEN 1.0D END", "pattern_id": "array_position(_distinct, get(_prints, i))",
    }
    columns = ", ".join(f"cast({values.get(n, f'e.`{n}`')} AS {t}) AS `{n}`" for n, t in EVENT_FIELDS.items())
    prints = f"transform(_events, e -> {fingerprint_sql('e.tool_name', 'e.category', 'e.message')})"
    whole = bound("_prints", prints, bound("_distinct", "array_distinct(_prints)", f"transform(_events, (e, i) -> struct({columns}))"))
    return bound("_text", f"coalesce({content}, '')", bound("_events", f"coalesce({found}, array())", whole))


def register(spark: SparkSession, names: tuple | None = None) -> None:
    """Makes the functions for this session; `names` bounds the formats. Custom formats that are loaded are among them."""
    chosen = [e for e in registry.entries() if e.specs and (names is None or e.name in names)]
    make = lambda head, body: spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    struct = "ARRAY<STRUCT<" + ", ".join(f"`{n}`: {t}" for n, t in EVENT_FIELDS.items()) + ">>"
    make(f"log_events(content STRING, format STRING DEFAULT 'auto') RETURNS {struct}", events_sql("content", "format", chosen))
    make(f"parse_log(content STRING, format STRING DEFAULT 'auto') RETURNS TABLE({EVENT_SCHEMA})", "SELECT inline(_events) FROM (SELECT log_events(parse_log.content, parse_log.format) AS _events)")
    make("detect_format(content STRING) RETURNS STRING", f"CASE WHEN content IS NOT NULL THEN {detect_sql('content', chosen)} END")
    make("normalise_message(message STRING) RETURNS STRING", normalised_sql("message"))
    make("log_fingerprint(tool STRING, category STRING, message STRING) RETURNS STRING", fingerprint_sql("tool", "category", "message"))
    badges = " ".join(f"WHEN lower(status) IN ({', '.join(quoted(w) for w in words)}) THEN {quoted(badge)}" for badge, words in WORDS)
    make("status_badge(status STRING) RETURNS STRING", f"CASE WHEN status IS NULL THEN NULL {badges} ELSE {quoted(UNKNOWN)} END")
    counted = f"CASE WHEN errors IS NULL OR warnings IS NULL OR running IS NULL THEN NULL WHEN running THEN {quoted(RUNNING)} WHEN errors > 0 THEN {quoted(FAIL)} WHEN warnings > 0 THEN {quoted(WARN)} ELSE {quoted(OK)} END"
    make("count_badge(errors BIGINT, warnings BIGINT, running BOOLEAN DEFAULT false) RETURNS STRING", counted)
    formats(spark).createOrReplaceTempView("_log_formats")
    make(f"log_formats() RETURNS TABLE({FORMATS_DDL.replace('format string', '`format` string', 1)})", "SELECT * FROM _log_formats")
