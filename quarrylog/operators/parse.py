"""Parsing texts into events: one narrow step a format, no shuffle.

A document is one row; its events come out of arrays inside that row, so event numbers are positions and
Spark splits the work by documents. Documents whose format differs go through one branch a format.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import registry
from ..schema import EVENT_FIELDS, LATER
from .detect import detect_format, test_of
from .post import at_least


def _events_of(docs: DataFrame, entry: registry.Entry) -> DataFrame:
    """docs with _events: array of events without the columns that later steps fill."""
    if len(entry.specs) == 1:
        return docs.withColumn("_hits", entry.specs[0].hits()).withColumn("_events", F.expr(entry.specs[0].events_sql("_hits"))).drop("_hits")
    if entry.name in registry.MERGED:
        hits = [x.hits().alias(f"_h{i}") for i, x in enumerate(entry.specs)]
        merged = f"array_sort(concat({', '.join(x.events_sql(f'_h{i}') for i, x in enumerate(entry.specs))}), (a, b) -> a.log_line_start - b.log_line_start)"
        return docs.select("*", *hits).withColumn("_events", F.expr(merged)).drop(*[f"_h{i}" for i in range(len(entry.specs))])
    return first_events(docs, [(F.lit(True), x) for x in entry.specs])


def _rows_of(docs: DataFrame, entry: registry.Entry) -> DataFrame:
    """An event a row, with _row, _file, its place _at and the columns that don't need others.

    Where one parser does it, hits become rows and then columns, so that columns that nobody reads are never made.
    """
    if len(entry.specs) != 1:
        return _as_rows(_events_of(docs, entry))
    (spec,) = entry.specs
    hits = _rows(docs.select("_row", "_file", "_text", F.expr(spec.after_sql(spec.hits_sql())).alias("_hits")), "_hits", "x", "_text")
    return hits.select("_row", "_file", "_at", *[F.expr(spec.event(n)).alias(n) for n in EVENT_FIELDS if n not in LATER])


def _as_rows(found: DataFrame) -> DataFrame:
    return _rows(found, "_events", "_e").select("_row", "_file", "_at", *[F.col("_e")[n].alias(n) for n in EVENT_FIELDS if n not in LATER])


def _rows(docs: DataFrame, array: str, element: str, *more: str) -> DataFrame:
    """A row for each element. The outer form, as for the other Spark filters by the array's size first, and for that makes the whole array twice."""
    return docs.select("_row", "_file", *more, F.posexplode_outer(array).alias("_at", element)).where(F.col("_at").isNotNull())


def first_events(docs: DataFrame, tried: list) -> DataFrame:
    """docs with _events: those of the first of (condition, parser) that yields any for the text in `_text`, else none.

    Each parser has a column of its own, null where its condition fails; nothing is nested in another parser, so that
    plans grow with the sum of the parsers.
    """
    n = len(tried)
    hits = docs.select("*", *[F.when(usable, spec.hits()).alias(f"_h{i}") for i, (usable, spec) in enumerate(tried)])
    own = hits.select(*docs.columns, *[F.expr(spec.events_sql(f"_h{i}")).alias(f"_e{i}") for i, (_, spec) in enumerate(tried)])
    first = "CASE " + " ".join(f"WHEN size(_e{i}) > 0 THEN _e{i}" for i in range(n)) + f" ELSE _e{n - 1} END"
    return own.withColumn("_events", F.expr(first)).drop(*[f"_e{i}" for i in range(n)])


def entries_of(format) -> list[registry.Entry] | None:
    """The parsers of a format argument, first choice first; None where texts decide themselves."""
    if isinstance(format, registry.Entry):
        return [format]
    if format.strip().lower() in ("auto", "unknown", ""):
        return None
    if format.startswith("regexp:"):
        from .custom import regexp_outcomes

        return [regexp_outcomes(format[len("regexp:") :])]
    if format.startswith("config:") or format.lower().endswith(".json"):
        from .custom import config_file

        return [config_file(format.removeprefix("config:"))]
    return registry.resolve(format)


def parse_log(
    docs: DataFrame, text: str = "content", format: str | registry.Entry = "auto", log_file: str | None = None, keep: tuple = (), severity_threshold: str = "all", ignore_errors: bool = False, format_column: str | None = None
) -> DataFrame:
    """`keep` columns and an event's columns for each event of each text.

    format: auto, a name, an alias, a group, an entry, `config:` and the path of a parser description (or just its path,
    which ends in .json), `regexp:` and a pattern (a text without a match gives one
    event that says so, a pattern that doesn't compile one error event a text), or a list of names of which the
    first that yields events counts. With `format_column`, each row names its own, and null means auto.
    Null and empty texts have no events. Repeated rows each have theirs. `severity_threshold` keeps events of
    this severity and above. An unknown format raises, with `ignore_errors` it gives no events.
    """
    if format_column is not None:
        return _by_own_format(docs, text, format_column, log_file, keep, severity_threshold, ignore_errors)
    name = F.col(log_file) if log_file else F.lit(None).cast("string")
    base = docs.select(F.struct(*keep).alias("_row") if keep else F.struct(F.lit(0).alias("_none")).alias("_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"), name.alias("_file"))
    try:
        candidates = entries_of(format)
    except ValueError:
        if not ignore_errors:
            raise
        candidates = []
    if candidates is None:
        chosen = [e for e in registry.entries() if e.specs]
        base = base.withColumn("_format", detect_format(F.col("_text")))
        if not docs.isStreaming:
            # The formats that occur, at most as many as there are formats: only they get a branch of the plan.
            present = {r[0] for r in base.select("_format").distinct().collect()}
            chosen = [e for e in chosen if e.name in present] or chosen[:1]
        parts = [_rows_of(base.where(F.col("_format") == e.name), e) for e in chosen]
        rows = reduce(lambda a, b: a.unionByName(b), parts)
    else:
        chosen = [e for e in candidates if e.specs] or [registry.BUILT_IN["generic_lint"]]
        if not any(e.specs for e in candidates):
            base = base.where(F.lit(False))
        is_group = isinstance(format, str) and len(chosen) > 1 and "," not in format
        if len(chosen) == 1:
            rows = _rows_of(base, chosen[0])
        else:
            # Members of a group also need the format's markers.
            rows = _as_rows(first_events(base, [(test_of(e, F.col("_text")) if is_group else F.lit(True), x) for e in chosen for x in e.specs]))
    from .patterns import with_patterns_in_rows

    values = {"event_id": (F.col("_at") + 1).cast("bigint"), "log_file": F.nullif(F.col("_file"), F.lit("")) if log_file else F.lit(None).cast("string")}
    patterns = with_patterns_in_rows({n: F.col(n) for n in EVENT_FIELDS if n not in LATER})
    columns = [(values.get(n) if n in values else patterns.get(n) if n in patterns else F.col(n)).cast(t).alias(n) for n, t in EVENT_FIELDS.items()]
    events = rows.select(*[F.col("_row")[c].alias(c) for c in keep], *columns)
    return events if severity_threshold.lower() == "all" else at_least(events, severity_threshold)


def _by_own_format(docs: DataFrame, text: str, column: str, log_file: str | None, keep: tuple, severity_threshold: str, ignore_errors: bool) -> DataFrame:
    """One branch for each format name that occurs; names come from the caller's table, as a rule few."""
    named = docs.withColumn("_named", F.coalesce(F.col(column), F.lit("auto")))
    names = sorted(r[0] for r in named.select("_named").distinct().collect()) or ["auto"]
    parts = [parse_log(named.where(F.col("_named") == n), text, n, log_file, keep, severity_threshold, ignore_errors) for n in names]
    return reduce(lambda a, b: a.unionByName(b), parts)
