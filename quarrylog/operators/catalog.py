"""The registry as tables: formats, matching of commands, diagnosis of a text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registry
from .detect import command_regex, test_of

FORMATS_DDL = "format string, description string, category string, priority int, requires_extension string, supports_workflow boolean, command_patterns array<struct<pattern: string, pattern_type: string>>, `groups` array<string>"


def formats(spark: SparkSession) -> DataFrame:
    """One row a format, auto first, then by category and name."""
    rows = [("auto", "Automatic format detection", "auto", 0, None, False, [], [])]
    rows += [(e.name, e.description, e.category, e.priority, None, e.supports_workflow, [(p, k) for k, p in e.commands], list(e.groups)) for e in sorted(registry.entries(), key=lambda e: (e.category, e.name))]
    return spark.createDataFrame(rows, FORMATS_DDL)


def match_commands(commands: DataFrame, command: str = "command") -> DataFrame:
    """The command's columns, format, priority, matched_patterns: all formats that know a command. LIKE respects case."""
    found = None
    for e in registry.entries():
        for kind, pattern in e.commands:
            hit = F.when(F.col(command).rlike(command_regex(kind, pattern)), F.struct(F.lit(e.name).alias("format"), F.lit(e.priority).alias("priority"), F.lit(pattern).alias("pattern"), F.lit(kind).alias("pattern_type")))
            found = [hit] if found is None else [*found, hit]
    hits = F.filter(F.array(*found), lambda x: x.isNotNull())
    # One array a row, regrouped inside the row: no join and no shuffle.
    by_format = F.transform(
        F.array_distinct(F.transform(hits, lambda x: F.struct((-x["priority"]).alias("order"), x["format"].alias("format")))),
        lambda f: F.struct(f["order"].alias("order"), f["format"].alias("format"), F.transform(F.filter(hits, lambda h: h["format"] == f["format"]), lambda h: F.struct(h["pattern"].alias("pattern"), h["pattern_type"].alias("pattern_type"))).alias("matched")),
    )
    return commands.withColumn("_m", F.explode(F.array_sort(by_format))).select(*commands.columns, F.col("_m.format").alias("format"), (-F.col("_m.order")).alias("priority"), F.col("_m.matched").alias("matched_patterns"))


def best_command_format(command: Column) -> Column:
    """The format of the best priority for a command; the executable's folder and case don't count."""
    bare = F.regexp_replace(F.trim(command), r"^\S*/(?=\S)", "")
    out = F.lit(None).cast("string")
    for e in reversed([e for e in registry.entries() if e.commands]):
        test = reduce(lambda a, b: a | b, (bare.rlike("(?i)" + command_regex(k, p)) for k, p in e.commands))
        out = F.when(test, e.name).otherwise(out)
    return out


def diagnose(docs: DataFrame, text: str = "content", emit: str = "all", names: list[str] | None = None) -> DataFrame:
    """docs' columns, format, priority, can_parse, events_produced, is_selected for every format (or `names`)."""
    chosen = [e for e in registry.entries() if e.specs and (names is None or e.name in names)]
    base = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # All tests and counts in one step: a parser is only run where its format's markers are.
    base = base.select("*", *[test_of(e, F.col("_text")).alias(f"_can{i}") for i, e in enumerate(chosen)])
    number = lambda e: reduce(lambda rest, x: F.when(F.size(x.hits()) > 0, F.size(x.hits())).otherwise(rest), reversed(e.specs), F.lit(0))
    base = base.select("*", *[F.when(F.col(f"_can{i}"), number(e)).otherwise(0).cast("bigint").alias(f"_n{i}") for i, e in enumerate(chosen)])
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(e.name).alias("format"), F.lit(e.priority).alias("priority"), F.col(f"_can{i}").alias("can_parse"), F.col(f"_n{i}").alias("events_produced")) for i, e in enumerate(chosen)])
    out = base.withColumn("_all", rows).withColumn("_first", F.get(F.filter("_all", lambda x: x["can_parse"]), F.lit(0))["i"])
    out = out.select("_row", "_first", F.explode("_all").alias("_x")).select("_row.*", "_x.format", "_x.priority", "_x.can_parse", "_x.events_produced", (F.col("_x.i") == F.coalesce("_first", F.lit(-1))).alias("is_selected"))
    return out.where("can_parse") if emit == "valid" else out.where("NOT can_parse") if emit == "invalid" else out
