"""URL rules by host-suffix and path-prefix expressions.

Each URL is expanded into host suffix + path prefix expressions, for the suffix sizes (labels) and
prefix lengths that rules have. The first bytes of an expression's SHA-256 are an equi-join key into the
rules; the full digest confirms; the longest rule wins, then the smaller by text.

Defined results: a null url, or one without `://`, has empty host and path and gets the default verdict;
equal urls get equal results, each row stays; a null page_id is kept; other columns are ignored; an
empty table gives an empty result. Rules may not be null; a host is lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The contract's rules as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
PREFIX_HEX = 8
#: Rules up to this many are sent to every executor; more are joined by shuffle on the hash prefix.
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Behind the first ://, up to / ? # or the end; only A-Z are lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules=RULES, default: str = "allow", url: str = "url", keep=("page_id",)) -> DataFrame:
    """keep, host, path, rule, verdict for every row."""
    spark = pages.sparkSession
    schema = "verdict string, rule_host string, rule_path string"
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame([tuple(r) for r in rules], schema)
    table = table.select(
        "verdict",
        F.concat("rule_host", "rule_path").alias("rule"),
        F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256).alias("full"),
        F.size(F.split("rule_host", r"\.")).alias("labels"),
        F.length("rule_path").alias("path_length"),
    )
    # The shapes of rules, not the rules, decide how far a URL is expanded: a long host or path adds nothing.
    shapes = table.select("labels", "path_length").distinct().collect()
    number = table.count()
    table = table.select("verdict", "rule", "full", F.substring("full", 1, PREFIX_HEX).alias("prefix"))
    if number <= BROADCAST_RULES:
        table = F.broadcast(table)
    rows = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.monotonically_increasing_id().alias("_row"))
    if not shapes:
        return rows.select(*keep, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    parts = F.split("host", r"\.")
    expressions = F.array(*[
        F.when(
            (F.size(parts) >= s["labels"]) & (F.length("path") >= s["path_length"]) & (F.col("host") != ""),
            F.concat_ws("\n", F.array_join(F.slice(parts, -s["labels"], s["labels"]), "."), F.substring(F.col("path"), 1, s["path_length"])),
        )
        for s in shapes
    ])
    # A row's expressions meet again by its number, given in this one scan, after the map side has merged them.
    tried = rows.select("*", F.explode_outer(F.filter(F.transform(expressions, lambda x: F.sha2(x, 256)), lambda x: x.isNotNull())).alias("digest")).withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    sure = F.when(F.col("digest") == F.col("full"), F.struct((-F.length("rule")).alias("size"), "rule", "verdict"))
    best = tried.join(table, "prefix", "left").groupBy("_row", *keep, "host", "path").agg(F.min(sure).alias("best"))
    return best.select(*keep, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").cast("long"), "url"))


OP5_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
SELECT page_id, host, path,
       (SELECT h || r.p FROM r WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, r.p) ORDER BY length(h || r.p) DESC LIMIT 1) AS rule,
       coalesce((SELECT verdict FROM r WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, r.p) ORDER BY length(h || r.p) DESC LIMIT 1), 'allow') AS verdict
FROM p
"""
