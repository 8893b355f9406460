"""Joins on containment (`text LIKE '%' || pattern || '%'`) without a nested loop.

A pattern occurs in a text only where all its q-grams do. Each pattern is looked up by the one of its grams that the
fewest texts hold; texts meet patterns by an equi-join on that gram, and the test itself follows. Counting grams shuffles
partial counts by gram, no texts. The table of patterns is broadcast while it has at most BROADCAST_PATTERNS rows; beyond
that, both sides are dealt by gram and a salt, so that a gram of very many texts lies in several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_PATTERNS = 200_000


def _grams(text: Column, widths: list[int]) -> Column:
    """All distinct runs of so many characters; a look-ahead takes them in one pass a width."""
    every = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{w}}}))"), F.lit(1)) for w in widths]
    return F.array_distinct(F.concat(*every) if len(every) > 1 else every[0])


def contains_join(texts: DataFrame, patterns: DataFrame, text: str, pattern: str, q: int = 3, salts: int = 16, broadcast_rows: int = BROADCAST_PATTERNS) -> DataFrame:
    """text_row, pattern_row (structs of all columns) of each pair of rows whose text holds the pattern, case and all.

    Null texts, null and empty patterns meet nothing. Repeated rows each meet what they hold. Patterns
    shorter than q are looked up by themselves. Clashing column names stay apart in the two structs.
    """
    rows = patterns.select(F.struct("*").alias("pattern_row"), F.col(pattern).cast("string").alias("_p")).where(F.length("_p") > 0)
    docs = texts.select(F.struct("*").alias("text_row"), F.col(text).cast("string").alias("_t")).where("_t IS NOT NULL")
    width = F.least(F.lit(q), F.length("_p"))
    own = rows.select("_p").distinct().withColumn("_w", width)
    widths = sorted(r[0] for r in own.select("_w").distinct().collect()) or [q]
    by_width = F.coalesce(*[F.when(F.col("_w") == w, _grams(F.col("_p"), [w])) for w in widths])
    grams = own.select("_p", F.explode(by_width).alias("_g"))
    wanted = grams.select("_g").distinct()
    small = lambda df: F.broadcast(df) if df.count() <= broadcast_rows else df
    met = docs.select(F.explode(_grams(F.col("_t"), widths)).alias("_g")).join(small(wanted), "_g", "left_semi").groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    # A pattern with a gram that no text holds occurs nowhere.
    rarest = grams.join(met, "_g", "left").groupBy("_p").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("x")).where("x.n > 0").select("_p", F.col("x._g").alias("_g"))
    known = rows.join(rarest, "_p")
    spread = docs.select("text_row", "_t", F.explode(_grams(F.col("_t"), widths)).alias("_g"))
    if known.count() <= broadcast_rows:
        pairs = spread.join(F.broadcast(known), "_g")
    else:
        dealt = known.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        narrow = spread.join(small(rarest.select("_g").distinct()), "_g", "left_semi").withColumn("_s", F.pmod(F.xxhash64("_t", F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
        pairs = narrow.join(dealt, ["_g", "_s"])
    return pairs.where(F.contains("_t", F.col("_p"))).select("text_row", "pattern_row")
