"""Benchmark decontamination by template windows.

Texts and benchmark items become tokens; numbers, names (capitalised inside a sentence) and units after a
number become typed slots, everything else is lower-cased. Windows of `width` tokens are hashed; windows of
documents meet those of items by a hash join. Along one alignment (place in the text less place in the
item) the slot fillers have to be a consistent substitution, both ways: one filler of the item, one of the text.
Windows whose slots hold the item's own fillers are the item word for word and count whatever stands beside them;
the substitution only admits the changed ones. Windows with fewer than LITERALS other tokens fit too much and
count only as they stand.
A document is reported for an item when its consistent windows cover `least_share` of the item's
windows, or `least_windows` of them.

Only the hashes of item windows, distinct, are broadcast, in blocks of at most BLOCK_HASHES; documents are never
shuffled by window, and one pass gives the windows of all widths. The few places that meet one are written; only
documents with such places are cut into tokens as they stand, and their windows are joined with the items' tokens,
which are compared. Counts move pre-aggregated by row and item.

Defined results: null and empty texts have no windows and match nothing; items of fewer tokens than `width` are
one window of their own length; items with equal text are all reported; repeated rows are each reported;
a null doc_id is kept; very long texts are whole; a first word of a sentence is no name; the control
characters U+0001 and U+0002 count as blanks; other columns are ignored or, in `drop_contaminated`, kept, whatever
their names; empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_keys, row_keys, text_or_empty, written

BLOCK_HASHES = 1_000_000
LITERALS = 3
NAME, NUMBER, UNIT = "\u0001", "0", "\u0002"
#: Units that become a slot after a number.
UNITS = "km|m|cm|mm|kg|g|mg|l|ml|s|ms|h|min|hours?|minutes?|seconds?|days?|years?|miles?|feet|inches|pounds?|dollars?|euros?|meters?|metres?|litres?|liters?|percent"


def plain(text: Column) -> Column:
    """Without the marks, and without the one letter whose lower case is two characters: so that `tokens_of` and
    `canonical` cut a text into the same tokens."""
    holds = F.contains(text, F.lit(NAME)) | F.contains(text, F.lit(UNIT)) | F.contains(text, F.lit("\u0130"))
    return F.when(holds, F.translate(text, NAME + UNIT + "\u0130", "  I")).otherwise(text)


def tokens_of(text: Column) -> Column:
    """Tokens as they stand; a name has its mark in front."""
    marked = F.regexp_replace(plain(text), r"(?<=[\p{Ll},;][ ])(?=\p{Lu}\p{Ll})", NAME)
    return F.regexp_extract_all(marked, F.lit(NAME + r"?\p{L}++|[0-9]++(?:[.,][0-9]++)*+"), F.lit(0))


def canonical(text: Column) -> Column:
    """The same tokens with slots instead of names, numbers and units."""
    slotted = F.regexp_replace(F.regexp_replace(plain(text), r"(?<=[\p{Ll},;][ ])\p{Lu}(?=\p{Ll})\p{L}++", NAME), r"[0-9]++(?:[.,][0-9]++)*+", NUMBER)
    slotted = F.regexp_replace(F.lower(slotted), rf"(?<=0[ ]?)(?<!\p{{L}})(?:{UNITS})(?!\p{{L}})", UNIT)
    return F.regexp_extract_all(slotted, F.lit(rf"[{NAME}{UNIT}]|\p{{L}}++|0"), F.lit(0))


def _is_slot(token: Column) -> Column:
    return token.isin(NAME, NUMBER, UNIT)


def _hashed(tokens: Column) -> Column:
    """A hash for each token, so that a window's hash reads numbers instead of its letters."""
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _windows(hashes: str, widths: list[int]) -> Column:
    """(width, at, hash) of all windows of these widths; places count from 0."""

    def of(width: int) -> Column:
        one = lambda i: F.struct(F.lit(width).alias("width"), (i - 1).alias("at"), F.xxhash64(F.slice(F.col(hashes), i, F.lit(width))).alias("hash"))
        none = F.expr("cast(array() as array<struct<width:int,at:int,hash:bigint>>)")
        return F.when(F.size(hashes) >= width, F.transform(F.sequence(F.lit(1), F.size(hashes) - width + 1), one)).otherwise(none)

    return F.concat(*map(of, widths)) if len(widths) > 1 else of(widths[0])


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """item_id, n_windows, place, width, hash, the window's tokens as they stand and canonical, and whether it is bare:
    short of LITERALS tokens that are no slots."""
    own = items.select("item_id", text_or_empty().alias("text")).select("item_id", tokens_of(F.col("text")).alias("raw"), canonical(F.col("text")).alias("tokens")).where(F.size("tokens") > 0)
    own = own.withColumn("width", F.least(F.lit(width), F.size("tokens"))).withColumn("n_windows", (F.size("tokens") - F.col("width") + 1).cast("long"))
    spread = own.withColumn("place", F.explode(F.sequence(F.lit(1), F.col("n_windows").cast("int"))))
    spread = spread.select("item_id", "n_windows", "place", "width", F.expr("slice(raw, place, width)").alias("item_raw"), F.expr("slice(tokens, place, width)").alias("item_tokens"))
    bare = F.size(F.filter("item_tokens", lambda x: ~_is_slot(x))) < F.least(F.lit(LITERALS), F.col("width"))
    return spread.withColumn("bare", bare).withColumn("hash", F.xxhash64(_hashed(F.col("item_tokens"))))


def contaminated_keys(docs: DataFrame, items: DataFrame, width: int = 8, least_share: float = 0.25, least_windows: int = 6) -> DataFrame:
    """k1, k2 (key of doc_id and text), item_id, matched, n_windows, slots_changed for each key and item that match."""
    windows = written(item_windows(items, width), "item-windows")
    hashes = written(windows.select("width", "hash").distinct(), "item-hashes")
    widths = [r[0] for r in hashes.select("width").distinct().orderBy("width").collect()]
    if not widths:
        return docs.sparkSession.createDataFrame([], "k1 long, k2 long, item_id long, matched long, n_windows long, slots_changed boolean")
    base = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).select(*row_keys(), "text")
    spread = base.select("k1", "k2", _hashed(canonical(F.col("text"))).alias("hashes")).select("k1", "k2", F.explode(_windows("hashes", widths)).alias("w")).select("k1", "k2", "w.*")
    blocks = -(-hashes.count() // BLOCK_HASHES)
    parts = [spread.join(F.broadcast(hashes.where(F.pmod(F.col("hash"), F.lit(blocks)) == block)), ["width", "hash"], "left_semi") for block in range(blocks)]
    places = written(reduce(DataFrame.unionByName, parts), "item-places")
    # A row's places are at most its windows, which its text holds as well.
    of_rows = written(places.groupBy("k1", "k2").agg(F.collect_set(F.struct("width", "hash", "at")).alias("met")), "item-rows")
    met = (
        by_keys(base, of_rows.select("k1", "k2"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).join(of_rows, ["k1", "k2"])
        .select("k1", "k2", "met", tokens_of(F.col("text")).alias("raw"), canonical(F.col("text")).alias("tokens"))
        .select("k1", "k2", F.explode(F.transform("met", lambda m: F.struct(
            m["width"].alias("width"), m["hash"].alias("hash"), m["at"].alias("at"),
            F.slice("raw", m["at"] + 1, m["width"]).alias("doc_raw"), F.slice("tokens", m["at"] + 1, m["width"]).alias("doc_tokens")))).alias("m"))
        .select("k1", "k2", "m.*")
    )
    same = F.forall(F.arrays_zip("item_raw", "doc_raw"), lambda x: F.lower(x["item_raw"]) == F.lower(x["doc_raw"]))
    found = (
        met.join(windows, ["width", "hash"]).where((F.col("item_tokens") == F.col("doc_tokens")) & (~F.col("bare") | same))
        .select("k1", "k2", "item_id", "place", "n_windows", (F.col("at") + 1 - F.col("place")).alias("shift"), same.alias("same"),
                F.filter(F.arrays_zip("item_tokens", "item_raw", "doc_raw"), lambda x: _is_slot(x["item_tokens"])).alias("slots"))
    )
    pairs = F.transform("slots", lambda x: F.struct(F.lower(x["item_raw"]).alias("a"), F.lower(x["doc_raw"]).alias("b")))
    one = lambda side: F.size("pairs") == F.size(F.array_distinct(F.col(f"pairs.{side}")))
    aligned = (
        found.groupBy("k1", "k2", "item_id", "n_windows", "shift")
        .agg(F.collect_set("place").alias("places"), F.collect_set(F.when(F.col("same"), F.col("place"))).alias("verbatim"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
        .withColumn("consistent", one("a") & one("b"))
        .withColumn("places", F.when(F.col("consistent"), F.col("places")).otherwise(F.col("verbatim")))
        .withColumn("pairs", F.when(F.col("consistent"), F.col("pairs")).otherwise(F.slice("pairs", 1, 0)))
        .where(F.size("places") > 0)
    )
    return (
        aligned.groupBy("k1", "k2", "item_id", "n_windows")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("matched"), F.max(F.exists("pairs", lambda x: x["a"] != x["b"])).alias("slots_changed"))
        .where((F.col("matched") >= F.ceil(F.lit(least_share) * F.col("n_windows"))) | (F.col("matched") >= least_windows))
        .select("k1", "k2", "item_id", "matched", "n_windows", "slots_changed")
    )


def contaminated(docs: DataFrame, items: DataFrame, width: int = 8, least_share: float = 0.25, least_windows: int = 6) -> DataFrame:
    """doc_id, item_id, matched, n_windows, slots_changed for each row of docs and item that match."""
    found = written(contaminated_keys(docs, items, width, least_share, least_windows), "contaminated")
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).select("doc_id", *row_keys())
    return by_keys(rows, found, ["k1", "k2"], "inner").select("doc_id", "item_id", "matched", "n_windows", "slots_changed")


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that match no item."""
    bad = written(contaminated_keys(docs, items).select("k1", "k2").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long"), text_or_empty().alias("text")).select("_row", *row_keys())
    return by_keys(rows, bad, ["k1", "k2"], "left_anti").select("_row.*")
