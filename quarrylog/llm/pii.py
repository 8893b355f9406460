"""Personal data: fixed patterns, widened by bootstrapped contextual extraction.

Seeds (what the fixed patterns find, tokens of 6 characters or more) induce lexical patterns: the token in front
of an identifier. Patterns and instances form a bipartite graph, scored in turn until nothing is new:

* confidence(pattern, kind) = distinct known instances of the kind behind it / distinct tokens of any sort
  behind it, and at least `min_support` distinct known instances;
* score(instance) = 1 - product over its patterns of (1 - confidence), for whatever token follows a pattern;
* share(instance) = distinct texts in which a pattern of the kind stands before it / distinct texts with it, by
  the token before, so that an ordinary word that once follows a pattern stays one.

Instances that reach `min_score` and `min_share` join the known ones; what stands before them elsewhere may become
a pattern. Copies of texts change nothing. All of it is DataFrame operations, and what they leave is written to the
shared folder. A pass over the texts bounds the confidence of new patterns from above: common words, behind which
far more tokens stand than known instances, leave a few rows each. Another one gives the tokens behind those that
may reach min_confidence, the third the places of new instances. A pass with nothing to look for is left out.

Defined results: null text counts as empty; empty text has no spans; equal rows get equal results
(each stays a row); a null doc_id is kept; very long texts are read whole, in time linear in their length; a token
at a text's start has no context, and counts if it is found elsewhere; other columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_keys, indexed, labels_of, let, overlapping, regex_spans, row_key, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the contract's patterns: the same matches, without backtracking or recursion.
# The lookbehind starts each run once (\G: or where the last match ended), so long runs stay linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"


def _digits(m):
    return F.regexp_replace(m, "[^0-9]", "")


def _card(m):
    d = _digits(m)
    return F.length(d).between(16, 19) & F.call_function("luhn_check", d)


def base_spans(text):
    """kind -> spans of the fixed patterns."""
    return {
        "email": regex_spans(text, EMAIL, needs="@"),
        "ip": regex_spans(text, IP, keep=lambda m: m.rlike(OCTETS), needs="."),
        "card": regex_spans(text, CARD, keep=_card),
        "phone": regex_spans(text, PHONE, keep=lambda m: F.length(_digits(m)).between(8, 15), needs="+"),
    }


def _placed(kind: str, spans):
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind")))


def _with_hits(index):
    """left, token and kind of the tokens that a fixed span overlaps."""

    def trimmed(x):
        s = x["s"] + F.length(F.regexp_extract(x["m"], r"^[^A-Za-z0-9+]*+", 0))
        return F.struct(x["left"].alias("left"), _trimmed(x["m"]).alias("token"), s.alias("s"))

    def hit(x):
        e = x["s"] + F.length(x["token"])
        return F.struct(x["left"].alias("left"), x["token"].alias("token"), F.get(overlapping(index, x["s"], e), F.lit(0))["kind"].alias("kind"))

    return F.filter(F.transform(F.transform("seen", trimmed), hit), lambda x: x["kind"].isNotNull() & (F.length(x["left"]) > 0) & (F.length(x["token"]) >= 6))


def _trimmed(m):
    """The token's identifier: no quotes, brackets or sentence marks around it."""
    return F.regexp_replace(F.regexp_replace(m, r"^[^A-Za-z0-9+]++", ""), r"(?<![^A-Za-z0-9])[^A-Za-z0-9]++$", "")


# Single characters instead of ranges: Java looks these up in a table, which takes a sixth of the time.
PLAIN = string.ascii_letters + string.digits
SPACE = r" \t\n\x0B\f\r"
EXTRA = "array<struct<kind:string,s:int,e:int>>"


def _core(m):
    """The token's identifier, or the token as it stands where it holds nothing else."""
    return F.coalesce(F.nullif(_trimmed(m), F.lit("")), m)


def _cores(text):
    """The text with _core of each token in its place: a regex for each token costs several times as much."""
    begun = F.regexp_replace(text, rf"(?<!\S)[^{PLAIN}+{SPACE}]++(?=[{PLAIN}]|\+\S*[{PLAIN}])", "")
    return F.regexp_replace(begun, rf"([{PLAIN}])[^{PLAIN}{SPACE}]++(?!\S)", "$1")


def _pairs(d: DataFrame, **more) -> DataFrame:
    """left, token: the identifier of each token and the token before it, lower-cased ('' at a text's start); `more` is computed once a text."""
    d = d.select("text", *[c.alias(n) for n, c in more.items()])
    pair = F.arrays_zip(F.concat(F.array(F.lit("")), F.split(F.lower("text"), r"\s+")).alias("a"), F.split(_cores(F.col("text")), r"\s+").alias("b"))
    return d.select(*more, F.explode(pair).alias("x")).select(*more, F.col("x.a").alias("left"), F.col("x.b").alias("token")).where(F.length("token") > 0)


def _and(before: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if before is None else before.unionByName(new)


def _without(rows: DataFrame, before: DataFrame | None, on: str) -> DataFrame:
    return rows if before is None else rows.join(before.select(on).distinct(), on, "left_anti")


def _bounds(d: DataFrame, lefts: DataFrame) -> DataFrame:
    """left, token, word, bits: what stands behind lefts (left, n), in about n / 8 + 1 rows for a left and one for each token shaped like a seed.

    The other tokens only set one of 64 * words bits, by their hash. So the bits set and the rows with a token are
    no more than the distinct tokens behind a left, however many texts there are.
    """
    lefts = lefts.select("left", F.ceil(F.col("n") / 8).alias("words"))
    rows = by_keys(_pairs(d, some=F.col("text").rlike("[0-9@]")), lefts, ["left"], "inner")
    shaped = F.col("some") & (F.length("token") >= 6) & F.col("token").rlike("[0-9@]")
    rows = rows.select("left", "words", F.when(shaped, F.col("token")).alias("token"), F.xxhash64("token").alias("hash"))
    word, bit = F.when(F.col("token").isNull(), F.expr("pmod(shiftright(hash, 6), words)")), F.when(F.col("token").isNull(), F.expr("shiftleft(1L, cast(hash & 63 as int))"))
    return rows.select("left", "token", word.alias("word"), bit.alias("bits")).groupBy("left", "token", "word").agg(F.bit_or("bits").alias("bits"))


def discover(d: DataFrame, seeds: DataFrame, min_support: int, min_confidence: float, min_score: float, min_share: float) -> tuple[DataFrame, DataFrame] | None:
    """found: token, kind of the instances that contexts tell; places: h, left, token of each distinct text that holds
    one, h its hash. None without any. seeds: left, token, kind."""
    known, asked, bounds, read, edges, places, found = seeds, None, None, None, None, None, None
    # Seeds of another shape (of `.@ab-c.de`, `ab-c.de` remains) may stand behind any left.
    odd = seeds.select("token").where(~F.col("token").rlike("[0-9@]")).distinct().count()
    while True:
        lefts = known.groupBy("left").agg(F.countDistinct("token").alias("n")).where(F.col("n") >= min_support)
        lefts = written(_without(lefts, asked, "left"), "pii-lefts")
        if not lefts.isEmpty():
            asked = _and(asked, lefts)
            bounds = _and(bounds, written(_bounds(d, lefts), "pii-bounds"))
        if bounds is None:
            return None
        kinds = known.select("token", "kind").distinct()
        # Only lefts that can reach the confidence have what stands behind them written out.
        least = bounds.groupBy("left").agg(F.sum(F.coalesce(F.bit_count("bits"), F.lit(1))).alias("least"))
        told = bounds.where(F.col("token").isNotNull()).select("left", "token")
        told = told if places is None else told.unionByName(places.select("left", "token")).distinct()
        most = told.join(kinds, "token").groupBy("left", "kind").agg(F.count(F.lit(1)).alias("n")).groupBy("left").agg(F.max("n").alias("n"))
        most = least.join(most, "left", "left").withColumn("n", F.coalesce("n", F.lit(0)) + odd)
        able = most.where((F.col("n") >= min_support) & (F.col("n") / F.col("least") >= min_confidence)).select("left")
        able = written(_without(able, read, "left"), "pii-able")
        if not able.isEmpty():
            read = _and(read, able)
            new = by_keys(_pairs(d), able, ["left"], "left_semi").distinct()
            edges = _and(edges, written(new, "pii-edges"))
        if edges is None:
            return None
        patterns = (
            edges.join(kinds, "token").groupBy("left", "kind").agg(F.count(F.lit(1)).alias("known"))
            .join(edges.groupBy("left").agg(F.count(F.lit(1)).alias("uses")), "left")
            .withColumn("confidence", F.least(F.lit(0.999), F.col("known") / F.col("uses")))
            .where((F.col("known") >= min_support) & (F.col("confidence") >= min_confidence))
            .select("left", "kind", "confidence")
        )
        patterns = written(patterns, "pii-patterns")
        candidates = (
            edges.join(patterns, "left")
            .groupBy("token", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
            .where(F.col("score") >= min_score)
            .groupBy("token").agg(F.max(F.struct("score", "kind"))["kind"].alias("kind"))
            .join(kinds.select("token").distinct(), "token", "left_anti")
        )
        candidates = written(candidates, "pii-candidates")
        unplaced = written(_without(candidates.select("token"), places, "token"), "pii-unplaced")
        if not unplaced.isEmpty():
            new = by_keys(_pairs(d, h=F.xxhash64("text")), unplaced, ["token"], "left_semi").select("h", "left", "token").distinct()
            places = _and(places, written(new, "pii-places"))
        if places is None:
            return None
        share = F.sum(F.when(F.col("confidence").isNotNull(), F.col("n")).otherwise(0)) / F.sum("n")
        counted = places.groupBy("left", "token").agg(F.count(F.lit(1)).alias("n"))
        fresh = (
            counted.join(candidates, "token").join(patterns, ["left", "kind"], "left")
            .groupBy("token", "kind").agg(share.alias("share")).where(F.col("share") >= min_share).select("token", "kind")
        )
        fresh = written(fresh, "pii-found")
        if fresh.isEmpty():
            return None if found is None else (found, places)
        found = _and(found, fresh)
        known = known.unionByName(counted.where(F.length("left") > 0).join(fresh, "token").select("left", "token", "kind"))


def _spans_of(d: DataFrame, kept: DataFrame, found: DataFrame, places: DataFrame) -> DataFrame:
    """key, extra: where the found instances stand, except where a fixed pattern has something already."""
    held = written(places.join(found, "token", "left_semi").select("h").distinct(), "pii-held")
    keys = written(by_keys(d.withColumn("h", F.xxhash64("text")), held, ["h"], "left_semi").select("key").distinct(), "pii-keys")
    base = F.array_sort(F.concat(*[_placed(k, F.col(k)) for k in KINDS]))
    rows = by_keys(d, keys, ["key"], "left_semi").select("key", F.explode(regex_spans(F.col("text"), r"\S++")).alias("x")).distinct()
    s = F.col("x.s") + F.when(_trimmed(F.col("x.m")) != "", F.length(F.regexp_extract("x.m", r"^[^A-Za-z0-9+]*+", 0))).otherwise(0)
    rows = rows.select("key", _core(F.col("x.m")).alias("token"), s.cast("int").alias("s"))
    rows = by_keys(rows, found, ["token"], "inner").select("key", F.struct("kind", "s", (F.col("s") + F.length("token")).cast("int").alias("e")).alias("x"))
    every = rows.groupBy("key").agg(F.sort_array(F.collect_set("x")).alias("every"))
    fixed = by_keys(kept.select("key", indexed(base).alias("index")), keys, ["key"], "left_semi").groupBy("key").agg(F.first("index").alias("index"))
    return every.join(fixed, "key").select("key", F.filter("every", lambda x: F.size(overlapping(F.col("index"), x["s"], x["e"])) == 0).alias("extra"))


def find_personal_data(docs: DataFrame, min_support: int = 5, min_confidence: float = 0.5, min_score: float = 0.8, min_share: float = 0.5) -> DataFrame:
    """doc_id, key, one array of spans (s, e, m) a kind, and `extra`: discovered spans (kind, s, e)."""
    d = docs.select("doc_id", text_or_empty().alias("text")).withColumn("key", row_key("doc_id", "text"))
    base = d.select("doc_id", "key", "text", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    # A seed's context is the token before, which ends the text between or is a token of the same sort.
    seen = F.transform(
        regex_spans(F.col("text"), CANDIDATE, around=True),
        lambda x: F.struct(
            x["s"].alias("s"),
            x["m"].alias("m"),
            F.lower(F.when(x["gap"].rlike(r"^\s++$"), F.coalesce(x["before"], F.lit(""))).otherwise(F.regexp_extract(x["gap"], r"(?<!\S)(\S++)\s++$", 1))).alias("left"),
        ),
    )
    held = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    index = indexed(F.array_sort(F.concat(*[_placed(k, F.col(k)) for k in KINDS])))
    kept = base.withColumn("seen", F.when(held, seen)).select("doc_id", "key", *KINDS, F.when(held, let(index, _with_hits)).alias("seeds"))
    kept = written(kept, "pii-spans")
    seeds = written(kept.select(F.explode("seeds").alias("x")).select("x.*").distinct(), "pii-seeds")
    told = discover(d, seeds, min_support, min_confidence, min_score, min_share)
    kept = kept.drop("seeds")
    if told is None:
        return kept.withColumn("extra", F.lit(None).cast(EXTRA))
    return by_keys(kept, written(_spans_of(d, kept, *told), "pii-extra"), ["key"], "left")


def op1_personal_data(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    own = lambda k: F.filter(F.coalesce("extra", F.expr(f"cast(array() as {EXTRA})")), lambda x: x["kind"] == k)
    every = [
        labels_of(k, F.array_sort(F.concat(F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))), F.transform(own(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))))
        for k in KINDS
    ]
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", *[labels_of(k, F.col(k)) for k in KINDS]), 256).alias("base_sha256"),
        F.concat_ws(",", *every).alias("spans"),
    )
