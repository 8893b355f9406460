"""Secrets: fixed patterns, and character Markov models for random strings that no pattern names.

Two first-order models over the printable characters, one of random strings and one of ordinary
identifiers, are counted from labelled samples. A candidate is any part of a run of identifier characters in a
text; the log-likelihood ratio of its character pairs, summed and per pair, decides. The table of ratios is one
constant array, looked up by pair index, so scoring needs no join and no Python.

Labelled samples: random ones are digests in hex, base64 and base 62 of a fixed number of integers, and
what the fixed patterns find in the sampled documents; ordinary ones are the longer words of the sampled
documents and WORDS, as they stand, in capitals, joined and numbered. The sample is bounded by `sample_docs`; only the fit uses it.

Defined results: null text counts as empty; empty text has no spans; equal rows get equal results; a null
doc_id is kept; very long texts are read whole, in time linear in their length; other columns are ignored or, in
`redact`, kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, indexed, let, overlapping, piece, regex_spans, text_or_empty

KINDS = ("assign", "access", "hex")
ASSIGN = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+[A-Za-z0-9+/_.=-]++"
ASSIGN_VALUE = r"(?i)^(?:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)"
# A run that is long enough is found at its start, and no part of a shorter one can be: the same as the
# contract's patterns with their length tests.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
RUN = "[A-Za-z0-9+/_-]"
FIRST, SIZE = 33, 94
#: One pair says no more than this for a random string, so that a few rare pairs don't make one.
MOST = 4.0
#: Words of file names and identifiers, beside those of the documents.
WORDS = (
    "about access account action active address after agent alert array attribute author back base before binary block board body bottom branch browser buffer build button call case change channel check child "
    "class client cloud code collection color column command comment commit common company compile component connect console container content context control copy count create current data database date debug "
    "delete description design detail device dialog directory display document domain download driver edit element email enable encode engine entity error event example execute export extension external factory "
    "feature field file filter final find first folder format frame function future gateway general generate global graph group handler header height help history home host icon image import include index info "
    "input insert install instance integer interface internal item java job join journal keyboard label language large layer layout length level library light limit line link list listener load local location "
    "login machine main manager master match member memory menu message method minimum model module monitor mouse name native network node normal note notification number object offset option order output owner "
    "package page parameter parent parse password path payment permission person phone picture pixel player plugin point policy position prefix preview private process product profile program project property "
    "protocol provider public query queue random range record reference region register release remote remove render replace report repository request require resource response result return role root route row "
    "sample schedule schema screen script search section security select sequence server service session shared simple single size socket sort source space spring stack standard start state static status storage "
    "store stream string structure style submit subscription success summary support switch system table target task team template terminal test text theme thread ticket title token tool topic total trace track "
    "transaction transfer transform tree trigger type unique update upload user utility validate value variable vector vendor version video view virtual visible volume warning web widget window worker write zone"
)
#: A part of a run ends where its ratios have fallen by so much.
DROP = 10.0


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": regex_spans(text, ASSIGN, keep=lambda m: F.length(F.regexp_extract(m, ASSIGN_VALUE, 1)) >= 6),
        "access": regex_spans(text, ACCESS, needs="AKIA"),
        "hex": regex_spans(text, HEX),
    }


def _pairs(s: Column) -> Column:
    """Indexes of the character pairs; characters outside the printable ones give none."""
    chars = F.split(s, "")
    every = F.zip_with(chars, F.slice(chars, F.lit(2), F.length(s)), lambda a, b: (F.ascii(a) - FIRST) * SIZE + F.ascii(b) - FIRST)
    return F.when(F.length(s) >= 2, F.filter(every, lambda x: (x >= 0) & (x < SIZE * SIZE))).otherwise(F.array().cast("array<int>"))


def fit(docs: DataFrame, sample_docs: int = 2000, random_strings: int = 3000) -> list[float]:
    """SIZE * SIZE log-likelihood ratios, random against ordinary."""
    spark = docs.sparkSession
    every = max(1, docs.count() // sample_docs)
    text = docs.select("doc_id", text_or_empty().alias("text")).where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    digest = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    made = spark.range(random_strings).select(F.explode(F.array(
        F.sha2(F.col("id").cast("string"), 256),
        F.base64(digest),
        F.regexp_replace(F.base64(digest), "[^A-Za-z0-9]", ""),
        F.translate(F.regexp_replace(F.base64(digest), "=", ""), "+/", "-_"),
    )).alias("s"))
    found = text.select(F.explode(F.concat(*base_spans(F.col("text")).values())).alias("x")).select(F.regexp_extract("x.m", r"[A-Za-z0-9+/_-]+$", 0).alias("s"))
    plain = text.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?<![!-~])[A-Za-z_]{5,}(?![!-~])"), F.lit(0))).alias("s"))
    plain = plain.union(spark.range(100).select(F.explode(F.split(F.lit(WORDS), " "))))
    low = F.lower("s")
    # Words stand in identifiers in capitals, joined, and with a number behind.
    plain = plain.select(F.explode(F.array(F.col("s"), F.upper("s"), F.concat(low, F.initcap("s")), F.concat(low, F.length("s") % 10), *[F.concat(x, F.lit(c), x) for x in (low, F.upper("s")) for c in "/_-"], F.concat(F.upper("s"), F.lit("_"), F.length("s") % 10))).alias("s"))
    # At most 2 x SIZE x SIZE counts come to the driver.
    counts = (
        made.union(found).select(F.lit(1).alias("random"), "s").union(plain.select(F.lit(0), "s"))
        .select("random", F.explode(_pairs(F.col("s"))).alias("pair"))
        .groupBy("random", "pair").count().collect()
    )
    tables = [[1.0] * (SIZE * SIZE), [0.05] * (SIZE * SIZE)]
    for random, pair, n in counts:
        tables[random][pair] += n
    # Ordinary words know letters well; other characters keep a broad floor, so that paths stay ordinary.
    logs = []
    for t in tables:
        logs.append([math.log(t[i] / sum(t[i // SIZE * SIZE : (i // SIZE + 1) * SIZE])) for i in range(SIZE * SIZE)])
    return [round(min(r - o, MOST), 4) for o, r in zip(*logs, strict=True)]


def ratios(s: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of each pair of `s`, a run of printable characters; a null closes the array."""
    constant = F.from_json(F.lit("[" + ",".join(map(str, table)) + "]"), "array<double>")
    chars = F.split(s, "")
    return F.zip_with(chars, F.slice(chars, F.lit(2), F.length(s)), lambda a, b: F.when(b.isNotNull(), F.get(constant, (F.ascii(a) - FIRST) * SIZE + F.ascii(b) - FIRST)))


def random_parts(m: Column, table: list[float], least: float, least_per_pair: float) -> Column:
    """Parts (s, e) of the run `m` that the random model explains far better, by place.

    The pair ratios, less half of `least_per_pair` each, are summed from where they begin to rise; a part
    closes where the sum falls to 0 or by DROP from its best, and ends at its best. It counts if its ratios reach
    `least` and `least_per_pair`, and then stands for the words between separators that it touches. A run that does so as a
    whole is one part.
    """
    drift = least_per_pair / 2
    none = F.expr("cast(array() as array<struct<s:int,e:int>>)")
    start = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("total"), F.lit(0.0).alias("sum"), F.lit(0).alias("s"), F.lit(0.0).alias("best"), F.lit(0).alias("e"), none.alias("out"))

    def step(acc, v):
        fresh = acc["sum"] <= 0
        now = F.when(fresh, F.lit(0.0)).otherwise(acc["sum"]) + v - drift
        best = F.when(fresh, F.lit(0.0)).otherwise(acc["best"])
        closes = v.isNull() | (now <= 0) | (now < best - DROP)
        pairs = acc["e"] - acc["s"] - 1
        raw = acc["best"] + drift * pairs
        counts = closes & ~fresh & (raw >= least) & (raw >= least_per_pair * pairs)
        return F.struct(
            (acc["i"] + 1).alias("i"),
            (acc["total"] + F.coalesce(v, F.lit(0.0))).alias("total"),
            F.when(closes, F.lit(0.0)).otherwise(now).alias("sum"),
            F.when(fresh, acc["i"]).otherwise(acc["s"]).alias("s"),
            F.when(closes, F.lit(0.0)).otherwise(F.greatest(best, now)).alias("best"),
            F.when(fresh | (now > best), acc["i"] + 2).otherwise(acc["e"]).alias("e"),
            F.when(counts, F.array_append(acc["out"], F.struct(acc["s"].alias("s"), acc["e"].alias("e")))).otherwise(acc["out"]).alias("out"),
        )

    def finish(acc):
        whole = (acc["total"] >= least) & (acc["total"] >= least_per_pair * (F.length(m) - 1))
        # A part stands for all of the words, between separators, that it touches.
        def widened(index):
            found = lambda x: overlapping(index, x["s"], x["e"])
            return F.transform(acc["out"], lambda x: let(found(x), lambda w: F.struct(
                F.coalesce(F.get(w, F.lit(0))["s"], x["s"]).cast("int").alias("s"), F.coalesce(F.get(w, F.size(w) - 1)["e"], x["e"]).cast("int").alias("e"))))

        return F.when(whole, F.array(F.struct(F.lit(0).alias("s"), F.length(m).alias("e")))).when(F.size(acc["out"]) > 0, let(let(indexed(regex_spans(m, "[A-Za-z0-9+]++")), widened), lambda w: F.filter(w, lambda x, i: (i == 0) | (x != F.get(w, i - 1))))).otherwise(none)

    return F.aggregate(ratios(m, table), start, step, finish)


def random_spans(text: Column, table: list[float], least: float = 20.0, least_per_pair: float = 1.2) -> Column:
    """The parts of runs with a letter that the random model explains far better."""
    # A shorter run can't reach `least`, whatever its pairs, nor can one whose positive ratios don't.
    shortest = math.ceil(least / MOST) + 1
    could = lambda m: F.aggregate(ratios(m, table), F.lit(0.0), lambda acc, v: acc + F.greatest(v, F.lit(0.0))) >= least
    found = regex_spans(text, rf"(?<!{RUN}){RUN}{{{shortest},}}+", keep=lambda m: m.rlike("[A-Za-z]") & could(m))
    parts = lambda x: F.transform(
        random_parts(x["m"], table, least, least_per_pair),
        lambda y: F.struct((x["s"] + y["s"]).alias("s"), (x["s"] + y["e"]).alias("e")),
    )
    return F.flatten(F.transform(found, parts))


def find_secrets(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """_row (all of docs' columns), one array of spans for each kind as _kind, and _random: spans of the models that no pattern's span holds whole."""
    table = fit(docs) if table is None else table
    own = base_spans(F.col("_text"))
    base = docs.select(F.struct("*").alias("_row"), text_or_empty().alias("_text"))
    for k in KINDS:
        base = base.withColumn(f"_{k}", own[k])
    base = base.withColumn("_random", random_spans(F.col("_text"), table))
    taken = F.array_sort(F.concat(*[F.transform(F.col(f"_{k}"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in KINDS]))
    free = let(indexed(taken), lambda index: F.filter("_random", lambda x: ~F.exists(overlapping(index, x["s"], x["e"]), lambda y: (y["s"] <= x["s"]) & (y["e"] >= x["e"]))))
    return base.withColumn("_random", F.when((F.size("_random") > 0) & (F.size("_assign") + F.size("_access") + F.size("_hex") > 0), free).otherwise(F.col("_random")))


def all_spans() -> Column:
    """(s, kind number, e) of every span, by start, then kind."""
    return F.array_sort(F.concat(*[_ordered(i, k) for i, k in enumerate((*KINDS, "random"))]))


def _ordered(i: int, k: str) -> Column:
    return F.transform(F.col(f"_{k}"), lambda x: F.named_struct(F.lit("s"), x["s"], F.lit("k"), F.lit(i), F.lit("e"), x["e"]))


def redact(docs: DataFrame, mark: str = "<SECRET>", table: list[float] | None = None) -> DataFrame:
    """`docs` with every secret in `text` replaced by `mark`; overlapping spans are replaced as one."""
    found = find_secrets(docs, table)
    spans = all_spans()

    def step(acc, x, cut):
        # Text from the last end to this start, then the mark unless this span only continues the last.
        fresh = x["s"] >= acc["at"]
        gap = piece(cut, acc["at"], x["s"])
        return F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"),
            F.when(fresh, F.array_append(acc["out"], F.concat(gap, F.lit(mark)))).otherwise(acc["out"]).alias("out"),
        )

    rest = let(blocks(F.col("_text")), lambda cut: F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out")),
        lambda acc, x: step(acc, x, cut),
        lambda acc: F.concat(F.array_join(acc["out"], ""), piece(cut, acc["at"], F.length("_text"))),
    ))
    any_span = F.size("_assign") + F.size("_access") + F.size("_hex") + F.size("_random") > 0
    return found.select(*[F.when(any_span, rest).otherwise(F.col("_row.text")).alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    found = find_secrets(docs)
    names = F.array(*[F.lit(k) for k in (*KINDS, "random")])
    written = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    base = F.array_sort(F.concat(*[_ordered(i, k) for i, k in enumerate(KINDS)]))
    return found.select(
        "_row.doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(all_spans()).alias("spans"),
    )
