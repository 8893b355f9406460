"""Shards of equal numbers of documents, by balanced label propagation.

Rows begin in shards by a hash. In each round every link tells how many of its rows each shard holds; a row with links
wants the shard where its links have most other rows (ties: by a hash of the link, so that a link's rows agree). How
many rows want to go from one shard to another is a table of shards x shards numbers, from which the round's quotas
follow: what comes into a shard must be matched by what leaves it, rows with links that want to go, else rows
without any, and a shard that can't give enough takes only part of the links that want in, drawn by a hash. A shard
that has no room left is closed: a link larger than a shard fills the next one. Rounds end when few rows move. In
the end counts are made equal but for one, exactly: surplus rows leave, those without links first.

Only tables of shards x shards numbers come to the driver. Links are counted before they are shuffled, links of very many
rows (fewer than 1,000 by their definition) are broadcast, and exact places come from counts by bucket, whose number
grows with the rows, so that no task holds a shard.

Defined results: null text has size 1 and the empty text's checksum, and is linked with empty texts; null doc_id is a document;
repeated rows each have their place; other columns are ignored; very long texts are only hashed; an empty table gives an
empty result, fewer rows than shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .skew import lookup

#: Most rounds, the part of linked rows that still moves when rounds end, and the part of a shard that counts as no room.
ROUNDS, SETTLED, CLOSED = 12, 0.001, 0.01
#: What a shard may hold in rounds beyond its equal part, so that links can move where no row is free.
SLACK = 0.05
#: A link with more than this part of a shard is split where a shard takes only part of it.
LARGE = 0.2
DRAWS = 1_000_000
#: Rows of a bucket of `places`.
PER_BUCKET = 20_000


def places(rows: DataFrame, group: str, order: str, total: int) -> DataFrame:
    """`rows` with `place`, from 0 without gaps in each group, by the long `order` (ties by `id`, which is unique).

    Buckets are ranges of `order`, so a sum over the (small) table of their counts gives each one's first place.
    """
    buckets = max(1, -(-total // PER_BUCKET))
    # A double is exact enough: rounding keeps the order of `order`, so buckets stay ranges.
    bucket = F.floor(F.col(order).cast("double") / F.lit(2.0**64 / buckets)).cast("int")
    rows = rows.withColumn("_bucket", bucket)
    counts = rows.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(order, "id")) - 1)
    return ranked.join(before, [group, "_bucket"]).withColumn("place", F.col("_rank") + F.col("_before")).drop("_rank", "_before", "_bucket")


def quotas(wants: list[list[int]], counts: list[int], alone: list[int]) -> tuple[list[float], list[float], list[float]]:
    """(taken, pushed, room): the part of those that want into each shard that it takes; the part of its rows without links
    that it pushes out; and how many more of these each shard takes in.

    wants[i][j] rows with links want from i to j. A shard holds an equal part and SLACK at most, after its own leavers and all its rows
    without links have made way. Lower parts taken mean fewer leavers elsewhere, so parts only fall until they fit.
    """
    n, cap = len(counts), (1 + SLACK) * sum(counts) / len(counts)
    into = [sum(wants[i][j] for i in range(n)) for j in range(n)]
    taken = [1.0] * n
    for _ in range(50):
        out = [sum(taken[j] * wants[i][j] for j in range(n)) for i in range(n)]
        taken = [min(taken[j], max(0.0, (cap - counts[j] + out[j] + alone[j]) / into[j])) if into[j] else 1.0 for j in range(n)]
    out = [sum(taken[j] * wants[i][j] for j in range(n)) for i in range(n)]
    after = [counts[i] - out[i] + taken[i] * into[i] for i in range(n)]
    pushed = [min(1.0, max(0.0, after[i] - cap) / alone[i]) if alone[i] else 0.0 for i in range(n)]
    return taken, pushed, [max(0.0, cap - x) for x in after]


def _of(values: list, at: str):
    return F.get(F.array(*[F.lit(v) for v in values]), F.col(at))


def _draw(number: int, salt: str, by="id"):
    return F.pmod(F.xxhash64(by, F.lit(number), F.lit(salt)), F.lit(DRAWS)) / DRAWS


def _chosen(room: list[float], draw):
    """A shard by a draw from 0 to 1, each with chances as its room."""
    total, at, out = sum(room), 0.0, None
    for i, x in enumerate(room):
        at += x
        test = draw < F.lit(at / total)
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return out.otherwise(F.lit(max(range(len(room)), key=room.__getitem__)))


def _tally(held: DataFrame, shards: int) -> DataFrame:
    return held.groupBy("link").agg(F.array(*[F.sum((F.col("shard") == s).cast("long")) for s in range(shards)]).alias("tally"), F.count(F.lit(1)).alias("all"))


def propagated(rows: DataFrame, links: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """id, linked, shard for each row. rows: unique long `id`; links: `id` and long `link`, rows of one link belong together."""
    sizes = written(links.groupBy("link").agg(F.count(F.lit(1)).alias("all")).where("all > 1"), "shard-links")
    kept = written(lookup(links, sizes, "link", "all", F.col("id")), "shard-linked")
    first = F.pmod(F.xxhash64("id", F.lit("first")), F.lit(shards)).cast("int").alias("shard")
    alone = written(rows.select("id").join(kept.select("id"), "id", "left_anti").select("id"), "shard-alone").select("id", first)
    linked = kept.select("id").distinct().select("id", first)
    # Rows of a link go together or not at all, but for links that are a good part of a shard.
    most = LARGE * (linked.count() + alone.count()) / shards
    open_ = [True] * shards
    for number in range(rounds):
        held = kept.join(linked, "id")
        met = lookup(held, _tally(held, shards), "link", "all", F.col("id"))
        scores = met.groupBy("id").agg(F.min("shard").alias("shard"), F.min("link").alias("_link"), F.max(F.aggregate("tally", F.lit(0).cast("long"), lambda a, x: a + x)).alias("_size"), *[F.sum(F.get("tally", F.lit(s))).alias(f"_{s}") for s in range(shards)])
        # The shard with most rows of its links, its own ones among them; closed shards only for those that are there.
        offers = F.array(*[F.when(F.lit(open_[s]) | (F.col("shard") == s), F.struct(F.col(f"_{s}").alias("n"), F.xxhash64("_link", F.lit(s)).alias("tie"), F.lit(s).alias("s"))) for s in range(shards)])
        wanted = written(scores.select("id", "shard", F.array_max(offers)["s"].alias("want"), F.when(F.col("_size") > most, F.col("id")).otherwise(F.col("_link")).alias("drawn")), "shard-wants")
        wants, lone = [[0] * shards for _ in range(shards)], [0] * shards
        counts = [0] * shards
        for i, j, n in wanted.groupBy("shard", "want").count().collect():
            counts[i] += n
            wants[i][j] += n if i != j else 0
        for i, n in alone.groupBy("shard").count().collect():
            lone[i] = n
        total_linked, counts = sum(counts), [a + b for a, b in zip(counts, lone, strict=True)]
        taken, pushed, room = quotas(wants, counts, lone)
        moving = sum(taken[j] * wants[i][j] for i in range(shards) for j in range(shards))
        linked = wanted.select("id", F.when(_draw(number, "take", "drawn") < _of(taken, "want"), F.col("want")).otherwise(F.col("shard")).alias("shard"))
        if sum(room) > 0:
            alone = alone.select("id", F.when(_draw(number, "push") < _of(pushed, "shard"), _chosen(room, _draw(number, "to"))).otherwise(F.col("shard")).alias("shard"))
        least = CLOSED * sum(counts) / shards
        waiting = [sum((1 - taken[k]) * wants[j][k] for k in range(shards)) for j in range(shards)]
        now_open = [lone[j] * (1 - pushed[j]) + room[j] + waiting[j] > least for j in range(shards)]
        if moving <= SETTLED * total_linked and now_open == open_:
            break
        open_ = now_open
    return linked.withColumn("linked", F.lit(1)).unionByName(alone.withColumn("linked", F.lit(0)))


def balanced_shards(rows: DataFrame, links: DataFrame, shards: int = 8) -> DataFrame:
    """id, shard, slot for each row: counts of shards are at most one apart, slots run from 0 without gaps."""
    state = propagated(rows, links, shards)
    state = written(state.withColumn("key", F.xxhash64("id", F.lit("slot"))).withColumn("part", F.col("shard") * 2 + F.col("linked")), "shard-state")
    number = {r[0]: r[1] for r in state.groupBy("part").count().collect()}
    lone, counts = [number.get(2 * s, 0) for s in range(shards)], [number.get(2 * s, 0) + number.get(2 * s + 1, 0) for s in range(shards)]
    total = sum(counts)
    # The fullest shards take the odd rows.
    fullest = sorted(range(shards), key=lambda s: (-counts[s], s))[: total % shards]
    aims = [total // shards + (s in fullest) for s in range(shards)]
    surplus = [max(0, c - a) for c, a in zip(counts, aims, strict=True)]
    lacking = [max(0, a - c) for c, a in zip(counts, aims, strict=True)]
    starts = [sum(surplus[:s]) for s in range(shards)]
    ends = [sum(lacking[: s + 1]) for s in range(shards)]
    placed = places(state, "part", "key", total).withColumn("at", F.col("place") + F.when(F.col("linked") == 1, _of(lone, "shard")).otherwise(F.lit(0)))
    leaves, nth = F.col("at") < _of(surplus, "shard"), _of(starts, "shard") + F.col("at")
    to = F.coalesce(*[F.when(nth < e, F.lit(s)) for s, e in enumerate(ends)])
    moved = placed.withColumn("to", F.when(leaves, to).otherwise(F.col("shard"))).withColumn("nth", nth)
    slot = F.when(leaves, F.col("nth") - _of([e - n for e, n in zip(ends, lacking, strict=True)], "to") + _of(counts, "to")).otherwise(F.col("at") - _of(surplus, "shard"))
    return moved.select("id", F.col("to").cast("int").alias("shard"), slot.cast("long").alias("slot"))


def sized(docs: DataFrame) -> DataFrame:
    """id, doc_id, size, text_crc32, link of each document; link is the same for equal texts."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    return docs.select(F.monotonically_increasing_id().alias("id"), F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("link"))


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    rows = written(sized(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), "shard-rows")
    found = balanced_shards(rows.select("id"), rows.select("id", "link"))
    out = rows.join(found, "id")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
