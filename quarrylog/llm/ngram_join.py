"""Jaccard join of word-shingle sets by T-occurrence search (DivideSkip).

1. Each text becomes its set of 64-bit shingle hashes. A 32-bit part of every hash goes to a bucket, which
   sends back, for each document, how many of its hashes no other document has. Two sets n >= m that link share at
   least ceil(t n) hashes, so a document with more than n - ceil(t n) of its own can't link and drops out
   here: most of a corpus does. Clashes of these parts only keep a document that could have gone.
2. The other documents' sets, one of each content, are written once. Their hashes are counted exactly. In a set
   ordered by that number, rarest first, two sets that link must share one of the first n - ceil(t n) + 1; hashes
   of one document fill that prefix without costing anything. Sets of compatible size that share a hash of
   their prefixes are tied; the components of these ties are blocks.
3. Inside a block, DivideSkip: for each set, short inverted lists are merged by counting, its longest lists are
   probed by binary search, and sets that reach the required overlap link. Pairs within a component that is
   already known are skipped, so a group of copies costs a forest, not all its pairs.
4. A block of more than PART_HASHES hashes is dealt into parts by size class and hash. Each part is solved
   together with one pivot of its class and of the class below; only sets that are then outside the block's largest
   component meet all parts. So a large group of near copies costs what its size is, and no link is lost.

Two sets n, m with overlap o link when 100 o >= threshold (n + m - o). Hash collisions (64 bits) are the
only way to differ from exact.

Defined results: texts without words, and null texts, have an empty set and link with nothing; with fewer
words than the shingle's size the whole sequence is one shingle; repeated rows stay, and link; rows with null
doc_id link by their text and don't count for the smallest id (a group of only such has null); very long
texts are hashed in steps of bounded size; other columns are ignored or, in `keep_one`, kept, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_keys, discard, portions, row_keys, small_batches, text_or_empty, tidy, written
from .components import components
from .shingles import shingle_sets

#: Hashes that a chunk of documents posts at once, buckets for each shuffle partition, hashes of a block's part.
CHUNK_HASHES, FINE, PART_HASHES = 500_000, 8, 500_000
POSTED = "bucket int, chunk long, doc_id array<long>, k1 array<long>, k2 array<long>, n array<long>, rep array<long>, digest binary, owners binary, data binary"
NAMES = [x.split()[0] for x in POSTED.split(", ")]
LONGS = pa.list_(pa.int64())
TYPES = [pa.int32(), pa.int64(), LONGS, LONGS, LONGS, LONGS, LONGS, pa.binary(), pa.binary(), pa.binary()]


def prefix_length(n, threshold: int):
    return n - -(-threshold * n // 100) + 1


def _texts(docs: DataFrame) -> DataFrame:
    d = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return d.select("doc_id", *row_keys(), "text")


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _posted(texts: DataFrame, size: int, buckets: int) -> DataFrame:
    """For each chunk of documents a row of these (bucket under 0), and one for each bucket: 32 bits of the
    hashes (`data`) and which of the chunk's documents has them (`owners`)."""

    def run(batches):
        tidy()
        part, number = TaskContext.get().partitionId(), 0
        rows, sets, seen, held = [], [], {}, 0

        def closed():
            nonlocal number, held, rows, sets, seen
            chunk = part << 32 | number
            doc_id, k1, k2, n, rep, digest = zip(*rows, strict=True)
            yield _row([-1 - number % buckets], [chunk], [doc_id], [k1], [k2], [n], [rep], [b"".join(digest)], [None], [None])
            owner = np.array([i for i, _ in sets], np.uint32)
            h = np.concatenate([s for _, s in sets]) if sets else np.array([], np.uint64)
            owner = np.repeat(owner, [len(s) for _, s in sets])
            bucket = ((h & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 65536 else np.uint32)
            order = np.argsort(bucket, kind="stable")
            data, owner, cut = (h[order] >> np.uint64(32)).astype("<u4"), owner[order], np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            full = [b for b in range(buckets) if cut[b] < cut[b + 1]]
            small = owner.astype("<u2") if len(rows) <= 65536 else owner
            none = [None] * len(full)
            for at in range(0, len(full), 512):
                f = full[at : at + 512]
                yield _row(f, [chunk] * len(f), *[none[: len(f)]] * 6, [small[cut[b] : cut[b + 1]].tobytes() for b in f], [data[cut[b] : cut[b + 1]].tobytes() for b in f])
            number, held, rows, sets, seen = number + 1, 0, [], [], {}

        for b in batches:
            ids, k1, k2, texts_ = (c.to_pylist() for c in b.columns)
            for begin, end in portions(texts_):
                for i, s in zip(range(begin, end), shingle_sets(texts_[begin:end], size), strict=True):
                    digest = _digest(s)
                    rep = seen.setdefault(digest, len(rows))
                    if rep == len(rows) and len(s):
                        sets.append((rep, s))
                        held += len(s)
                    rows.append((ids[i], k1[i], k2[i], len(s), rep, digest))
                if held >= CHUNK_HASHES or len(rows) >= 60_000:
                    yield from closed()
        if rows:
            yield from closed()

    return texts.mapInArrow(run, POSTED)


def _row(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], names=NAMES)


def _singles(posted: DataFrame) -> DataFrame:
    """Instead of the hashes of (bucket, chunk): how many of each document's no other document has (`owners`, `data`)."""

    def solved(pieces):
        h = np.concatenate([p[2] for p in pieces])
        order = np.argsort(h, kind="stable")
        sorted_h = h[order]
        edge = np.concatenate(([True], sorted_h[1:] != sorted_h[:-1], [True]))
        single = np.zeros(len(h), bool)
        single[order] = edge[:-1] & edge[1:]
        at, out = 0, []
        for chunk, owners, data in pieces:
            own, n = np.unique(owners[single[at : at + len(data)]], return_counts=True)
            at += len(data)
            if len(own):
                out.append((chunk, own.astype("<u4").tobytes(), n.astype("<u4").tobytes()))
        none = [None] * len(out)
        return _row([0] * len(out), [x[0] for x in out], *[none] * 6, [x[1] for x in out], [x[2] for x in out])

    def run(batches):
        now, pieces = None, []
        for b in batches:
            bucket = b.column(0).to_numpy()
            documents = b.filter(pa.array(bucket < 0))
            if documents.num_rows:
                yield documents
            b = b.filter(pa.array(bucket >= 0))
            for k, chunk, owners, data in zip(*(b.column(c).to_pylist() for c in ("bucket", "chunk", "owners", "data")), strict=True):
                if k != now and pieces:
                    yield solved(pieces)
                    pieces = []
                now = k
                data = np.frombuffer(data, "<u4")
                pieces.append((chunk, np.frombuffer(owners, "<u2" if len(owners) < 4 * len(data) else "<u4"), data))
        if pieces:
            yield solved(pieces)

    return posted.mapInArrow(run, POSTED)


def _known(counted: DataFrame, threshold: int) -> DataFrame:
    """One row a document; `able` if it doesn't have too many hashes of its own. Sorted by (chunk, bucket)."""
    names = ["doc_id", "k1", "k2", "n", "digest", "able"]

    def run(batches):
        documents, singles = None, None

        def closed():
            ids, k1, k2, n, rep, digest = documents
            able = (n > 0) & (prefix_length(n, threshold) > singles[rep])
            return pa.RecordBatch.from_arrays([ids, k1, k2, pa.array(n), pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(n), [None, pa.py_buffer(digest)]).cast(pa.binary()), pa.array(able)], names=names)

        for b in batches:
            for i in range(b.num_rows):
                if b.column("digest")[i].is_valid:
                    if documents is not None:
                        yield closed()
                    ids, k1, k2, n, rep = (b.column(c)[i].values for c in NAMES[2:7])
                    documents = ids, k1, k2, n.to_numpy(), rep.to_numpy(), b.column("digest")[i].as_py()
                    singles = np.zeros(len(n), np.int64)
                else:
                    owners = np.frombuffer(b.column("owners")[i].as_py(), "<u4")
                    singles[owners] += np.frombuffer(b.column("data")[i].as_py(), "<u4")
        if documents is not None:
            yield closed()

    return counted.mapInArrow(run, "doc_id long, k1 long, k2 long, n long, digest binary, able boolean")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """digest, n, hashes of each text; a content that a task has met lately only once."""

    def run(batches):
        tidy()
        seen: dict[bytes, None] = {}
        for b in batches:
            texts_ = b.column(0).to_pylist()
            for begin, end in portions(texts_):
                out = []
                for s in shingle_sets(texts_[begin:end], size):
                    digest = _digest(s)
                    if len(s) and digest not in seen:
                        if len(seen) >= 100_000:
                            seen.clear()
                        seen[digest] = None
                        out.append((digest, s))
                offsets = np.cumsum([0] + [len(s) for _, s in out]).astype(np.int32)
                flat = np.concatenate([s for _, s in out]).view(np.int64) if out else np.array([], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.binary()), pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["digest", "n", "hashes"])

    return texts.select("text").mapInArrow(run, "digest binary, n long, hashes array<long>")


class Block:
    """DivideSkip over sets in ascending order of size; `sides` are bits, and only pairs that have both are looked at."""

    def __init__(self, sets: list[np.ndarray], threshold: int, sides: list[int]):
        self.sets, self.threshold, self.sides = sets, threshold, np.array(sides)
        self.n = np.array([len(s) for s in sets])
        self.label = np.arange(len(sets))
        self.members = [[i] for i in range(len(sets))]
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owner = tokens[order], owner[order]
        self.first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        self.keys = tokens[self.first]
        self.end = np.append(self.first[1:], len(tokens))

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.label[self.members[b]] = a
        self.members[a] += self.members[b]
        self.members[b] = []

    def links(self):
        """A forest of links: (i, j) whose sets link and that were not connected before."""
        t = self.threshold
        for i in range(len(self.sets)):
            n = int(self.n[i])
            at = np.searchsorted(self.keys, self.sets[i])
            begin, end = self.first[at], self.end[at]
            order = np.argsort(end - begin, kind="stable")
            begin, end = begin[order], end[order]
            need = -(-t * n // 100)  # the least overlap with any set that can link
            # The longest need - 1 lists can be left to probing: a set in none of the others misses `need`.
            short = len(at) - (need - 1)
            while short < len(at) and end[short] - begin[short] <= 2:
                short += 1
            size = end[:short] - begin[:short]
            where = np.repeat(begin[:short] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            found, count = np.unique(self.owner[where], return_counts=True)
            keep = (found > i) & (count >= need - (len(at) - short)) & (self.label[found] != self.label[i]) & ((self.sides[found] | self.sides[i]) == 3)
            keep &= 100 * np.minimum(self.n[found], n) >= t * np.maximum(self.n[found], n)
            found, count = found[keep], count[keep]
            if not len(found):
                continue
            m = self.n[found]
            least = -(-t * (n + m) // (100 + t))
            # Probe the long lists for all candidates at once, or merge them too where that is less work.
            lists = list(zip(begin[short:].tolist(), end[short:].tolist(), strict=True))
            if sum(e - b for b, e in lists) < 3000 * len(lists):
                count = count + self._merged(lists)[found]
            else:
                for left, (b, e) in zip(range(len(lists), 0, -1), lists, strict=True):
                    able = count + left >= least
                    if not able.all():
                        found, count, least = found[able], count[able], least[able]
                    if not len(found):
                        break
                    own = self.owner[b:e]
                    p = np.minimum(np.searchsorted(own, found), e - b - 1)
                    count = count + (own[p] == found)
            for j in found[count >= least].tolist():
                if self.label[j] != self.label[i]:
                    self.join(i, j)
                    yield i, j

    def _merged(self, lists: list[tuple[int, int]]) -> np.ndarray:
        """How many of the lists hold each set."""
        if not lists:
            return np.zeros(len(self.sets), np.int64)
        return np.bincount(np.concatenate([self.owner[b:e] for b, e in lists]), minlength=len(self.sets))


def _links(cells: DataFrame, threshold: int) -> DataFrame:
    """cells: block, cell, side, id, hashes. Returns links a, b: a forest for each cell."""
    laid = cells.repartition("block", "cell").sortWithinPartitions("block", "cell", F.size("hashes"), "id").select(F.concat_ws("/", "block", "cell").alias("cell"), "side", "id", "hashes")

    def rows(batches):
        for b in batches:
            hashes = b.column(3)
            yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), (hashes[i].values.to_numpy().view(np.uint64) for i in range(len(hashes))), strict=True)

    def run(batches):
        tidy()
        found = []
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            sides: dict[int, int] = {}
            sets = []
            for _, side, i, s in group:
                if i not in sides:
                    sets.append(s)
                sides[i] = sides.get(i, 0) | side
            ids = list(sides)
            if len(sets) > 1:
                found += [(ids[i], ids[j]) for i, j in Block(sets, threshold, list(sides.values())).links()]
            if len(found) > 10_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    return laid.mapInArrow(run, "a long, b long")


def _pairs(found):
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["a", "b"])


def _ties(sets: DataFrame, threshold: int) -> DataFrame:
    """a, b: sets that share a rare hash, so that any two that can link are connected."""
    postings = sets.select("id", "n", F.explode("hashes").alias("hash"))
    shared = postings.groupBy("hash").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    prefix = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") / 100) + 1
    rare = postings.join(shared, "hash").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "hash"))).alias("hashes")).withColumn("left", (prefix - (F.col("n") - F.size("hashes"))).cast("int"))
    # Sets that can link are of one size class or of neighbouring ones.
    lists = rare.where("left > 0").select("id", F.floor(F.log("n") / math.log(100 / threshold) + 1e-9).alias("class") if threshold < 100 else F.col("n").alias("class"), F.explode(F.slice("hashes.hash", 1, F.col("left"))).alias("hash"))
    lists = written(lists, "ngram-lists")
    first = lists.groupBy("hash", "class").agg(F.min("id").alias("a"))
    within = lists.join(first, ["hash", "class"]).select("a", F.col("id").alias("b"))
    across = first.join(first.select("hash", (F.col("class") - 1).alias("class"), F.col("a").alias("b")), ["hash", "class"]).select("a", "b")
    return within.union(across).where("a <> b")


def _roots(sets: DataFrame, threshold: int) -> DataFrame:
    """id, root for sets that link with others; root is the smallest id of the component."""
    blocks = written(components(_ties(sets, threshold), "ngram-ties").withColumnRenamed("root", "block"), "ngram-blocks")
    classed = blocks.join(sets.select("id", "n"), "id").withColumn("class", F.floor(F.log("n") / math.log(100 / threshold) + 1e-9) if threshold < 100 else F.col("n"))
    by_class = classed.groupBy("block", "class").agg(F.sum("n").alias("hashes"), F.min("id").alias("pivot"))
    large = by_class.groupBy("block").agg(F.sum("hashes").alias("total")).where(F.col("total") > PART_HASHES).select("block")
    by_class = written(by_class.join(large, "block"), "ngram-large")
    shown = sets.select("id", "hashes")
    in_large = by_class.select("block").distinct()
    small = blocks.join(in_large, "block", "left_anti").select("block", F.lit("").alias("cell"), F.lit(3).alias("side"), "id").join(shown, "id")
    links = written(_links(small, threshold), "ngram-links")
    if by_class.isEmpty():
        return components(links, "ngram-roots")
    dealt = lambda d, n, most: d.withColumn("parts", F.ceil(F.col(n) / most).cast("int")).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    parts = written(dealt(classed.join(by_class.select("block", "class", "hashes"), ["block", "class"]), "hashes", PART_HASHES).select("block", "class", "part", "parts", "id", "n"), "ngram-parts")
    own = parts.select("block", F.concat_ws(":", "class", "part").alias("cell"), "id")
    pivots = by_class.select("block", "pivot", F.explode(F.array("class", F.col("class") + 1)).alias("class")).join(parts.select("block", "class", "part").distinct(), ["block", "class"])
    first = own.union(pivots.select("block", F.concat_ws(":", "class", "part").alias("cell"), F.col("pivot").alias("id"))).distinct()
    inside = written(_links(first.withColumn("side", F.lit(3)).join(shown, "id"), threshold), "ngram-inside")
    joined = written(components(inside, "ngram-inside-roots"), "ngram-inside-roots")
    placed = parts.join(joined, "id", "left").withColumn("root", F.coalesce("root", "id"))
    main = placed.groupBy("block", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("block").agg(F.max(F.struct("size", "root"))["root"].alias("main"))
    rest = placed.join(main, "block").where("root <> main").select("block", "class", "id", "n")
    totals = rest.groupBy("block", "class").agg(F.sum("n").alias("rest"))
    rest = written(dealt(rest.join(totals, ["block", "class"]), "rest", PART_HASHES).select("block", "class", "part", "parts", "id"), "ngram-rest")
    kinds = lambda d: d.select("block", "class", "part").distinct()
    meets = (
        kinds(rest).select("block", F.col("class").alias("c"), F.col("part").alias("p"), F.explode(F.array(F.col("class") - 1, "class", F.col("class") + 1)).alias("class"))
        .join(kinds(parts).withColumnRenamed("part", "q"), ["block", "class"]).withColumn("cell", F.concat_ws(":", "c", "p", "class", "q"))
    )
    one = rest.join(meets.select("block", F.col("c").alias("class"), F.col("p").alias("part"), "cell"), ["block", "class", "part"]).select("block", "cell", F.lit(1).alias("side"), "id")
    two = parts.join(meets.select("block", "class", F.col("q").alias("part"), "cell"), ["block", "class", "part"]).select("block", "cell", F.lit(2).alias("side"), "id")
    across = written(_links(one.union(two).join(shown, "id"), threshold), "ngram-across")
    return components(links.union(inside).union(across), "ngram-roots")


def ngram_components(docs: DataFrame, size: int = 4, threshold: int = 85) -> DataFrame:
    """doc_id, k1, k2 (key of doc_id and text), n_shingles, component_id and group for every row of docs.

    `group` is the smallest content digest of the component, null for texts without words.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _texts(docs)
    with small_batches(spark):
        posted = _posted(texts, size, FINE * partitions).repartition(partitions, "bucket").sortWithinPartitions("bucket", "chunk")
        counted = _singles(posted).repartition(partitions, "chunk").sortWithinPartitions("chunk", F.isnull("digest"))
        known = written(_known(counted, threshold), "ngram-known")
        able = by_keys(texts, known.where("able").select("k1").distinct(), ["k1"], "left_semi")
        sets = _sets(able, size).groupBy("digest").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes"))
        # Numbered as they are written, so that a set has one number ever after.
        sets = written(sets.withColumn("id", F.monotonically_increasing_id()), "ngram-sets")
        roots = written(_roots(sets, threshold), "ngram-roots")
    # Contents get their component's names: the smallest doc_id of all its rows, the smallest digest.
    contents = known.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
    linked = contents.join(roots.join(sets.select("id", "digest"), "id").select("digest", "root"), "digest")
    names = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.min("digest").alias("group")), "root").select("digest", "component_id", "group")
    named = contents.join(names, "digest", "left").select("digest", F.when(F.col("group").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("group", "digest").alias("group"))
    named = written(named, "ngram-named")
    discard(sets)
    return known.join(named, "digest", "left").select(
        "doc_id", "k1", "k2", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "group"
    )


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id (null last); of rows that share it, any one."""
    found = written(ngram_components(docs, size, threshold).where("group is not null").select("group", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), "k1", "k2"), "ngram-found")
    best = found.groupBy("group").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("best"))
    gone = written(found.join(best, "group").where(F.struct("doc_id", "k1", "k2") != F.col("best")).select("k1", "k2").distinct(), "ngram-gone")
    again = written(found.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2").join(gone, ["k1", "k2"], "left_anti"), "ngram-again")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long"), text_or_empty().alias("text")).select("_row", *row_keys())
    kept = by_keys(rows, gone.union(again), ["k1", "k2"], "left_anti")
    if not again.isEmpty():  # rows of equal doc_id and text
        kept = kept.unionByName(by_keys(rows, again, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]))
    return kept.select("_row.*")
