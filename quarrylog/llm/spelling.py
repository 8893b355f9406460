"""Spelling variants: pairs of words one edit apart, by an errata trie over heavy paths.

Each node of the words' trie has one heavy child, the one with most words below it. A word leaves heavy paths at
its light edges only, at most log2(words) of them, since every light edge halves the words below. There, and only
there, it is moved (small to large): its rest is merged into the node with the edge's character skipped, into the
heavy subtree with the character replaced by the heavy one or with the heavy one put in, and into the node's
wildcard subtree, where light subtrees meet each other. Terminals that coincide are a pair one edit apart:

* two words that differ in one character part at one node; if one of them goes on heavily, the other one's
  replaced form is it, otherwise both are in the node's wildcard subtree with the same rest;
* of a word and a longer one, the longer one's extra character stands at the end of its run of equal characters;
  where they part, the extra one is light (skipped there) or heavy (put into the shorter one, which is light there
  or ends there).

So every pair is found once, whatever child is called heavy: that choice bounds the work, not the result. Nodes are
known by a rolling hash of their prefix, so that a word of any length has linear cost, and a hash that two nodes
share does no harm. Skipped, replaced and put-in forms meet the words by an equi-join; a wildcard group has at most
one word for each character of the alphabet and is summed up as it is, without its pairs.

Defined results: null and empty texts have no words; a null doc_id counts as an empty name in the hash; repeated rows count
each; very long texts are read match by match; other columns are ignored; no words give an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .skew import lookup

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Of each so many (document, word) pairs, one loses a character.
DAMAGED = 97
#: Distinct words that a task holds before it hands their counts on, characters of texts read at once.
HELD, AT_ONCE = 200_000, 1 << 20
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
END = -1


def damaged_word(name: str, word: str) -> str:
    """The word as document `name` spells it."""
    return _spelt(zlib.crc32(f"{name}:".encode()), word)


def _spelt(prefix: int, word: str) -> str:
    h = zlib.crc32(word.encode(), prefix)
    if h % DAMAGED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _runs(text: str):
    """Counts of a text's runs, in portions of bounded size."""
    if len(text) <= AT_ONCE:
        yield Counter(RUN.findall(text))
        return
    found = Counter()
    for m in RUN.finditer(text):
        found[m[0]] += 1
        if len(found) >= HELD:
            yield found
            found = Counter()
    yield found


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over all texts; docs has doc_id and text."""

    def run(batches):
        held = Counter()

        def put():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for i in range(b.num_rows):
                name, text = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                prefix = zlib.crc32(f"{'' if name is None else name}:".encode())
                for found in _runs(text or ""):
                    for run_, n in found.items():
                        word = _spelt(prefix, run_.translate(LOWER))
                        if len(word) >= LEAST_LENGTH:
                            held[word] += n
                    if len(held) >= HELD:
                        yield put()
                        held = Counter()
        if held:
            yield put()

    own = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return own.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _edges(words: DataFrame) -> DataFrame:
    """id, k, node, c for each node on each word's path: c is the next character, END at the word's end."""

    def run(batches):
        for whole in batches:
            for b in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                texts = b.column(1).to_pylist()
                sizes = np.array([len(t) for t in texts], np.int64)
                letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
                begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
                ids = b.column(0).to_numpy()
                node, alive = np.zeros(len(texts), np.uint64), np.arange(len(texts))
                out, k, waiting = [], 0, 0
                while len(alive):
                    more = sizes[alive] > k
                    at = np.where(more, begin[alive] + k, 0)
                    c = np.where(more, letters[at] if len(letters) else END, END)
                    out.append((ids[alive], np.full(len(alive), k), node[alive].view(np.int64), c))
                    waiting += len(alive)
                    alive = alive[more]
                    node[alive] = node[alive] * MULTIPLIER + c[more].astype(np.uint64) + np.uint64(1)
                    k += 1
                    if waiting >= 20_000 or not len(alive):
                        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1].astype(np.int32)), pa.array(columns[2], pa.int64()), pa.array(columns[3].astype(np.int32))], names=["id", "k", "node", "c"])
                        out, waiting = [], 0

    return words.select("id", "word").mapInArrow(run, "id bigint, k int, node bigint, c int")


def _moved(words: DataFrame) -> DataFrame:
    """kind, key, word, n for each light edge: kind -1 is a form to look up, k >= 0 a wildcard at character k."""
    edges = _edges(words)
    child = edges.groupBy("node", "c").agg(F.count(F.lit(1)).alias("m"))
    heavy = child.groupBy("node").agg(F.max(F.when(F.col("c") >= 0, F.struct("m", (-F.col("c")).alias("c")))).alias("top"), F.count(F.lit(1)).alias("ways"), F.sum("m").alias("all")).where("ways > 1 AND top IS NOT NULL")
    heavy = written(heavy.select("node", (-F.col("top.c")).alias("heavy"), "all"), "spelling-heavy")
    light = lookup(edges, heavy, "node", "all", F.xxhash64("id", "k")).where("c <> heavy")
    paths = light.groupBy("id").agg(F.collect_list(F.struct("k", "heavy")).alias("light"))

    def run(batches):
        for whole in batches:
            for b in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                kinds, keys, movers, counts = [], [], [], []
                for word, n, light in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                    for edge in light:
                        k, put = edge["k"], chr(edge["heavy"])
                        front, c, rest = word[:k], word[k : k + 1], word[k + 1 :]
                        forms = [front + put + c + rest]
                        if c:
                            forms.append(front + put + rest)
                            if rest[:1] != c:
                                forms.append(front + rest)
                            kinds.append(k)
                            keys.append(front + rest)
                        kinds += [-1] * len(forms)
                        keys += forms
                        movers += [word] * (len(forms) + bool(c))
                        counts += [n] * (len(forms) + bool(c))
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.string()), pa.array(movers, pa.string()), pa.array(counts, pa.int64())], names=["kind", "key", "word", "n"])

    return words.join(paths, "id").select("word", "n", "light").mapInArrow(run, "kind int, key string, word string, n bigint")


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best (n, word) for each word with others one edit away; words has word and n, each word once."""
    words = written(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    moved = written(_moved(words), "spelling-moved")
    known = words.select(F.col("word").alias("key"), F.col("n").alias("m"))
    pairs = moved.where("kind < 0").join(known, "key")
    # Of largest n, the least word: as (-n, word) the least pair.
    side = lambda own, n, other: pairs.select(F.col(own).alias("word"), F.lit(1).cast("long").alias("near"), F.struct((-F.col(n)).alias("n"), F.col(other).alias("word")).alias("best"))
    groups = moved.where("kind >= 0").groupBy("kind", "key").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))).alias("all")).where("size(all) > 1")
    each = groups.select("all", F.posexplode("all").alias("at", "own")).select(F.col("own.word").alias("word"), (F.size("all") - 1).cast("long").alias("near"), F.expr("CASE WHEN at = 0 THEN all[1] ELSE all[0] END").alias("best"))
    found = side("word", "m", "key").unionByName(side("key", "n", "word")).unionByName(each)
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")).select("word", "n_near", F.struct((-F.col("best.n")).alias("n"), F.col("best.word").alias("word")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for word -> form: forms followed to the last one by doubling, so in log2 of the longest way."""
    ahead, done = written(forms.select("word", F.col("form").alias("root")), "spelling-roots"), None
    while True:
        known = ahead if done is None else ahead.unionByName(done)
        met = written(ahead.join(known.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", "root", "next"), "spelling-roots")
        last = met.where("next IS NULL").select("word", "root")
        done = last if done is None else done.unionByName(last)
        ahead = met.where("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if ahead.isEmpty():
            return done


def variants(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root for a table of words with their counts."""
    words = written(words, "spelling-counts")
    near = near_words(words)
    out = words.join(near, "word", "left").withColumn("fits", F.col("best.n") >= RATIO * F.col("n"))
    out = written(out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("fits"), F.col("best.word")).alias("form"), F.when(F.col("fits"), F.col("best.n")).alias("form_n")), "spelling-forms")
    last = roots(out.where("form IS NOT NULL").select("word", "form"))
    return out.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return variants(word_counts(docs)).select("word", "form", "root", "n", "n_near", "form_n")
