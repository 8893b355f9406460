"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

Kernel: strings are compared by their letter triples, gaps allowed: a triple spanning n characters weighs
DECAY ** n, up to SPAN characters, and a word's start counts as a letter; so `idiot`, `i-d-i-o-t` and
`idxiot` stay close. Landmarks are strings out of the labelled texts, chosen one after the other: each
time the string that occurs in the most toxic words no landmark occurs in, among those that toxic texts have
far oftener than others. A text's features are, for each landmark, the highest kernel value over all its
words relative to the landmark's own (values under FLOOR count as none), mapped by the inverse root of the
landmarks' kernel matrix (Nyström). A linear SVM on them, squared hinge, is fitted by Newton steps; a logistic
curve through its margins gives scores from 0 to 1.

Fit: in one task, from at most `max_labelled` labelled rows, taken by the order of a hash of doc_id; the telling
words of toxic rows are given as examples of their own too, plain and with separators or letters put in.
Scoring: one pass over all texts; a worker keeps a bounded table of the words it has met.

Defined results: null and empty texts have no words and get the score of the bias; repeated rows each give a
row; labels with null are left out, of several labels of a doc_id the highest counts; without labels
of both kinds, or without telling strings, every score is 0; other columns are ignored or, in `drop_toxic`,
kept; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, text_or_empty

DECAY, SPAN, FLOOR = 0.7, 5, 0.5
OFFSETS = [(i, j) for i in range(1, SPAN - 1) for j in range(1, SPAN - i)]
LONGEST, OVERLAP = 40, 8
EDGES = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"
SEPARATORS = dict.fromkeys(map(ord, "-._*~`|/\\"))
START, BASE = 27, 64
SPACED = re.compile(r"(?<!\S)(?:\S[ ]){2,}\S(?!\S)")


def _codes() -> np.ndarray:
    """Character -> code below BASE: a to z, small Latin-1 letters, the start mark; 0 for what is no letter.

    Digits and signs that stand for letters count as these; all other letters share three codes.
    """
    out = np.zeros(0x3000, np.int32)
    for c in range(0x100, 0x3000):
        if chr(c).isalpha():
            out[c] = 61 + c % 3
    for i, c in enumerate(range(0xDF, 0x100)):
        out[c] = 28 + i
    for c in range(ord("a"), ord("z") + 1):
        out[c] = c - 96
    for sign, letter in zip("013457@$!", "oieastasi", strict=True):
        out[ord(sign)] = ord(letter) - 96
    out[ord("^")] = START
    return out


CODES = _codes()
WORD_TABLE = 200_000
TRIPLES = BASE**3


def words_of(text: str | None) -> set[str]:
    text = (text or "").lower()
    found = set(text.split())
    for run in SPACED.findall(text):
        found.add(run.replace(" ", ""))
    return found


def trimmed(word: str) -> str:
    """The word as it is compared: its start marked, no signs around it and no separators inside."""
    return "^" + word.strip(EDGES).translate(SEPARATORS)


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each word's parts, and the number of the word of each part; long words are cut with overlap."""
    parts, owner = [], []
    for i, w in enumerate(words):
        if len(w) <= LONGEST:
            parts.append(w)
            owner.append(i)
        else:
            for at in range(0, len(w) - OVERLAP, LONGEST - OVERLAP):
                parts.append(w[at : at + LONGEST])
                owner.append(i)
    wide = max(map(len, parts), default=1) or 1
    raw = np.array(parts, f"U{wide}").view(np.uint32).reshape(len(parts), wide)
    return CODES[np.where(raw < len(CODES), raw, 0x2FFF if CODES[0x2FFF] else 0x101)] * (raw > 0), np.array(owner, np.int64)


def triples(codes: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, triple (or its number in `wanted`, where that isn't 0) and weight of all occurrences, by row."""
    wide = codes.shape[1]
    rows, keys, weights = [], [], []
    for i, j in OFFSETS:
        if wide <= i + j:
            continue
        a, b, c = codes[:, : wide - i - j], codes[:, i : wide - j], codes[:, i + j :]
        key = (a * BASE + b) * BASE + c
        key = np.where((a > 0) & (b > 0) & (c > 0), key, 0)
        if wanted is not None:
            key = wanted[key]
        r, k = np.nonzero(key)
        rows.append(r)
        keys.append(key[r, k])
        weights.append(np.full(len(r), DECAY ** (i + j + 1), np.float32))
    if not rows:
        return np.array([], np.int64), np.array([], np.int64), np.array([], np.float32)
    rows = np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return rows[order], np.concatenate(keys)[order], np.concatenate(weights)[order]


@dataclass
class Model:
    """wanted: triple -> its row in landmarks (0: none); weights, bias: the SVM; slope, shift: the logistic curve."""

    wanted: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def kernel(self, words: list[str]) -> np.ndarray:
        """words x landmarks: kernel value over the landmark's own, at most 1; from FLOOR on stretched to 0 to 1."""
        out = np.zeros((len(words), self.landmarks.shape[1]), np.float32)
        for at in range(0, len(words), 4000):
            codes, owner = codes_of(words[at : at + 4000])
            row, key, weight = triples(codes, self.wanted)
            if len(row):
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                k = np.minimum(np.add.reduceat(self.landmarks[key] * weight[:, None], first), 1)
                k = np.maximum(k - FLOOR, 0) / (1 - FLOOR)
                np.maximum.at(out, at + owner[row[first]], k)
        return out

    def margins(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.weights + self.bias

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(pooled) + self.shift, -30, 30)))


class Pooler:
    """Highest kernel values of texts, by a bounded table of words met before."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.table: dict[str, int] = {}
        self.stacked, self.n = np.zeros((1024, self.model.landmarks.shape[1]), np.float32), 1

    def pool(self, texts: list[str | None]) -> np.ndarray:
        sets = [words_of(t) for t in texts]
        new = set().union(*sets).difference(self.table)
        if len(self.table) + len(new) > WORD_TABLE:
            self.clear()
            new = set().union(*sets)
        if new:
            new = list(new)
            k = self.model.kernel([trimmed(w) for w in new])
            hit = k.any(axis=1)
            ids = np.zeros(len(new), np.int64)
            ids[hit] = np.arange(self.n, self.n + hit.sum())
            before, self.n = self.n, self.n + int(hit.sum())
            self.table.update(zip(new, ids.tolist(), strict=True))
            if self.n > len(self.stacked):
                self.stacked = np.vstack([self.stacked[:before], np.zeros((self.n, self.stacked.shape[1]), np.float32)])
            self.stacked[before : self.n] = k[hit]
        out = np.zeros((len(texts), self.stacked.shape[1]), np.float32)
        for i, words in enumerate(sets):
            rows = set(map(self.table.__getitem__, words))
            rows.discard(0)
            if rows:
                out[i] = self.stacked[list(rows)].max(axis=0)
        return out


def landmark_table(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """wanted and landmarks of a Model, and the landmarks' kernel matrix."""
    codes, owner = codes_of(strings)
    row, key, weight = triples(codes)
    known = np.unique(key)
    wanted = np.zeros(TRIPLES, np.int32)
    wanted[known] = np.arange(1, len(known) + 1)
    table = np.zeros((len(known) + 1, len(strings)), np.float32)
    np.add.at(table, (wanted[key], owner[row]), weight)
    own = (table**2).sum(axis=0)
    gram = table.T @ table / np.sqrt(np.outer(own, own))
    return wanted, table / own, gram


def choose_landmarks(telling: dict[str, int], ordinary: Counter, n_groups: int, n0: int, most: int) -> list[str]:
    """Strings of words: telling has word -> groups of toxic texts with it, ordinary word -> other texts with it."""
    parts = lambda w: {w[i:j] for i in range(len(w) - 2) for j in range(i + 3, min(len(w), i + 11) + 1)}
    n1: Counter = Counter()
    for w, n in telling.items():
        for p in parts(trimmed(w)):
            n1[p] += n
    fine = {p for p, n in n1.items() if n >= max(4, 0.03 * n_groups)}
    n2: Counter = Counter()
    for w, n in ordinary.items():
        for p in parts(trimmed(w)):
            if p in fine:
                n2[p] += n
    fine = {p for p in fine if n1[p] / n_groups > 20 * (n2[p] + 1) / n0 and np.count_nonzero(CODES[[min(ord(c), 0x101) for c in p]]) >= 3}
    holders: dict[str, list[str]] = {}
    for w in telling:
        for p in parts(trimmed(w)):
            if p in fine:
                holders.setdefault(p, []).append(w)
    gain, left, out = Counter({p: n1[p] for p in fine}), set(telling), []
    while gain and len(out) < most:
        top = max(gain.values())
        if top < max(4, 0.03 * n_groups):
            break
        # The longest string that does nearly as well as the best says most about the words.
        best = max((p for p, n in gain.items() if n >= 0.9 * top), key=lambda p: (len(p), gain[p], p))
        out.append(best)
        for w in [w for w in holders[best] if w in left]:
            left.discard(w)
            for p in parts(trimmed(w)):
                if p in fine:
                    gain[p] -= telling[w]
    return out


def _disguised(word: str, rng: random.Random) -> str:
    at = rng.randrange(1, max(2, len(word)))
    return rng.choice([rng.choice("-._*").join(word), word[:at] + rng.choice("xzqk-*.") + word[at:]])


def _newton(x: np.ndarray, y: np.ndarray, c: float, steps: int = 30) -> np.ndarray:
    """Squared-hinge linear SVM; the last weight is the bias."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        active = y * (x1 @ w) < 1
        a = x1[active]
        new = np.linalg.solve(ridge + 2 * c * a.T @ a, 2 * c * a.T @ y[active])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _copy_groups(texts: list[str]) -> list[int]:
    """A group number for each text; texts that share one of four minimum hashes of word triples get the same."""
    parent, seen = list(range(len(texts))), {}

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, text in enumerate(texts):
        words = (text or "").lower().split()
        hashes = [zlib.crc32(" ".join(words[j : j + 3]).encode()) for j in range(max(1, len(words) - 2))]
        for k, salt in enumerate((0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)):
            key = (k, min((h ^ salt) * 0x2545F491 & 0xFFFFFFFF for h in hashes))
            parent[top(i)] = top(seen.setdefault(key, i))
    return [top(i) for i in range(len(texts))]


def fit(texts: list[str], labels: list[int], n_landmarks: int = 48, c: float = 10.0, seed: int = 7) -> Model | None:
    """None without rows of both labels."""
    rng = random.Random(seed)
    unique = list(dict.fromkeys(zip(texts, labels, strict=True)))
    sets = [{w.strip(EDGES) for w in words_of(t)} for t, _ in unique]
    y = np.array([1 if v else -1 for _, v in unique])
    if len(set(y.tolist())) < 2:
        return None
    df = [Counter(), Counter()]
    for words, v in zip(sets, y, strict=True):
        df[int(v > 0)].update(w for w in words if 3 <= len(w) <= LONGEST)
    n0 = (y < 0).sum()
    # Near copies say the same thing once: a word counts in toxic texts by groups of copies.
    toxic = [i for i in range(len(unique)) if y[i] > 0]
    in_groups: dict[str, set] = {}
    for i, group in zip(toxic, _copy_groups([unique[i][0] for i in toxic]), strict=True):
        for w in sets[i]:
            in_groups.setdefault(w, set()).add(group)
    n_groups = len(set().union(*in_groups.values())) if in_groups else 1
    words = choose_landmarks({w: len(g) for w, g in in_groups.items() if 3 <= len(w) <= LONGEST}, df[0], n_groups, n0, n_landmarks)
    if not words:
        return None
    wanted, table, gram = landmark_table(words)
    # Telling words of toxic texts are labelled examples of their own, once as they are and once
    # disguised: each such word has to carry the label alone.
    bare = [w[1:] if w[0] == "^" else w for w in words]
    again = []
    for i in toxic:
        for w in sorted(sets[i]):
            if any(b in w for b in bare):
                again += [w, _disguised(w, rng)]
    again = again[: 20 * len(unique)]
    pooler = Pooler(Model(wanted, table, np.zeros(len(words)), 0.0, 1.0, 0.0))
    every = [t for t, _ in unique] + again
    pooled = np.vstack([pooler.pool(every[i : i + 500]) for i in range(0, len(every), 500)]).astype(float)
    y = np.r_[y, np.ones(len(again))]
    # Nyström: K_mm ** -1/2 maps kernel values to features.
    values, vectors = np.linalg.eigh(gram + 1e-3 * np.eye(len(words)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    w = _newton(pooled @ root, y, c)
    margins = pooled @ root @ w[:-1] + w[-1]
    # Logistic curve by Newton steps, on the rows as they were labelled.
    m, target = margins[: len(unique)], (y[: len(unique)] > 0) * 1.0
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(ab[0] * m + ab[1], -30, 30)))
        g = np.array([((p - target) * m).sum() + 1e-2 * ab[0], (p - target).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * m * m).sum() + 1e-2, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        ab -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return Model(wanted, table, root @ w[:-1], float(w[-1]), float(ab[0]), float(ab[1]))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 5000) -> Model | None:
    """Fits on labelled rows that are not held out, at most `max_labelled` ids and twice as many rows of them.

    The fit is one task, whose input these bounds hold; only the model comes to the driver.
    """
    chosen = (
        labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    rows = rows.orderBy("doc_id", "text", "toxic").limit(2 * max_labelled).select("text", "toxic")

    def run(batches):
        texts, found = [], []
        for b in batches:
            texts += b.column(0).to_pylist()
            found += b.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, found) if texts else None)], pa.binary())], names=["model"])

    models = [pickle.loads(r[0]) for r in rows.mapInArrow(run, "model binary").collect()]  # one row a partition, and the limit leaves one
    return next((m for m in models if m is not None), None)


def with_score(docs: DataFrame, model: Model | None, text: str = "text", score: str = "score") -> DataFrame:
    """`docs` with a column `score` (it replaces one of that name)."""
    kept = [c for c in docs.columns if c != score]
    if model is None:
        return docs.select(*kept, F.lit(0.0).alias(score))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(score, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        pooler = _pooler_of(shared)
        for b in batches:
            at = b.schema.names.index(text)
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                found = pooler.model.scores(pooler.pool(part.column(at).to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=[*part.schema.names, score])

    return docs.select(*kept).mapInArrow(run, schema)


def _pooler_of(shared) -> Pooler:
    model = shared.value
    return kept(("toxicity", hash(model.weights.tobytes())), lambda: Pooler(model))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """Documents whose score stays under `least`, with their own columns."""
    model = train(docs, labels)
    boxed = docs.select(F.struct("*").alias("_row"), text_or_empty().alias("_text"))
    return with_score(boxed, model, text="_text", score="_score").where(F.col("_score") < least).select("_row.*")
