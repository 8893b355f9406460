"""Token ids in Simple-8b blocks.

A 64-bit word holds a selector in its top four bits and, below, as many ids of one width as the
selector says. Ids of 60 bits and more are escapes: their word holds an index into the block's list of
raw values. A block covers whole documents; `marks` has the number of ids before every
MARK-th word, so that the reader starts inside a block, decodes some documents at a time, and all words of a
selector at once.

Blocks are rows of a Parquet table, sorted by (shard, block); shards are ranges of doc_id. The writer is
Spark's, so that files appear only when a task commits, on any store that Spark can reach.

Defined results: null text counts as empty (then only the end id is written); a null doc_id sorts first;
rows with equal doc_id are in the order of their texts; other columns are ignored, whatever their names;
an empty table gives an empty result. Texts of any length stay whole: a long one is a block of its own size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions, scratch_path, text_or_empty
from .words import ByteLevelPieces, table

#: selector -> (ids in the word, bits of each); 0 is an escape, 1 a run of zeros.
SELECTORS = ((1, 60), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([n for n, _ in SELECTORS])
MARK = 256
BLOCK_IDS = 1 << 17
#: Ids that the reader decodes at once, in whole documents.
READ_IDS = 1 << 15


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """words, marks and raw escape values of unsigned ids."""
    ids = np.ascontiguousarray(ids)
    n = len(ids)
    chosen = np.full(n, 15, np.uint8)
    if ids.dtype.itemsize > 4:
        chosen[ids >= np.uint64(1 << 60)] = 0
    for s in range(14, 0, -1):
        count, bits = SELECTORS[s]
        if n < count:
            continue
        fits = ids < (1 << bits)
        if not fits.any():
            continue
        have, run = 1, fits
        while have < count:
            step = min(have, count - have)
            run = run[: len(run) - step] & run[step:]
            have += step
        chosen[: len(run)][run] = s
    at, starts, jump = 0, [], COUNTS[chosen].tolist()
    while at < n:
        starts.append(at)
        at += jump[at]
    starts = np.array(starts, np.int64)
    sel = chosen[starts]
    words = sel.astype(np.uint64) << np.uint64(60)
    wide = ids.astype(np.uint64, copy=False)
    raw = np.array([], np.uint64)
    for s in np.unique(sel):
        count, bits = SELECTORS[s]
        mine = np.flatnonzero(sel == s)
        if s == 0:
            raw = wide[starts[mine]]
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
        elif bits:
            for k in range(count):
                words[mine] |= wide[starts[mine] + k] << np.uint64(bits * k)
    return words, starts[::MARK].astype(np.uint32), raw


def unpack(words: np.ndarray, raw: np.ndarray, dtype=np.uint32) -> np.ndarray:
    sel = (words >> np.uint64(60)).astype(np.uint8)
    counts = COUNTS[sel]
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype)
    for s in np.unique(sel):
        count, bits = SELECTORS[s]
        mine = np.flatnonzero(sel == s)
        own, at = words[mine], starts[mine]
        if s == 0:
            out[at] = raw[(own & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif bits:
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                out[at + k] = ((own >> np.uint64(bits * k)) & mask).astype(dtype)
    return out


def unpack_range(words: np.ndarray, marks: np.ndarray, raw: np.ndarray, begin: int, end: int, dtype=np.uint32) -> np.ndarray:
    """The ids begin to end of a block: only the words between the marks around them are decoded."""
    if begin >= end:
        return np.array([], dtype)
    first = int(np.searchsorted(marks, begin, "right")) - 1
    last = int(np.searchsorted(marks, end, "left"))
    part = unpack(words[first * MARK : last * MARK], raw, dtype)
    return part[begin - int(marks[first]) : end - int(marks[first])]


BLOCK_SCHEMA = "shard int, block int, first long, n_ids long, doc_ids array<long>, lengths array<long>, words binary, marks binary, raw binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Encodes doc_id, text into Simple-8b blocks under `path`, in ascending doc_id order."""
    tokenizer = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        pieces, shard = table(ByteLevelPieces, tokenizer), TaskContext.get().partitionId()
        held, sizes, names, first, block = [], [], [], 0, 0

        def closed():
            nonlocal first, block
            ids = np.frombuffer(b"".join(held), "<u4")
            words, marks, raw = pack(ids)
            row = [[shard], [block], [first], [len(ids)], [names[:]], [sizes[:]], [words.tobytes()], [marks.tobytes()], [raw.tobytes()]]
            first, block = first + len(ids), block + 1
            held.clear(), sizes.clear(), names.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, ARROW, strict=True)], names=[x.split()[0] for x in BLOCK_SCHEMA.split(", ")])

        total = 0
        for b in batches:
            texts = b.column(1).to_pylist()
            for at, to in portions(texts, 256):
                for name, data in zip(b.column(0)[at:to].to_pylist(), pieces.encode(texts[at:to]), strict=True):
                    held += (data, end)
                    sizes.append(len(data) // 4 + 1)
                    names.append(name)
                    total += sizes[-1]
                    if total >= BLOCK_IDS:
                        yield closed()
                        total = 0
        if names:
            yield closed()

    (
        docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, BLOCK_SCHEMA)
        .write.option("compression", "zstd").parquet(path)
    )


ARROW = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]


def read_ids(spark, path: str, digest_only: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and ids or their crc32, from the files."""
    blocks = spark.read.parquet(path)
    # One number a shard comes to the driver: at most the number of partitions that wrote.
    total, offsets = 0, []
    for shard, n in sorted(blocks.groupBy("shard").agg(F.sum("n_ids")).collect()):
        offsets.append((shard, total))
        total += n
    before = dict(offsets)
    last = ("ids_crc32", "long", pa.int64()) if digest_only else ("ids", "array<long>", pa.list_(pa.int64()))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                packed = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["marks"], np.uint32), np.frombuffer(r["raw"], np.uint64)
                ends = np.cumsum(r["lengths"])
                starts = ends - r["lengths"]
                data, at = [], 0
                while at < len(ends):  # some documents at a time, found by the marks
                    to = max(at + 1, int(np.searchsorted(ends, starts[at] + READ_IDS, "right")))
                    ids = unpack_range(*packed, int(starts[at]), int(ends[to - 1]))
                    cut = [ids[s:e] for s, e in zip((starts[at:to] - starts[at]).tolist(), (ends[at:to] - starts[at]).tolist(), strict=True)]
                    data += [zlib.crc32(x.astype("<u4", copy=False)) for x in cut] if digest_only else [x.tolist() for x in cut]
                    at = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(starts + before[r["shard"]] + r["first"], pa.int64()), pa.array(r["lengths"], pa.int64()), pa.array(data, last[2])],
                    names=["doc_id", "start", "n_tokens", last[0]],
                )

    return blocks.select("shard", "first", "doc_ids", "lengths", "words", "marks", "raw").mapInArrow(run, f"doc_id long, start long, n_tokens long, {last[0]} {last[1]}")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_token_ids(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_ids(spark, path, digest_only=True)
