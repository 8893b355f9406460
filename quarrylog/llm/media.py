"""Media columns: bytes as grey PNG pictures in a binary column, read back with checksum tests.

`encode` writes signature, IHDR, IDAT (zlib) and IEND chunks with their CRCs, each row with the filter that
suits it. `decode` tests the signature and every chunk's CRC, inflates, and undoes all five row filters with numpy,
diagonal by diagonal.
The feature is a low-frequency cosine-transform hash: the picture's area means on a GRID x GRID raster,
a 2-D cosine transform, and one bit for each low frequency against their median.

Defined results: null text counts as empty (one row of zeros); repeated rows each give a row, equal texts
equal values; a null doc_id is kept; very long texts are tall pictures; other columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions, text_or_empty, written

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
GRID, LOW = 32, 8
_k, _x = np.meshgrid(np.arange(LOW), np.arange(GRID), indexing="ij")
COSINES = np.cos(np.pi * _k * (2 * _x + 1) / (2 * GRID))


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def _filtered(rows: np.ndarray, kind: int, up: np.ndarray) -> np.ndarray:
    """The rows less what filter `kind` guesses from the samples to the left, above and above left."""
    left, corner = np.zeros_like(rows), np.zeros_like(rows)
    left[:, 1:], corner[:, 1:] = rows[:, :-1], up[:, :-1]
    return rows - (0 if kind == 0 else left if kind == 1 else up if kind == 2 else ((left.astype(np.uint16) + up) // 2).astype(np.uint8) if kind == 3 else _paeth(left, up, corner))


def encode(payload: bytes, width: int = WIDTH, filter_type: int | None = None, level: int = 6) -> bytes:
    """A grey 8-bit PNG whose samples are `payload`; its length is a positive multiple of width.

    Each row gets the filter that leaves the least sum of absolute differences, or `filter_type`. Unfiltered samples
    count a quarter: deflate finds repeated bytes itself, so that a filter has to save much more.
    """
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    up = np.vstack([np.zeros((1, width), np.uint8), rows[:-1]])
    out = np.empty((len(rows), width + 1), np.uint8)
    if filter_type is not None:
        out[:, 0] = filter_type
        out[:, 1:] = _filtered(rows, filter_type, up)
    else:
        tried = np.stack([_filtered(rows, k, up) for k in range(5)])
        left = np.abs(tried.view(np.int8).astype(np.int16)).sum(axis=2)
        left[0] //= 4
        out[:, 0] = left.argmin(axis=0)
        out[:, 1:] = tried[out[:, 0], np.arange(len(rows))]
    header = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(out.tobytes(), level)) + chunk(b"IEND", b"")


def _paeth(a, b, c):
    a, b, c = (x.astype(np.int16) for x in (a, b, c))
    pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
    return np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, c)).astype(np.uint8)


def unfiltered(raws: list[np.ndarray]) -> list[np.ndarray]:
    """The samples of pictures of one width, given as rows of a filter's number and the filtered samples.

    A sample needs those to its left and above only, so all samples of one diagonal (row + column), of all
    pictures at once, are undone in one numpy step.
    """
    width = raws[0].shape[1] - 1
    heights = [len(r) for r in raws]
    raw = np.concatenate(raws)
    kinds = raw[:, 0]
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown filter")
    y = np.concatenate([np.arange(h) for h in heights])
    order = np.argsort(y, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    above = np.where(y > 0, place[np.arange(len(y)) - 1], len(y))[order]
    y, kinds, data = y[order], kinds[order].astype(np.int16), raw[order, 1:].astype(np.int16)
    # One column of zeros on the left, and one row of zeros above all first rows.
    out = np.zeros((len(y) + 1, width + 1), np.int16)
    of_kind = [kinds == k for k in range(5)]
    ends = np.searchsorted(y, np.arange(max(heights) + width + 1), "left")
    for d in range(max(heights) + width - 1):
        i = slice(int(ends[max(0, d - width + 1)]), int(ends[min(d + 1, max(heights))]))
        x = d - y[i]
        rows = np.arange(i.start, i.stop)
        a, b, c = out[rows, x], out[above[i], x + 1], out[above[i], x]
        pa_, pb, pc = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
        paeth = np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, c))
        guess = a * of_kind[1][i] + b * of_kind[2][i] + ((a + b) >> 1) * of_kind[3][i] + paeth * of_kind[4][i]
        out[rows, x + 1] = (data[rows, x] + guess) & 255
    samples = out[place, 1:].astype(np.uint8)
    return np.split(samples, np.cumsum(heights)[:-1])


def inflated(data: bytes) -> np.ndarray:
    """Rows of a filter's number and filtered samples; ValueError if a checksum or the layout is wrong."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, idat, header = 8, [], None
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("a chunk is cut off")
        (size,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if len(body) < size or struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            idat.append(body)
        elif kind == b"IEND":
            break
        at += size + 12
    if header is None or header[2:] != (8, 0, 0, 0, 0):
        raise ValueError("only grey 8-bit pictures without interlace")
    width, height = header[:2]
    raw = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8)
    if not height or len(raw) != height * (width + 1):
        raise ValueError("wrong number of samples")
    return raw.reshape(height, width + 1)


def decode(data: bytes) -> np.ndarray:
    """The samples, as rows x width; ValueError if a checksum or the layout is wrong."""
    return unfiltered([inflated(data)])[0]


def decode_all(pictures: list[bytes]) -> list[np.ndarray]:
    """The samples of each picture; those of like height and equal width are undone together."""
    raws = [inflated(p) for p in pictures]
    order = sorted(range(len(raws)), key=lambda i: raws[i].shape[::-1])
    out: list = [None] * len(raws)
    at = 0
    while at < len(order):
        to, first = at + 1, raws[order[at]].shape
        while to < len(order) and raws[order[to]].shape[1] == first[1] and raws[order[to]].shape[0] <= 2 * first[0] + 16:
            to += 1
        for i, rows in zip(order[at:to], unfiltered([raws[i] for i in order[at:to]]), strict=True):
            out[i] = rows
        at = to
    return out


def cosine_hash(rows: np.ndarray) -> str:
    """LOW x LOW bits in hex: which low frequencies lie above their median (the mean's bit is 0)."""
    means = _means(_means(rows.astype(np.float64)).T).T
    f = (COSINES @ means @ COSINES.T).round(6).ravel()
    f[0] = -np.inf
    bits = f > np.median(f[1:])
    return np.packbits(bits).tobytes().hex()


def _means(x: np.ndarray) -> np.ndarray:
    """Area means of the rows of x on GRID bins of equal height; fewer rows are repeated."""
    n = len(x)
    if n < GRID:
        return x[np.arange(GRID) * n // GRID]
    edges = np.arange(GRID + 1) * n // GRID
    return np.add.reduceat(x, edges[:-1], axis=0) / np.diff(edges)[:, None]


def padded(text: str | None) -> tuple[int, bytes]:
    data = (text or "").encode()
    return len(data), data + bytes(-len(data) % WIDTH if data else WIDTH)


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: the text's padded bytes as a PNG."""

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for at, to in portions(texts, 256):
                part = b.slice(at, to - at)
                both = [padded(x) for x in texts[at:to]]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in both], pa.int64()), pa.array([encode(p) for _, p in both], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """Digests and feature of the samples read back from the media column."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.string() if "string" in x else pa.int64() for x in schema.split(", ")]

    def run(batches):
        for b in batches:
            out = [[] for _ in names]
            docs, ns, media_ = (b.column(i).to_pylist() for i in range(3))
            for at, to in portions(media_, 256):
                for doc, n, data, rows in zip(docs[at:to], ns[at:to], media_[at:to], decode_all(media_[at:to]), strict=True):
                    payload = rows.tobytes()
                    row = (doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest(), cosine_hash(rows))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def op9_media(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return media_features(written(to_media(docs), "media"))
