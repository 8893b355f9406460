"""What the operators share: scratch tables in the cluster's folder, and regex spans as column expressions."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); in local mode a temporary one where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quarrylog-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/quarrylog-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` as a table in the shared folder and reads it again: lineage ends there, executors may go."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` made and that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20):
    """Within it, Python workers get batches of so many rows and bytes at most, whatever the length of texts."""
    held = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


_kept: dict = {}


def kept(key, make):
    """What a worker process keeps over its tasks: one thing at a time, so that operators' tables don't add up."""
    if key not in _kept:
        tidy()
        _kept[key] = make()
    return _kept[key]


def tidy() -> None:
    """Gives a worker's memory back that earlier tasks of other operators hold."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def portions(texts: list[str], most_rows: int = 500, most_chars: int = 1 << 20):
    """(begin, end) of runs of texts of bounded number and length; one longer text is a run of its own."""
    begin, chars = 0, 0
    for i, t in enumerate(texts):
        if i > begin and (i - begin >= most_rows or chars + len(t) > most_chars):
            yield begin, i
            begin, chars = i, 0
        chars += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key(*names: str) -> Column:
    """A key that rows equal in `names` share; repeated rows therefore get one and the same result."""
    return F.concat_ws(":", F.hex(F.xxhash64(*names)), F.hex(F.xxhash64(F.lit("k"), *names)))


def row_keys() -> list[Column]:
    """k1, k2: a key that rows of equal doc_id and text share. It is made of what rows hold, so every scan gives the same."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit("k"), "doc_id", "text").alias("k2")]


#: Up to so many rows of keys go to every executor; more are joined by shuffle.
BROADCAST_KEYS = 1_000_000


def by_keys(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join with a table of keys, broadcast only after a look at its size."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, on, how)


SPANS = "array<struct<s:int,e:int,m:string>>"
#: Matches that one running sum takes; an array grows by copying, so long ones are summed in two levels.
SUMMED = 256


def let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def regex_spans(text: Column, pattern: str, keep=None, needs: str | None = None, around: bool = False) -> Column:
    """Leftmost non-overlapping matches of `pattern` as structs (s, e, m): code points, end exclusive.

    The texts between matches come from split, the matches from regexp_extract_all; a running sum of
    lengths gives the offsets. `keep(m)` drops matches that fail, without another try inside them.
    `needs` is a literal that every match holds: texts without it skip the regex. With `around`, gap is
    the text behind the match before, and `before` is that match. The cost is linear in the text.
    """
    none = F.expr("cast(array() as " + (SPANS.replace("m:string", "m:string,gap:string,before:string") if around else SPANS) + ")")

    def pairs(matches):
        columns = [F.split(text, pattern, -1).alias("p"), matches.alias("m")]
        return F.arrays_zip(*columns, F.concat(F.array(F.lit(None).cast("string")), matches).alias("b")) if around else F.arrays_zip(*columns)

    size = lambda x: F.length(x["p"]) + F.coalesce(F.length(x["m"]), F.lit(0))

    def step(acc, x):
        start = acc["at"] + F.length(x["p"])
        end = acc["at"] + size(x)
        valid = x["m"].isNotNull()
        if keep is not None:
            valid = valid & keep(x["m"])
        item = F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m"), *([x["p"].alias("gap"), x["b"].alias("before")] if around else []))
        return F.struct(end.alias("at"), F.when(valid, F.array_append(acc["out"], item)).otherwise(acc["out"]).alias("out"))

    def summed(part, at):
        return F.aggregate(part, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def in_parts(p):
        parts = F.transform(F.sequence(F.lit(1), F.size(p), F.lit(SUMMED)), lambda i: F.slice(p, i, F.lit(SUMMED)))

        def placed(parts):
            sizes = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda acc, x: acc + size(x)))
            starts = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
            return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), starts.alias("at")), lambda x: F.when(x["part"].isNull(), none).otherwise(summed(x["part"], x["at"]))))

        return let(parts, placed)

    found = let(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), pairs), lambda p: F.when(F.size(p) <= SUMMED, summed(p, F.lit(0))).otherwise(in_parts(p)))
    has = text.rlike(pattern)
    if needs is not None:
        has = F.contains(text, F.lit(needs)) & has
    return F.when(has, found).otherwise(none)


def indexed(spans: Column) -> Column:
    """Spans by place in parts of SUMMED, each with where it begins and ends: an index for `overlapping`."""
    one = lambda part: F.struct(F.element_at(part, 1)["s"].alias("s"), F.array_max(F.transform(part, lambda x: x["e"])).alias("e"), part.alias("spans"))
    starts = lambda all_: F.filter(F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(SUMMED)), lambda i: F.size(all_) > 0)
    return let(spans, lambda all_: F.transform(starts(all_), lambda i: let(F.slice(all_, i, F.lit(SUMMED)), one)))


def overlapping(index: Column, s: Column, e: Column) -> Column:
    """The spans of an index that overlap s to e, by place; only parts that do are passed."""
    meets = lambda k: (k["s"] < e) & (k["e"] > s)
    return F.flatten(F.transform(F.filter(index, meets), lambda p: F.filter(p["spans"], meets)))


#: Characters of a block of a text.
BLOCK = 4096


def blocks(text: Column) -> Column:
    """The text in blocks of equal length, for `piece`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def piece(of: Column, s: Column, e: Column) -> Column:
    """Characters s to e of a text given in blocks; the cost doesn't depend on where they stand."""
    first = (s / BLOCK).cast("int")
    some = F.array_join(F.slice(of, first + 1, F.greatest((e / BLOCK).cast("int") - first + 1, F.lit(0))), "")
    return F.substring(some, s - first * BLOCK + 1, e - s)


def labels_of(kind: Column | str, spans: Column) -> Column:
    """kind:start:end of each span."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.transform(spans, lambda x: F.concat_ws(":", kind, x["s"].cast("string"), x["e"].cast("string")))
