"""Log files as rows (log_file, content)."""

from __future__ import annotations

import gzip
import re
import zipfile
import zlib
from io import BytesIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE_LIMIT = 100 * 1024 * 1024
#: What a folder is searched for.
SUFFIXES = ("xml", "json", "txt", "log", "out")
ZIP_ENTRY = r"^\d+_(.+)\.txt$"


def checked(path: str) -> str:
    if not path:
        raise ValueError("empty path")
    if len(path) > 4096:
        raise ValueError("path is too long")
    if "\0" in path or "../" in path or "..\\" in path or path.endswith("/.."):
        raise ValueError("path is not allowed")
    return path


def _as_regex(glob: str) -> str:
    """A glob as a regex: `*` and `?` stay within a folder, `**` spans any number of them."""
    out, i, depth = [], 0, 0
    while i < len(glob):
        c = glob[i]
        if glob.startswith("**/", i):
            out.append("(?:.*/)?")
            i += 3
            continue
        if c == "[" and "]" in glob[i:]:
            end = glob.index("]", i)
            out.append("[" + glob[i + 1 : end].replace("!", "^", 1) + "]")
            i = end + 1
            continue
        depth += (c == "{") - (c == "}" and depth > 0)
        out.append({"*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")"}.get(c) or ("|" if c == "," and depth else re.escape(c)))
        i += 1
    return "".join(out)


def _binary_files(spark: SparkSession, path: str) -> DataFrame | None:
    """Spark's rows of binary files, or None where nothing is found. Where `**` stands, all folders below are walked."""
    top, deep = path, None
    if "**/" in path:
        top, deep = path.split("**/", 1)
        top = top.rstrip("/") or "."
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(top)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    if found is None or len(found) == 0:
        return None
    if deep is None:
        return spark.read.format("binaryFile").load(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(top)
    return files.where(F.col("path").rlike("(?:^|/)" + _as_regex(("" if top == "." else top.split("/")[-1] + "/") + "**/" + deep) + "$"))


def unpacked(name: str, data: bytes, most: int) -> bytes:
    """The file's bytes, never more than most + 1 of them: unpacking stops there."""
    if name.endswith((".gz", ".gzip")):
        return gzip.GzipFile(fileobj=BytesIO(data)).read(most + 1)
    if name.endswith((".zst", ".zstd")):
        import zstandard

        return zstandard.ZstdDecompressor().stream_reader(BytesIO(data), read_across_frames=True).read(most + 1)
    return data


def _read(spark: SparkSession, path: str, size_limit: int) -> DataFrame:
    """log_file, content, problem: one of the last two is null. Files over the limit are never loaded."""
    checked(path)
    files = _binary_files(spark, path + "*.{" + ",".join(SUFFIXES) + "}" if path.endswith("/") else path)
    if files is None:
        return spark.createDataFrame([], "log_file string, content string, problem string")

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0), b.column(1), strict=True):
                name, text, problem = name.as_py(), None, None
                try:
                    plain = unpacked(name, data.as_py(), size_limit)
                    if len(plain) > size_limit:
                        problem = f"more than {size_limit} bytes are not allowed"
                    else:
                        text = plain.decode("utf-8", "replace")
                except (OSError, EOFError, zlib.error) as e:
                    problem = f"not readable: {e}"
                except Exception as e:
                    if type(e).__name__ != "ZstdError":
                        raise
                    problem = f"not readable: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text], pa.string()), pa.array([problem], pa.string())], names=["log_file", "content", "problem"])

    # The test of `length` reaches the reader, which skips such files; in the other branch no content is read.
    fits = files.where(F.col("length") <= size_limit).select("path", "content").mapInArrow(run, "log_file string, content string, problem string")
    large = files.where(F.col("length") > size_limit).select(F.col("path").alias("log_file"), F.lit(None).cast("string").alias("content"), F.concat(F.col("length").cast("string"), F.lit(f" bytes, {size_limit} are allowed")).alias("problem"))
    return fits.unionByName(large)


def read_docs(spark: SparkSession, path: str, size_limit: int = SIZE_LIMIT, skip_large: bool = False) -> DataFrame:
    """A file, a glob (`**` walks folders) or a folder; .gz, .gzip, .zst and .zstd are unpacked. A missing path gives no rows.

    Files are read as binary by Spark's own reader, so any store it knows will do; unpacking happens in the
    task that read the file and stops at `size_limit` bytes. Larger files, and those that can't be unpacked, fail, or are
    left out with `skip_large`; `unreadable` lists them.
    """
    found = _read(spark, path, size_limit)
    if skip_large:
        return found.where("problem IS NULL").drop("problem")
    fail = F.raise_error(F.concat(F.lit("FileTooLarge or unreadable: "), "log_file", F.lit(": "), "problem")).cast("string")
    return found.select("log_file", F.when(F.col("problem").isNotNull(), fail).otherwise(F.col("content")).alias("content"))


def unreadable(spark: SparkSession, path: str, size_limit: int = SIZE_LIMIT) -> DataFrame:
    """log_file, problem of each file that `read_docs` can't take."""
    return _read(spark, path, size_limit).where("problem IS NOT NULL").select("log_file", "problem")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """log_file, line_no, line of each file; a file is read whole by one task, so that its lines can be numbered."""
    checked(path)
    docs = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("log_file"), F.posexplode(F.split("value", "\r?\n")).alias("at", "line"))
    return docs.select("log_file", (F.col("at") + 1).alias("line_no"), "line")


def read_zip_logs(spark: SparkSession, path: str) -> DataFrame:
    """job_order, job_name, log_file, content of the root entries `N_name.txt` of workflow archives, by name."""

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(BytesIO(data)) as z:
                    entries = sorted(x for x in z.namelist() if re.match(ZIP_ENTRY, x))
                    for x in entries:
                        yield pa.RecordBatch.from_arrays([pa.array([int(x.split("_")[0])], pa.int32()), pa.array([re.match(ZIP_ENTRY, x)[1]]), pa.array([f"{name}!{x}"]), pa.array([z.read(x).decode("utf-8", "replace")])], names=["job_order", "job_name", "log_file", "content"])

    return spark.read.format("binaryFile").load(checked(path)).select("path", "content").mapInArrow(run, "job_order int, job_name string, log_file string, content string")
