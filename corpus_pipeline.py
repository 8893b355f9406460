"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, BPE ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the
columns of documents. Stages are written as Parquet in the shared folder and read again, so that a lost
executor costs tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylog.llm import bpe, decontaminate, ngram_join, secret_scan, toxicity
from quarrylog.llm.common import scratch_path


def toxic_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, Jaccard similarity of 0.8)."""
    return ngram_join.keep_one(docs, size=5, threshold=80)


def benchmark_leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def token_ids(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids that training reads."""
    return bpe.encode(docs).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxic_documents),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("secret_scan", secrets),
    ("bpe", token_ids),
]
#: Two stages run trained models and one a set-similarity search: no SQL for the whole.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
