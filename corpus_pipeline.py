"""The corpus pipeline: quality, line dedup, near-duplicate dedup, decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage before kept.  ``run``
writes each stage's result as Parquet in the shared folder and reads it back for the next one, so
a lost executor costs the running stage only.  All stages but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import cotrain_quality, decontaminate, line_dedup, minhash_dedup, packing
from tabwright.llm.common import table, written
from tabwright.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return cotrain_quality.good_documents(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten and more documents go; ``n_chars`` follows the text."""
    kept = line_dedup.with_kept_text(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest id."""
    return minhash_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), unnamed=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    p = packing.pack(docs, tokenizer_path())
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                    "sequence_id", "offset", "sequence_length")


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("packing", pack),
]

# Training a classifier, signatures and tokens are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
