"""Cleans a corpus and packs it into training sequences: toxicity, near duplicates, repeated passages, benchmark
leaks, packing. Every stage works on all that the one before it wrote; all but the last return the columns of
documents.

Defined results: a document without text passes the filters unchanged and is packed as its end token; documents of
which a stage leaves no word go; untouched documents stay as they are; an empty table gives an empty result; further
columns are carried along to the last stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fleetmart.llm import decontaminate, neardup, packing, substring, toxicity
from fleetmart.llm.queries import table, toxic_lexicon
from fleetmart.operators.settle import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, with a lexicon learned from the labels, doesn't reject."""
    return toxicity.reject(docs, toxic_lexicon(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (shingles of five words, similarity of 0.8), the smallest document."""
    return neardup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the windows of 13 words that a smaller document has."""
    return substring.remove(docs)


def cut_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ten words that they share with the benchmark."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("substring_dedup", cut_repeats),
    ("decontamination", cut_leaks), ("packing", pack),
]

# learned weights and tokens are not expressible in SQL; tests compare the stages with brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
