"""Corpus pipeline: five operators one after another over the documents.

Each stage reads what the one before has written. All but the last return the
columns of ``documents``; the last returns the token digests of every text
that is left.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import cloudpickle  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import platelake  # noqa: E402
from platelake.llm import bpe, decontaminate, lines, quality, simhash  # noqa: E402
from platelake.session import cut_lineage  # noqa: E402

cloudpickle.register_pickle_by_value(platelake)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go; texts stay as they are."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in several documents stay in the first of them. A text
    may end up empty; its row stays, and ``n_chars`` follows the text."""
    cut = lines.drop_repeated_lines(docs)
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    untouched = F.col("n_dropped") == 0
    return cut.select(*[
        (F.when(untouched, F.col("row")[c]).otherwise(changed[c]) if c in changed
         else F.col("row")[c]).alias(c)
        for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs, benchmark)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that are left."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# SimHash components and BPE merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
