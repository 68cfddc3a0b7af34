"""The corpus pipeline: quality rules, line dedup, near-duplicate removal,
PII and packing, each stage one operator of ``stratum.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and lets its decisions take effect; all but the last return the columns of
``documents``.  Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import jaccard_join, line_dedup, packing, pii, quality_rules
from stratum.session import scratch_path
from stratum.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (8)."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in many documents (3)."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (10)."""
    return jaccard_join.keep_one(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the terms that reveal it replaced (6)."""
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents (1)."""
    return packing.digest(packing.pack(docs))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("privacy", privacy), ("pack", pack)]

# The tokenizer and the packing are beyond SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
