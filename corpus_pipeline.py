"""The corpus pipeline: from the documents table to packed training sequences.

Each stage takes the documents that the one before kept and returns documents,
the last one packed pieces. Line dedup keeps every document, also one that
loses all its lines; the stages that filter drop whole documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyroll.llm.common import ship, table, written
from skyroll.llm.contamination import clean
from skyroll.llm.lines import with_lines_removed
from skyroll.llm.near import without_near_duplicates
from skyroll.llm.packing import pack
from skyroll.llm.quality import passing


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the rules or the outlier test reject go."""
    ship(spark)
    return passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: lines similar to an earlier one go; n_chars follows the text."""
    ship(spark)
    return with_lines_removed(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each class of near-duplicates stays."""
    ship(spark)
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents with a window of a benchmark item go."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: pieces in sequences of 1,024 tokens."""
    import public_tokenizers

    ship(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: Tokens and packing can't be expressed in SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage keeps is written for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
