"""From raw documents to packed training sequences, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.  Nulls, empty texts, repeated rows and empty
tables go through every stage (see the operators' docstrings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from popdist.llm.common import documents, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    from popdist.llm.quality import keep_good

    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the largest doc_id stays."""
    from popdist.llm.exact_dedup import keep_first_copies

    return keep_first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles (Jaccard 0.8), one stays."""
    from popdist.llm.jaccard_join import keep_one

    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    from popdist.llm.secret_scan import redact

    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    from popdist.llm.packing import pack
    from popdist.llm.queries import tokenizer_path

    return pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("packing", packing),
]

#: a trained classifier and a tokenizer decide; SQL cannot express them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
