"""Training-corpus pipeline: documents in, token counts and digests out.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)``
and returns a DataFrame; all but the last return the columns of ``docs``.
``run`` applies them to the table ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, decontaminate, language_id, near_dup, toxicity
from tessera.llm.blocks import fold, small_batches
from tessera.llm.registry import tokenizer_file


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told (texts that are null or have no letter go)."""
    model = language_id.fit(docs, learn=fold("doc_id", 4) != 2)
    small_batches(spark)
    return docs.where(language_id.detector(model)(F.col("text"))["lang"] != language_id.UNDETERMINED)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents scored below one half."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn=fold("doc_id", 5) != 0)
    small_batches(spark)
    return docs.where(toxicity.scorer(model)(F.col("text")) < 0.5)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest id, of each group of near duplicates."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that benchmark phrases do not cover to a twentieth or more."""
    return decontaminate.clean(docs, decontaminate.phrase_blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def tokenise_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every document."""
    return byte_bpe.digests(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), keep_ids=True)


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("near_dup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", tokenise_stage),
]

#: Trained models and tokenisation cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
