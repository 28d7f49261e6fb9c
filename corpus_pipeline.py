"""The corpus pipeline: quality, near-duplicates, benchmark decontamination, mixing, token output.

Every stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the next
stage's documents. All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import crf_quality, fm_decontaminate, pfair_mix, simhash, token_output
from labelloom.llm.common import bounded_batches
from labelloom.scratch import new_path

#: Documents of a lower score are rejected.
LEAST_SCORE = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line model scores below LEAST_SCORE; texts without lines stay."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return crf_quality.keep(docs, crf_quality.train(docs, labels), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group: 3-word shingles, links of at most 3 differing bits."""
    bounded_batches(spark)
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of the benchmark out of the texts."""
    bounded_batches(spark)
    cleaned = fm_decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return cleaned


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the documents into the order of the mixed blocks: of the files by name, and of the rows within a file."""
    bounded_batches(spark)
    return pfair_mix.in_mixed_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks of the documents in their mixed order, decoded again: one row per document.

    The order is that of the files and rows of ``docs``; a table that comes from no file is taken in order of doc_id.
    """
    bounded_batches(spark)
    return token_output.token_table(in_order(docs), public_tokenizers.path("byte_bpe_50k.json"))


def in_order(docs: DataFrame) -> DataFrame:
    try:
        rows = docs.select("doc_id", "text", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return token_output.by_key(docs)
    return rows.repartitionByRange("_file", "_row").sortWithinPartitions("_file", "_row").select("doc_id", "text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens),
]

#: SQL can express neither the fitted model nor the tokenizer; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
