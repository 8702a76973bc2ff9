"""Documents to token ids in five stages; each is written as Parquet and read again as the next one's documents.

Each stage judges all documents that the one before has kept:

* quality: documents that fail the quality rules go;
* language: documents whose language is not one of the accepted ones, or not clear, go;
* near-copies: of each group of near-copies the document of the smallest doc_id stays. Rows that repeat a doc_id are one
  document and stay once; rows without a doc_id go if a document with one is in their group, and all stay if none is;
* decontamination: documents that hold a passage of the benchmark go, each row by its own text;
* tokens: each document gets its token ids and their byte offsets.

Null texts fail the quality rules, so no later stage of ``run`` sees any. An empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vacantia.llm.byte_bpe import encode_table
from vacantia.llm.common import staged
from vacantia.llm.decontaminate import drop_contaminated
from vacantia.llm.language_id import keep_identified
from vacantia.llm.quality_rules import keep_good
from vacantia.llm.simhash import keep_first


#: Rows that a task hands to Python at once. Rows hold whole texts, so this bounds the memory of a task on either side.
ROWS_TO_PYTHON = "1000"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_TO_PYTHON)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, whose limits come from the documents given."""
    small_batches(spark)
    return keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the accepted languages."""
    small_batches(spark)
    return keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    small_batches(spark)
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return drop_contaminated(docs, benchmark)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its token ids and their byte offsets."""
    small_batches(spark)
    return encode_table(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [("quality", quality), ("language", language), ("near_copies", near_copies), ("decontamination", decontamination),
          ("tokens", tokens)]

#: XXH64, pair merging and code point classes are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
