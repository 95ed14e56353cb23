"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, reads its own texts anew, and
its decisions take effect: documents whose language can't be told go, of
equal texts and of near duplicates one stays, documents that hold a passage
of the benchmark go, and what is left is packed.  Between two stages the
documents are a Parquet table in the shared scratch space.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revtrail.llm import decontam, exact_dedup, langid, ngram_join, packing
from revtrail.llm.scratch import written
from revtrail.session import configure


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return langid.drop_unknown(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return ngram_join.drop_near_duplicates(docs, n=5, similarity=0.8)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES = [("language ID", language_id), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", benchmark_passages), ("best-fit packing", packed)]

#: Classifiers, MinHash and a tokenizer are beyond SQL; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
