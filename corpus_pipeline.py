"""From raw documents to token ids: five stages, each on all that the one before kept.

Quality rules drop documents that fail them, of each group of near duplicates one document
stays, word windows that an earlier document has are cut out, documents that hold a
benchmark item are dropped, and what is left is encoded. ``n_chars`` follows the text.

Nulls, empty tables and repeated rows are treated as the operators' modules say; other
columns of the documents go through all stages.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from billsift.llm import decontaminate, pieces, rules, similar, substrings
from billsift.llm.tables import in_small_batches
from billsift.llm.vocabulary import Vocabulary
from billsift.session import discard, new_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.one_of_each_group(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cut_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(docs, Vocabulary.load(pieces.MODEL_PATH).content)


def _small_batches(stage):
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        in_small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality_rules", _small_batches(quality_rules)),
    ("near_duplicates", _small_batches(near_duplicates)),
    ("repeated_substrings", _small_batches(repeated_substrings)),
    ("benchmark_decontamination", _small_batches(benchmark_decontamination)),
    ("sentencepiece_encoding", _small_batches(sentencepiece_encoding)),
]

#: An isolation forest and a tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a folder after all stages; a stage's table goes when the next is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        made, path = stage(spark, docs, sf_dir), new_path(spark, f"pipeline-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
