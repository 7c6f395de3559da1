"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from billsift.llm.alignment import op11_tokenizer_alignment
from billsift.llm.chat import op1_chat_formatting
from billsift.llm.decontaminate import op3_benchmark_decontamination
from billsift.llm.html import op5_html_extraction
from billsift.llm.lexical import op12_lexical_search
from billsift.llm.oracle import ORACLES
from billsift.llm.pieces import op9_sentencepiece
from billsift.llm.quality import op6_quality_classifier
from billsift.llm.rules import op8_quality_rules
from billsift.llm.similar import op7_ngram_jaccard_join
from billsift.llm.substrings import op4_substring_dedup
from billsift.llm.tables import in_small_batches
from billsift.llm.token_counts import op2_token_counts
from billsift.llm.token_files import op13_token_files
from billsift.llm.toxicity import op10_toxicity

__all__ = ["ORACLES", "QUERIES", "importable"]

Query = Callable[[SparkSession, str], DataFrame]


def importable(query: Query) -> Query:
    """A query in small batches; workers of a session started in another folder find the package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
        in_small_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name: importable(query)
    for name, query in {
        "op1_chat_formatting": op1_chat_formatting,
        "op2_token_counts": op2_token_counts,
        "op3_benchmark_decontamination": op3_benchmark_decontamination,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_html_extraction": op5_html_extraction,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
        "op8_quality_rules": op8_quality_rules,
        "op9_sentencepiece": op9_sentencepiece,
        "op10_toxicity": op10_toxicity,
        "op11_tokenizer_alignment": op11_tokenizer_alignment,
        "op12_lexical_search": op12_lexical_search,
        "op13_token_files": op13_token_files,
    }.items()
}
