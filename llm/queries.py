"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import (
    collocations,
    embedding_dedup,
    exact_dedup,
    fingerprints,
    language_id,
    mixing,
    ngram_join,
    period_runs,
    sentencepiece_codec,
    sharding,
    suffix_dedup,
    url_filter,
    warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mixing": mixing.op1_source_mixing,
        "op2_ngram_jaccard": ngram_join.op2_ngram_jaccard,
        "op3_warc": warc.op3_warc,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_language_id": language_id.op5_language_id,
        "op6_sharding": sharding.op6_sharding,
        "op7_sentencepiece": sentencepiece_codec.op7_sentencepiece,
        "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
        "op9_fingerprints": fingerprints.op9_fingerprints,
        "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
        "op11_exact_dedup": exact_dedup.op11_exact_dedup,
        "op12_period_runs": period_runs.op12_period_runs,
        "op13_collocations": collocations.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_source_mixing": mixing.OP1_SQL,
        "op3_warc": warc.OP3_SQL,
        "op4_url_filter": url_filter.OP4_SQL,
        "op8_embedding_dedup": embedding_dedup.OP8_SQL,
        "op11_exact_dedup": exact_dedup.OP11_SQL,
        "op13_collocations": collocations.OP13_SQL,
    }
