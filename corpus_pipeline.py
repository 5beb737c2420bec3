"""Five stages from raw documents to token digests; each output is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.common import read, stored
from llm.language_id import keep_identified
from llm.mixing import realised
from llm.ngram_join import keep_one
from llm.sentencepiece_codec import token_digests
from llm.suffix_dedup import remove_repeats


#: Over 50 words: how they are spaced and how many bytes they have does not matter.
PASSAGE_WORDS = 51


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is identified."""
    return keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return keep_one(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts byte strings of 400 and more, and passages of over 50 words, that occur elsewhere
    out of the texts."""
    return remove_repeats(docs, passage=PASSAGE_WORDS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources so that no source is seen more than twice as often
    as the largest; every document stays at least once."""
    return realised(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left and decodes it again: one row per document."""
    return token_digests(docs)


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("suffix_dedup", repeats_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", token_stage),
]

#: Training a model and suffix sorting are not SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
