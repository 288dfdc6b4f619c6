"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chorus.llm import exact_dedup, language_id, mixing, sentencepiece_codec, simhash
from chorus.llm.common import read_table
from chorus.llm.queries import PIECES, tokenizer
from chorus.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machines place in no learned language go: null text,
    no letter, or a prediction whose score is below ``MIN_SCORE``."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space runs as one space) the smallest id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints (3-word shingles, at most 3
    differing bits) the smallest id stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks, 0 to 3 times."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, with the round trip checked."""
    return sentencepiece_codec.encode_documents(docs, tokenizer(PIECES))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies),
          ("simhash_near_dedup", drop_near_copies), ("mixing", mix_sources),
          ("sentencepiece", encode)]

#: SQL cannot express fingerprints' components or the best paths; the tests
#: hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's output is a table in the
    shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
