"""A training-data pipeline over the table ``documents``: language identification, exact
and near deduplication, mixing of sources to target weights, and BPE encoding and decoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``.  All
stages but the last return the columns of ``docs``, whatever their names; of an empty table
each stage makes an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilealg.llm import bpe, exact_dedup, langid, mixing, near_dedup
from tilealg.llm.shared import written

#: SQL cannot express the language, mixing and BPE stages; tests/llm/test_pipeline.py
#: compares run() with a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus' own labelled rows teach (operator 6).  A null
    text, one without a letter, and every text of a corpus without labels go; of languages that
    tie the first by name is taken, so that no tie goes; repeated rows stay or go alike."""
    return langid.accepted(spark, docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts, the one with the largest id (operator 8);
    a null text is an empty one, a null id smaller than any other, one of repeated rows stays."""
    return exact_dedup.dedup(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or
    more, the one with the smallest id (operator 10); texts without words are alone, a null id
    stays only where a group has no other, one of repeated rows stays."""
    return near_dedup.dedup(spark, docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2 in turn, 150 % of all words, a document twice at most;
    a document drawn twice is there twice (operator 1).  Rows come shard by shard, each
    shard shuffled.  A null source is one of its own, texts without words go with their parcel."""
    plan = mixing.Mix(spark, docs, mixing.cyclic_weights(3, 1, 2))
    return plan.mix().orderBy(*plan.added).select(*[f"`{c}`" for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the checksum of the text they decode to (operator 9):
    doc_id, n_tokens, token_ids, decoded_sha256; no tokens for a null or empty text."""
    return bpe.encode(spark, docs, bpe.tokenizer_path())


STAGES = [("language_id", language), ("exact_dedup", exact), ("minhash_near_dedup", near),
          ("mix_sources", mix), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
