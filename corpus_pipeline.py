"""The document pipeline: language ID, quality, near-duplicates, packing.

Every stage reads all that its predecessor kept, written as Parquet. The first three return the
columns of `documents`, the last one the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cindermill.llm import jaccard, langid, packing, quality
from cindermill.llm.common import id_remainder, materialise, table
from cindermill.llm.queries import JSON_TOKENIZER


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; the filters are learned from the incoming rows outside the held-out part."""
    return langid.keep_identified(docs, langid.fit(docs.where(id_remainder("doc_id", 4) != 2)))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is within their language's threshold."""
    return quality.keep_documents(docs, table(spark, sf_dir, "labels").where("quality = 1"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8), the one with the smallest id."""
    return jaccard.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents."""
    return packing.pack_documents(docs, public_tokenizers.path(JSON_TOKENIZER), public_tokenizers.PATTERN, added_tokens=True)


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", distinct), ("packing", pack)]

#: Learned models and token ids have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
