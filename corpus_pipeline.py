"""From raw documents to packed training sequences: five stages, each over all that the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lotledger.llm import exactdedup, mixing, ngramjoin, ordinal, packing
from lotledger.llm.common import table, written
from lotledger.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model grades at least good."""
    return ordinal.scored(docs, table(spark, sf_dir, "labels")).where("keep").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    return exactdedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id."""
    return ngramjoin.deduplicated(docs, n=5, t=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files that follow the interleaved order of the sources."""
    return mixing.interleaved(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences, with their ids, in the order of the documents' files."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER), added=True)


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("mixing sources to target weights", mix), ("packing", pack)]

#: Training, spanning links and byte-pair merges have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
