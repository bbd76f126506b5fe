"""Corpus cleaning pipeline over ``documents``: a chain of the operators in ``shelfspark.llm``.

Every stage works on all rows its predecessor kept. The stages before the last
return the columns of ``documents``; the last returns token counts and digests
of what remains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from shelfspark.llm.common import read, stored
from shelfspark.llm.queries import tokenizer_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold stay; labels are learned from rows that are not held out."""
    return toxicity.acceptable(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: 3-word shingles, at most 3 differing bits."""
    return simhash.keep_one(docs, words=3, bits=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item stay."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"), decontaminate.AGREE)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every remaining document."""
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [("toxicity", reject_toxic), ("exact_dedup", drop_copies), ("simhash_near_dedup", drop_near_copies),
          ("decontamination", decontaminated), ("bpe", tokenized)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each stage's rows written and read again."""
    docs = read(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs


# Scores, fingerprints, seeds and BPE are beyond SQL; tests/llm holds the chain against a brute-force version.
ORACLE_SQL = None
