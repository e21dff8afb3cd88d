"""From ``documents`` to packed training sequences, in five stages.

Every stage is (name, function); a function takes (spark, docs, sf_dir), works on all rows its
predecessor kept, and returns the columns of ``documents``, but for the last, which returns the
packed pieces. Null texts go with the first stage; an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelrank.llm import decontam, langid, packing, simhash, suffix
from reelrank.llm.common import materialise, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the CRF, trained on the rows that are not held out, can tell."""
    return langid.keep_identified(docs, langid.fit(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (three-word shingles, two bits)."""
    return simhash.keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 200 bytes or more that occur more than once."""
    return suffix.drop_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has neither the models nor the tokenizer; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
