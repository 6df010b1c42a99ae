"""From raw documents to packed sequences: five stages, each written and read again.

Every stage but the last returns the columns of ``documents``. Language and toxicity
stages fit their models on the documents given to ``sf_dir`` and drop what they reject;
the two deduplication stages keep one document of each group, near copies by the SimHash
operator with the numbers of its contract (four-word shingles, at most four bits); packing
returns pieces.

Nulls, empty texts, repeated ids and empty tables are treated as the five operators state:
language ID rejects a null or blank text, the classes of both deduplication stages hold all
rows with one text or fingerprint, and a row without a doc_id stays where no class names it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import exact, language, packing, simhash, toxicity
from corpusloom.llm.base import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, language.fitted(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.harmless(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.without_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), "word")


STAGES = [
    ("language_id", language_id),
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("best_fit_packing", pack),
]

#: No SQL: trained models and a fitted packing; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
