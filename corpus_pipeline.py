"""Corpus preparation as a chain of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result
is written as Parquet and read again as the next stage's ``docs``, so a lost
executor costs a stage's open tasks and no more.  All stages but the last
return the columns of ``documents``.

The mixing stage aims at the sources' root-tempered shares of what the
stages before it kept; an id may occur several times behind it, and the
packing stage packs each occurrence.

Defined cases are those of the operators; every stage accepts an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from genoflux.llm import exact_dedup, jaccard_join, mixing, packing, quality_rules
from genoflux.llm.common import table
from genoflux.llm.queries import vocabulary
from genoflux.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one of the largest id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the smallest id."""
    return jaccard_join.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights and shuffled."""
    return mixing.mix(docs, mixing.tempered(docs)).drop("__copy", "__copies", "__order")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("ngram_jaccard_join", near),
          ("mixing", mixture), ("packing", packed)]

#: Learned rules, Jaccard classes and token packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict = {}
