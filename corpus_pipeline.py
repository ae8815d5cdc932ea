"""From raw documents to packed sequences, in five stages over one table.

Each stage takes all that the one before has kept, and its output is written and read again. The first
four drop documents and return the columns of ``documents``; the last packs what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailtide.llm import decontaminate, near_dedup, packing, quality_classifier, quality_rules
from retailtide.llm.components import written
from retailtide.llm.shipping import ship
from retailtide.llm.tokens import vocabulary


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labelled ones, does not reject."""
    model = quality_classifier.train(spark, docs, _read(spark, sf_dir, "labels"))
    return quality_classifier.filter_documents(docs, model)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the current policy of the quality rules."""
    ship(spark)
    return quality_rules.filter_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return near_dedup.filter_documents(ship(spark), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold enough of a benchmark item to count as contaminated."""
    found = written(decontaminate.find(docs, _read(spark, sf_dir, "benchmark")), "contamination")
    return decontaminate.drop_found(docs, found)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents with their places in sequences of 4096 tokens."""
    ship(spark)
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can express neither the trained classifier nor the tokens; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
