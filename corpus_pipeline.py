"""The documents of a corpus on their way to training data, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import mixing, near_copies, pieces, substrings, toxicity
from factloom.llm.common import table
from factloom.llm.queries import piece_model
from factloom.sources.workspace import stage


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar, learned from all labels, does not reject."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_copies.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; those of which nothing is left go."""
    left = substrings.remove_repeats(docs)
    some = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))
    values = {"n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))}
    return left.where(some).select(*[values.get(c, F.col(c)).alias(c) for c in docs.columns])


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a row for each time that a document is taken."""
    return mixing.mix_documents(docs)


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces."""
    return pieces.encode(docs, piece_model(spark), dropout=0.1, seed=1)


STAGES = [
    ("toxicity", without_toxic),
    ("near-duplicates", without_near_copies),
    ("substrings", without_repeats),
    ("mixing", mixed_to_weights),
    ("sentencepiece", in_pieces),
]

#: The stages learn from labels, cluster and mix by hashes; SQL cannot express them. Tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
