"""From raw documents to packed training sequences: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import decontaminate, line_dedup, ngram_join, packing, queries, toxicity
from fareflow.llm.store import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents it rejects go."""
    weights = queries.toxicity_weights(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, weights)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: lines found in three documents stay in one; a document that loses all its lines stays, empty."""
    cleaned = line_dedup.dedup_lines(spark, docs, min_chars=20, min_docs=3)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cleaned.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies the smallest id stays."""
    return ngram_join.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold benchmark items go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: sequences of 2,048 words."""
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

# A learnt score and a packing are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
