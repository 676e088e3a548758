"""Corpus pipeline: documents through five operators, one written table per stage.

Toxic documents go, one document of each near-duplicate group stays, personal data is replaced, the
sources are mixed to their weights, and what is left is encoded into pieces. Every stage works on all
rows of its predecessor.

Odd rows, in every stage: null and empty texts count as empty texts, and very long ones are taken whole; null ids
and sources are values of their own; repeated rows stay repeated where the stage says nothing else; ties go by the
operators' rules; columns beyond the documents' own pass through, whatever their names; empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import mixing, pieces, simhash, surrogates, toxicity
from shoplake.llm.common import materialize, prepare, table
from shoplake.llm.queries import PIECES, SURROGATE_KEY


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under 0.7; the classifier learns from the labelled ones among them.

    Empty and null texts are scored as texts without n-grams; rows without an id are never learnt from.
    """
    prepare(spark)
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of SimHash near-duplicates.

    Null, empty and white texts have the fingerprint zero and so form a group; of repeated rows one stays; rows
    without an id are a group's last choice.
    """
    prepare(spark)
    return simhash.deduplicated(docs)


def surrogate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the new text. Null texts stay null."""
    prepare(spark)
    replaced = surrogates.pseudonymised(docs, SURROGATE_KEY)
    n_chars = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", n_chars).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources (weights 5, 2, 1) takes them: not at all to three times, empty ones
    included. Rows equal in id and text are taken equally often."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row, and whether the text decoded from them is the text that was encoded."""
    prepare(spark)
    segmenter = pieces.Segmenter(pieces.Vocabulary.read(public_tokenizers.path(PIECES)))
    slim = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    decoded = pieces.decode(pieces.encode(slim, segmenter, keep_text=True), segmenter)
    return decoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_dedup", dedup_stage),
    ("pii_surrogates", surrogate_stage),
    ("source_mixing", mixing_stage),
    ("piece_encoding", pieces_stage),
]

# The classifier, the fingerprints and the segmentation are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
