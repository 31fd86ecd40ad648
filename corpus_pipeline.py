"""A training-corpus pipeline over ``documents``, one operator of ``fieldbook.llm`` per stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldbook.llm import exact_dedup, jaccard_join, mixing, quality, sentencepiece_codec
from fieldbook.llm.queries import learning_labels
from fieldbook.plans.tables import load
from fieldbook.session import ensure_defaults, materialize

#: No SQL: the classifier's training and the budget fitting are iterative, and the encoding is no SQL expression.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.7 or more stay."""
    ensure_defaults(spark)
    weights = quality.train(docs, learning_labels(spark, sf_dir))
    return quality.keep_good(docs, weights)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text, that with the largest doc_id stays."""
    ensure_defaults(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of five-word shingles, that with the smallest doc_id stays."""
    ensure_defaults(spark)
    return jaccard_join.drop_near_copies(docs, width=5, threshold=0.8)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source as often as its target weight takes them (0 to 3 times)."""
    ensure_defaults(spark)
    return mixing.mixed_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their SentencePiece ids."""
    ensure_defaults(spark)
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("drop_exact_copies", drop_exact_copies),
    ("drop_near_copies", drop_near_copies),
    ("mix_to_weights", mix_to_weights),
    ("encode_pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again."""
    ensure_defaults(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
