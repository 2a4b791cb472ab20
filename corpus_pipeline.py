"""The corpus pipeline: from raw documents to token ids.

Five stages, each applying one operator to all that the stage before kept. SQL cannot
express the classifier, the sketches or the piece encoding, so there is no SQL for
the whole; tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from annoflow.llm import decontaminate, line_dedup, near_dup, pieces, quality
from annoflow.llm.common import keep_matching, one_row_each, shielded, table, with_key
from annoflow.session import temporary_tables, written

PIECE_MODEL = "piece_bpe_32k.model"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, does not reject."""
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    safe, back = shielded(docs, "doc_id", "text")
    return back(quality.score_rows(safe, trees).where("predicted = 1"))


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line; n_chars goes with the text."""
    kept = line_dedup.without_lines(docs, line_dedup.later_lines(docs))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("long"))
    return kept


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    classes = near_dup.near_classes(docs)
    gone = classes.groupBy("key").agg(F.max("kept").alias("kept")).where(~F.col("kept"))
    safe, back = shielded(docs, "doc_id", "text")
    return back(one_row_each(keep_matching(with_key(safe), gone, "key", "left_anti")))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    safe, back = shielded(docs, "doc_id", "text")
    return back(keep_matching(with_key(safe), found.where("contaminated"), "key", "left_anti"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their digest and that of the text they decode to."""
    return pieces.encode_documents(docs, public_tokenizers.path(PIECE_MODEL), with_ids=True)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", new_lines),
    ("near_dedup", one_of_each),
    ("decontamination", uncontaminated),
    ("sentencepiece", token_ids),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # what a stage writes for itself goes when its result is there
        with temporary_tables(spark):
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
