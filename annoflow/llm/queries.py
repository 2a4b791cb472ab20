"""One query for each operator, over its whole tables, with the SQL it must agree
with where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from annoflow.llm import (
    chunk_dedup, decontaminate, exact_dedup, fill_middle, graph_search, licenses, line_dedup, near_dup, pieces, quality, suffix_dedup,
    token_counts, whitening,
)
from annoflow.llm.common import Query, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

PIECE_MODEL = "piece_bpe_32k.model"


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(licenses.LICENSE_SQL)
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.license_scan(licenses.files_of(table(spark, sf_dir, "documents")))
    return scanned.withColumnRenamed("file", "doc_id")


@query(decontaminate.CONTAMINATION_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("key")


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


@query()
def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.chunk_dedup(table(spark, sf_dir, "documents"))


@query()
def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_classes(table(spark, sf_dir, "documents")).drop("key")


@query()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


@query(line_dedup.LINES_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.without_lines(docs.select("doc_id", "text"), line_dedup.later_lines(docs), counts=True)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(text, 256).alias("kept_sha256"))


@query()
def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query(fill_middle.FILL_SQL)
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    output, before = F.col("output"), fill_middle.restored(F.col("form"), F.col("output"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(output.cast("binary"), 256).alias("output_sha256"), F.sha2(before.cast("binary"), 256).alias("restored_sha256"),
    )


@query(exact_dedup.EXACT_SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))
