"""Registered queries against their SQL, and the pipeline against the operators."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from annoflow.llm import decontaminate, near_dup, quality
from annoflow.llm.queries import QUERIES, SQL
from tests_support import CLASHING, brute_lines_of

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    rows = want.select(", ".join(got.columns)).fetchall()
    assert Counter(map(repr, map(tuple, got.collect()))) == Counter(map(repr, rows))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        if name == "quality":
            trees = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r.doc_id for r in quality.score(docs, trees).where("predicted = 1").collect()}
        elif name == "line_dedup":
            want = {r.doc_id for r in before.collect()}
            assert {r.doc_id: r.text for r in kept.collect()} == brute_lines_of(before)
            assert kept.where(F.col("n_chars") != F.length("text")).count() == 0
        elif name == "near_dedup":
            want = {r.doc_id for r in near_dup.near_classes(before).where("kept").collect()}
        else:
            found = decontaminate.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            want = {r.doc_id for r in found.where("NOT contaminated").collect()}
        assert {r.doc_id for r in kept.collect()} == want
    final = corpus_pipeline.run(spark, SF).toPandas()
    assert set(final.doc_id) == {r.doc_id for r in kept.collect()}
    assert final.decoded_equal.all()


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    extra = docs.withColumns({n: F.concat(F.lit(n + "-"), F.col("doc_id").cast("string")) for n in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, extra, SF)
        assert kept.columns == extra.columns, name
        rows = kept.collect()
        assert rows and all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in CLASHING), name
    assert corpus_pipeline.STAGES[-1][1](spark, extra, SF).count() == 120


def test_pipeline_writes_what_stages_read(spark, monkeypatch):
    read = []

    def stage(spark, docs, sf_dir):
        read.append({name.rsplit("/", 2)[-2].rsplit("-", 1)[0] for name in docs.inputFiles()})
        return docs.where("doc_id % 7 != 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage), ("three", stage)])
    corpus_pipeline.run(spark, SF)
    assert read[1:] == [{"stage-one"}, {"stage-two"}]
