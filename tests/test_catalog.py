"""Every registered query against its SQL, and the plans that must hold at scale."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from annoflow.operators.totals import with_chunk
from annoflow.plans import catalog, ledger as ledgers

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = [tuple(r[c] for c in names) for r in df.collect()]
    want = duck.sql(catalog.SQL[name])
    assert sorted(want.columns) == names
    places = [want.columns.index(c) for c in names]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(got, key=key) == sorted((tuple(r[i] for i in places) for r in want.fetchall()), key=key)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_annotating_and_rendering_do_not_shuffle(spark):
    """Beyond spreading a scan too small for the cluster, which is bounded."""
    for name in ("annotation_counts_by_key", "json_render", "document_window", "standoff_render", "inline_render"):
        plan = plan_of(catalog.QUERIES[name](spark, SF))
        assert plan.count("Exchange") == plan.count("Exchange RoundRobinPartitioning") <= 1, name


def test_columns_are_pruned(spark):
    plan = plan_of(catalog.QUERIES["token_annotations"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "ReadSchema: struct<doc_id:bigint>" in plan_of(catalog.QUERIES["restart_unprocessed"](spark, SF))


def test_finished_work_is_dropped_before_annotating(spark):
    docs = catalog.documents(spark, SF)
    done = catalog._ledger(spark, SF)
    plan = plan_of(catalog.annotate_batches(ledgers.unprocessed(docs, done), catalog.tokens()))
    assert plan.index("MapInArrow") < plan.index("LeftAnti")


def test_no_window_over_all_rows(spark):
    sizes = catalog.table(spark, SF, "documents").select("doc_id", F.octet_length("text").alias("s"))
    plan = plan_of(with_chunk(sizes, F.col("s"), 1000, order_by=["doc_id"]))
    assert "SinglePartition" not in plan
