"""What tasks hold at a time, and what is computed once."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from annoflow.functions import render
from annoflow.operators.annotate import small_parts, tokens
from annoflow.plans import catalog, ledger as ledgers
from annoflow.sinks import chunks
from annoflow.sources import json_stream

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


class _Given:
    """A table of one batch, whose function is run here."""

    def __init__(self, batch):
        self.batch = batch

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return list(run(iter([self.batch])))


def test_chunks_render_each_row_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def text(n):
        calls.add(1)
        return f"{n}" if n % 3 else None

    rows = spark.range(9).select(F.udf(text, "string")("id").alias("rendered"))
    wrote = chunks.write_chunks(rows, str(tmp_path / "out"))
    assert sum(r["docs"] for r in wrote.collect()) == 6
    assert calls.value == 9


def test_chunk_writers_hold_few_texts(monkeypatch):
    sizes = []

    class Column:
        def __len__(self):
            return 1000

        def slice(self, begin, size):
            sizes.append(size)
            return pa.array(["a", None] * 500).slice(begin, size)

    assert list(chunks._texts(Column())) == ["a"] * 500
    assert max(sizes) <= 100


def test_a_ledger_that_is_not_there_needs_no_python(spark, tmp_path):
    empty = ledgers.read_ledger(spark, str(tmp_path / "none"))
    assert "ExistingRDD" not in plan_of(empty)
    assert empty.isEmpty() and empty.schema.simpleString() == ledgers.ledger_schema().simpleString()


def test_named_files_are_taken_in_small_parts():
    batch = pa.RecordBatch.from_pydict({"rendered": ["x" * 1000] * 20})
    assert [p.num_rows for p in small_parts(batch, 5000, "rendered")] == [4, 5, 5, 5, 1]


def test_lines_are_made_compact_in_small_parts():
    texts = pa.RecordBatch.from_pydict({"value": ['{"a" : "%s"}' % ("x" * 300_000)] * 10})
    parts = json_stream.compact(_Given(texts), "value")
    assert len(parts) > 2 and sum(p.num_rows for p in parts) == 10


def test_annotators_are_given_about_a_million_characters():
    batch = pa.RecordBatch.from_pydict({"text": ["ab " * 100_000] * 20})
    parts = list(small_parts(batch))
    assert sum(p.num_rows for p in parts) == 20
    assert max(p.num_rows for p in parts) * 300_000 < 2 << 20


@pytest.mark.parametrize("features", [False, True])
def test_inline_sends_only_what_tags_need(spark, features):
    found = catalog.annotate_batches(catalog.documents(spark, SF), tokens())
    plan = render.with_inline(found, include_features=features)._jdf.queryExecution().analyzed()
    sent = plan.children().head().schema().apply("annotations").dataType().simpleString()
    assert "set_name" not in sent and ("features" in sent) == features


def test_type_as_property_does_not_sort_annotations(spark):
    plan = plan_of(catalog.QUERIES["type_as_property"](spark, SF))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
