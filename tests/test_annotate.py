import pytest
from pyspark.sql import functions as F

from annoflow.model import as_documents
from annoflow.operators.annotate import annotate, annotate_batches, lines, tokens
from annoflow.plans.ledger import result_rows


@pytest.fixture
def docs(spark):
    rows = [("a", "Hello big world"), ("b", "x  y\nZed a@b.cc"), ("c", ""), ("d", None)]
    return as_documents(spark.createDataFrame(rows, "doc_id string, text string"), "doc_id", "text")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def spans(row_annotations):
    return [(a["set_name"], a["ann_id"], a["type"], a["start"], a["end"]) for a in row_annotations]


def test_tokens_and_lines(docs):
    found = by_id(annotate_batches(docs, tokens(), lines()), "annotations", "error")
    assert spans(found["b"][0]) == [
        ("", 0, "Token", 0, 1),
        ("", 1, "Token", 3, 8),  # 'y\nZed' has no space in it
        ("", 2, "Email", 9, 15),
        ("Layout", 3, "Line", 0, 4),
        ("Layout", 4, "Line", 5, 15),
    ]
    assert [a["features"] for a in found["b"][0]][-1] == {"number": "1"}
    assert spans(found["a"][0])[0] == ("", 0, "Capitalised", 0, 5)
    assert found["c"] == ([], None)
    assert found["d"] == ([], "no content")


def test_offsets_are_code_points(spark):
    df = as_documents(spark.createDataFrame([("a", "é😀 b")], "doc_id string, text string"), "doc_id", "text")
    row = annotate_batches(df, tokens()).first()
    assert spans(row["annotations"]) == [("", 0, "Token", 0, 2), ("", 1, "Token", 3, 4)]


def test_per_document_failure_is_isolated(docs):
    def application():
        def run(doc):
            if doc["doc_id"] == "a":
                raise ValueError("bad document")
            if doc["doc_id"] == "c":
                raise RuntimeError
            if doc["doc_id"] == "e":
                return [{"type": "T", "start": "zero", "end": 1}]
            doc["features"]["seen"] = True
            return [{"type": "T", "start": 0, "end": 1, "features": {"n": 3}}]

        return run

    docs = docs.union(docs.filter("doc_id = 'b'").withColumn("doc_id", F.lit("e")))
    found = by_id(annotate(docs, application), "error", "annotations", "features")
    assert "integer" in found["e"][0] and found["e"][1] == []
    assert found["a"][0] == "bad document"
    assert found["c"][0] == "Internal error"
    assert found["d"][0] == "no content"
    assert found["b"][0] is None
    assert found["b"][1][0]["features"] == {"n": "3"}
    assert found["b"][2] == {"seen": "true"}
    results = by_id(result_rows(annotate(docs, application), "r"), "return_code", "execution_ms")
    assert results["a"] == ("FAIL", 0)
    assert results["b"][0] == "SUCCESS"


def test_batch_annotator_failure_is_isolated(docs):
    def picky(batch):
        if "a" in batch.column("doc_id").to_pylist():
            raise ValueError("no a")
        return tokens()(batch)

    found = by_id(annotate_batches(docs.coalesce(1), picky), "error", "annotations")
    assert found["a"] == ("no a", [])
    assert found["b"][0] is None and len(found["b"][1]) == 3


def test_application_lifecycle(docs, tmp_path):
    log = str(tmp_path)

    class App:
        def setup(self):
            self._note("setup")

        def annotate(self, doc):
            self._note("document")
            if doc["doc_id"] == "stop":
                raise MemoryError("out")
            return []

        def finish(self):
            self._note("finish")

        def abort(self, error):
            self._note("abort")

        def _note(self, what):
            import os, uuid

            open(os.path.join(log, f"{what}-{uuid.uuid4().hex}"), "w").close()

    def noted(what):
        return len(list(tmp_path.glob(f"{what}-*")))

    annotate(docs.coalesce(1), App).collect()
    assert (noted("setup"), noted("document"), noted("finish"), noted("abort")) == (1, 3, 1, 0)

    stopping = docs.filter("doc_id = 'a'").withColumn("doc_id", F.lit("stop"))
    with pytest.raises(Exception, match="out"):
        annotate(stopping, App).collect()
    assert noted("abort") >= 1
    assert noted("finish") == 1


def test_failing_setup_ends_the_run(docs):
    class App:
        def setup(self):
            raise OSError("no model")

        def annotate(self, doc):
            return []

    with pytest.raises(Exception, match="no model"):
        annotate(docs, App).collect()


@pytest.mark.parametrize("start, end", [(-1, 1), (2, 1), (0, 6)])
def test_annotations_outside_the_text_fail_the_document(spark, start, end):
    docs = as_documents(spark.createDataFrame([("a", "12345"), ("b", "123456")], "id string, body string"), "id", "body")
    found = annotate(docs, lambda: lambda doc: [{"type": "X", "start": start, "end": end}])
    errors = {r.doc_id: r.error for r in found.collect()}
    assert "outside the text" in errors["a"]
    assert ("outside" in (errors["b"] or "")) == (not (start, end) == (0, 6))
