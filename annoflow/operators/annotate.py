"""Running an annotation application over documents.

``annotate`` runs user code one document at a time inside ``mapInArrow``: one
application copy per task, started at the first document, finished or aborted
once. A document whose processing raises becomes a failed row and the others go
on. ``annotate_batches`` is the same for annotators that work on whole Arrow
batches; ``Splitter`` is such an annotator and gives the token and line
annotations that the queries use.

Neither shuffles. Rows leave in the partition they came in, so the parallelism
is that of the scan; ``balanced`` evens it out where sources are lumpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from operator import index
from time import perf_counter
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_type

from annoflow.model import ANNOTATION, ANNOTATIONS

_ANNOTATION_ARROW = to_arrow_type(ANNOTATION)
_ANNOTATIONS_ARROW = to_arrow_type(ANNOTATIONS)

NO_MESSAGE = "Internal error"


def annotated_schema(docs: DataFrame) -> T.StructType:
    return T.StructType(
        list(docs.schema.fields)
        + [
            T.StructField("annotations", ANNOTATIONS),
            T.StructField("execution_ms", T.LongType()),
            T.StructField("error", T.StringType()),
        ]
    )


def balanced(docs: DataFrame) -> DataFrame:
    """Spread a scan that cannot keep the cluster busy; leave any other alone.

    ``docs`` must be a plain scan with projections and filters. A scan with at
    least two partitions per core is kept as it is, so what this shuffles is
    bounded by two ``spark.sql.files.maxPartitionBytes`` per core, however large
    the table. It serves tables stored as a few large row groups.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() >= 2 * cores:
        return docs
    return docs.repartition(2 * cores)


def message_of(error: BaseException) -> str:
    return str(error) or NO_MESSAGE


def annotate(docs: DataFrame, application: Callable[[], Any]) -> DataFrame:
    """Run ``application`` over every document.

    ``application`` is a factory called once per task. It returns either a
    function ``doc -> annotations`` or an object with ``annotate(doc)`` and
    optionally ``setup()``, ``finish()`` and ``abort(error)``. ``doc`` is a dict
    of the document's columns; changes to ``doc["features"]`` and ``doc["text"]``
    are kept. Each annotation is a dict with ``type``, ``start``, ``end`` and
    optionally ``set_name``, ``features`` and ``ann_id``.

    ``MemoryError`` and anything raised by ``setup`` end the task, not just the
    document.
    """
    schema = annotated_schema(docs)
    arrow_schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        app = None
        try:
            for batch in batches:
                if app is None:
                    app = application()
                    _hook(app, "setup")
                call = app if not hasattr(app, "annotate") else app.annotate
                for part in small_parts(batch):
                    rows = [_annotate_one(call, row) for row in part.to_pylist()]
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)
        except GeneratorExit:
            _hook(app, "abort", None)
            raise
        except BaseException as error:
            _hook(app, "abort", error)
            raise
        _hook(app, "finish")

    return docs.mapInArrow(run, schema)


def small_parts(batch: pa.RecordBatch, characters: int = 1 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``characters`` of text each, so that
    what is built beside the text stays small however long texts are."""
    size = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size, dtype=np.int64) // characters
    edges = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1, [batch.num_rows]])
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if end > begin:
            yield batch.slice(begin, end - begin)


def _hook(app: Any, name: str, *args: Any) -> None:
    hook = getattr(app, name, None)
    if hook is not None:
        hook(*args)


def _annotate_one(call: Callable[[dict], Iterable[dict]], row: dict) -> dict:
    row["annotations"], row["error"], row["execution_ms"] = [], row.get("load_error"), 0
    if row["error"] is not None:
        return row
    features = dict(row["features"] or ())
    doc = {**row, "features": dict(features), "id_attrs": dict(row["id_attrs"] or ())}
    began = perf_counter()
    try:
        found = [_annotation(a, i) for i, a in enumerate(call(doc) or ())]
        features = [(str(k), _as_text(v)) for k, v in doc["features"].items()]
        text = _as_text(doc["text"])
        for a in found:
            if not 0 <= a["start"] <= a["end"] <= len(text or ""):
                raise ValueError(f"annotation {a['ann_id']} ({a['start']} to {a['end']}) lies outside the text")
    except MemoryError:
        raise
    except Exception as error:
        row["error"] = message_of(error)
        return row
    row["annotations"] = found
    row["features"], row["text"] = features, text
    row["execution_ms"] = int((perf_counter() - began) * 1000)
    return row


def _annotation(given: dict, number: int) -> dict:
    features = given.get("features") or {}
    return {
        "set_name": str(given.get("set_name") or ""),
        "ann_id": index(given.get("ann_id", number)),
        "type": str(given["type"]),
        "start": index(given["start"]),
        "end": index(given["end"]),
        "features": [(str(k), _as_text(v)) for k, v in features.items()],
    }


def _as_text(value: Any) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


# --- annotators over whole Arrow batches -----------------------------------

BatchAnnotator = Callable[[pa.RecordBatch], pa.ListArray]


def annotate_batches(docs: DataFrame, *annotators: BatchAnnotator) -> DataFrame:
    """Run annotators that turn a batch of documents into a list column.

    Their results are put side by side for each document and numbered. If an
    annotator raises, its batch is run again document by document, so that only
    the documents at fault fail. ``execution_ms`` is the batch's time shared out
    by text length.
    """
    schema = annotated_schema(docs)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_parts(batch):
                yield from _annotate_batch(part, names, annotators)

    return docs.mapInArrow(run, schema)


def _annotate_batch(batch, names, annotators) -> Iterator[pa.RecordBatch]:
    loaded = pc.is_null(batch.column("load_error"))
    began = perf_counter()
    try:
        found = _side_by_side([a(batch) for a in annotators], loaded)
    except MemoryError:
        raise
    except Exception as error:
        if batch.num_rows > 1:
            for i in range(batch.num_rows):
                yield from _annotate_batch(batch.slice(i, 1), names, annotators)
            return
        found = pa.array([[]], type=_ANNOTATIONS_ARROW)
        errors = pa.array([message_of(error)], type=pa.string())
        spent = pa.array([0], type=pa.int64())
    else:
        errors = batch.column("load_error")
        size = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        total = max(int(size.sum()), 1)
        spent = pa.array(((perf_counter() - began) * 1000 * size / total).astype(np.int64))
    yield pa.RecordBatch.from_arrays(
        [*(batch.column(n) for n in names), found, spent, errors],
        names=[*names, "annotations", "execution_ms", "error"],
    )


def _side_by_side(lists: Sequence[pa.ListArray], loaded: pa.Array) -> pa.ListArray:
    """Concatenate several list columns row by row and number the items."""
    rows = len(loaded)
    counts = np.zeros((len(lists), rows), dtype=np.int64)
    parts, places = [], []
    for i, column in enumerate(lists):
        offsets = np.asarray(column.offsets, dtype=np.int64)
        counts[i] = np.diff(offsets)
        parts.append(column.values.slice(offsets[0], offsets[-1] - offsets[0]))
    totals = counts.sum(axis=0)
    bounds = np.concatenate([[0], np.cumsum(totals)])
    before = np.vstack([np.zeros((1, rows), np.int64), np.cumsum(counts, axis=0)[:-1]])
    for i in range(len(lists)):
        first = np.repeat(bounds[:-1] + before[i], counts[i])
        within = np.arange(counts[i].sum()) - np.repeat(np.cumsum(counts[i]) - counts[i], counts[i])
        places.append(first + within)
    order = np.empty(int(bounds[-1]), dtype=np.int64)
    order[np.concatenate(places)] = np.arange(len(order))
    items = pa.concat_arrays(parts).take(pa.array(order))
    numbers = np.arange(len(order)) - np.repeat(bounds[:-1], totals)
    fields = [items.field(f.name) for f in _ANNOTATION_ARROW]
    fields[1] = pa.array(numbers)
    items = pa.StructArray.from_arrays(fields, fields=list(_ANNOTATION_ARROW))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items).cast(_ANNOTATIONS_ARROW)


class Splitter:
    """Annotates the non-empty pieces of each text between separators.

    ``types`` maps a type to a regular expression the whole piece must match,
    tried in order; pieces that match none get ``default_type``. With
    ``number_feature`` each piece carries its 0-based number among all pieces of
    the text, empty ones included.
    """

    def __init__(
        self,
        separator: str,
        set_name: str,
        default_type: str,
        types: Sequence[tuple[str, str]] = (),
        number_feature: str | None = None,
    ) -> None:
        self.separator = separator
        self.set_name = set_name
        self.default_type = default_type
        self.types = tuple(types)
        self.number_feature = number_feature

    def __call__(self, batch: pa.RecordBatch) -> pa.ListArray:
        text = batch.column("text").cast(pa.large_string())
        pieces = pc.split_pattern(pc.fill_null(text, ""), self.separator)
        offsets = np.asarray(pieces.offsets, dtype=np.int64)
        offsets = offsets - offsets[0]
        flat = pieces.flatten()
        counts = np.diff(offsets)
        size = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
        step = size + len(self.separator)
        before = np.cumsum(step) - step
        start = before - np.repeat(before[offsets[:-1]], counts)
        number = np.arange(len(flat)) - np.repeat(offsets[:-1], counts)

        kept = size > 0
        row = np.repeat(np.arange(len(counts)), counts)[kept]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(counts)))])
        flat = flat.filter(pa.array(kept))
        start, size, number = start[kept], size[kept], number[kept]
        n = len(start)
        items = pa.StructArray.from_arrays(
            [
                pa.repeat(pa.scalar(self.set_name), n),
                pa.array(np.zeros(n, np.int64)),
                self._types(flat),
                pa.array(start),
                pa.array(start + size),
                self._features(number),
            ],
            fields=list(_ANNOTATION_ARROW),
        )
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items)

    def _types(self, flat: pa.Array) -> pa.Array:
        out = pa.repeat(pa.scalar(self.default_type), len(flat))
        for name, pattern in reversed(self.types):
            matched = pc.match_substring_regex(flat, pattern)
            out = pc.if_else(matched, pa.scalar(name), out)
        return out

    def _features(self, number: np.ndarray) -> pa.Array:
        n = len(number)
        kind = pa.map_(pa.string(), pa.string())
        if self.number_feature is None:
            return pa.MapArray.from_arrays(
                pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.string()), pa.array([], pa.string())
            )
        return pa.MapArray.from_arrays(
            pa.array(np.arange(n + 1, dtype=np.int32)),
            pa.repeat(pa.scalar(self.number_feature), n),
            pa.array(number).cast(pa.string()),
        ).cast(kind)


def tokens() -> Splitter:
    """Space-separated tokens in the default set."""
    return Splitter(
        " ",
        "",
        "Token",
        types=[
            ("Email", r"^[^@\s]+@[^@\s]+\.[A-Za-z]+$"),
            ("Capitalised", r"^[A-Z][a-z]+$"),
        ],
    )


def lines() -> Splitter:
    """Lines in the set ``Layout``, numbered from 0."""
    return Splitter("\n", "Layout", "Line", number_feature="number")
