"""Schemas and job settings.

Two table shapes carry everything:

* a *documents* table, one row per document (``DOCUMENT``);
* an *annotated* table: the same rows plus ``annotations``, an array of
  annotation structs, with ``execution_ms`` and ``error``.

Annotations stay nested beside their document. Selecting, windowing, counting,
grouping and rendering are per-document work, so on the nested form they need
no shuffle, and two documents that share an ID are never mixed up. Questions
across documents explode the array first (``operators.select.explode_annotations``).

Offsets count code points inside the engine, as Spark's string functions do.
Exporters convert to UTF-16 units where a document has characters past U+FFFF.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.column import Column

STRING_MAP = T.MapType(T.StringType(), T.StringType())

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("id_attrs", STRING_MAP),
        T.StructField("text", T.StringType()),
        T.StructField("features", STRING_MAP),
        T.StructField("mime_type", T.StringType()),
        T.StructField("encoding", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("document_length", T.LongType()),
        T.StructField("load_error", T.StringType()),
    ]
)

ANNOTATION = T.StructType(
    [
        T.StructField("set_name", T.StringType()),  # '' is the default set
        T.StructField("ann_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("features", STRING_MAP),
    ]
)

ANNOTATIONS = T.ArrayType(ANNOTATION)

RESULT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("doc_id", T.StringType()),
        T.StructField("return_code", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("document_length", T.LongType()),
        T.StructField("execution_ms", T.LongType()),
        T.StructField("annotation_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("error", T.StringType()),
    ]
)

SUCCESS = "SUCCESS"
FAIL = "FAIL"


@dataclass(frozen=True)
class Selection:
    """One annotation set and the types wanted from it; no types means all."""

    set_name: str | None = ""
    types: Sequence[str] = ()

    @property
    def set_key(self) -> str:
        return self.set_name or ""


@dataclass
class Output:
    """One output of a run: where, in which form, and of which documents.

    ``form`` is one of ``json``, ``standoff``, ``xml`` (inline), ``xces``,
    ``text``, ``parquet``, ``push``, ``custom`` or ``none``. ``layout`` is
    ``files`` (one file per document) or ``chunks`` (many JSON documents per
    file). A custom output is ``options["write"]``: a function of the annotated
    rows (with ``row_id``), this output and a key for the write, that writes them
    and returns the rows it failed for (``row_id``, ``error``) or None.
    """

    form: str
    path: str | None = None
    selections: Sequence[Selection] = ()
    condition_feature: str | None = None
    layout: str = "files"
    options: dict[str, Any] = field(default_factory=dict)


@dataclass
class JobSpec:
    """A whole run.

    ``ids`` is a DataFrame with ``doc_id`` and optionally ``id_attrs`` (several
    are concatenated in order, duplicates kept); ``load`` turns such IDs into
    documents. A source of unknown length (a JSON stream) gives ``documents``
    directly and no ``ids``. ``application`` is what ``operators.annotate``
    accepts, and ``ledger`` is the report table's directory.
    """

    job_id: str
    ledger: str
    application: Any
    ids: DataFrame | Sequence[DataFrame] | None = None
    load: Callable[[DataFrame], DataFrame] | None = None
    documents: DataFrame | None = None
    outputs: Sequence[Output] = ()
    restart_key: str = "text"

    def __post_init__(self) -> None:
        if not self.ledger:
            raise ValueError("a job needs a report location")
        if (self.documents is None) == (self.ids is None):
            raise ValueError("give either ids with a loader, or documents")
        if self.ids is not None and self.load is None:
            raise ValueError("ids need a loader")
        if self.restart_key not in ("text", "full"):
            raise ValueError("restart_key is 'text' or 'full'")


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def as_documents(
    df: DataFrame,
    doc_id: str | Column,
    text: str | Column,
    *,
    features: Column | None = None,
    id_attrs: Column | None = None,
    file_size: Column | None = None,
    mime_type: str | None = None,
    load_error: Column | None = None,
) -> DataFrame:
    """Project any table onto ``DOCUMENT``. Bytes default to the UTF-8 size."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.col(text) if isinstance(text, str) else text
    return df.select(
        doc_id.cast("string").alias("doc_id"),
        (empty_map() if id_attrs is None else id_attrs).alias("id_attrs"),
        text.alias("text"),
        (empty_map() if features is None else features).alias("features"),
        F.lit(mime_type).cast("string").alias("mime_type"),
        F.lit("UTF-8").alias("encoding"),
        (F.octet_length(text) if file_size is None else file_size).cast("long").alias("file_size"),
        F.length(text).cast("long").alias("document_length"),
        F.coalesce(F.lit(None).cast("string") if load_error is None else load_error, F.when(text.isNull(), F.lit("no content"))).alias("load_error"),
    )
