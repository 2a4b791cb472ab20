"""Which documents a run is about: ID tables ``(doc_id, id_attrs)``."""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

from annoflow.fixed_values import (
    DEFAULT_EXCLUDE_STATUS,
    RECORD_LENGTH,
    RECORD_OFFSET,
    RECORD_POSITION,
    UNKNOWN_STATUS,
)
from annoflow.functions.globs import path_matches
from annoflow.model import empty_map
from annoflow.operators.totals import with_running_total


def explicit_ids(df: DataFrame, doc_id: str | Column, id_attrs: Column | None = None) -> DataFrame:
    """IDs from any table, each optionally with attributes."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return df.select(
        doc_id.cast("string").alias("doc_id"),
        (empty_map() if id_attrs is None else id_attrs).alias("id_attrs"),
    )


def with_prefix(ids: DataFrame, prefix: str | None) -> DataFrame:
    return ids.withColumn("doc_id", F.concat(F.lit(prefix), "doc_id")) if prefix else ids


def ids_from_lines(
    spark: SparkSession, path: str, prefix: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """One ID per line of a text file, trimmed. A blank line is an empty ID."""
    lines = spark.read.text(path)
    if "\n".encode(encoding) != b"\n":
        raise ValueError(f"lines cannot be found in {encoding} text; convert it first")
    if codecs.lookup(encoding).name != "utf-8":
        lines = _decoded_lines(lines, encoding)
    return list_ids(lines, "value", prefix)


def _decoded_lines(lines: DataFrame, encoding: str) -> DataFrame:
    """Lines read as they are in the file, decoded from their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [v.decode(encoding, "replace") for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])

    return lines.select(F.col("value").cast("binary")).mapInArrow(run, "value string")


def list_ids(lines: DataFrame, column: str, prefix: str | None = None) -> DataFrame:
    """IDs from a column of lines: outer whitespace off, prefix on."""
    trimmed = F.regexp_replace(F.col(column), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return with_prefix(explicit_ids(lines, trimmed), prefix)


def union_ids(sources: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """Several ID tables in order, duplicates kept; ``src_ord`` says which one.

    ``distinct`` keeps one row per ID text and attributes.
    """
    if not sources:
        raise ValueError("no ID sources")
    parts = [s.withColumn("src_ord", F.lit(i)) for i, s in enumerate(sources)]
    ids = parts[0]
    for part in parts[1:]:
        ids = ids.unionByName(part)
    if distinct:
        entries = F.array_sort(F.map_entries("id_attrs"))
        ids = (
            ids.groupBy("doc_id", entries.alias("_attrs"))
            .agg(F.min("src_ord").alias("src_ord"))
            .select("doc_id", F.map_from_entries("_attrs").alias("id_attrs"), "src_ord")
        )
    return ids


def in_order(ids: DataFrame) -> DataFrame:
    """IDs sorted by text, so that listings repeat."""
    return ids.orderBy("doc_id")


def matching_ids(
    ids: DataFrame,
    includes: str | Iterable[str] | None = None,
    excludes: str | Iterable[str] | None = None,
    default_excludes: str | bool | None = None,
) -> DataFrame:
    return ids.filter(path_matches(F.col("doc_id"), includes, excludes, default_excludes))


# --- archive records -------------------------------------------------------


def with_positions(records: DataFrame, archive: str = "archive", order_by: str = "offset") -> DataFrame:
    """Number the records of each archive from 0 by offset, as ``position``.

    For tables of records; the archive readers number as they read.
    """
    return with_running_total(
        records, F.lit(1), "position", order_by=[order_by], group_by=archive
    )


def status_matches(status: Column, include: str | None = None, exclude: str | None = None) -> Column:
    """Whole-match status filters.

    With neither pattern given, redirects and errors are excluded. An empty
    exclude excludes nothing. A record without a status counts as the text
    ``_not_found_``.
    """
    if exclude is None and not include:
        exclude = DEFAULT_EXCLUDE_STATUS
    status = F.coalesce(status, F.lit(UNKNOWN_STATUS))
    kept = F.lit(True)
    if include:
        kept &= status.rlike(f"^(?:{include})$")
    if exclude:
        kept &= ~status.rlike(f"^(?:{exclude})$")
    return kept


def mime_matches(mime: Column, wanted: str | None) -> Column:
    """Whether a type starts with any of a whitespace-separated list."""
    types = (wanted or "").split()
    kept = F.lit(not types)
    for one in types:
        kept |= F.coalesce(mime.startswith(one), F.lit(False))
    return kept


def record_ids(
    records: DataFrame,
    *,
    include_status: str | None = None,
    exclude_status: str | None = None,
    mime_types: str | None = None,
    with_archive: bool = True,
) -> DataFrame:
    """IDs of archive records worth processing.

    Leaves out the archive's own header (position 0), empty bodies, and what the
    status and type filters reject. Positions were given before any filter.
    """
    wanted = wanted_records(include_status, exclude_status, mime_types)
    return records.filter(wanted).select(F.col("url").alias("doc_id"), record_attrs(with_archive).alias("id_attrs"))


def record_attrs(with_archive: bool) -> Column:
    """Where a record stands, as the attributes of its ID."""
    attrs = [
        F.lit(RECORD_OFFSET), F.col("offset").cast("string"),
        F.lit(RECORD_LENGTH), F.col("length").cast("string"),
        F.lit(RECORD_POSITION), F.col("position").cast("string"),
    ]
    return F.create_map(*attrs, *([F.lit("url"), F.col("archive")] if with_archive else []))


def wanted_records(include_status: str | None, exclude_status: str | None, mime_types: str | None) -> Column:
    return (
        (F.col("position") > 0)
        & (F.col("body_length") > 0)
        & F.col("is_document")
        & status_matches(F.col("status"), include_status, exclude_status)
        & mime_matches(F.col("mime"), mime_types)
    )
