"""Reports as XML: rendered for export, and read back to resume older work."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

from annoflow.fixed_values import (
    REPORT_COUNT,
    REPORT_DOCUMENTS,
    REPORT_ENTRY,
    REPORT_ENTRY_NUMBERS,
    REPORT_ERROR,
    REPORT_ROOT,
    REPORT_STATISTICS,
    REPORT_SUMMARY,
    REPORT_SUMMARY_FIELDS,
)
from annoflow.functions.render import xml_attribute, xml_text
from annoflow.model import FAIL, SUCCESS
from annoflow.plans import ledger as ledgers
from annoflow.session import temporary_path, temporary_tables
from annoflow.sources import storage

_OPEN = f"<{REPORT_ENTRY} "
_CLOSE = f"</{REPORT_ENTRY}>"


def _element(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), xml_text(value.cast("string")), F.lit(f"</{name}>"))


def _if_known(name: str, size: Column) -> Column:
    return F.when(size >= 0, _element(name, size)).otherwise(F.lit(""))


def result_xml() -> Column:
    """A result row as one entry: sizes and time where known, counts of a
    success, the description of a failure."""
    counts = F.array_join(
        F.transform(
            F.array_sort(F.map_entries("annotation_counts")),
            lambda e: F.concat(
                F.lit(f'<{REPORT_COUNT} type="'),
                xml_attribute(e["key"]),
                F.lit('" count="'),
                e["value"].cast("string"),
                F.lit('"/>'),
            ),
        ),
        "",
    )
    return F.concat(
        F.lit(f'{_OPEN}id="'),
        xml_attribute(F.col("doc_id")),
        F.lit('" returnCode="'),
        F.col("return_code"),
        F.lit('">'),
        *(_if_known(element, F.col(column)) for element, column in REPORT_ENTRY_NUMBERS),
        F.when(
            F.col("return_code") == SUCCESS,
            F.concat(
                F.lit(f"<{REPORT_STATISTICS}>"),
                F.coalesce(counts, F.lit("")),
                F.lit(f"</{REPORT_STATISTICS}>"),
            ),
        ).otherwise(
            F.when(F.col("error").isNotNull(), _element(REPORT_ERROR, F.col("error"))).otherwise("")
        ),
        F.lit(_CLOSE),
    )


def summary_xml() -> Column:
    """A summary row as the closing element of a report."""
    return F.concat(
        F.lit(f"<{REPORT_SUMMARY}>"),
        *(_element(element, F.col(column)) for element, column in REPORT_SUMMARY_FIELDS),
        F.lit(f"</{REPORT_SUMMARY}>"),
    )


def export_xml(results: DataFrame, path: str) -> None:
    """Write a result table as entries, one per line, in as many files as tasks."""
    results.select(result_xml().alias("value")).write.mode("overwrite").text(path)


#: Bytes copied at a time.
_PIECE = 4 << 20


def write_report(results: DataFrame, summary: DataFrame, path: str, namespace: str | None = None) -> None:
    """Write one XML file: the root, the entries of all results, and the summary (the first row of ``summary``).

    Entries are rendered by all tasks into parts; one task then copies the parts, in order and piece by piece, into the
    file, which takes its name when it is whole. ``namespace`` is the root's, for tools that ask for one.
    """
    spark = results.sparkSession
    with temporary_tables(spark):
        parts = temporary_path(spark, "report-parts")
        export_xml(results, parts)
        end = summary.select(summary_xml()).first()[0]
        begin = f'<?xml version="1.0" encoding="UTF-8"?>\n<{REPORT_ROOT}'
        begin += f" xmlns={quoteattr(namespace)}>" if namespace else ">"
        begin += f"\n<{REPORT_DOCUMENTS}>\n"
        end = f"</{REPORT_DOCUMENTS}>\n{end}\n</{REPORT_ROOT}>\n"

        def copy(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in incoming:
                size = _joined(parts, path, begin, end) if batch.num_rows else 0
                yield pa.RecordBatch.from_pydict({"size": [size]})

        spark.range(1, numPartitions=1).mapInArrow(copy, "size long").collect()


def _joined(parts: str, path: str, begin: str, end: str) -> int:
    source, folder = storage.locate(parts)
    system, place = storage.locate(path)
    system.create_dir(posixpath.dirname(place), recursive=True)
    temporary = posixpath.join(posixpath.dirname(place), f".{posixpath.basename(place)}.{uuid.uuid4().hex}")
    names = sorted(i.path for i in source.get_file_info(pafs.FileSelector(folder)) if i.base_name.startswith("part-"))
    with system.open_output_stream(temporary, compression=None) as out:
        out.write(begin.encode())
        for name in names:
            with source.open_input_stream(name, compression=None) as f:
                for piece in storage.chunks_of(f, _PIECE):
                    out.write(piece)
        out.write(end.encode())
        size = out.tell()
    storage.move_over(system, temporary, place)
    return size


def report_of_run(spark: SparkSession, ledger: str, run_id: str, path: str, elapsed_ms: int = 0, namespace: str | None = None) -> None:
    """The report file of a run: what the ledger holds of it, and its summary."""
    own = ledgers.read_ledger(spark, ledger).where(F.col("run_id") == run_id)
    write_report(own, ledgers.summary(own, run_id, elapsed_ms), path, namespace)


def import_xml(spark: SparkSession, path: str) -> DataFrame:
    """Results from reports, whole or cut short; incomplete entries are left out.

    Files are split at the entries themselves, so a large report is read by many
    tasks, and a record counts only if its closing tag was written.
    """
    record = F.col("value")
    body = F.substring_index(record, _CLOSE, 1)

    def text_of(tag: str) -> Column:
        found = F.regexp_extract(body, f"(?s)<{tag}>(.*?)</{tag}>", 1)
        return F.when(body.contains(f"<{tag}>"), _unescaped(found))

    def attribute(name: str) -> Column:
        # Quoted either way; the group of the other quote is empty.
        pattern = rf"""(?s)^(?:[^>]*?\s)?{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
        return _unescaped(
            F.concat(F.regexp_extract(body, pattern, 1), F.regexp_extract(body, pattern, 2))
        )

    counted = F.regexp_extract_all(
        body, F.lit(rf'<{REPORT_COUNT} type="([^"]*)" count="(?:\d+)"'), F.lit(1)
    )
    counts = F.regexp_extract_all(
        body, F.lit(rf'<{REPORT_COUNT} type="(?:[^"]*)" count="(\d+)"'), F.lit(1)
    )
    entries = spark.read.text(path, lineSep=_OPEN)
    return (
        entries.filter(record.contains(_CLOSE))
        .select(
            attribute("id").alias("doc_id"),
            attribute("returnCode").alias("return_code"),
            *(text_of(element).cast("long").alias(column) for element, column in REPORT_ENTRY_NUMBERS),
            F.when(
                F.size(counted) > 0,
                F.map_from_arrays(
                    F.transform(counted, _unescaped), F.transform(counts, lambda c: c.cast("long"))
                ),
            ).alias("annotation_counts"),
            text_of(REPORT_ERROR).alias("error"),
        )
        .filter(F.col("return_code").isin(SUCCESS, FAIL))
    )


def import_report(spark: SparkSession, report: str, ledger: str, run_id: str) -> None:
    """Take an XML report into a ledger, so that a job resumes from it."""
    ledgers.write_results(import_xml(spark, report).withColumn("run_id", F.lit(run_id)), ledger, run_id=run_id)


def _unescaped(value: Column) -> Column:
    plain = value
    for entity, char in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
        ("&#10;", "\n"), ("&#xA;", "\n"), ("&#xa;", "\n"),
        ("&#13;", "\r"), ("&#xD;", "\r"), ("&#xd;", "\r"),
        ("&#9;", "\t"), ("&#x9;", "\t"),
        ("&amp;", "&"),
    ):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return plain
