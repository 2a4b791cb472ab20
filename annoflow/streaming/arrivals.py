"""Documents that arrive as files, annotated as they come.

A file stream feeds ``plans.job.run`` batch by batch. Each batch skips what the
ledger already has, writes its outputs, then its results, both under (run,
batch), so a batch replayed after a crash replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from annoflow.model import JobSpec, Output
from annoflow.plans import ledger as ledgers
from annoflow.plans.job import run
from annoflow.sources.json_stream import compact, json_documents, read_objects


#: Batches after which their small files in the ledger are merged.
MERGE_EVERY = 20
_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def arriving_lines(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """Stream of column ``json`` from newline-delimited files as they appear."""
    return _reader(spark, options).format("text").load(path)


def arriving_files(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """Stream of column ``path`` of the files in a folder as they appear."""
    listed = _reader(spark, options).format("binaryFile").schema(_BINARY_FILE).load(path)
    return listed.select("path")


def _reader(spark: SparkSession, options: dict[str, Any]):
    reader = spark.readStream
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader


def archive_options(folder: str) -> dict[str, str]:
    """Options that move processed files to ``folder``.

    A file is moved when a later batch begins, so the newest ones stay until
    more arrive.
    """
    return {"cleanSource": "archive", "sourceArchiveDir": folder}


def annotate_stream(
    stream: DataFrame,
    job_id: str,
    application: Any,
    ledger: str,
    checkpoint: str,
    *,
    to_documents: Callable[[DataFrame], DataFrame],
    outputs: list[Output] | None = None,
    run_id: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Start annotating a stream of documents of unknown length.

    ``to_documents`` turns one batch of the stream into documents. With ``once``
    the query takes what is there (``availableNow``) and stops; otherwise it
    looks again every ten seconds until stopped.
    """
    run_id = run_id or job_id

    def take(batch: DataFrame, number: int) -> None:
        spec = JobSpec(
            job_id=job_id,
            ledger=ledger,
            application=application,
            documents=to_documents(batch),
            outputs=outputs or [],
        )
        run(batch.sparkSession, spec, run_id=run_id, batch=number, few=True)
        if number % MERGE_EVERY == MERGE_EVERY - 1:
            ledgers.merge_batches(batch.sparkSession, ledger, run_id)

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")
    return writer.start()


def documents_of_lines(**ids: Any) -> Callable[[DataFrame], DataFrame]:
    """``to_documents`` for ``arriving_lines``; takes ``json_documents`` options."""
    return lambda batch: json_documents(compact(batch.filter(F.col("value").rlike(r"[^\x00-\x20]")), "value"), **ids)


def documents_of_files(compression: str | None = None, **ids: Any) -> Callable[[DataFrame], DataFrame]:
    """``to_documents`` for ``arriving_files`` holding arrays or run-on objects."""
    return lambda batch: json_documents(read_objects(batch, compression), **ids)
