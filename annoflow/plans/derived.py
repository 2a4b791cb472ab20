"""Containers written by Spark tasks from the given tables.

The readers of archives, ZIP files and JSON streams need such files to read;
these make them, a bounded number of rows per file, so they grow with the
tables they come from.
"""

from __future__ import annotations

import gzip
import io
import posixpath
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

from annoflow.session import scratch_path, written
from annoflow.sources import storage

ROWS_PER_FILE = 50


def write_containers(
    rows: DataFrame, number: Column, key: str, name: str, extension: str, pack: Callable[[list[dict]], bytes]
) -> DataFrame:
    """Write rows, ``ROWS_PER_FILE`` to a file by ``number``, in order of ``key``;
    returns the paths of the files."""
    spark = rows.sparkSession
    root = scratch_path(spark, name)
    schema = pa.schema([("path", pa.string())])

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = str(TaskContext.get().taskAttemptId())
        held: list[dict] = []

        def flush() -> pa.RecordBatch:
            path = posixpath.join(root, f"{name}-{held[0]['_file']:06d}{extension}")
            storage.write_atomically(path, pack(held), attempt)
            held.clear()
            return pa.RecordBatch.from_pylist([{"path": path}], schema=schema)

        for batch in incoming:
            for row in batch.to_pylist():
                if held and held[0]["_file"] != row["_file"]:
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    filed = rows.withColumn("_file", F.floor(number / ROWS_PER_FILE).cast("long"))
    spread = filed.repartition("_file").sortWithinPartitions("_file", key)
    return written(spread.mapInArrow(run, "path string"), name + "-paths")


def zip_of(rows: list[dict]) -> bytes:
    """Entries from columns ``name`` and ``text``."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for row in rows:
            z.writestr(row["name"], row["text"])
    return out.getvalue()


def json_array_of(rows: list[dict]) -> bytes:
    """One array of the objects in column ``json``, gzipped."""
    return gzip.compress(plain_json_array_of(rows))


def plain_json_array_of(rows: list[dict]) -> bytes:
    return ("[\n" + ",\n".join(row["json"] for row in rows) + "\n]\n").encode()


FIRST_DAY = datetime(2024, 1, 1)


def _http(row: dict) -> tuple[bytes, bytes]:
    """An HTTP message from a page row: head and body."""
    if row["status"] is None:
        return b"", b"no response line\n"
    day = FIRST_DAY + timedelta(minutes=row["page_id"])
    body = b"" if row["is_empty"] else row["html"].encode(row["charset"] or "windows-1252", "replace")
    head = f"HTTP/1.1 {row['status']} Some reason\r\n"
    if row["mime"]:
        head += f"Content-Type: {row['mime']}\r\n"
    if row["page_id"] % 2 == 0:
        head += f"Date: {day.strftime('%a, %d %b %Y %H:%M:%S')} GMT\r\n"
    if row["page_id"] % 3 == 0 and body:
        head += "Transfer-Encoding: chunked\r\n"
        half = len(body) // 2
        parts = [p for p in (body[:half], body[half:]) if p]
        body = b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"
    return (head + "\r\n").encode(), body


def _warc_record(kind: str, fields: dict[str, str], content: bytes) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n"
    head += "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return (head + f"Content-Length: {len(content)}\r\n\r\n").encode() + content + b"\r\n\r\n"


def warc_of(rows: list[dict]) -> bytes:
    """A gzipped WARC: its header, then a request and a response for each page."""
    records = [_warc_record("warcinfo", {"Content-Type": "application/warc-fields"}, b"software: x\r\n")]
    for row in rows:
        day = FIRST_DAY + timedelta(days=1, minutes=row["page_id"])
        fields = {"WARC-Target-URI": row["url"], "WARC-Date": day.strftime("%Y-%m-%dT%H:%M:%SZ")}
        request = {**fields, "Content-Type": "application/http; msgtype=request"}
        spacing = " " if row["page_id"] % 2 else ""
        response = {**fields, "Content-Type": f"Application/HTTP;{spacing}msgtype=response"}
        records.append(_warc_record("request", request, b"GET / HTTP/1.1\r\n\r\n"))
        records.append(_warc_record("response", response, b"".join(_http(row))))
    return b"".join(gzip.compress(r) for r in records)


def arc_of(rows: list[dict]) -> bytes:
    """An uncompressed ARC: its header, then a record for each page."""
    about = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    out = [b"filedesc://x.arc 0.0.0.0 20240101000000 text/plain %d\n" % len(about), about, b"\n"]
    for row in rows:
        day = FIRST_DAY + timedelta(days=1, minutes=row["page_id"])
        content = b"".join(_http(row))
        mime = (row["mime"] or "no-type").split(";")[0]
        head = f"{row['url']} 1.2.3.4 {day.strftime('%Y%m%d%H%M%S')} {mime} {len(content)}\n"
        out += [head.encode(), content, b"\n"]
    return b"".join(out)


def pages_as_records(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages with the made-up HTTP facts the archive writers use."""
    page = F.col("page_id")
    status = (
        F.when(page % 7 == 0, "301").when(page % 7 == 1, "404").when(page % 7 == 3, F.lit(None))
        .otherwise("200")
    )
    charset = F.when(page % 5 == 4, F.lit(None)).otherwise("utf-8")
    mime = (
        F.when(page % 5 == 0, 'text/html; charset="utf-8"').when(page % 5 == 1, "text/plain; charset=UTF-8")
        .when(page % 5 == 2, "application/xhtml; charset='utf-8'").when(page % 5 == 3, "text/html; charset=utf-8")
        .otherwise("text/html")
    )
    return pages.select(
        "page_id", "url", "html", status.alias("status"), charset.alias("charset"), mime.alias("mime"),
        (page % 11 == 0).alias("is_empty"),
    )
