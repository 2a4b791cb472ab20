"""ZIP files as collections of documents."""

from __future__ import annotations

import bz2
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from annoflow.model import DOCUMENT
from annoflow.operators.annotate import message_of
from annoflow.operators.enumerate import matching_ids, with_prefix
from annoflow.operators.spread import spread
from annoflow.session import written
from annoflow.sources import storage
from annoflow.sources.archive_frames import Window
from annoflow.sources.files import _load_one

ZIP_ATTR = "zip"


def paths_frame(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Container files as rows, one partition each: a lost task repeats one file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    return frame.repartition(max(1, len(paths)))


def list_zip_entries(
    zips: DataFrame,
    includes: str | Iterable[str] | None = None,
    excludes: str | Iterable[str] | None = None,
    default_excludes: str | bool | None = None,
    prefix: str | None = None,
    file_name_encoding: str | None = None,
) -> DataFrame:
    """IDs of the entries of the ZIP files in column ``path``, read from their
    directories alone. The attribute ``zip`` says which file an entry is in; ``place`` says where, so that
    ``read_zip_entries`` need not look at the directory again. In no order."""
    index = zip_index(zips, file_name_encoding)
    broken = F.raise_error(F.concat(F.lit("cannot list "), F.col("path"), F.lit(": "), F.col("problem"))).cast("string")
    found = index.withColumn("doc_id", F.when(F.col("problem").isNotNull(), broken).otherwise(F.col("entry")))
    kept = matching_ids(found, includes, excludes, default_excludes)
    attrs = F.create_map(F.lit(ZIP_ATTR), F.col("path"))
    place = F.struct("entry", *_PLACE)
    return with_prefix(kept, prefix).select("doc_id", attrs.alias("id_attrs"), F.col("size").alias("file_size"), place.alias("place"))


_PLACE = ("at", "packed", "size", "method", "flags", "crc")
_INDEX = "path string, entry string, at long, packed long, size long, method int, flags int, crc long, problem string"
#: Bytes of a local header before its name.
_LOCAL = 30
_PIECE = 1 << 18


def zip_index(zips: DataFrame, file_name_encoding: str | None = None) -> DataFrame:
    """The directories of the ZIP files in column ``path`` as a table, a row an entry: where its local header
    stands, its packed and full size, method, flags and check sum. A file without a directory that can be read
    is one row with a ``problem``. Each directory is read once: the table is written."""
    schema = to_arrow_schema(T.StructType.fromDDL(_INDEX))
    empty = dict.fromkeys(schema.names)

    def entries(path: str) -> Iterator[dict]:
        try:
            with _opened(path, file_name_encoding) as z:
                for e in z.infolist():
                    if not e.is_dir():
                        yield {
                            "path": path, "entry": e.filename, "at": e.header_offset, "packed": e.compress_size, "size": e.file_size,
                            "method": e.compress_type, "flags": e.flag_bits, "crc": e.CRC, "problem": None,
                        }
        except (OSError, ValueError, zipfile.BadZipFile) as error:
            yield {**empty, "path": path, "problem": message_of(error)}

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in incoming for path in batch.column("path").to_pylist() for row in entries(path))
        yield from storage.batches(rows, schema, lambda row: 100 + len(row["entry"] or ""))

    return written(zips.select("path").mapInArrow(run, _INDEX), "zip-index")


def read_zip_entries(
    ids: DataFrame,
    zip_path: str | None = None,
    *,
    encoding: str | None = None,
    mime_type: str | None = None,
    file_name_encoding: str | None = None,
) -> DataFrame:
    """Load entries by name from ``zip_path`` or the file in the ID's ``zip``
    attribute. An unknown entry fails on its own. ``file_size`` is uncompressed.

    Where an entry stands is known from the listing (column ``place``), or is looked up in the ``zip_index`` of
    the files that the IDs name. IDs are range-partitioned by file and place: a task reads the bytes of its
    entries in their order, and nothing else, and a file with very many of the entries is read by many tasks.
    """
    charset = encoding or "UTF-8"
    "".encode(charset)
    schema = to_arrow_schema(DOCUMENT)
    located = ids.withColumn("_zip", F.lit(zip_path) if zip_path else F.nullif(F.col("id_attrs")[ZIP_ATTR], F.lit("")))
    if "place" not in ids.columns:
        located = _placed(located, file_name_encoding)
    elif "problem" not in located.columns:
        located = located.withColumn("problem", F.lit(None).cast("string"))
    located = located.select("doc_id", "id_attrs", "_zip", "problem", *(F.col("place")[c].alias(f"_{c}") for c in _PLACE))
    ordered = spread(located, "_zip", "_at", size=F.col("_packed"))

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Window] = {}

        def window(path: str) -> Window:
            if path not in held:
                for other in held.values():
                    other.f.close()
                held.clear()
                held[path] = Window(storage.open_input(path), step=_PIECE)
            return held[path]

        def load(row: dict) -> dict:
            path, problem = row.pop("_zip"), row.pop("problem")
            place = {c: row.pop(f"_{c}") for c in _PLACE}
            if not path:
                raise ValueError(f"no ZIP file is known for {row['doc_id']}")
            if problem:
                raise ValueError(f"{path} is no ZIP file that can be read: {problem}")
            if place["at"] is None:
                raise KeyError(f"{path} holds no entry {row['doc_id']}")
            data = entry_bytes(window(path), place)
            return {"text": data.decode(charset, "replace"), "file_size": len(data)}

        rows = (_load_one(load, row, charset, mime_type) for b in incoming for row in b.to_pylist())
        yield from storage.batches(rows, schema, lambda row: 4 * len(row["text"] or ""))
        for w in held.values():
            w.f.close()

    return ordered.mapInArrow(run, DOCUMENT)


def _placed(located: DataFrame, file_name_encoding: str | None) -> DataFrame:
    """IDs with ``place``, and the ``problem`` of files without a directory that can be read."""
    kept = written(located, "zip-ids")
    files = kept.select(F.col("_zip").alias("path")).where("path IS NOT NULL").distinct()
    index = zip_index(files, file_name_encoding)
    # of entries with one name the last counts
    last = index.where("problem IS NULL").groupBy(F.col("path").alias("_zip"), F.col("entry").alias("doc_id")).agg(
        F.max(F.struct(*_PLACE)).alias("place")
    )
    broken = index.where("problem IS NOT NULL").select(F.col("path").alias("_zip"), "problem")
    return kept.join(last, ["_zip", "doc_id"], "left").join(broken, "_zip", "left")


def entry_bytes(window: Window, place: dict) -> bytes:
    """The contents of an entry, from its bytes alone."""
    head = window.peek(place["at"], _LOCAL)
    if len(head) < _LOCAL or head[:4] != b"PK\x03\x04":
        raise ValueError(f"no entry begins at {place['at']}")
    if place["flags"] & 1:
        raise ValueError("the entry is encrypted")
    begin = place["at"] + _LOCAL + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
    packed = window.peek(begin, place["packed"])
    if len(packed) < place["packed"]:
        raise EOFError("the ZIP file ends inside the entry")
    if place["method"] == zipfile.ZIP_STORED:
        data = packed
    elif place["method"] == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(packed, -15)
    elif place["method"] == zipfile.ZIP_BZIP2:
        data = bz2.decompress(packed)
    else:
        raise ValueError(f"unsupported compression method {place['method']}")
    if zlib.crc32(data) != place["crc"]:
        raise ValueError("the entry's check sum is wrong")
    return data


def _opened(path: str, file_name_encoding: str | None) -> zipfile.ZipFile:
    return zipfile.ZipFile(storage.open_input(path), metadata_encoding=file_name_encoding)
