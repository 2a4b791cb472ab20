"""Files of JSON objects, each object a document whose text is the object.

Objects may be in one top-level array, one after another with or without space,
or one per line. Files of any of these layouts are read by many tasks, unless they are compressed.
"""

from __future__ import annotations

import json
import lzma
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

from annoflow.functions.ids import id_from_pointer, id_from_template, is_document
from annoflow.functions.values import bind
from annoflow.model import DOCUMENT, as_documents
from annoflow.operators.annotate import small_parts
from annoflow.operators.spread import spread
from annoflow.session import written
from annoflow.sources import storage
from annoflow.sources.json_blocks import PIECE, Entry, TopValues, effect, entries


#: Bytes of a file that one task takes the values of.
BLOCK_BYTES = 64 << 20
_BLOCK = "path string, begin long, end long, size long, packed boolean"
_EFFECT = "path string, begin long, end long, first long, ends_in0 boolean, deeper0 long, least0 long, ends_in1 boolean, deeper1 long, least1 long"
_ENTRY = "path string, begin long, end long, size long, packed boolean, in_string boolean, depth long, base long, in_array boolean, started boolean"
_OBJECTS = "json string, place string, load_error string"


def read_objects(files: DataFrame, compression: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns ``json``, ``place`` and ``load_error``: every top-level value of the files in column ``path``.

    A plain file is read by many tasks, a block each. What a block does to strings and depths is found first, for both
    ways in which it may begin (``sources.json_blocks``); one short row a block tells how each does begin. A compressed
    file is read by one task. What is not JSON, or breaks off, is a row with an error and
    its place (file and byte), so that no loss passes unnoticed; the values beside it are read.
    """
    name = storage.compression_name(compression)
    blocks = written(files.select("path").mapInArrow(_blocks(name, block_bytes), _BLOCK), "json-blocks")
    shared = blocks.where("NOT packed AND (begin > 0 OR end < size)")
    whole = blocks.where("packed OR (begin = 0 AND end = size)").select(
        "*", *(F.lit(v).alias(n) for n, v in vars(Entry()).items())
    )
    effects = _spread_blocks(shared).mapInArrow(_effects, _EFFECT)
    begun = effects.groupBy("path").applyInArrow(_entries, _ENTRY)
    entries = written(whole.select(*(F.col(f"`{c}`") for c in begun.columns)).union(begun), "json-entries")
    return _spread_blocks(entries).mapInArrow(_values(name), _OBJECTS)


def _spread_blocks(blocks: DataFrame) -> DataFrame:
    return spread(blocks, "path", "begin", size=F.col("end") - F.col("begin"))


def _blocks(name: str, block_bytes: int):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for path in batch.column("path").to_pylist():
                with storage.open_input(path) as f:
                    size = f.size()
                    packed = storage.is_packed(f.read(16), name)
                begins = [0] if packed else list(range(0, max(size, 1), block_bytes))
                ends = [size] if packed else [min(b + block_bytes, size) for b in begins]
                rows = {"path": [path] * len(begins), "begin": begins, "end": ends, "size": [size] * len(begins), "packed": [packed] * len(begins)}
                yield pa.RecordBatch.from_pydict(rows)

    return run


def _before(f, begin: int) -> bytes:
    """The bytes before a block, as far back as a run of backslashes goes."""
    size = 64
    while True:
        f.seek(max(0, begin - size))
        held = f.read(min(size, begin))
        if len(held) == begin or held.strip(b"\\"):
            return held
        size *= 16


def _pieces(f, begin: int, end: int) -> Iterator[bytes]:
    f.seek(begin)
    while begin < end and (piece := f.read(min(PIECE, end - begin))):
        begin += len(piece)
        yield piece


def _effects(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in incoming:
        for block in batch.to_pylist():
            with storage.open_input(block["path"]) as f:
                found = effect(_pieces(f, block["begin"], block["end"]), _before(f, block["begin"]))
            row = {n: block[n] for n in ("path", "begin", "end")} | found
            yield pa.RecordBatch.from_pydict({n: [row[n]] for n in re.findall(r"(\w+) \w+", _EFFECT)})


def _entries(group: pa.Table) -> pa.Table:
    """How the blocks of one file begin: a short row each."""
    rows = sorted(group.to_pylist(), key=lambda r: r["begin"])
    size = rows[-1]["end"]
    begun = [
        {"path": r["path"], "begin": r["begin"], "end": r["end"], "size": size, "packed": False, **vars(e)}
        for r, e in zip(rows, entries(rows))
    ]
    return pa.Table.from_pylist(begun)


def _values(name: str):
    schema = pa.schema([("json", pa.string()), ("place", pa.string()), ("load_error", pa.string())])

    def found(block: dict) -> Iterator[dict]:
        path = block["path"]
        with storage.open_input(path) as f:
            if block["packed"]:
                top, pieces = TopValues(), storage.decompressed(f, name)
            else:
                entry = Entry(*(block[n] for n in vars(Entry())))
                limit = block["end"] if block["end"] < block["size"] else float("inf")
                top = TopValues(block["begin"], entry, _before(f, block["begin"]), limit)
                pieces = _pieces(f, block["begin"], block["size"])
            try:
                for place, text, problem in top.read(pieces):
                    if problem is None:
                        try:
                            for value in _parsed(text):
                                yield {"json": value, "place": f"{path}@{place}", "load_error": None}
                            continue
                        except (ValueError, RecursionError) as error:
                            problem = f"not JSON: {error}"
                    yield {"json": None, "place": f"{path}@{place}", "load_error": problem}
            except (EOFError, ValueError, OSError, zlib.error, lzma.LZMAError) as error:
                # the compression breaks: nothing after this place can be read
                yield {"json": None, "place": f"{path}@{top.at}", "load_error": f"cannot read on: {error}"}

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in incoming for block in batch.to_pylist() for row in found(block))
        yield from storage.batches(rows, schema, lambda row: 4 * len(row["json"] or "") + 100)

    return run


def _parsed(text: bytes) -> Iterator[str]:
    """The values of a text that ``TopValues`` found: one, or several scalars without space between them."""
    whole, at = text.decode("utf-8"), 0
    while at < len(whole):
        value, at = _decoder().raw_decode(whole, at)
        yield _written(value)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Column ``json`` of newline-delimited files (plain, or gz and bz2 by name)."""
    return compact(spark.read.text(path).filter(F.col("value").rlike(r"[^\x00-\x20]")), "value")


def compact(df: DataFrame, column: str) -> DataFrame:
    """Column ``json``: the text of ``column`` without space between tokens."""
    schema = pa.schema([("json", pa.string())])

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in incoming for part in small_parts(whole, column=column)):
            texts = [_compact(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], schema=schema)

    return df.select(column).mapInArrow(run, "json string")


#: Marks a number kept as it was written; no text holds it by chance.
_NUMBER = "\x00number\x00" + uuid.uuid4().hex


def _is_number(value) -> bool:
    return isinstance(value, str) and value.startswith(_NUMBER)


def _not_json(name: str):
    raise ValueError(f"{name} is not JSON")


_READ = {"parse_float": lambda text: _NUMBER + text, "parse_constant": _not_json}


@lru_cache
def _decoder() -> json.JSONDecoder:
    return json.JSONDecoder(**_READ)




def _compact(text: str) -> str:
    return _written(json.loads(text, **_READ))


def _written(value) -> str:
    """JSON without space: numbers with a point or exponent as they were, lone surrogates escaped."""
    text = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    mark = _NUMBER.replace("\x00", "\\u0000")
    text = re.sub(f'"{re.escape(mark)}([^"]*)"', r"\1", text)
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m.group()):04x}", text)


def values_in(pieces: Iterator[bytes]) -> Iterator[str]:
    """Compact JSON values from UTF-8 data in pieces, up to the first that is broken, which is an error.

    Holds one value at a time.
    """
    for _, text, problem in TopValues().read(pieces):
        if problem is not None:
            raise ValueError(f"broken JSON stream: {problem}")
        yield from _parsed(text)


def json_documents(
    objects: DataFrame,
    *,
    id_pointer: str | None = None,
    id_template: str | None = None,
    mime_type: str | None = None,
) -> DataFrame:
    """Documents from column ``json``; objects without an ID are left out.

    An object that cannot be parsed to look for its ID (too large for a variant, say), and a row that
    has a ``load_error``, must not pass for one without an ID: each is a document that failed to load, named
    after its ``place`` if the rows have one.
    """
    if id_pointer is None and id_template is None:
        raise ValueError("json_documents takes IDs from a pointer or from a template: give one")

    def read(variant: Column) -> Column:
        found = (
            id_from_pointer(variant, F.col("json"), id_pointer)
            if id_pointer is not None
            else id_from_template(variant, F.col("json"), id_template)
        )
        unread = F.col("json").isNotNull() & variant.isNull()
        problem = F.concat(F.lit("cannot parse a JSON object that begins "), F.substring("json", 1, 80))
        return F.struct(found.alias("id"), F.when(unread, problem).alias("problem"))

    error = F.col("load_error") if "load_error" in objects.columns else F.lit(None).cast("string")
    place = F.col("place") if "place" in objects.columns else F.lit(None).cast("string")
    # parsed once, whatever is asked of it
    found = objects.withColumn("_read", bind(F.try_parse_json("json"), read))
    found = found.withColumn("_problem", F.coalesce(error, F.col("_read.problem")))
    named = F.when(F.col("_problem").isNull(), F.col("_read.id")).otherwise(
        F.coalesce(place, F.concat(F.lit("unread-"), F.md5(F.coalesce("json", F.lit("")))))
    )
    found = found.withColumn("doc_id", named).filter(is_document(F.col("doc_id")))
    docs = as_documents(found.withColumn("_text", F.when(F.col("_problem").isNull(), F.col("json"))), "doc_id", "_text", mime_type=mime_type, load_error=F.col("_problem"))
    # The size of one object in a stream is not known.
    return docs.withColumn("file_size", F.lit(None).cast("long")).select(DOCUMENT.names)
