"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where its top bits are zero, so
cuts depend on the sixteen bytes before them and fall into step again after an
insertion. Chunks with equal digests are equal; the first one stays.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import content_key, id_and_text, keep_matching, map_batches
from annoflow.session import written

#: Chunk sizes in bytes: shortest, longest; a cut comes every 32 bytes on average
#: beyond the shortest.
SHORTEST, LONGEST, CUT_BITS = 24, 96, 5


def _gear() -> np.ndarray:
    """256 scattered 32-bit numbers from the bytes' own values (splitmix)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def gear_hashes(data: bytes) -> np.ndarray:
    """h[i] = 2 h[i-1] + GEAR[data[i]] over the last 16 bytes, by doubling the window."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):
        shifted = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += shifted
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end; none for an empty text."""
    size = len(data)
    if not size:
        return []
    cuts = (np.flatnonzero(gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    ends, start = [], 0
    for cut in cuts:
        while cut - start > LONGEST:
            start += LONGEST
            ends.append(start)
        if cut - start >= SHORTEST:
            start = cut
            ends.append(cut)
    while size - start > LONGEST:
        start += LONGEST
        ends.append(start)
    if start < size:
        ends.append(size)
    return ends


def _chunks(batch: pa.RecordBatch) -> pa.RecordBatch:
    digests, lengths, counts, sizes, whole = [], [], [0], [], []
    for value in batch.column(2):
        data = value.as_py().encode()
        start = 0
        for end in chunk_ends(data):
            digests.append(xxhash.xxh3_128_digest(data[start:end]))
            lengths.append(end - start)
            start = end
        counts.append(len(lengths))
        sizes.append(len(data))
        whole.append(hashlib.sha256(data).hexdigest())
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    offsets = pa.array(counts, pa.int32())
    pairs = pa.StructArray.from_arrays([pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], ["a", "b"])
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(whole),
         pa.ListArray.from_arrays(offsets, pa.array(lengths, pa.int32())), pa.ListArray.from_arrays(offsets, pairs)],
        names=["key", "doc_id", "n_bytes", "sha256", "lengths", "digests"],
    )


def later_runs(lengths: list[int], later: dict[int, int | None], least: int = 0) -> list[tuple[int, int, list]]:
    """(start, end, first documents) of the runs of neighbouring chunks in ``later``
    that are ``least`` bytes long or more."""
    runs, at, begin, firsts = [], 0, None, []
    for i, length in enumerate([*lengths, 0]):
        if i in later:
            begin = at if begin is None else begin
            firsts.append(later[i])
        elif begin is not None:
            if at - begin >= least:
                runs.append((begin, at, firsts))
            begin, firsts = None, []
        at += length
    return runs


def _cut(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    out = []
    for row in batch.to_pylist():
        data = row["text"].encode()
        runs = later_runs(row["lengths"], {x["place"]: x["first_doc"] for x in row["later"]}, least)
        kept, at = hashlib.sha256(), 0
        for begin, end, _ in runs:
            kept.update(data[at:begin])
            at = end
        kept.update(data[at:])
        firsts = sorted({d for *_, docs in runs for d in docs if d is not None})
        out.append((sum(e - b for b, e, _ in runs), len(runs), kept.hexdigest(), firsts,
                    [{"begin": b, "end": e} for b, e, _ in runs]))
    columns = list(zip(*out))
    return pa.RecordBatch.from_arrays(
        [batch.column(batch.schema.get_field_index("key")), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
         pa.array(columns[2]), pa.array(columns[3], pa.list_(pa.int64())),
         pa.array(columns[4], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
        names=["key", "n_removed", "n_spans", "kept_sha256", "first_docs", "spans"],
    )


def chunk_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_run: int = 0) -> DataFrame:
    """Remove all chunks seen before, in the order of doc_id and place; with ``least_run``, only
    where a run of them has so many bytes or more.

    Returns doc_id, n_bytes, n_chunks, n_removed, n_spans, kept_sha256 (of the
    bytes that stay), first_docs (where removed chunks come first, sorted) and spans
    (removed bytes as begin and end). Null and empty texts have no chunks.
    Rows that repeat ID and text are one document, returned as often as they come;
    a null ID comes before all others. Other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col).select(
        content_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    schema = (
        "key binary, doc_id long, n_bytes long, sha256 string, lengths array<int>, digests array<struct<a:long,b:long>>"
    )
    base = map_batches(rows, _chunks, schema).withColumn("num", F.monotonically_increasing_id())
    base = written(base, "chunks")
    repeats = base.groupBy("key").agg(F.min("num").alias("first"), F.count("*").alias("n")).where("n > 1")
    single = base.join(repeats.select("key", "first"), "key", "left").where("first IS NULL OR first = num")
    chunks = single.select("num", "doc_id", F.posexplode("digests").alias("place", "digest")).select(
        "num", "doc_id", "place", F.col("digest.a").alias("a"), F.col("digest.b").alias("b")
    )
    # half a digest tells nearly all chunks that occur once; the rest are compared by the whole
    shared = written(chunks.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), "shared-digests")
    likely = written(keep_matching(chunks, shared, "a"), "likely-repeats")
    repeated = (
        likely.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "num", "place")).alias("first"))
        .where("n > 1")
    )
    later = likely.join(repeated, ["a", "b"]).where(
        (F.col("num") != F.col("first.num")) | (F.col("place") != F.col("first.place"))
    )
    by_doc = later.groupBy("num").agg(
        F.collect_list(F.struct("place", F.col("first.doc_id").alias("first_doc"))).alias("later")
    )
    affected = written(single.select("num", "key", "lengths").join(by_doc, "num"), "chunk-repeats")
    texts = keep_matching(rows.select("key", "text"), affected, "key").dropDuplicates(["key"])
    cut = map_batches(
        texts.join(affected, "key").select("key", "text", "lengths", "later"), partial(_cut, least=least_run),
        "key binary, n_removed long, n_spans long, kept_sha256 string, first_docs array<long>, spans array<struct<begin:long,end:long>>",
    )
    return base.join(cut, "key", "left").select(
        "doc_id", "n_bytes", F.size("lengths").cast("long").alias("n_chunks"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
        F.coalesce("first_docs", F.array().cast("array<long>")).alias("first_docs"),
        F.coalesce("spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")).alias("spans"),
    )
