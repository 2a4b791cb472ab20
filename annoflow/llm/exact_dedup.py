"""Exact duplicates by counting quotient filters.

Each partition counts the fingerprints of its texts in counting quotient filters, one for each
region (the leading bits). A filter keeps every fingerprint: which of its quotients occur,
and the sorted remainders of each, so filters merge without loss by merging their sorted remainders.
Texts whose fingerprint occurs once are no one's copy and go no further. The others are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from annoflow.llm.common import BROADCAST_KEYS, join_counted
from annoflow.session import temporary_tables, written

#: Characters that do not count when texts are compared.
BLANK = "\t\n\x0b\f\r "
#: Fingerprints of a filter before it is handed on, and expected in a region.
FILTER_ROWS, REGION_ROWS = 1 << 20, 1 << 18
#: Groups of more rows than one in so many of the table are hot; there are no more of them than this.
HOT_GROUPS = 100_000
#: Rows of a group that one task takes in any case.
GROUP_ROWS = 1_000


# --- counting quotient filters --------------------------------------------------


def pack_filter(prints: np.ndarray, counts: np.ndarray, region_bits: int) -> bytes:
    """The filter of sorted, different 64-bit fingerprints of one region.

    The region's bits are left out. The next bits, the quotient, say which run a fingerprint is
    in; a bit for each quotient says whether it has a run, a bit for each slot whether it ends one.
    Slots hold the remainders, whose bytes are as few as they need. A count above one follows its remainder in
    slots of its own, marked by a third bit, lowest digits first.
    """
    n = len(prints)
    quotient_bits = min(64 - region_bits, max(3, int(n).bit_length()))
    width = -(-(64 - region_bits - quotient_bits) // 8) or 1
    own = prints << np.uint64(region_bits) if region_bits else prints
    quotients = (own >> np.uint64(64 - quotient_bits)).astype(np.int64)
    remainders = (own << np.uint64(quotient_bits)) >> np.uint64(region_bits + quotient_bits)
    base = 256**width
    digits = np.zeros(n, np.int64)
    left = np.where(counts > 1, counts, 0)
    while left.any():
        digits += left > 0
        left = left // base if width < 8 else np.zeros_like(left)
    at = np.arange(n) + np.cumsum(digits) - digits
    slots = np.zeros(n + int(digits.sum()), np.uint64)
    counter = np.ones(len(slots), bool)
    ends = np.zeros(len(slots), bool)
    slots[at], counter[at] = remainders, False
    left = np.where(counts > 1, counts, 0).astype(np.uint64)
    for place in range(int(digits.max(initial=0))):
        more = np.flatnonzero(digits > place)
        slots[at[more] + 1 + place] = left[more] % np.uint64(base) if width < 8 else left[more]
        left = left // np.uint64(base) if width < 8 else left
    last = np.concatenate([quotients[1:] != quotients[:-1], [True]]) if n else np.empty(0, bool)
    ends[(at + digits)[last]] = True
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotients] = True
    head = np.array([n, len(slots), quotient_bits, width], np.int64)
    body = slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return b"".join([head.tobytes(), *(np.packbits(x).tobytes() for x in (occupied, ends, counter)), body.tobytes()])


def unpack_filter(data: bytes, region: int, region_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints, sorted, and counts of a filter."""
    n, size, quotient_bits, width = np.frombuffer(data, np.int64, 4).tolist()
    at, flags = 32, []
    for many in (1 << quotient_bits, size, size):
        step = -(-many // 8)
        flags.append(np.unpackbits(np.frombuffer(data, np.uint8, step, at), count=many).astype(bool))
        at += step
    occupied, ends, counter = flags
    padded = np.zeros((size, 8), np.uint8)
    padded[:, :width] = np.frombuffer(data, np.uint8, size * width, at).reshape(-1, width)
    slots = padded.ravel().view("<u8")
    first = np.flatnonzero(~counter)
    run = np.cumsum(ends) - ends
    quotients = np.flatnonzero(occupied)[run[first]].astype(np.uint64)
    prints = quotients << np.uint64(64 - region_bits - quotient_bits) | slots[first]
    if region_bits:
        prints |= np.uint64(region) << np.uint64(64 - region_bits)
    counts = np.ones(n, np.int64)
    digits = np.diff(np.concatenate([first, [size]])) - 1
    counts[digits > 0] = 0
    for place in range(int(digits.max(initial=0))):
        more = np.flatnonzero(digits > place)
        counts[more] += (slots[first[more] + 1 + place] << np.uint64(8 * width * place)).astype(np.int64)
    return prints, counts


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints, sorted, and counts of several lists of them, each sorted."""
    prints = np.concatenate([p for p, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(prints, kind="stable")  # merges runs that are sorted already
    prints, counts = prints[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else np.empty(0, int)
    return prints[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def repeated_prints(prints: DataFrame, region_bits: int) -> DataFrame:
    """``print`` and ``n`` of the 64-bit fingerprints (column ``print``) that occur more than once."""

    def filters(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        regions = (values >> np.uint64(64 - region_bits)).astype(np.int64) if region_bits else np.zeros(len(values), np.int64)
        names, starts = np.unique(regions, return_index=True)
        stops = [*starts[1:].tolist(), len(values)]
        packed = [pack_filter(values[a:b], counts[a:b], region_bits) for a, b in zip(starts.tolist(), stops)]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], names=["region", "filter"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            size += batch.num_rows
            if size >= FILTER_ROWS:
                yield filters(held)
                held, size = [], 0
        if size:
            yield filters(held)

    def merge(group: pa.Table) -> pa.Table:
        region = group["region"][0].as_py()
        values, counts = merged([unpack_filter(data.as_py(), region, region_bits) for data in group["filter"]])
        again = counts > 1
        return pa.table({"print": pa.array(values[again].view(np.int64)), "n": pa.array(counts[again])})

    return prints.mapInArrow(count, "region long, filter binary").groupBy("region").applyInArrow(merge, "print long, n long")


# --- stages ---------------------------------------------------------------------


def without_blanks(text: Column) -> Column:
    """A text without the characters of ``BLANK``; null is empty."""
    plain = F.coalesce(text, F.lit(""))
    for blank in BLANK:
        plain = F.replace(plain, F.lit(blank), F.lit(""))
    return plain


def fingerprint(plain: Column) -> Column:
    return F.xxhash64(plain)


def digest(plain: Column) -> Column:
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The group of each document, whose texts are equal but for blanks.

    Returns one row for each row: doc_id, keep_id, group_size, kept and text_sha256 (of the text
    without blanks). Of a group the row with the most code points stays, then the smallest ID
    (none comes last); of rows that agree in both, any one. keep_id is the ID of the row that stays, null if it
    has none. Null, empty and blank texts are one group. No rows: no
    result. Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), text.alias("text"), without_blanks(docs[text_col]).alias("plain"))
    rows = rows.withColumn("print", fingerprint(F.col("plain")))
    with temporary_tables(spark):
        total = docs.count()
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        region_bits = max(total // REGION_ROWS, tasks - 1).bit_length()
        repeated = written(repeated_prints(rows.select("print"), region_bits), "repeated-prints")

        # hot fingerprints are so few that they can be sent to every task; each of the others has few rows
        many = max(GROUP_ROWS, total // HOT_GROUPS)
        if repeated.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
            marked = rows.join(F.broadcast(repeated), "print", "left")
        else:
            hot = F.broadcast(repeated.where(F.col("n") > many).select("print", F.col("n").alias("hot")))
            marked = rows.join(hot, "print", "left")
            cold = marked.where("hot IS NULL").join(repeated.where(F.col("n") <= many), "print", "left")
            marked = cold.drop("hot").unionByName(marked.where("hot IS NOT NULL").withColumnRenamed("hot", "n"))
        # only texts that may have a copy are written; of the others the digest
        marked = marked.select(
            "doc_id", F.length("text").cast("long").alias("size"), "print", digest(F.col("plain")).alias("digest"),
            F.when(F.col("n").isNotNull(), F.col("plain")).alias("plain"),
        ).withColumn("num", F.monotonically_increasing_id())
        marked = written(marked, "fingerprints")
        single = marked.where("plain IS NULL").select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
        )
        candidates = marked.where("plain IS NOT NULL")
        slim = candidates.drop("plain")

        # the bytes decide: equal texts of a task are put together before anything is shuffled
        names = ["print", "digest"]
        classes = written(_equal_texts(candidates).drop("plain"), "equal-texts")
        shared = written(classes.groupBy(names).agg(F.count("*").alias("texts")).where("texts > 1").select(names), "shared-digests")
        if shared.isEmpty():
            named = _with_class(slim, classes, names, many)
        else:
            # a digest that different texts share: their bytes go on telling them apart
            mixed = candidates.join(shared, names, "left_semi")
            named = _with_class(slim.join(shared, names, "left_anti"), classes.join(shared, names, "left_anti"), names, many).unionByName(
                _with_class(mixed, _equal_texts(mixed), [*names, "plain"], many).drop("plain")
            )
        named = named.select("doc_id", "keep_id", "group_size", (F.col("num") == F.col("first_num")).alias("kept"), "digest")
        out = single.union(named).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
        return written(out, "exact-classes", keep=True)


def _equal_texts(candidates: DataFrame) -> DataFrame:
    """Each different text, the rows that have it, and which of them stays."""
    order = F.struct((-F.col("size")).alias("size"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "num")
    groups = candidates.groupBy("print", "digest", "plain").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    return groups.select("print", "digest", "plain", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.num").alias("first_num"))


def _with_class(rows: DataFrame, classes: DataFrame, on: list[str], many: int) -> DataFrame:
    """Rows with their class; classes of more than ``many`` rows are few and go to every task."""
    hot = classes.where(F.col("group_size") > many)
    cold = classes.where(F.col("group_size") <= many)
    names = [c for c in classes.columns if c not in on]
    marked = rows.join(F.broadcast(hot), on, "left")
    rest = join_counted(marked.where("first_num IS NULL").drop(*names), cold, on)
    return marked.where("first_num IS NOT NULL").unionByName(rest)


EXACT_SQL = """
WITH plain AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS plain FROM documents),
ranked AS (
  SELECT doc_id, plain, row_number() OVER own AS place, first_value(doc_id) OVER own AS keep_id
  FROM plain WINDOW own AS (PARTITION BY plain ORDER BY length(text) DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY plain) AS group_size, place = 1 AS kept, sha256(plain) AS text_sha256 FROM ranked
"""
