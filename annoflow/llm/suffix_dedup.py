"""Removal of byte strings that occur elsewhere too, by suffix arrays.

Equal strings are brought together first. The anchor of a string of ``LENGTH`` bytes is
the place in it where sixteen bytes have the least hash, so equal strings have
equal anchors. Strings that start side by side and share an anchor make one
piece of text; pieces go to shards by the bytes at their anchor. A piece whose
surroundings of the anchor occur once only, in either direction, cannot hold a repeated string and
stays out; of equal pieces one goes. Each shard sorts its suffixes
(Larsson-Sadakane) and measures neighbours' common prefixes (Kasai). Anchors too
common for one shard are spread over several, whose sorted strings are merged by
binary search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import content_key, id_and_text, join_split, keep_matching, map_batches
from annoflow.llm.hashing import mix, prefix_sums, window_hashes
from annoflow.session import temporary_tables, written

#: Bytes of a string, of the hashed part at an anchor, and of its surroundings on one side.
LENGTH, GRAM, SIDE = 400, 16, 200
#: Bytes of a text looked at together, and of a shard.
BLOCK, SHARD = 1 << 20, 1 << 20
_PLACE = np.uint64((1 << 30) - 1)


# --- anchors ------------------------------------------------------------------


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by running minima from block borders."""
    n = len(x)
    padded = np.concatenate([x, np.full(-n % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()[:n]
    back = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()[:n]
    return np.minimum(back[: n - width + 1], ahead[width - 1 :])


def pieces_of(data: np.ndarray) -> dict[str, np.ndarray]:
    """Pieces of a text: anchor, first and last start of the strings that have it,
    hash of the bytes at the anchor, of the 200 from it on, of the 200 up to its end
    (0 where the text is too short for them)."""
    names = ("anchor", "first", "last", "gram", "right", "left")
    found: dict[str, list[np.ndarray]] = {name: [] for name in names}
    for begin in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        low = max(0, begin - SIDE)
        part = data[low : begin + BLOCK + LENGTH + SIDE]
        starts = min(BLOCK, len(data) - LENGTH + 1 - begin)
        sums = prefix_sums(part)
        grams = window_hashes(sums, GRAM)
        sides = window_hashes(sums, SIDE)
        own = grams[begin - low : begin - low + starts + LENGTH - GRAM]
        place = np.arange(len(own), dtype=np.uint64)
        least = sliding_minimum((own & ~_PLACE) | place, LENGTH - GRAM + 1) & _PLACE
        heads = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        anchor = least[heads].astype(np.int64) + begin
        local = anchor - low
        right, left = local + SIDE <= len(part), local + GRAM >= SIDE
        found["anchor"].append(anchor)
        found["first"].append(heads + begin)
        found["last"].append(np.concatenate([heads[1:], [starts]]) - 1 + begin)
        found["gram"].append(grams[local])
        found["right"].append(np.where(right, sides[np.minimum(local, len(sides) - 1)], np.uint64(0)))
        found["left"].append(np.where(left, mix(sides[np.maximum(local + GRAM - SIDE, 0)]), np.uint64(0)))
    return {name: np.concatenate(parts) if parts else np.empty(0, np.int64) for name, parts in found.items()}


# --- suffix arrays ------------------------------------------------------------


def words_at(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as one number, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | padded[i : i + len(data)]
    return out


def suffix_array(data: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Sorted suffixes. Each keeps the rank of its group, those equal so far; a
    round sorts only groups of several, by the rank of what follows the part known
    to be equal, and so doubles that part."""
    n = len(data)
    order = np.argsort(words, kind="stable")
    rank = np.empty(n, np.int64)
    heads = _heads(words[order])
    rank[order] = heads
    unsorted = _in_groups(heads)
    at, equal = np.flatnonzero(unsorted), 8
    while len(at):
        who = order[at]
        # of suffixes that end within the equal part the shorter comes first
        behind = np.where(who + equal < n, n + rank[np.minimum(who + equal, n - 1)], n - 1 - who)
        key = rank[who] << 32 | behind
        by = np.argsort(key, kind="stable")
        order[at] = who = who[by]
        key = key[by]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        firsts = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[who] = firsts
        at = at[_in_groups(firsts)]
        equal *= 2
    return order


def _heads(values: np.ndarray) -> np.ndarray:
    """For sorted values, where the first equal one stands."""
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    return np.maximum.accumulate(np.where(fresh, np.arange(len(values)), 0))


def _in_groups(heads: np.ndarray) -> np.ndarray:
    """Whether a value has a neighbour in its group."""
    same = heads[1:] == heads[:-1]
    return np.concatenate([same, [False]]) | np.concatenate([[False], same])


def common_prefixes(words: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Of each suffix, the length, up to ``most``, that it shares with the one before it in
    order: at least that of the suffix one place earlier, less one. Many stretches of the
    text are walked side by side, eight bytes at a time."""
    n = len(words)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    lanes = max(1, min(n, 8192))
    stretch = -(-n // lanes)
    starts = np.arange(lanes) * stretch
    out = np.zeros(n, np.int32)
    shared = np.zeros(lanes, np.int64)
    padded = np.concatenate([words, np.zeros(most + 8, np.uint64)])
    for step in range(stretch):
        place = starts + step
        live = np.flatnonzero(place < n)
        i = place[live]
        j = before[i]
        length = np.where(j >= 0, np.maximum(shared[live] - 1, 0), 0)
        going = np.flatnonzero(j >= 0)
        while len(going):
            apart = padded[i[going] + length[going]] ^ padded[j[going] + length[going]]
            same = np.full(len(going), 8)
            for size in range(8):
                same -= apart >= np.uint64(1 << (8 * size))
            length[going] += same
            going = going[(same == 8) & (length[going] < most)]
        room = n - np.maximum(i, j)
        length = np.minimum(np.minimum(length, most), np.where(j >= 0, room, 0))
        out[i] = length
        shared[live] = length
    return out


def repeated_starts(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Of each text, where strings of ``length`` bytes start that start elsewhere in ``texts`` too."""
    joined = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
    words = words_at(joined)
    order = suffix_array(joined, words)
    shared = common_prefixes(words, order, length)
    twice = shared >= length
    ordered = twice[order]
    twice[order[:-1][ordered[1:]]] = True  # the one before shares as much
    out, at = [], 0
    for text in texts:
        starts = max(0, len(text) - length + 1)
        out.append(np.flatnonzero(twice[at : at + starts]))
        at += len(text) + 1
    return out


# --- stages -------------------------------------------------------------------


def _anchored(batch: pa.RecordBatch) -> pa.RecordBatch:
    columns: dict[str, list[np.ndarray]] = {}
    counts, sizes, whole = [0], [], []
    for value in batch.column(2):
        data = value.as_py().encode()
        found = pieces_of(np.frombuffer(data, np.uint8))
        for name in ("right", "left"):
            columns.setdefault(name, []).append(found[name].astype(np.uint64).view(np.int64))
        counts.append(counts[-1] + len(found["anchor"]))
        sizes.append(len(data))
        whole.append(hashlib.sha256(data).hexdigest())
    offsets = pa.array(counts, pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(columns[name]))) for name in ("right", "left")]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(whole), *lists],
        names=["key", "doc_id", "n_bytes", "sha256", "rights", "lefts"],
    )


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The pieces of a document that may hold repeated strings: only those starts
    whose string has the repeated side of the anchor in full."""
    rows = []
    for row in batch.to_pylist():
        data = row["text"].encode()
        found = pieces_of(np.frombuffer(data, np.uint8))
        sides: dict[int, int] = {}
        for x in row["marks"]:
            sides[x["place"]] = sides.get(x["place"], 0) | x["side"]
        for place, side in sides.items():
            anchor, first, last = (int(found[name][place]) for name in ("anchor", "first", "last"))
            if not side & 1:
                last = min(last, anchor - (SIDE - GRAM))
            if not side & 2:
                first = max(first, anchor - (LENGTH - SIDE))
            if first <= last:
                digest = np.frombuffer(xxhash.xxh3_128_digest(data[first : last + LENGTH]), np.int64)
                rows.append((row["num"], first, last + LENGTH, int(found["gram"][place].view(np.int64)), int(digest[0]), int(digest[1])))
    columns = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=["num", "begin", "end", "gram", "a", "b"]
    )


def _texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for row in batch.to_pylist():
        data = row["text"].encode()
        rows += [(x["gram"], x["a"], x["b"], data[x["begin"] : x["end"]]) for x in row["pieces"]]
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())], names=["gram", "a", "b", "piece"]
    )


def spans_of(starts: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings of ``length`` at ``starts`` (sorted)."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length)
    begins = starts[np.concatenate([[0], breaks + 1])]
    ends = starts[np.concatenate([breaks, [len(starts) - 1]])] + length
    return list(zip(begins.tolist(), ends.tolist()))


def _sorted_shard(group: pa.Table) -> pa.Table:
    texts = group["piece"].to_pylist()
    found = zip(group["a"].to_pylist(), group["b"].to_pylist(), repeated_starts(texts))
    return _spans_table([(x, y, spans_of(starts)) for x, y, starts in found if len(starts)])


#: A string in a list that shards exchange: its digest, its piece and where it starts there.
_STRING = np.dtype([("c", "<i8"), ("d", "<i8"), ("a", "<i8"), ("b", "<i8"), ("start", "<i4")])
_SPREAD = "a long, b long, spans array<struct<from:long,to:long>>, slice int, strings binary"
_SPANS = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _spans_table(found: list[tuple[int, int, list[tuple[int, int]]]]) -> pa.Table:
    a, b, spans = zip(*found) if found else ([], [], [])
    listed = [[{"from": x, "to": y} for x, y in one] for one in spans]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "spans": pa.array(listed, _SPANS)})


def _spread_shard(slices: int):
    def run(group: pa.Table) -> pa.Table:
        """A shard of an anchor that several shards share: the spans repeated within it, and its different
        strings, sorted by digest and cut into the slices in which all shards' lists are merged."""
        texts = group["piece"].to_pylist()
        within, lists, seen = [], [], set()
        for x, y, text, starts in zip(group["a"].to_pylist(), group["b"].to_pylist(), texts, repeated_starts(texts)):
            within.append((x, y, spans_of(starts)))
            repeated = np.zeros(max(0, len(text) - LENGTH + 1), bool)
            repeated[starts] = True
            digests, places = [], []
            for start in range(len(repeated)):
                digest = xxhash.xxh3_128_digest(text[start : start + LENGTH])
                if repeated[start]:
                    if digest in seen:
                        continue
                    seen.add(digest)
                digests.append(digest)
                places.append(start)
            strings = np.empty(len(places), _STRING)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            strings["c"], strings["d"], strings["a"], strings["b"], strings["start"] = halves[:, 0], halves[:, 1], x, y, places
            lists.append(strings)
        own = _spans_table([w for w in within if w[2]])
        strings = np.concatenate(lists)
        strings = strings[np.lexsort((strings["d"], strings["c"]))]
        # slices are ranges of digests
        slice_of = ((strings["c"].astype(np.float64) + 2.0**63) / 2.0**64 * slices).astype(np.int64).clip(0, slices - 1)
        numbers, begins = np.unique(slice_of, return_index=True)
        ends = [*begins[1:].tolist(), len(strings)]
        parts = [strings[i:j].tobytes() for i, j in zip(begins.tolist(), ends)]
        own = own.append_column("slice", pa.nulls(len(own), pa.int32())).append_column("strings", pa.nulls(len(own), pa.binary()))
        n = len(parts)
        cut = pa.table({"a": pa.nulls(n, pa.int64()), "b": pa.nulls(n, pa.int64()), "spans": pa.nulls(n, _SPANS),
                        "slice": pa.array(numbers, pa.int32()), "strings": pa.array(parts, pa.binary())})
        return pa.concat_tables([own, cut])

    return run


def _merged(group: pa.Table) -> pa.Table:
    """Strings that several shards have: each shard's list searched for the digests of the others', by bisection."""
    lists = [np.frombuffer(x.as_py(), _STRING) for x in group["strings"]]
    everything = np.concatenate(lists)
    digests = np.empty(len(everything), [("c", "<i8"), ("d", "<i8")])
    digests["c"], digests["d"] = everything["c"], everything["d"]
    ordered = np.sort(digests)
    times = np.searchsorted(ordered, digests, "right") - np.searchsorted(ordered, digests, "left")
    shared = everything[times > 1]
    shared = shared[np.lexsort((shared["start"], shared["b"], shared["a"]))]
    heads = np.flatnonzero(np.concatenate([[True], (shared["a"][1:] != shared["a"][:-1]) | (shared["b"][1:] != shared["b"][:-1])])) if len(shared) else []
    ends = [*list(heads[1:]), len(shared)]
    return _spans_table(
        [(int(shared["a"][i]), int(shared["b"][i]), spans_of(shared["start"][i:j].astype(np.int64))) for i, j in zip(heads, ends)]
    )


def _kept(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    for row in batch.to_pylist():
        data = row["text"].encode()
        merged: list[list[int]] = []
        for span in sorted((x["begin"], x["end"]) for x in row["spans"]):
            if merged and span[0] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], span[1])
            else:
                merged.append(list(span))
        kept, at = hashlib.sha256(), 0
        for begin, end in merged:
            kept.update(data[at:begin])
            at = end
        kept.update(data[at:])
        out.append((row["key"], sum(e - b for b, e in merged), len(merged), kept.hexdigest(),
                    [{"begin": b, "end": e} for b, e in merged]))
    columns = list(zip(*out))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3]),
         pa.array(columns[4], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
        names=["key", "n_removed", "n_spans", "kept_sha256", "spans"],
    )


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte that a string of ``LENGTH`` bytes covers which starts anywhere
    else too, in the same document or another; strings never cross documents.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that
    stay) and spans (removed bytes as begin and end). Null and short texts lose nothing.
    Every row is a document: of rows that repeat ID and text all lose their bytes. Other columns are not read.
    """
    spark = docs.sparkSession
    with temporary_tables(spark):
        rows = id_and_text(docs, id_col, text_col).select(
            content_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text"
        )
        schema = "key binary, doc_id long, n_bytes long, sha256 string, rights array<long>, lefts array<long>"
        base = map_batches(rows, _anchored, schema).withColumn("num", F.monotonically_increasing_id())
        base = written(base, "anchors")
        total = base.count()
        twice = written(base.groupBy("key").agg(F.min("num").alias("first"), F.count("*").alias("times")).where("times > 1"), "repeated-rows")
        named = written(join_split(base.select("key", "doc_id", "n_bytes", "sha256", "num"), twice, "key", "times", total, "left"), "rows")
        single = keep_matching(base, named.where("first != num"), "num", "left_anti")
        marked = _marked(single, total)
        texts = keep_matching(rows.select("key", "text"), marked, "key").dropDuplicates(["key"])
        texts = written(texts.join(marked, "key"), "marked-texts")
        by_doc = _repeated_spans(texts)
        cut = map_batches(
            texts.select("num", "key", "text").join(by_doc, "num").select("key", "text", "spans"), _kept,
            "key binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:long,end:long>>",
        )
        # a row that comes more than once is repeated from end to end
        whole = F.col("times").isNotNull() & (F.col("n_bytes") >= LENGTH)
        spans = "array<struct<begin:bigint,end:bigint>>"
        everything = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
        joined = named.where(~whole).join(cut, "key", "left").select(
            "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
            F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), F.coalesce("spans", F.array().cast(spans)).alias("spans"),
        )
        gone = named.where(whole).select(
            "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
            F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"), everything.cast(spans).alias("spans"),
        )
        return written(joined.union(gone), "kept-bytes", keep=True)


def _marked(single: DataFrame, total: int) -> DataFrame:
    """num, key and marks (pieces, with the sides that another piece has too) of the documents that have any."""
    with temporary_tables(single.sparkSession):

        def exploded(column: str, side: int) -> DataFrame:
            return single.select("num", F.lit(side).alias("side"), F.posexplode(column).alias("place", "hash")).where("hash != 0")

        sides = exploded("rights", 1).union(exploded("lefts", 2))
        # a left side that is the right one has been hashed once more, so the two never meet
        shared = written(sides.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "shared-sides")
        found = join_split(sides, shared, "hash", "n", total)
        marks = found.groupBy("num").agg(F.collect_list(F.struct("place", "side")).alias("marks"))
        return written(single.select("num", "key").join(marks, "num"), "marked", keep=True)


def _repeated_spans(texts: DataFrame) -> DataFrame:
    """num and spans of the documents that hold repeated strings."""
    spark = texts.sparkSession
    with temporary_tables(spark):
        pieces = written(map_batches(texts.select("num", "text", "marks"), _cut, "num long, begin long, end long, gram long, a long, b long"), "pieces")
        distinct = pieces.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("num", "begin", "end", "gram")).alias("one"))
        distinct = written(distinct.select("a", "b", "n", "one.*"), "distinct-pieces")
        grams = distinct.groupBy("gram").agg(F.sum(F.col("end") - F.col("begin")).alias("size"))
        # a piece that no other has the anchor of may still repeat itself
        homes = written(distinct.join(grams, "gram"), "homes")
        hot = F.col("size") > SHARD // 2
        cold_size, hot_size = homes.agg(*(F.coalesce(F.sum(F.when(c, F.col("end") - F.col("begin"))), F.lit(0)) for c in (~hot, hot))).first()
        shards = max(1, -(-int(cold_size) // SHARD))

        def with_text(chosen: DataFrame) -> DataFrame:
            lists = chosen.groupBy("num").agg(F.collect_list(F.struct("gram", "a", "b", "begin", "end")).alias("pieces"))
            return map_batches(
                texts.select("num", "text").join(lists, "num").select("text", "pieces"), _texts, "gram long, a long, b long, piece binary"
            )

        schema = "a long, b long, spans array<struct<from:long,to:long>>"
        dealt = with_text(homes.where(~hot)).withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)).cast("int"))
        removed = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(_sorted_shard, schema)
        if hot_size:
            parts = -(-int(hot_size) * 4 // SHARD)
            strings = with_text(homes.where(hot)).withColumn("shard", F.pmod(F.xxhash64("a", "b"), F.lit(parts)).cast("int"))
            strings = written(strings.repartition(parts, "shard").groupBy("shard").applyInArrow(_spread_shard(parts), _SPREAD), "strings")
            # no more strings than bytes: a slice of all is as large as what one shard has
            merged = strings.where("slice IS NOT NULL").select("slice", "strings").groupBy("slice").applyInArrow(_merged, schema)
            removed = removed.union(strings.where("slice IS NULL").select("a", "b", "spans")).union(merged)
        whole = distinct.where("n > 1").select(
            "a", "b", F.array(F.struct(F.lit(0).cast("long").alias("from"), (F.col("end") - F.col("begin")).alias("to"))).alias("spans")
        )
        # one row a piece, so that a piece of many documents is joined once for each
        removed = removed.union(whole).groupBy("a", "b").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
        removed = written(removed.join(distinct.select("a", "b", "n"), ["a", "b"]), "repeated-spans")
        moved = F.transform("spans", lambda x: F.struct((F.col("begin") + x["from"]).alias("begin"), (F.col("begin") + x["to"]).alias("end")))
        found = join_split(pieces.select("num", "begin", "a", "b"), removed, ["a", "b"], "n", pieces.count())
        by_doc = found.select("num", moved.alias("spans")).groupBy("num").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        return written(by_doc, "spans-by-document", keep=True)
