"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A sketch takes the shingles (runs of words, labelled by how often they came before) with
the smallest hashes and keeps them in text order, so that it tells texts that
have the same shingles in another order apart. Texts with an equal sketch share a
bucket. All pairs of a bucket are decided: some texts of it, its pivots, are aligned with
all others but those already linked to them, then leave it; where texts of several classes
stay, four times as many pivots follow. Texts with most links are pivots first, so the middle of a large
group soon links it. No bucket is capped, and nothing is dropped before it is compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from annoflow.llm.common import content_key, id_and_text, join_counted, keep_matching, map_batches, one_row_each
from annoflow.llm.components import components
from annoflow.llm.hashing import BASE, STEP, mix, prefix_sums, run_hashes
from annoflow.session import temporary_path, temporary_tables, written

#: Sketches of a text.
SKETCHES = 120
#: Texts with words from, to: words of a shingle, shingles of a sketch. The ranges overlap by so
#: much that texts that can be similar have one in common.
KINDS = ((8, 30, 2, 2), (24, 100, 2, 3), (80, 1 << 60, 3, 2))
#: Texts of up to so many words meet if they are equal but for one word: they can differ in no more.
TINY = 9
#: Bits of a text that tell by their parity how many words differ at least, in longs.
PARITY = 16
#: Texts of so many words, for which these bits are too few, have ``FINE`` longs more of them.
LONG, FINE = 500, 64
#: Least share of words that alignment leaves as they are.
SIMILARITY = 0.8


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, all words at once; blanks and control characters part words."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    inside = np.concatenate([[False], data > 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    return run_hashes(prefix_sums(data), starts, ends)


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash of each run of ``size`` words; of all words, if fewer."""
    width = min(size, len(words))
    if not width:
        return np.empty(0, np.uint64)
    out = np.full(len(words) - width + 1, np.uint64(width))
    for i in range(width):
        out = mix(out * STEP + words[i : len(words) - width + 1 + i])
    return out


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingles (or words) told apart by how many equal ones came before."""
    if not len(shingles):
        return shingles
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    heads = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    nth = np.arange(len(ordered)) - np.maximum.accumulate(np.where(heads, np.arange(len(ordered)), 0))
    out = np.empty_like(shingles)
    out[order] = mix(ordered + nth.astype(np.uint64) * BASE)
    return out


def sketches(shingles: np.ndarray, marks: np.ndarray, seeds: np.ndarray, picks: int) -> np.ndarray:
    """For each seed, a hash of the ``picks`` smallest shingles in text order.

    ``marks`` are the labelled shingles. No shingles: no sketches.
    """
    if not len(shingles):
        return np.empty(0, np.uint64)
    picks = min(picks, len(shingles))
    out = np.empty(len(seeds), np.uint64)
    step = max(1, 500_000 // len(shingles))
    for at in range(0, len(seeds), step):
        part = seeds[at : at + step]
        # marks are scattered already: a product by another odd number each orders them anew
        ranks = marks[None, :] * (part[:, None] | np.uint64(1))
        rows = np.arange(len(part))
        places = np.empty((len(part), picks), int)
        for p in range(picks):
            places[:, p] = ranks.argmin(1)
            ranks[rows, places[:, p]] = np.uint64(2**64 - 1)
        places.sort(1)
        found = part.copy()
        for p in range(picks):
            found = mix(found * STEP + shingles[places[:, p]])
        out[at : at + step] = found
    return out


SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * BASE)


def bucket_keys(words: np.ndarray) -> np.ndarray:
    """The buckets of a text, given as word hashes."""
    n = len(words)
    keys = []
    if 0 < n <= TINY:
        # the words, and all but one of them
        for left in (words, *(np.delete(words, i) for i in range(n if n > 4 else 0))):
            keys.append(mix(shingle_hashes(left, TINY) * STEP + BASE))
    for least, most, size, picks in KINDS:
        if least <= n <= most:
            shingles = shingle_hashes(words, size)
            keys.append(sketches(shingles, labelled(shingles), SEEDS, picks))
    return np.unique(np.concatenate(keys)) if keys else np.empty(0, np.uint64)


def parity_bits(marks: np.ndarray, longs: int = PARITY) -> np.ndarray:
    """For each of 64 * ``longs`` classes of labelled words, whether the text has an odd number of them: an edit
    takes away the last label of one word at most, and adds one to another, so it changes two bits at most."""
    odd = np.bincount((marks >> np.uint64(20)).astype(np.int64) % (64 * longs), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


# --- alignment ----------------------------------------------------------------


def allowed(n: int, m: int, similarity: float) -> int:
    """Most edits that two texts of ``n`` and ``m`` words may be apart."""
    return int((1 - similarity) * max(n, m) + 1e-9)


def edits_within(a: list[np.ndarray], b: list[np.ndarray], band: int, most: list[int] | None = None) -> np.ndarray:
    """Word edits (insert, delete, replace) between each a and b, looking only ``band``
    words off the diagonal: exact where the result is at most ``band``, and at most ``most`` if that is
    given. Ends as soon as every pair has more edits than that, whatever follows."""
    many = len(a)
    n, m = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    rows, width = int(n.max(initial=0)), 2 * band + 1
    far = np.int32(1 << 29)
    left = np.zeros((many, rows), np.uint64)
    right = np.zeros((many, rows + 2 * band + 1), np.uint64)
    held = np.zeros((many, rows + 2 * band + 1), bool)
    for p in range(many):
        left[p, : n[p]] = a[p]
        size = min(m[p], rows + band + 1)
        right[p, band : band + size] = b[p][:size]
        held[p, band : band + size] = True
    steps = np.arange(width, dtype=np.int32)
    row = np.where(steps >= band, steps - band, far)[None, :].repeat(many, 0).astype(np.int32)
    out = np.full(many, far)
    place = m - n + band
    inside = (place >= 0) & (place < width)

    def keep(i: int) -> None:
        ended = inside & (n == i)
        out[ended] = row[ended, place[ended]]

    keep(0)
    for i in range(rows):
        window = slice(i, i + width)
        differ = (right[:, window] != left[:, i : i + 1]) | ~held[:, window]
        # column k of row i + 1 is word i + 1 + k - band of b
        new = row + differ
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        new[:, :] = np.minimum(new, far)
        row = np.minimum.accumulate(new - steps, 1) + steps
        keep(i + 1)
        if most is not None and i % 64 == 63 and (row.min(1) > most).all():
            break
    return out


def common(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two arrays have in common, repeated ones as often as both have them."""
    u, c = np.unique(x, return_counts=True)
    v, d = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    return int(np.minimum(c[i], d[j]).sum())


def edits_at_least(x: np.ndarray, y: np.ndarray) -> int:
    """A bound from below: an edit takes one word from what both have, and two pairs of neighbours."""
    longest = max(len(x), len(y))
    words = longest - common(x, y)
    if min(len(x), len(y)) < 2:
        return words
    pairs = longest - 1 - common(mix(x[:-1] * STEP + x[1:]), mix(y[:-1] * STEP + y[1:]))
    return max(words, -(-pairs // 2))


def edits_at_most(x: np.ndarray, y: np.ndarray) -> int:
    """A bound from above, from one way to turn x into y: words that each has once, as long as their places
    go up in both, stay; what stands between two of them is replaced."""
    u, c = np.unique(x, return_counts=True)
    v, d = np.unique(y, return_counts=True)
    both = np.intersect1d(u[c == 1], v[d == 1], assume_unique=True)
    if not len(both):
        return max(len(x), len(y))
    i = np.flatnonzero(np.isin(x, both))
    order = np.argsort(y, kind="stable")
    j = order[np.searchsorted(y[order], x[i])]
    # of places in y that do not go up those far off the usual shift are left out first
    shift = j - i
    near = np.abs(shift - np.median(shift)) <= np.abs(len(x) - len(y)) + 8
    i, j = i[near], j[near]
    up = j > np.concatenate([[-1], np.maximum.accumulate(j)[:-1]]) if len(j) else np.empty(0, bool)
    i = np.concatenate([[-1], i[up], [len(x)]])
    j = np.concatenate([[-1], j[up], [len(y)]])
    gap_x, gap_y = np.diff(i) - 1, np.diff(j) - 1
    bound = np.maximum(gap_x, gap_y)
    for g in np.flatnonzero((gap_x == gap_y) & (gap_x > 0)):
        # words of a gap as long in both that are the same stay too
        bound[g] = np.count_nonzero(x[i[g] + 1 : i[g + 1]] != y[j[g] + 1 : j[g + 1]])
    return int(bound.sum())


def measured(a: list[np.ndarray], b: list[np.ndarray], similarity: float) -> list[tuple[bool, int]]:
    """Whether each two texts, as word hashes, align with ``similarity`` or more, and
    the edits between them: no fewer than there are if they do, else no more than there are.

    Bounds from below and above settle most pairs. What they leave is aligned in bands that double until the
    edits fit in one or the edits allowed do.
    """
    out = [(False, 0)] * len(a)
    left = []
    for p, (x, y) in enumerate(zip(a, b)):
        most = allowed(len(x), len(y), similarity)
        least = edits_at_least(x, y)
        out[p] = (False, least)
        if least <= most:
            highest = edits_at_most(x, y)
            if highest <= most:
                out[p] = (True, highest)
            else:
                left.append((p, most))
    band = 8
    while left:
        left.sort(key=lambda q: len(a[q[0]]))
        following, at = [], 0
        while at < len(left):
            size = 1
            # rows of a batch are as long as its longest text: 16 MB at most
            while at + size < len(left) and size < 128 and (size + 1) * len(a[left[at + size][0]]) * 24 <= 16_000_000:
                size += 1
            part = left[at : at + size]
            at += size
            found = edits_within([a[p] for p, _ in part], [b[p] for p, _ in part], band, [m for _, m in part])
            for (p, most), edits in zip(part, found):
                if edits <= band or band >= most:
                    out[p] = (True, int(edits)) if edits <= most else (False, most + 1)
                else:
                    following.append((p, most))
        left, band = following, band * 2
    return out


def similar(a: list[np.ndarray], b: list[np.ndarray], similarity: float) -> list[bool]:
    return [x for x, _ in measured(a, b, similarity)]


# --- stages -------------------------------------------------------------------


def _sketched(batch: pa.RecordBatch) -> pa.RecordBatch:
    found, bits, fine, counts, sizes = [], [], [], [0], []
    for value in batch.column(2):
        words = word_hashes(value.as_py())
        keys = bucket_keys(words)
        found.append(keys)
        marks = labelled(words)
        bits.append(parity_bits(marks))
        fine.append(parity_bits(marks, FINE) if len(words) >= LONG else None)
        counts.append(counts[-1] + len(keys))
        sizes.append(len(words))
    flat = np.concatenate(found).view(np.int64)
    places = pa.array(np.arange(len(bits) + 1) * PARITY, pa.int32())
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(flat)),
         pa.ListArray.from_arrays(places, pa.array(np.concatenate(bits))), pa.array(fine, pa.list_(pa.int64()))],
        names=["key", "doc_id", "n_words", "buckets", "bits", "fine"],
    )


def _aligned(similarity: float):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[int, np.ndarray] = {}
        pairs = batch.select(["a", "b"]).to_pydict()
        for side in ("a", "b"):
            for num, text in zip(pairs[side], batch.column(batch.schema.get_field_index(f"text_{side}"))):
                if num not in known:
                    known[num] = word_hashes(text.as_py())
        found = similar([known[n] for n in pairs["a"]], [known[n] for n in pairs["b"]], similarity)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs["a"], pa.int64()), pa.array(pairs["b"], pa.int64()), pa.array(found, pa.bool_())],
            names=["a", "b", "similar"],
        )

    return run


def _labelled(new: DataFrame) -> DataFrame:
    """The table that ``_relabelled`` returns, of the first links: labels are smallest texts of components."""
    links = new.where("similar").select(F.explode(F.array("a", "b")).alias("num")).groupBy("num").agg(F.count("*").alias("links"))
    found = components(new.where("similar"), "a", "b").select(F.col("node").alias("num"), F.col("component").alias("label"))
    return written(found.join(links, "num").select("num", "label", "links"), "labels")


def _relabelled(labels: DataFrame, new: DataFrame) -> DataFrame:
    """num, label (a text it is linked to over any steps, the smallest one known) and links of each
    linked text, from those before and the new links."""
    links = new.where("similar").select(F.col("a").alias("num"), F.col("b").alias("other"))
    links = links.union(links.select(F.col("other").alias("num"), F.col("num").alias("other")))
    known = labels.select(F.col("num").alias("other"), F.col("label").alias("theirs"))
    near = links.join(known, "other", "left").groupBy("num").agg(F.min(F.least("num", "other", "theirs")).alias("near"), F.count("*").alias("more"))
    both = labels.join(near, "num", "full").select(
        "num", F.least("label", "near").alias("label"), (F.coalesce("links", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("links")
    )
    both = written(both, "near-labels")
    # the label's own label is further on
    further = both.select(F.col("num").alias("label"), F.col("label").alias("further"))
    return written(both.join(further, "label", "left").select("num", F.least("label", "further").alias("label"), "links"), "labels")


def near_classes(
    docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The class of each document: texts linked, over any number of steps, by word
    edits of at most ``1 - similarity`` of the longer one's words.

    Returns key (see ``content_key``), doc_id, class_id (smallest ID of the class, null if it
    has none), class_size (rows) and kept (true for one row of each class, that
    with the smallest ID). Equal texts are one class; so are all null and empty
    texts and, apart from them, all blank texts without words that are equal. Rows that
    repeat ID and text come back as often as they came, one of them kept. Other
    columns are not read.

    Similar texts of up to 9 words always meet. Of longer ones, an edit takes at most as many
    shingles as a shingle has words: wherever the edits to a fifth of the words stand, c of u different
    labelled shingles stay common, c / u at least 0.38 from 10 words on (shingles of two words) and 0.24 above
    100 (of three), and the chance that none of the 120 sketches is shared is below 0.001
    (C(c, picks) / C(u, picks) for each). Where edits to a fifth are scattered over more than 100 words, it is about
    1e-6. All texts that share a sketch are decided; later rounds lose none.
    """
    spark = docs.sparkSession
    with temporary_tables(spark):
        rows = id_and_text(docs, id_col, text_col).select(
            content_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text"
        )
        schema = "key binary, doc_id long, n_words int, buckets array<long>, bits array<long>, fine array<long>, content binary"

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = _sketched(batch)
            return out.append_column("content", batch.column(3))

        base = map_batches(rows.withColumn("content", F.unhex(F.md5(F.col("text").cast("binary")))), run, schema)
        base = written(base.withColumn("num", F.monotonically_increasing_id()), "sketches")
        copies = written(base.groupBy("content").agg(F.min("num").alias("num"), F.count("*").alias("copies")), "different-texts")
        repeated = copies.where("copies > 1").select("content", F.col("num").alias("first_num"))
        repeats = join_counted(base.select("num", "content"), repeated, "content").where("num != first_num")
        # the sketches are not shuffled to leave out the few texts that were there before
        classes = _classes(rows, keep_matching(base, written(repeats.select("num"), "repeats"), "num", "left_anti"), similarity)
        named = (
            base.select("num", "key", "doc_id", "content").join(copies.select("content", F.col("num").alias("first_num")), "content")
            .join(classes.withColumnRenamed("num", "first_num"), "first_num", "left")
            .withColumn("class", F.coalesce("class", "first_num"))
        )
        named = written(named.select("num", "key", "doc_id", "class"), "classes")
        first = named.groupBy("class").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "num")).alias("first"), F.count("*").alias("class_size")
        )
        out = named.join(first, "class").select(
            "key", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("num") == F.col("first.num")).alias("kept")
        )
        return written(out, "near-classes", keep=True)


def _classes(rows: DataFrame, firsts: DataFrame, similarity: float) -> DataFrame:
    """num and class of every text that is linked to another. Every pair of texts that share a bucket
    is aligned, or found apart by length or words, or linked already."""
    spark = rows.sparkSession
    with temporary_tables(spark):
        # most buckets hold one text: what is sorted to find the others is as narrow as can be
        placed = firsts.select("num", F.explode("buckets").alias("bucket"))
        shared = written(placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "bucket-sizes")
        met = written(placed.join(shared, "bucket"), "shared-buckets")
        # texts that meet many others are likely to lie in the middle of their group: they are compared with it first
        weights = met.groupBy("num").agg(F.sum("size").alias("weight"))
        weights = weights.join(firsts.select("num", "n_words", *(folded_bits("bits", i, 2).alias(x) for i, x in enumerate(("even", "odd")))), "num")
        left = written(met.drop("size").join(weights, "num").withColumns({"label": F.col("num"), "links": F.lit(0).cast("long")}), "buckets")
        keys = written(firsts.select("num", "key", "bits", "fine").join(left.select("num").distinct(), "num"), "bucket-keys")
        # rows that repeat ID and text have one key: their text is taken once
        texts = keep_matching(one_row_each(rows.select("key", "text")), keys, "key")
        texts = written(texts.join(keys, "key").select("num", "text", "bits", "fine"), "bucket-texts")

        # edits allowed, as ``allowed`` has them; each changes the length by one at most, and one that changes it
        # changes one bit at most, any other two
        most = F.floor((1 - similarity) * F.greatest("n_words", "p_words") + 1e-9)
        longer = F.abs(F.col("n_words") - F.col("p_words"))
        folded = sum(F.bit_count(F.col(x).bitwiseXOR(F.col(f"p_{x}"))) for x in ("even", "odd"))
        verdicts = temporary_path(spark, "verdicts")
        labels = spark.createDataFrame([], "num long, label long, links long")
        pivots_each, decided = 1, False
        # the first round looks at one pair a row; those that follow have all bits at hand, and few rows
        names = {"num": "p", "label": "p_label", "n_words": "p_words", "even": "p_even", "odd": "p_odd"}
        possible = (longer <= most) & (longer + folded <= 2 * most)
        while not left.isEmpty():
            # one pivot of each part of a bucket; parts are dealt anew each round
            part = F.pmod(F.xxhash64("num", F.lit(pivots_each)), F.lit(pivots_each))
            best = F.min(F.struct((-F.col("links")).alias("rank"), (-F.col("weight")).alias("next"), *names)).alias("pivot")
            pivots = left.groupBy("bucket", part.alias("part")).agg(best)
            pivots = written(pivots.select("bucket", *(F.col(f"pivot.{n}").alias(p) for n, p in names.items())), "pivots")
            met = left.join(pivots, "bucket").where((F.col("num") != F.col("p")) & (F.col("label") != F.col("p_label")) & possible)
            pairs = met.select(F.least("num", "p").alias("a"), F.greatest("num", "p").alias("b"), most.alias("most")).distinct()
            if decided:
                pairs = pairs.join(_verdicts(spark, verdicts), ["a", "b"], "left_anti")
            pairs = written(pairs, "pairs")
            if pivots_each == 1:
                pairs = _close(pairs, texts)
            if not pairs.isEmpty():
                new = _decided(pairs, texts, similarity)
                new.write.mode("append").parquet(verdicts)
                decided = True
                if not new.where("similar").isEmpty():
                    # nearly all links are found first: what they link over any steps is not compared again
                    labels = _relabelled(labels, new) if pivots_each > 1 else _labelled(new)
            # a pivot is decided with all of its bucket; a bucket of texts linked to each other needs no more
            rest = left.drop("label", "links").join(pivots.select("bucket", F.col("p").alias("num")), ["bucket", "num"], "left_anti")
            named = rest.join(labels, "num", "left").withColumns({"label": F.coalesce("label", "num"), "links": F.coalesce("links", F.lit(0))})
            mixed = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
            left = named.join(mixed.select("bucket"), "bucket").select(left.columns)
            if pivots_each == 1:
                left = left.drop("even", "odd").join(texts.select("num", "bits", "fine"), "num")
                names = {"num": "p", "label": "p_label", "n_words": "p_words", "bits": "p_bits", "fine": "p_fine"}
                possible = (longer <= most) & (longer + bits_apart("bits", "p_bits") <= 2 * most) & (longer + fine_apart("fine", "p_fine") <= 2 * most)
            left = written(left, "undecided")
            pivots_each *= 4
        if not decided:
            return spark.createDataFrame([], "num long, class long")
        found = components(_verdicts(spark, verdicts).where("similar"), "a", "b")
        return written(found.select(F.col("node").alias("num"), F.col("component").alias("class")), "linked", keep=True)


def _verdicts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("a long, b long, similar boolean").parquet(path)


def _close(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that all bits of their words do not tell apart."""
    bits = [texts.select(F.col("num").alias(x), F.col("bits").alias(f"bits_{x}"), F.col("fine").alias(f"fine_{x}")) for x in "ab"]
    apart = F.greatest(bits_apart("bits_a", "bits_b"), fine_apart("fine_a", "fine_b"))
    return written(pairs.join(bits[0], "a").join(bits[1], "b").where(apart <= 2 * F.col("most")).select("a", "b"), "close-pairs")


def _decided(close: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """a, b and similar: the pairs aligned. Only theirs are the texts that are moved."""
    close = close.select("a", "b")
    nums = close.select(F.col("a").alias("num")).union(close.select(F.col("b").alias("num")))
    needed = keep_matching(texts.select("num", "text"), nums, "num")
    sides = [needed.select(F.col("num").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab"]
    both = close.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b")
    return written(map_batches(both, _aligned(similarity), "a long, b long, similar boolean"), "alignments")


def folded_bits(column: str, first: int, step: int) -> Column:
    """Every ``step``-th long of an array, from ``first`` on, folded into one: two texts differ in no more of its bits."""
    out = F.col(column)[first]
    for i in range(first + step, PARITY, step):
        out = out.bitwiseXOR(F.col(column)[i])
    return out


def bits_apart(a: str, b: str) -> Column:
    """In how many of their bits two arrays of ``PARITY`` longs differ."""
    return sum(F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(PARITY))


def fine_apart(a: str, b: str) -> Column:
    """The same for two arrays of ``FINE`` longs; 0 if one is missing."""
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return F.coalesce(apart, F.lit(0))
