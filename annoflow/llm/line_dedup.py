"""Removal of lines that match an earlier line: an exact set-similarity join.

The words of a line, as a set, are ordered by how rare they are. Two lines that are
similar enough share a word in the first few of that order (prefix filter); where in the
order it stands (positional filter) and how many words the lines have (length filter)
say whether they can be. What passes is verified.

Lines that are equal count once. A list of lines under one word is first met by
its earliest line alone, which settles groups of near copies without listing
their pairs; the rest is met by those of the list that are long and short enough, and bits of
the words tell most of them apart where they meet, so that few pairs are ever rows. The words of
prefixes take many times the room of the lines: they are listed a share at a time.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from annoflow.llm.common import content_key, id_and_text, join_counted, keep_matching, one_row_each, shielded, with_key
from annoflow.session import temporary_tables, written

#: Least share of common words, as a fraction: 4 / 5.
NUMERATOR, DENOMINATOR = 4, 5
#: Counters of word frequencies, each for the words of one hash: a megabyte of classes.
COUNTERS = 1 << 20
_HASH_BITS = 56
#: The words of prefixes are listed in so many shares at most, and in no more than give each so many words.
SHARES, SHARE_WORDS = 8, 1 << 20


def line_words(line: Column) -> Column:
    """The words of a line, repeated ones too, and empty ones; blanks part words.

    Plain spaces are cut at without a regular expression, which most lines need not.
    """
    odd = line.contains("\t") | line.contains("\x0b") | line.contains("\f") | line.contains("\r")
    return F.when(odd, F.split(line, r"\s+")).otherwise(F.split(line, " "))


def word_hashes(line: Column) -> Column:
    """64-bit hashes of the distinct words of a line."""
    return F.array_distinct(F.transform(F.array_remove(line_words(line), ""), lambda w: F.xxhash64(w)))


def rarity_classes(texts: DataFrame) -> DataFrame:
    """One row, one array: for each counter, a class that grows with the logarithm of its words'
    frequency in all of ``text``."""
    words = texts.select(F.explode(line_words(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))).alias("word")).where("word != ''")
    counts = words.groupBy(_counter(F.xxhash64("word")).alias("counter")).agg(F.count("*").alias("n"))
    classes = counts.select("counter", F.floor(4 * F.log2(F.col("n") + 1)).cast("tinyint").alias("class"))
    every = texts.sparkSession.range(COUNTERS).select(F.col("id").cast("int").alias("counter"))
    full = written(every.join(classes, "counter", "left").select("counter", F.coalesce("class", F.lit(0).cast("tinyint")).alias("class")), "rarity")
    # COUNTERS rows, whatever the corpus
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("counter", "class"))), lambda x: x["class"]).alias("classes"))


def _counter(code: Column) -> Column:
    return code.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")


def _codes(hashes: Column, classes: Column) -> Column:
    """Hashes as numbers that sort by rarity class, then hash."""

    def code(h):
        return F.shiftleft(F.element_at(classes, _counter(h) + 1).cast("long"), _HASH_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << _HASH_BITS) - 1)))

    return F.sort_array(F.transform(hashes, code))


def _parity(hashes: Column, lane: int) -> Column:
    """64 bits, each whether an odd number of the words of a lane have it: two lines differ in
    no more bits than in words."""

    def toggle(bits, h):
        own = F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(1)) == lane
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
        return F.when(own, bits.bitwiseXOR(bit)).otherwise(bits)

    return F.aggregate(hashes, F.lit(0).cast("long"), toggle)


def _prefix(n: Column) -> Column:
    """Words of the order within which a similar line must share one."""
    return n - F.ceil(n * NUMERATOR / DENOMINATOR) + 1


def _can_match(n: Column, pos: Column, m: Column, at: Column) -> Column:
    """Length filter, and positional filter: what can still be common from the shared word on."""
    long_enough = (n * DENOMINATOR >= m * NUMERATOR) & (m * DENOMINATOR >= n * NUMERATOR)
    common = F.least(n - pos, m - at)
    return long_enough & (common * (NUMERATOR + DENOMINATOR) >= (n + m) * NUMERATOR)


def later_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines that have words in common with an earlier line to a Jaccard similarity of
    0.8 or more, in the order of doc_id and place, whether that earlier line stays or not.

    Returns key (see ``content_key``) and removed (numbers of such lines, from 0) of each document
    that has any. Lines end at newlines; blank ones match nothing. Words are told
    apart by 56 bits of their hash while candidates are sought and by 64 when they are verified.
    Null and empty texts are one blank line. Rows that repeat ID and text are one document; a null
    ID comes before all others, and of texts with one ID the one with the smaller digest of ID and text comes first. Other
    columns are not read.
    """
    spark = docs.sparkSession
    with temporary_tables(spark):
        rows = id_and_text(docs, id_col, text_col).select(
            content_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text"
        )
        single = one_row_each(rows)
        with temporary_tables(spark):
            coded = _coded_lines(single)
            copies = coded.groupBy("lid").agg(F.min("num").alias("first_num"), F.count("*").alias("times")).where("times > 1")
            copies = written(copies.select("lid", "first_num"), "copied-lines")
            marked = join_counted(coded, copies, "lid", "left")
            again = written(marked.where("first_num != num").select("key", "line_no"), "repeated-lines", keep=True)
            firsts = marked.where("first_num IS NULL OR first_num = num").drop("lid", "first_num")
            firsts = written(firsts, "slim-lines", keep=True)
        words = firsts.agg(F.sum(F.size("prefix"))).first()[0] or 0
        shares = [(i, many) for many in [min(SHARES, max(1, -(-words // SHARE_WORDS)))] for i in range(many)]

        # the earliest line of each list meets the others
        led = reduce(DataFrame.union, [written(_led(_listed(firsts, *share)), "shared-words") for share in shares])
        done = _verified(_close(led.distinct(), firsts), firsts, rows)

        # the rest: each line of a list meets those before it
        settled = written(done.select(F.col("y").alias("num")).distinct(), "settled-lines")
        pairs = [written(_met(_listed(firsts, *share), settled), "aimed-words") for share in shares]
        pairs = written(reduce(DataFrame.union, pairs).distinct(), "candidates")
        matches = done.union(_verified(pairs, firsts, rows))
        similar = firsts.join(matches.select(F.col("y").alias("num")).distinct(), "num", "left_semi").select("key", "line_no")
        found = again.union(similar).groupBy("key").agg(F.collect_set("line_no").alias("removed"))
        return written(found, "removed-lines", keep=True)


def _coded_lines(single: DataFrame) -> DataFrame:
    """A row for each line with words: number, document, digest, words in its set, the first of
    their codes, and bits of all. Numbers go up in the order of ID (none first), digest of ID and text, and line."""
    with temporary_tables(single.sparkSession):
        order = [F.col("doc_id").asc_nulls_first(), F.col("key")]
        ordered = single.repartitionByRange(*order).sortWithinPartitions(*order)
        lines = ordered.select("key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        coded = lines.withColumn("classes", rarity_classes(single).scalar())
        coded = coded.withColumn("codes", _codes(word_hashes(F.col("line")), F.col("classes"))).withColumn("n", F.size("codes"))
        base = coded.where("n > 0").select(
            F.monotonically_increasing_id().alias("num"), "key", "line_no",
            F.unhex(F.md5(F.col("line").cast("binary"))).alias("lid"), "n",
            F.slice("codes", F.lit(1), _prefix(F.col("n")).cast("int")).alias("prefix"),
            _parity(F.col("codes"), 0).alias("even"), _parity(F.col("codes"), 1).alias("odd"),
        )
        return written(base, "lines", keep=True)


def _listed(firsts: DataFrame, share: int, shares: int) -> DataFrame:
    """The words of prefixes, with place and line, that are of one share of all words."""
    words = firsts.select("num", "n", "even", "odd", F.posexplode("prefix").alias("pos", "code"))
    return words if shares == 1 else words.where(F.pmod("code", F.lit(shares)) == share)


def _led(listed: DataFrame) -> DataFrame:
    """The earliest line (x) of each word with each other line (y) of it that it can match."""
    # what most words of a prefix need is to be found in no other: so few columns as can be go there
    shape = F.col("n").cast("long") * (1 << 32) + F.col("pos")
    listed = listed.select("code", "num", shape.alias("shape"))
    least = F.min(F.struct("num", "shape")).alias("head")
    shared = listed.groupBy("code").agg(F.count("*").alias("times"), least).where("times > 1").select("code", "head")
    unpacked = lambda shape: (F.shiftright(shape, 32).cast("int"), shape.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    others = (F.col("head.num") != F.col("num")) & _can_match(*unpacked(F.col("head.shape")), *unpacked(F.col("shape")))
    return listed.join(shared, "code").where(others).select(F.col("head.num").alias("x"), F.col("num").alias("y")).distinct()


def _met(listed: DataFrame, settled: DataFrame) -> DataFrame:
    """The lines (y) that are not settled with the earlier ones (x) that they share a word with and, by length, place
    of the word and bits, can match.

    Lists are parted by classes of length. Pairs are told apart inside the join: only the close ones become rows.
    """
    # least and most words that a line can have which matches from this word on
    fewest = F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)
    most = F.floor((F.col("n") * DENOMINATOR - F.col("pos") * (NUMERATOR + DENOMINATOR)) / NUMERATOR)
    width = 2 * math.log(DENOMINATOR / NUMERATOR)
    length_class = lambda n: F.floor(F.log(n.cast("double")) / width).cast("int")
    listed = listed.where(fewest <= most)
    later = keep_matching(listed, settled, "num", "left_anti").withColumn("class", length_class(F.col("n")))
    earlier = listed.select(
        "code", F.explode(F.sequence(length_class(fewest), length_class(most))).alias("class"),
        *(F.col(c).alias(f"x_{c}") for c in ("num", "n", "pos", "even", "odd")),
    )
    near = _can_match(F.col("x_n"), F.col("x_pos"), F.col("n"), F.col("pos"))
    alike = _alike(F.col("x_n"), F.col("n"), (F.col("x_even"), F.col("even")), (F.col("x_odd"), F.col("odd")))
    pairs = later.join(earlier, ["code", "class"]).where((F.col("x_num") < F.col("num")) & near & alike)
    return pairs.select(F.col("x_num").alias("x"), F.col("num").alias("y")).distinct()


def without_lines(
    docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False
) -> DataFrame:
    """``docs`` with the lines that ``later_lines`` found taken out of their texts. Texts without such lines, null
    ones too, stay as they are, and so do all other columns; with ``counts`` n_lines and n_removed
    come after them, in place of columns of these names."""
    names = [n for n in docs.columns if not counts or n not in ("n_lines", "n_removed")]
    safe, back = shielded(docs.select(names), id_col, text_col)
    keyed = with_key(safe.withColumnsRenamed({id_col: "doc_id", text_col: "text"}))
    joined = keyed.join(removed, "key", "left").withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    kept = F.array_join(F.transform(stay, lambda i: F.element_at(F.col("lines"), i + 1)), "\n")
    done = joined.withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept))
    done = done.withColumnsRenamed({"doc_id": id_col, "text": text_col})
    if not counts:
        return back(done)
    n_removed = F.coalesce(F.size("removed"), F.lit(0)).cast("long")
    return done.select(*safe.columns, F.size("lines").cast("long"), n_removed).toDF(*names, "n_lines", "n_removed")


def _alike(n: Column, m: Column, *lanes: tuple[Column, Column]) -> Column:
    """Whether the bits in which two lines differ, no more than the words in which they do, are few enough for the similarity."""
    apart = sum(F.bit_count(a.bitwiseXOR(b)) for a, b in lanes)
    # common words c >= (n + m) * 4 / 9, so at most (n + m) / 9 others
    return apart * (NUMERATOR + DENOMINATOR) <= (n + m) * (DENOMINATOR - NUMERATOR)


def _close(pairs: DataFrame, base: DataFrame) -> DataFrame:
    """The pairs (x, y) of line numbers that the bits of their words do not tell apart."""
    bits = base.select("num", "n", "even", "odd")
    sides = [bits.select(F.col("num").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("n", "even", "odd"))) for side in "xy"]
    alike = _alike(F.col("x_n"), F.col("y_n"), *((F.col(f"x_{c}"), F.col(f"y_{c}")) for c in ("even", "odd")))
    return written(pairs.join(sides[0], "x").join(sides[1], "y").where(alike).select("x", "y"), "candidates")


def _verified(pairs: DataFrame, base: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (x, y) of line numbers, compared word by word, whose word sets have the similarity."""
    with temporary_tables(base.sparkSession):
        return written(_similar(pairs, base, rows), "matches", keep=True)


def _similar(pairs: DataFrame, base: DataFrame, rows: DataFrame) -> DataFrame:
    nums = pairs.select(F.col("x").alias("num")).union(pairs.select(F.col("y").alias("num"))).distinct()
    wanted = written(base.join(nums, "num", "left_semi").select("num", "key", "line_no"), "candidate-lines")
    texts = keep_matching(rows.select("key", "text"), wanted, "key").dropDuplicates(["key"])
    by_doc = wanted.groupBy("key").agg(F.collect_list(F.struct("num", "line_no")).alias("wanted"))
    lines = texts.join(by_doc, "key").select(F.split("text", "\n").alias("lines"), F.explode("wanted").alias("one"))
    sets = lines.select(F.col("one.num").alias("num"), word_hashes(F.element_at("lines", F.col("one.line_no") + 1)).alias("set"))
    sets = written(sets, "candidate-sets")
    both = (
        pairs.join(sets.select(F.col("num").alias("x"), F.col("set").alias("a")), "x")
        .join(sets.select(F.col("num").alias("y"), F.col("set").alias("b")), "y")
    )
    common = F.size(F.array_intersect("a", "b"))
    enough = common * (NUMERATOR + DENOMINATOR) >= (F.size("a") + F.size("b")) * NUMERATOR
    return both.where(enough).select("x", "y")


LINES_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, count(*) AS times,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(concat(coalesce(doc_id::VARCHAR, ''), chr(0), coalesce(text, '')))) AS row
  FROM documents GROUP BY doc_id, coalesce(text, '')),
lines AS (
  SELECT row, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM docs),
worded AS (
  SELECT row_number() OVER (ORDER BY row, place) AS num, row, place, line,
         list_distinct(list_filter(regexp_split_to_array(line, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')) AS words FROM lines),
tokens AS (SELECT num, len(words) AS n, unnest(words) AS word FROM worded),
ranked AS (
  SELECT num, n, word, row_number() OVER (PARTITION BY num ORDER BY times, word) AS rank
  FROM tokens JOIN (SELECT word, count(*) AS times FROM tokens GROUP BY word) USING (word)),
prefixes AS (SELECT num, n, word FROM ranked WHERE rank <= n - ceil(0.8 * n - 1e-9) + 1),
pairs AS (
  SELECT DISTINCT a.num AS x, b.num AS y FROM prefixes a JOIN prefixes b USING (word)
  WHERE a.num < b.num AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4),
matched AS (
  SELECT DISTINCT y AS num FROM pairs JOIN worded a ON a.num = x JOIN worded b ON b.num = y
  WHERE len(list_intersect(a.words, b.words)) * 9 >= (len(a.words) + len(b.words)) * 4),
cleaned AS (
  SELECT row, count(*) AS n_lines, count(matched.num) AS n_removed,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE matched.num IS NULL), '')) AS kept_sha256
  FROM worded LEFT JOIN matched USING (num) GROUP BY row)
SELECT doc_id, n_lines, n_removed, kept_sha256 FROM (SELECT *, unnest(range(times)) FROM docs) JOIN cleaned USING (row)
"""
