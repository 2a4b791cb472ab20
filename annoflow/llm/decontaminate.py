"""Benchmark decontamination by a positional inverted index.

The index holds a posting (document, position) for each training word that a
benchmark item uses. A window of an item is looked up from its rarest words on: the
lists of the two rarest are shifted by their offsets in the window and intersected; what is left
must be in the shifted lists of all its other words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from annoflow.llm.common import content_key, id_and_text, join_counted, keep_matching
from annoflow.session import written

#: The letters that are lower-cased, and what parts words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window.
WIDTH = 10


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(plain, SEPARATORS), "")


@dataclass
class Phrases:
    """``windows``: wid and words, each once. ``items``: item_id and wid, each pair once."""

    windows: DataFrame
    items: DataFrame


def item_windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> Phrases:
    """Windows of ``width`` consecutive words; a shorter item with words is one window.
    Items without an ID or words have none."""
    words = items.where(items[id_col].isNotNull()).select(items[id_col].alias("item_id"), words_of(items[text_col]).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    cut = words.where(F.size("words") > 0).select("item_id", "words", F.explode(starts).alias("start"))
    cut = cut.select("item_id", F.slice("words", F.col("start") + 1, width).alias("words"))
    cut = written(cut.withColumn("wid", F.unhex(F.md5(F.array_join("words", " ").cast("binary")))), "windows")
    return Phrases(cut.select("wid", "words").dropDuplicates(["wid"]), cut.select("item_id", "wid").distinct())


@dataclass
class Index:
    """``terms``: word, term. ``postings``: key, pos, term."""

    terms: DataFrame
    postings: DataFrame


def build_index(docs: DataFrame, windows: DataFrame) -> Index:
    """Postings of ``docs`` (key, words) for every word of the windows."""
    terms = windows.select(F.explode("words").alias("word")).distinct()
    terms = written(terms.withColumn("term", F.monotonically_increasing_id()), "terms")
    placed = docs.select("key", F.posexplode("words").alias("pos", "word"))
    return Index(terms, written(join_counted(placed, terms, "word").select("key", "pos", "term"), "postings"))


def _ranked(index: Index, windows: DataFrame) -> DataFrame:
    """wid, n, offset, term and rank (1: the rarest in the index) of each window's words."""
    counts = index.postings.groupBy("term").agg(F.count("*").alias("times"))
    words = windows.select("wid", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word"))
    rarity = Window.partitionBy("wid").orderBy("times", "offset")
    known = words.join(index.terms, "word").join(counts, "term", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    return written(known.withColumn("rank", F.row_number().over(rarity)).drop("word", "times"), "window-words")


def phrase_matches(index: Index, windows: DataFrame) -> DataFrame:
    """key, wid, start and n of each exact occurrence of a window."""
    ranked = _ranked(index, windows)

    def shifted(rank: int) -> DataFrame:
        one = ranked.where(F.col("rank") == rank).select("wid", "n", "offset", "term")
        listed = join_counted(index.postings, one, "term")
        return listed.where("pos >= offset").select("key", "wid", "n", (F.col("pos") - F.col("offset")).alias("start"))

    both = shifted(1).join(shifted(2).drop("n"), ["key", "wid", "start"], "left_semi").where("n > 1")
    found = written(both.union(shifted(1).where("n = 1").select(both.columns)).distinct(), "candidates")
    rest = ranked.where("rank > 2").select("wid", "offset", "term")
    wanted = join_counted(found.where("n > 2"), rest, "wid").withColumn("pos", F.col("start") + F.col("offset"))
    # only documents with a candidate matter from here on
    lists = keep_matching(index.postings, found, "key").distinct()
    met = wanted.join(lists, ["key", "pos", "term"]).groupBy("key", "wid", "start", "n").agg(F.count("*").alias("met"))
    return met.where("met = n - 2").drop("met").select("key", "wid", "start", "n").union(
        found.where("n <= 2").select("key", "wid", "start", "n")
    )


def proximity_matches(index: Index, windows: DataFrame, slop: int) -> DataFrame:
    """key, wid and place of each window whose words all stand, each at most ``slop``
    words off its place, about where its rarest word stands.

    ``place`` is where the window would start by its rarest word. A posting counts
    for its slot of ``slop + 1`` starts and both neighbours, so that the lists meet by equality.
    """
    ranked = _ranked(index, windows)
    listed = join_counted(index.postings, ranked, "term").select(
        "key", "wid", "n", "rank", "offset", (F.col("pos") - F.col("offset")).alias("start")
    )
    slot = F.floor(F.col("start") / (slop + 1))
    anchors = listed.where("rank = 1").select("key", "wid", "n", F.col("start").alias("place"), slot.alias("slot"))
    others = listed.where("rank > 1").select("key", "wid", "offset", "start", F.explode(F.array(slot - 1, slot, slot + 1)).alias("slot"))
    met = anchors.join(others, ["key", "wid", "slot"]).where(F.abs(F.col("start") - F.col("place")) <= slop)
    near = met.groupBy("key", "wid", "place", "n").agg(F.count_distinct("offset").alias("met")).where("met = n - 1")
    return near.select("key", "wid", "place").union(anchors.where("n = 1").select("key", "wid", "place")).distinct()


def _covered(spans: Column) -> Column:
    """Positions covered by an array of (start, end), which may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))

    def step(done, x):
        end = F.greatest(done["end"], x["end"].cast("long"))
        return F.struct(end.alias("end"), (done["hit"] + F.greatest(end - F.greatest(done["end"], x["start"].cast("long")), F.lit(0))).alias("hit"))

    return F.aggregate(F.array_sort(spans), start, step, lambda done: done["hit"])


def contamination(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """What each document holds of the items, word for word.

    Returns key (see ``content_key``), doc_id, n_words, n_hit (words inside any
    occurrence of a window), n_items, items_sha256 (of the item IDs sorted as strings and
    joined by commas) and contaminated. Null and empty texts have no words. Rows that
    repeat ID and text come back as often as they came; items with the same windows all count.
    Other columns are not read.
    """
    phrases = item_windows(items, width, item_id_col, item_text_col)
    base = id_and_text(docs, id_col, text_col).select(
        content_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", words_of(F.col("text")).alias("words")
    )
    matches = written(phrase_matches(build_index(base, phrases.windows), phrases.windows), "matches")
    hits = matches.groupBy("key").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))).alias("spans")
    ).select("key", _covered(F.col("spans")).alias("n_hit"))
    found = join_counted(matches.select("key", "wid").distinct(), phrases.items, "wid").groupBy("key").agg(
        F.collect_set(F.col("item_id").cast("string")).alias("ids")
    )
    joined = hits.join(found, "key")
    none = F.array().cast("array<string>")
    return base.select("key", "doc_id", F.size("words").cast("long").alias("n_words")).join(joined, "key", "left").select(
        "key", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("ids", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.coalesce("ids", none)), ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


CONTAMINATION_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(words), {WIDTH}) AS n, array_to_string(words[i:i + {WIDTH - 1}], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, greatest(len(words) - {WIDTH - 1}, 1))) AS i FROM item_words WHERE len(words) > 0)),
grams AS (
  SELECT row, n, i, array_to_string(words[i:i + n - 1], ' ') AS phrase
  FROM (SELECT row, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)),
matches AS (SELECT row, i, grams.n, item_id FROM grams JOIN windows ON grams.n = windows.n AND grams.phrase = windows.phrase),
hits AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(generate_series(i, i + n - 1)) AS p FROM matches) GROUP BY row),
ids AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item_id FROM matches) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN ids USING (row)
"""
