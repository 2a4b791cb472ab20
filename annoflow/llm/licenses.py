"""Licence scan: headers and licence files against templates, then inheritance.

Every line of a file, and a licence file as a whole, becomes a sparse TF-IDF
vector over the templates' words; words outside them weigh nothing. Its cosine to each
template names its licence. So do its paragraphs, its leading comment and a licence file as a whole, by
the texts of licences and their standard headers. A file without one takes that of the licence file in its
nearest directory upwards.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from annoflow.llm.common import content_key, join_counted
from annoflow.llm.decontaminate import words_of
from annoflow.session import written

#: Usual short notices of common licences.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Use of this source code is governed by the BSD 2-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose is granted under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General Public License"
    " as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
_GNU_REST = (
    " This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
    " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} General Public License for more details. You should have"
    " received a copy of the GNU {name} General Public License along with this {what}. If not, see <https://www.gnu.org/licenses/>."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
_APACHE_REST = (
    ' Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,'
    " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
    " permissions and limitations under the License."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with"
    " this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)


def _blocks() -> tuple[tuple[str, str], ...]:
    out = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    for licence, what, name, version in (
        ("AGPL-3.0", "program", "Affero", "3"), ("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"),
        ("LGPL-2.1", "library", "Lesser", "2.1"), ("LGPL-3.0", "library", "Lesser", "3"), ("LGPL-3.0", "program", "Lesser", "3"),
    ):
        out += [(licence, text.format(what=what, name=name, version=version)) for text in (_GNU, _GNU + _GNU_REST)]
    return (*out, ("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + _APACHE_REST), ("MPL-2.0", _MPL))


#: Fixed texts: whole licences and their standard headers, held against blocks of lines.
BLOCKS = _blocks()
#: Words of which every one of these texts has one.
LEGAL = r"(?i)licen[cs]|copyright|redistribut|permission"
#: Names of licence files, in any letter case, with any extension.
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"
#: Least cosine that counts as a match.
THRESHOLD = 0.7


def template_terms(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """template (number), license, word and tf of each template."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")
    words = rows.select("template", "license", F.explode(words_of(F.col("text"))).alias("word"))
    return words.groupBy("template", "license", "word").agg(F.count("*").alias("tf"))


def _weight(tf: Column, idf: Column) -> Column:
    return (1 + F.log(tf)) * idf


def block_shares(spark: SparkSession, templates=BLOCKS) -> DataFrame:
    """template, license, word, idf and share (of the unit vector) of block texts; words are weighed by how
    few of these texts have them, so that no corpus changes a score."""
    terms = written(template_terms(spark, templates), "block-terms")
    df = terms.groupBy("word").agg(F.count("*").alias("df"))
    idf = df.select("word", (1 + F.log(F.lit(1.0 + len(templates)) / (1.0 + F.col("df")))).alias("idf"))
    weighted = terms.join(F.broadcast(idf), "word").withColumn("weight", _weight(F.col("tf"), F.col("idf")))
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    return written(weighted.join(F.broadcast(norms), "template").select("template", "license", "word", "idf", (F.col("weight") / F.col("norm")).alias("share")), "blocks")


def block_scores(files: DataFrame, is_license: Column, threshold: float) -> DataFrame:
    """key, file, path, license and score of what ``BLOCKS`` say of a file's blocks: its paragraphs, parted by
    lines without letters and digits, its leading comment, and all of it if it is a licence file."""
    shares = block_shares(files.sparkSession)
    text = F.col("text")
    lines = F.split(text, "\n")
    mark = r"^\s*(#|//|/?\*|--|;|%|<!--|\"\"\"|dnl\b)"
    code = F.array_position(F.transform(lines, lambda x: ~x.rlike(mark)), True).cast("int")
    marked = F.array_join(F.slice(lines, F.lit(1), F.when(code > 0, code - 1).otherwise(F.size(lines))), "\n")
    leading = F.when(F.ltrim(text).startswith("/*"), F.substring_index(text, "*/", 1)).otherwise(marked)
    paragraphs = F.split(text, r"\n[^\p{L}\p{N}\n]*(?=\n)")
    blocks = F.array_distinct(F.concat(paragraphs, F.array(leading), F.when(is_license, F.array(text)).otherwise(F.array().cast("array<string>"))))
    found = files.where(text.rlike(LEGAL)).select("key", "file", "path", F.explode(blocks).alias("block")).where(F.col("block").rlike(LEGAL))
    parts = written(found.select(F.monotonically_increasing_id().alias("part"), "key", "file", "path", words_of(F.col("block")).alias("words")), "license-blocks")
    counted = parts.select("part", F.explode("words").alias("word")).groupBy("part", "word").agg(F.count("*").alias("tf"))
    idf = shares.select("word", "idf").dropDuplicates(["word"])
    vectors = written(counted.join(F.broadcast(idf), "word").select("part", "word", _weight(F.col("tf"), F.col("idf")).alias("weight")), "block-vectors")
    lengths = vectors.groupBy("part").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("length"))
    dots = vectors.join(F.broadcast(shares.drop("idf")), "word").groupBy("part", "template", "license").agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    scored = dots.join(lengths, "part").select("part", "license", F.round(F.col("dot") / F.col("length"), 6).alias("score"))
    return scored.where(F.col("score") >= threshold).join(parts.drop("words"), "part").select("key", "file", "path", "license", "score")


def ancestors(path: Column) -> Column:
    """Directories above a path, the root ('') first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda d: F.array_join(F.slice(parts, F.lit(1), d), "/"))


def license_scan(files: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """The licence of each file of ``files`` (file: any ID, path, text).

    Returns file, path, license, score, origin ('own', 'inherited' or null) and license_path.
    Own: the best of a file's lines (of its whole text too, for a licence file); ties go to the
    smaller licence name. With the usual templates, ``BLOCKS`` are held against blocks of lines too. Several licence files of a directory: the best, then the smallest licence,
    path and file. Weights are (1 + ln tf) idf, with idf = 1 + ln((1 + N) / (1 + df)) over all N lines of
    all files. Null and empty texts have no licence of their own; a null path is the root's.
    Rows that repeat come back as often as they came; rows of one ID and path with other texts, and those
    without an ID, each have the licence of their own text. Other columns are not read.
    """
    spark = files.sparkSession
    files = files.select(
        "file", F.coalesce("path", F.lit("")).alias("path"), F.coalesce("text", F.lit("")).alias("text")
    )
    # names a row by all it holds: IDs may be null or repeat
    files = files.withColumn("key", content_key(F.col("file"), F.concat_ws("\x00", "path", "text")))
    terms = template_terms(spark, templates).collect()  # the templates are part of the program
    vocabulary = sorted({t["word"] for t in terms})
    known = F.array(*[F.lit(w) for w in vocabulary])
    lines = files.select("key", "file", "path", F.explode(F.split("text", "\n")).alias("line")).withColumn("words", words_of(F.col("line")))
    present = lines.select(F.array_intersect("words", known).alias("words"))
    df = {r["word"]: r["df"] for r in present.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df")).collect()}
    total = files.select(F.sum(F.size(F.split("text", "\n")))).first()[0] or 0

    idf = spark.createDataFrame([(w, df.get(w, 0)) for w in vocabulary], "word string, df long").select(
        "word", (1 + F.log((F.lit(1.0) + total) / (1.0 + F.col("df")))).alias("idf")
    )
    weighted = template_terms(spark, templates).join(F.broadcast(idf), "word").withColumn("weight", _weight(F.col("tf"), F.col("idf")))
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    unit = written(weighted.join(norms, "template").select("template", "license", "word", (F.col("weight") / F.col("norm")).alias("share")), "templates")
    # a vector with none but a template's lightest words, together below the threshold, cannot reach it
    light = Window.partitionBy("template").orderBy("share", "word")
    heavy = unit.withColumn("upto", F.sqrt(F.sum(F.col("share") ** 2).over(light))).where(F.col("upto") >= threshold - 1e-9)
    seeds = [r["word"] for r in heavy.select("word").distinct().orderBy("word").collect()]
    hopeful = F.arrays_overlap("words", F.array(*[F.lit(w) for w in seeds]))

    name = F.element_at(F.split("path", "/"), -1)
    is_license = name.rlike(LICENSE_FILE)
    whole = files.where(is_license).select("key", "file", "path", words_of(F.col("text")).alias("words"))
    parts = lines.select("key", "file", "path", "words").union(whole).where(hopeful)
    parts = written(parts.select(F.monotonically_increasing_id().alias("part"), "key", "file", "path", F.filter("words", lambda w: F.array_contains(known, w)).alias("words")), "license-parts")
    counted = parts.select("part", F.explode("words").alias("word")).groupBy("part", "word").agg(F.count("*").alias("tf"))
    vectors = written(counted.join(F.broadcast(idf), "word").select("part", "word", _weight(F.col("tf"), F.col("idf")).alias("weight")), "license-vectors")
    lengths = vectors.groupBy("part").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("length"))
    # the templates' words, a table as small as the program text
    dots = vectors.join(F.broadcast(unit), "word").groupBy("part", "template", "license").agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    scored = dots.join(lengths, "part").select("part", "license", F.round(F.col("dot") / F.col("length"), 6).alias("score")).where(F.col("score") >= threshold)
    by_line = scored.join(parts.select("part", "key", "file", "path"), "part").select("key", "file", "path", "license", "score")
    if templates is TEMPLATES:
        by_line = by_line.union(block_scores(files, is_license, threshold))
    own = (
        by_line.groupBy("key", "file", "path")
        .agg(F.max_by("license", F.struct("score", _reversed("license"))).alias("license"), F.max("score").alias("score"))
    )
    own = written(own, "own-licenses")

    parent = F.element_at(ancestors(F.col("path")), -1)
    declared = own.where(F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE)).groupBy(parent.alias("directory")).agg(
        F.min(F.struct((-F.col("score")).alias("rank"), "license", "path", "file")).alias("best")
    )
    declared = written(declared, "directory-licenses")
    directories = files.select(parent.alias("directory")).distinct()
    above = directories.select("directory", F.posexplode(F.concat(ancestors(F.col("directory")), F.array("directory"))).alias("depth", "up"))
    met = join_counted(above, declared.withColumnRenamed("directory", "up"), "up")
    nearest = written(met.groupBy("directory").agg(F.max_by("best", F.struct("depth")).alias("nearest")), "nearest-licenses")

    placed = files.select("key", "file", "path", parent.alias("directory"))
    with_own = join_counted(placed, own.drop("file", "path").dropDuplicates(["key"]), "key", "left")
    everything = join_counted(with_own, nearest, "directory", "left")
    return everything.select(
        "file", "path", F.coalesce("license", "nearest.license").alias("license"),
        F.coalesce("score", -F.col("nearest.rank")).alias("score"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("nearest.license").isNotNull(), "inherited").alias("origin"),
        F.when(F.col("license").isNotNull(), F.col("path")).otherwise(F.col("nearest.path")).alias("license_path"),
    )


def _reversed(name: str) -> Column:
    """Sorts names the other way round (ASCII)."""
    return F.transform(F.split(name, ""), lambda c: -F.ascii(c))


def files_of(documents: DataFrame) -> DataFrame:
    """Documents as files of a tree: source/lang/shelf/ID.txt. One that closes with a licence notice
    is its shelf's licence file, or, for IDs divisible by three, that of the level above."""
    closing = F.lower(F.element_at(F.split(F.coalesce("text", F.lit("")), "\n"), -1))
    notice = closing.rlike("licen[cs]e")
    shelf = F.floor(F.col("doc_id") / 64).cast("string")
    path = (
        F.when(notice & (F.col("doc_id") % 3 == 0), F.concat_ws("/", "source", "lang", F.lit("LICENSE")))
        .when(notice, F.concat_ws("/", "source", "lang", shelf, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", "source", "lang", shelf, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    )
    return documents.select(F.col("doc_id").alias("file"), path.alias("path"), "text")


_VALUES = ", ".join("({}, '{}', '{}')".format(i, name, text) for i, (name, text) in enumerate(TEMPLATES))
_TOKENS = r"list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

LICENSE_SQL = rf"""
WITH templates AS (SELECT * FROM (VALUES {_VALUES}) v(template, license, text)),
template_words AS (
  SELECT template, license, word, count(*) AS tf
  FROM (SELECT template, license, unnest({_TOKENS.format('text')}) AS word FROM templates) GROUP BY ALL),
files AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         CASE WHEN notice AND doc_id % 3 = 0 THEN concat_ws('/', source, lang, 'LICENSE')
              WHEN notice THEN concat_ws('/', source, lang, CAST(doc_id // 64 AS VARCHAR), 'LICENSE')
              ELSE concat_ws('/', source, lang, CAST(doc_id // 64 AS VARCHAR), doc_id || '.txt') END AS path
  FROM (SELECT *, regexp_matches(lower(string_split(coalesce(text, ''), chr(10))[-1]), 'licen[cs]e') AS notice FROM documents)),
lines AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM files),
parts AS (
  SELECT row_number() OVER () AS part, row, is_line, {_TOKENS.format('line')} AS words
  FROM (SELECT row, line, true AS is_line FROM lines UNION ALL SELECT row, text, false FROM files WHERE path LIKE '%/LICENSE')),
counted AS (
  SELECT part, is_line, word, count(*) AS tf FROM (SELECT part, is_line, unnest(words) AS word FROM parts)
  WHERE word IN (SELECT word FROM template_words) GROUP BY ALL),
idf AS (
  SELECT word, 1 + ln((1.0 + (SELECT count(*) FROM lines)) / (1.0 + coalesce(df, 0))) AS idf
  FROM (SELECT DISTINCT word FROM template_words)
  LEFT JOIN (SELECT word, count(*) AS df FROM counted WHERE is_line GROUP BY word) USING (word)),
template_vectors AS (SELECT template, license, word, (1 + ln(tf)) * idf AS weight FROM template_words JOIN idf USING (word)),
template_units AS (SELECT *, weight / sqrt(sum(weight * weight) OVER (PARTITION BY template)) AS share FROM template_vectors),
vectors AS (SELECT part, word, (1 + ln(tf)) * idf AS weight FROM counted JOIN idf USING (word)),
lengths AS (SELECT part, sqrt(sum(weight * weight)) AS length FROM vectors GROUP BY part),
scored AS (
  SELECT part, license, round(sum(vectors.weight * share) / any_value(length), 6) AS score
  FROM vectors JOIN template_units USING (word) JOIN lengths USING (part) GROUP BY part, template, license),
own AS (
  SELECT row, license, score FROM (
    SELECT row, license, score, row_number() OVER (PARTITION BY row ORDER BY score DESC, license) AS k
    FROM scored JOIN parts USING (part) WHERE score >= {THRESHOLD}) WHERE k = 1),
placed AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS directory FROM files),
declared AS (
  SELECT directory, license, score, path FROM (
    SELECT directory, own.license, own.score, path,
           row_number() OVER (PARTITION BY directory ORDER BY own.score DESC, own.license, path, doc_id) AS k
    FROM own JOIN placed USING (row) WHERE path LIKE '%/LICENSE') WHERE k = 1),
inherited AS (
  SELECT row, d.license, d.score, d.path AS license_path FROM placed
  JOIN declared d ON placed.directory = d.directory OR starts_with(placed.directory, d.directory || '/')
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(d.directory) DESC) = 1)
SELECT doc_id, path, coalesce(own.license, inherited.license) AS license, coalesce(own.score, inherited.score) AS score,
       CASE WHEN own.license IS NOT NULL THEN 'own' WHEN inherited.license IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN own.license IS NOT NULL THEN path ELSE license_path END AS license_path
FROM placed LEFT JOIN own USING (row) LEFT JOIN inherited USING (row)
"""
