"""The registered queries: each operator at work on the given tables.

``@query`` puts a Spark job and the SQL that must give the same rows side by
side. SQL is left out only where SQL cannot say the same thing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from annoflow.functions import ids as id_rules, naming, render
from annoflow.functions.globs import path_matches
from annoflow.functions.values import truthy, with_type_property
from annoflow.model import FAIL, SUCCESS, Selection, as_documents, empty_map
from annoflow.operators import enumerate as listing
from annoflow.operators.annotate import annotate_batches, balanced, lines, tokens
from annoflow.operators.group import annotation_counts, entities, merged
from annoflow.operators.lookup import lookup
from annoflow.operators.select import (
    apply_window,
    explode_annotations,
    inside_window,
    save_if,
    select_annotations,
    with_window,
)
from annoflow.operators.totals import with_chunk
from annoflow.plans import ledger as ledgers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced(as_documents(table(spark, sf_dir, "documents"), "doc_id", "text"))


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate_batches(documents(spark, sf_dir), tokens(), lines())


# --- SQL shared by the checks ----------------------------------------------

_PIECES = """
    SELECT doc_id, pos, piece,
           CAST(sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY pos)
                - length(piece) - 1 AS BIGINT) AS start
    FROM (SELECT doc_id, unnest(string_split(text, '{sep}')) AS piece,
                 generate_subscripts(string_split(text, '{sep}'), 1) AS pos
          FROM documents)"""

ANN = f"""
  toks AS ({_PIECES.format(sep=' ')}),
  lins AS ({_PIECES.format(sep="' || chr(10) || '")}),
  ann AS (
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, '' AS set_name,
           CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS BIGINT) AS ann_id,
           CASE WHEN regexp_full_match(piece, '[^@\\s]+@[^@\\s]+\\.[A-Za-z]+') THEN 'Email'
                WHEN regexp_full_match(piece, '[A-Z][a-z]+') THEN 'Capitalised'
                ELSE 'Token' END AS type,
           start, CAST(start + length(piece) AS BIGINT) AS "end", piece,
           CAST(NULL AS BIGINT) AS number
    FROM toks WHERE piece <> ''
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 'Layout',
           CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1
                + coalesce(n, 0) AS BIGINT), 'Line',
           start, CAST(start + length(piece) AS BIGINT), piece, CAST(pos - 1 AS BIGINT)
    FROM lins LEFT JOIN (SELECT doc_id, count(*) AS n FROM toks WHERE piece <> ''
                         GROUP BY doc_id) USING (doc_id)
    WHERE piece <> '')"""

TITLE = """
  title AS (SELECT doc_id, start, "end" FROM ann WHERE type = 'Line' AND number = 0)"""

_XML_ESCAPED = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


# --- documents and annotations ---------------------------------------------


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(length(text) AS BIGINT) AS document_length,
              CAST(strlen(text) AS BIGINT) AS file_size
       FROM documents"""
)
def doc_metadata(spark, sf_dir):
    docs = as_documents(table(spark, sf_dir, "documents"), "doc_id", "text")
    return docs.select("doc_id", "document_length", "file_size")


_SPANS_SQL = f"""WITH {ANN}
  SELECT doc_id, type, count(*) AS n, CAST(max(start) AS BIGINT) AS last_start,
         CAST(max("end") AS BIGINT) AS last_end, CAST(sum(ann_id) AS BIGINT) AS ids,
         CAST(sum("end" - start) AS BIGINT) AS covered
  FROM ann WHERE set_name = '{{0}}' GROUP BY doc_id, type"""


def _spans(found: DataFrame) -> DataFrame:
    return (
        explode_annotations(found)
        .groupBy("doc_id", "type")
        .agg(
            F.count("*").alias("n"),
            F.max("start").alias("last_start"),
            F.max("end").alias("last_end"),
            F.sum("ann_id").alias("ids"),
            F.sum(F.col("end") - F.col("start")).alias("covered"),
        )
    )


@query(_SPANS_SQL.format(""))
def token_annotations(spark, sf_dir):
    return _spans(select_annotations(annotated(spark, sf_dir), [Selection("")]))


@query(_SPANS_SQL.format("Layout"))
def line_annotations(spark, sf_dir):
    return _spans(select_annotations(annotated(spark, sf_dir), [Selection("Layout")]))


@query(
    """WITH words AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS term FROM benchmark),
            toks AS (SELECT doc_id, unnest(string_split(text, ' ')) AS term FROM documents)
       SELECT term, count(*) AS matches, count(DISTINCT doc_id) AS docs
       FROM toks JOIN words USING (term) WHERE term <> '' GROUP BY term"""
)
def gazetteer_lookup(spark, sf_dir):
    terms = (
        table(spark, sf_dir, "benchmark")
        .select(F.explode(F.split("text", " ")).alias("term"))
        .filter("term <> ''")
        .distinct()
    )
    # Only words of the list are counted; they are counted in two steps, so a
    # frequent one is a row per task and document in the shuffle, not one per token.
    per_doc = (
        balanced(table(spark, sf_dir, "documents").select("doc_id", "text"))
        .select("doc_id", F.explode(F.split("text", " ", -1)).alias("term"))
        .join(terms, "term", "left_semi")
        .groupBy("term", "doc_id")
        .agg(F.count("*").alias("n"))
    )
    return per_doc.groupBy("term").agg(F.sum("n").alias("matches"), F.count("*").alias("docs"))


# --- selecting, counting, grouping -----------------------------------------

PICKED = [Selection("", ("Email", "Capitalised")), Selection("Layout")]


def _by_set_and_type(found: DataFrame) -> DataFrame:
    return (
        explode_annotations(found)
        .groupBy("set_name", "type")
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("doc_id").alias("docs"),
            F.sum("start").alias("starts"),
        )
    )


_BY_SET_AND_TYPE = """
  SELECT set_name, type, count(*) AS n, count(DISTINCT doc_id) AS docs,
         CAST(sum(start) AS BIGINT) AS starts
  FROM ann {0} GROUP BY set_name, type"""


@query(
    f"WITH {ANN}"
    + _BY_SET_AND_TYPE.format(
        "WHERE (set_name = '' AND type IN ('Email', 'Capitalised')) OR set_name = 'Layout'"
    )
)
def select_by_set_type(spark, sf_dir):
    return _by_set_and_type(select_annotations(annotated(spark, sf_dir), PICKED))


@query(f"WITH {ANN}" + _BY_SET_AND_TYPE.format(""))
def select_default_all(spark, sf_dir):
    return _by_set_and_type(select_annotations(annotated(spark, sf_dir), []))


COUNTED = [
    Selection("", ("Email", "Capitalised")),
    Selection("Layout"),
    Selection("Layout", ("Line", "Heading")),
    Selection("Missing"),
]


@query(
    f"""WITH {ANN},
      n AS (SELECT doc_id,
              count_if(set_name = '' AND type = 'Email') AS email,
              count_if(set_name = '' AND type = 'Capitalised') AS capitalised,
              count_if(set_name = 'Layout') AS layout
            FROM ann GROUP BY doc_id),
      d AS (SELECT CAST(documents.doc_id AS VARCHAR) AS doc_id, coalesce(email, 0) AS email,
              coalesce(capitalised, 0) AS capitalised, coalesce(layout, 0) AS layout
            FROM documents LEFT JOIN n ON CAST(documents.doc_id AS VARCHAR) = n.doc_id)
      SELECT doc_id, ':Email' AS key, CAST(email AS BIGINT) AS n FROM d
      UNION ALL SELECT doc_id, ':Capitalised', CAST(capitalised AS BIGINT) FROM d
      UNION ALL SELECT doc_id, 'Layout', CAST(layout AS BIGINT) FROM d
      UNION ALL SELECT doc_id, 'Layout:Line', CAST(layout AS BIGINT) FROM d
      UNION ALL SELECT doc_id, 'Layout:Heading', CAST(0 AS BIGINT) FROM d
      UNION ALL SELECT doc_id, 'Missing', CAST(0 AS BIGINT) FROM d"""
)
def annotation_counts_by_key(spark, sf_dir):
    counts = annotation_counts(F.col("annotations"), COUNTED)
    return annotated(spark, sf_dir).select("doc_id", F.explode(counts).alias("key", "n"))


_ENTITIES_SQL = """WITH {0}
  SELECT doc_id, {1} AS label, count(*) AS n, min(start) AS first_start,
         string_agg(type || '@' || start || '-' || "end", ',' ORDER BY start, "end", ann_id) AS spans
  FROM ann GROUP BY ALL"""


def _spans_in_order(found: DataFrame, by: str) -> DataFrame:
    span = lambda x: F.concat(
        x["payload"]["type"], F.lit("@"), x["start"].cast("string"), F.lit("-"), x["end"].cast("string")
    )
    return entities(found, by).select(
        "doc_id",
        "label",
        F.size("items").cast("long").alias("n"),
        F.col("items")[0]["start"].alias("first_start"),
        F.array_join(F.transform("items", span), ",").alias("spans"),
    )


@query(_ENTITIES_SQL.format(ANN, "type"))
def entities_by_type(spark, sf_dir):
    return _spans_in_order(annotated(spark, sf_dir), "type")


@query(
    _ENTITIES_SQL.format(ANN, "CASE WHEN set_name = '' THEN 'default' ELSE set_name END")
)
def entities_by_set(spark, sf_dir):
    return _spans_in_order(annotated(spark, sf_dir), "set")


@query(
    f"""WITH {ANN},
      m AS (SELECT DISTINCT doc_id, type, start, "end", ann_id FROM ann)
      SELECT doc_id, count(*) AS n, CAST(sum(start) AS BIGINT) AS starts,
             CAST(sum("end") AS BIGINT) AS ends FROM m GROUP BY doc_id"""
)
def merged_sets(spark, sf_dir):
    return (
        merged(annotated(spark, sf_dir))
        .groupBy("doc_id")
        .agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"))
    )


@query(
    f"""WITH {ANN}
      SELECT doc_id, type, count(*) AS n, min(type || ':' || start) AS sample
      FROM ann GROUP BY doc_id, type"""
)
def type_as_property(spark, sf_dir):
    found = explode_annotations(annotated(spark, sf_dir)).withColumn(
        "features", with_type_property(F.col("features"), F.col("type"), "kind")
    )
    # The least text would be found by sorting all annotations in memory. As numbers, digits from the left
    # and then how many (places in a text have at most 10), it is found by hashing.
    digits = F.col("start").cast("string")
    in_order = F.rpad(digits, 10, "0").cast("long") * 16 + F.length(digits)
    least = F.substring(F.lpad(F.shiftright("least", 4).cast("string"), 10, "0"), F.lit(1), F.col("least").bitwiseAND(F.lit(15)).cast("int"))
    return (
        found.groupBy("doc_id", F.col("features")["kind"].alias("type"))
        .agg(F.count("*").alias("n"), F.min(in_order).alias("least"))
        .select("doc_id", "type", "n", F.concat("type", F.lit(":"), least).alias("sample"))
    )


# --- windows and conditions ------------------------------------------------


def _titled(found: DataFrame) -> DataFrame:
    """Rename the first line of each document to ``Title``, the window type."""
    renamed = F.transform(
        "annotations",
        lambda a: F.when(
            (a["type"] == "Line") & (a["features"]["number"] == "0"), a.withField("type", F.lit("Title"))
        ).otherwise(a),
    )
    return found.withColumn("annotations", renamed)


@query(
    f"""WITH {ANN}, {TITLE},
      w AS (SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, text, coalesce(t.start, 0) AS s,
                   coalesce(t."end", length(text)) AS e
            FROM documents d LEFT JOIN title t ON t.doc_id = CAST(d.doc_id AS VARCHAR)),
      i AS (SELECT w.doc_id, count(*) AS n, CAST(sum(start - s) AS BIGINT) AS starts
            FROM w JOIN ann ON ann.doc_id = w.doc_id AND start >= s AND "end" <= e
            GROUP BY w.doc_id)
      SELECT w.doc_id, substr(text, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)) AS text,
             coalesce(n, 0) AS n, coalesce(starts, 0) AS starts
      FROM w LEFT JOIN i USING (doc_id)"""
)
def document_window(spark, sf_dir):
    cut = apply_window(with_window(_titled(annotated(spark, sf_dir)), "Title", "Layout"))
    starts = F.aggregate(
        "annotations", F.lit(0).cast("long"), lambda total, a: total + a["start"]
    )
    return cut.select(
        "doc_id", "text", F.size("annotations").cast("long").alias("n"), starts.alias("starts")
    )


@query(
    f"""WITH {ANN}, {TITLE}
      SELECT ann.type, count(*) AS n, CAST(sum(ann."end" - ann.start) AS BIGINT) AS covered
      FROM ann JOIN title t ON t.doc_id = ann.doc_id
        AND ann.start >= t.start AND ann."end" <= t."end"
      GROUP BY ann.type"""
)
def annotations_within(spark, sf_dir):
    found = with_window(_titled(annotated(spark, sf_dir)), "Title", "Layout")
    windowed = found.filter(F.exists("annotations", lambda a: a["type"] == "Title")).withColumn(
        "annotations", inside_window(F.col("annotations"), F.col("window"))
    )
    type_ = F.when(F.col("type") == "Title", "Line").otherwise(F.col("type"))
    return (
        explode_annotations(windowed)
        .groupBy(type_.alias("type"))
        .agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("covered"))
    )


@query(
    f"""WITH {ANN},
      e AS (SELECT doc_id, count(*) AS n FROM ann WHERE type = 'Email' GROUP BY doc_id)
      SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
             CASE WHEN n > 1 THEN 'FAIL' ELSE 'SUCCESS' END AS return_code,
             CASE WHEN n > 1 THEN 'document ' || d.doc_id || ' has several Email annotations, so no window'
             END AS error
      FROM documents d LEFT JOIN e ON e.doc_id = CAST(d.doc_id AS VARCHAR)"""
)
def window_conflict(spark, sf_dir):
    found = with_window(annotated(spark, sf_dir), "Email")
    return ledgers.result_rows(found, "run").select("doc_id", "return_code", "error")


def _with_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the feature ``save``, missing where there is no label."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    docs = balanced(table(spark, sf_dir, "documents").select("doc_id", "text"))
    save = F.when(F.col("quality") == 1, " Yes ").when(F.col("quality") == 0, "off")
    joined = docs.join(labels, docs.doc_id == labels.id, "left")
    return as_documents(
        joined,
        "doc_id",
        "text",
        features=F.when(save.isNotNull(), F.create_map(F.lit("save"), save)).otherwise(empty_map()),
    )


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(length(text) AS BIGINT) AS document_length
       FROM documents JOIN labels USING (doc_id) WHERE quality = 1"""
)
def conditional_save(spark, sf_dir):
    return save_if(_with_quality(spark, sf_dir), " save ").select("doc_id", "document_length")


@query(
    """SELECT doc_id, v.value AS given,
              coalesce(lower(regexp_replace(v.value, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) IN ('true', 'yes', 'on'), false) AS truth
       FROM labels, (VALUES (' True '), ('YES'), ('on'), ('1'), ('off'), (''), ('tru e'), (NULL),
                            (chr(9) || 'yes'), ('On' || chr(13) || chr(10)), (chr(9)), ('no' || chr(10))) v(value)"""
)
def truthy_values(spark, sf_dir):
    given = [" True ", "YES", "on", "1", "off", "", "tru e", None, "\tyes", "On\r\n", "\t", "no\n"]
    grid = table(spark, sf_dir, "labels").select(
        "doc_id", F.explode(F.array(*(F.lit(g).cast("string") for g in given))).alias("given")
    )
    return grid.select("doc_id", "given", truthy(F.col("given")).alias("truth"))


# --- IDs -------------------------------------------------------------------


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier run's results: labelled documents, failed where toxic."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("toxic") == 0, SUCCESS).otherwise(FAIL).alias("return_code"),
    )


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)"""
)
def restart_unprocessed(spark, sf_dir):
    ids = listing.explicit_ids(table(spark, sf_dir, "documents"), "doc_id")
    return ledgers.unprocessed(ids, _ledger(spark, sf_dir)).select("doc_id")


@query(
    """WITH ids AS (SELECT doc_id FROM labels UNION ALL SELECT doc_id + 1000000 FROM labels)
       SELECT CAST(ids.doc_id AS VARCHAR) AS doc_id,
              CASE WHEN text IS NULL THEN 'FAIL' ELSE 'SUCCESS' END AS return_code,
              CASE WHEN text IS NULL THEN 'Unknown document ' || ids.doc_id END AS error,
              CAST(length(text) AS BIGINT) AS document_length
       FROM ids LEFT JOIN documents USING (doc_id)"""
)
def lookup_missing(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    ids = listing.union_ids(
        [
            listing.explicit_ids(labels, "doc_id"),
            listing.explicit_ids(labels, F.col("doc_id") + 1000000),
        ]
    )
    docs = as_documents(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = lookup(ids, docs).withColumns(
        {
            "error": F.col("load_error"),
            "annotations": F.array().cast(ANNOTATIONS_DDL),
            "execution_ms": F.lit(0).cast("long"),
        }
    )
    return ledgers.result_rows(found, "run").select(
        "doc_id", "return_code", "error", "document_length"
    )


ANNOTATIONS_DDL = (
    "array<struct<set_name:string,ann_id:bigint,type:string,start:bigint,`end`:bigint,"
    "features:map<string,string>>>"
)


@query(
    """SELECT 0 AS src_ord, 'doc/' || doc_id AS doc_id FROM documents
       UNION ALL SELECT 1, 'item/' || item_id FROM benchmark
       UNION ALL SELECT 2, 'doc/' || doc_id FROM labels"""
)
def union_ids(spark, sf_dir):
    source = lambda name, column, prefix: listing.with_prefix(
        listing.explicit_ids(table(spark, sf_dir, name), column), prefix
    )
    ids = listing.union_ids(
        [
            source("documents", "doc_id", "doc/"),
            source("benchmark", "item_id", "item/"),
            source("labels", "doc_id", "doc/"),
        ]
    )
    return listing.in_order(ids).select("src_ord", "doc_id")


@query(
    """SELECT DISTINCT 'doc/' || doc_id AS doc_id FROM
       (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM labels)"""
)
def distinct_ids(spark, sf_dir):
    sources = [
        listing.with_prefix(listing.explicit_ids(table(spark, sf_dir, n), "doc_id"), "doc/")
        for n in ("documents", "labels")
    ]
    return listing.union_ids(sources, distinct=True).select("doc_id")


@query("SELECT 'large/' || doc_id AS doc_id FROM documents")
def list_ids(spark, sf_dir):
    padded = table(spark, sf_dir, "documents").select(
        F.concat(F.lit(" \t"), F.col("doc_id").cast("string"), F.lit("  ")).alias("line")
    )
    return listing.list_ids(padded, "line", "large/").select("doc_id")


@query(
    r"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM pages)
       SELECT page_id, path FROM p
       WHERE (regexp_full_match(path, '(.*/)?[^/]*\.html') OR regexp_full_match(path, '(en|es)(/.*)?'))
         AND NOT regexp_full_match(path, '(.*/)?[^/]*9[^/]*')
         AND NOT regexp_full_match(path, '(.*/)?[^/]77')"""
)
def glob_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", "^https?://[^/]+/([^?#]*)", 1).alias("path")
    )
    return pages.filter(path_matches(F.col("path"), "**/*.html, en/** es/", "**/*9*,**/?77"))


# --- archive records -------------------------------------------------------

_HOST = "^https?://([^/]+)"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as records of one archive per host, with made-up headers."""
    page = F.col("page_id")
    status = (
        F.when(page % 7 == 0, "301").when(page % 7 == 1, "404").when(page % 7 == 2, "503")
        .when(page % 7 == 3, F.lit(None)).when(page % 7 == 4, "206").otherwise("200")
    )
    mime = (
        F.when(page % 5 == 0, "text/html; charset=utf-8").when(page % 5 == 1, "text/plain")
        .when(page % 5 == 2, "application/pdf").when(page % 5 == 3, F.lit(None)).otherwise("text/html")
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.regexp_extract("url", _HOST, 1).alias("archive"),
        (page * 1000).alias("offset"),
        F.when(page % 11 == 0, 0).otherwise(F.length("html")).cast("long").alias("body_length"),
        status.alias("status"),
        mime.alias("mime"),
    )


_RECORDS = r"""
  r AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/]+)', 1) AS archive,
    CASE WHEN page_id % 11 = 0 THEN 0 ELSE length(html) END AS body_length,
    CASE page_id % 7 WHEN 0 THEN '301' WHEN 1 THEN '404' WHEN 2 THEN '503' WHEN 3 THEN NULL
                     WHEN 4 THEN '206' ELSE '200' END AS status,
    CASE page_id % 5 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'text/plain'
                     WHEN 2 THEN 'application/pdf' WHEN 3 THEN NULL ELSE 'text/html' END AS mime
    FROM pages)"""


@query(
    f"""WITH {_RECORDS},
      n AS (SELECT *, row_number() OVER (PARTITION BY archive ORDER BY page_id) - 1 AS position FROM r)
      SELECT page_id, archive, CAST(position AS BIGINT) AS position FROM n
      WHERE position > 0 AND body_length > 0"""
)
def archive_positions(spark, sf_dir):
    numbered = listing.with_positions(_records(spark, sf_dir))
    return numbered.filter("position > 0 and body_length > 0").select(
        "page_id", "archive", "position"
    )


@query(
    f"""WITH {_RECORDS}, s AS (SELECT page_id, coalesce(status, '_not_found_') AS status FROM r)
      SELECT 'default' AS filter, page_id, status FROM s WHERE NOT regexp_full_match(status, '[345].*')
      UNION ALL SELECT 'include', page_id, status FROM s WHERE regexp_full_match(status, '3..|20')
      UNION ALL SELECT 'exclude', page_id, status FROM s WHERE NOT regexp_full_match(status, '40.|_.*')
      UNION ALL SELECT 'both', page_id, status FROM s
        WHERE regexp_full_match(status, '[24].*') AND NOT regexp_full_match(status, '206')
      UNION ALL SELECT 'nothing', page_id, status FROM s"""
)
def status_filter(spark, sf_dir):
    records = _records(spark, sf_dir)
    settings = {
        "default": (None, None),
        "include": ("3..|20", None),
        "exclude": (None, "40.|_.*"),
        "both": ("[24].*", "206"),
        "nothing": (None, ""),
    }
    status = F.col("status")
    which = F.filter(
        F.array(
            *(
                F.when(listing.status_matches(status, *patterns), F.lit(name))
                for name, patterns in settings.items()
            )
        ),
        lambda name: name.isNotNull(),
    )
    return records.select(
        F.explode(which).alias("filter"), "page_id", F.coalesce(status, F.lit("_not_found_")).alias("status")
    )


@query(
    f"""WITH {_RECORDS} SELECT page_id, mime FROM r
      WHERE starts_with(mime, 'text/html') OR starts_with(mime, 'application/')"""
)
def mime_filter(spark, sf_dir):
    records = _records(spark, sf_dir)
    return records.filter(listing.mime_matches(F.col("mime"), "text/html  application/")).select(
        "page_id", "mime"
    )


_CLEAN_URL = r"""regexp_replace(regexp_replace(
    regexp_extract(url, '^(?:.*?://)?(.*?)(?:\?.*)?(?:#.*)?$', 1),
    '[^\x00-\x7F]+', '~', 'g'), '[/:\\]', '_', 'g')"""


@query(
    rf"""SELECT page_id,
         printf('%03d/%03d', page_id * 12345 // 1000, page_id * 12345 % 1000) || '_'
           || {_CLEAN_URL} || '.xml' AS path
       FROM pages"""
)
def archive_paths(spark, sf_dir):
    attrs = F.create_map(F.lit("recordPosition"), (F.col("page_id") * 12345).cast("string"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        naming.output_path(F.col("url"), attrs, naming.by_position("3/3"), ".xml").alias("path"),
    )


@query(
    """WITH p AS (SELECT page_id, CASE page_id % 6
           WHEN 0 THEN 'a.b/' || page_id || '.html.gz' WHEN 1 THEN 'ft/' || page_id || '.html'
           WHEN 2 THEN 'a.b/c' || page_id WHEN 3 THEN 'x/.hidden' || page_id
           WHEN 4 THEN '../up' || page_id ELSE '/abs/' || page_id || '.txt' END AS id FROM pages)
       SELECT page_id,
         CASE WHEN page_id % 6 < 4 THEN id || '.xml' END AS appended,
         CASE page_id % 6 WHEN 0 THEN 'a.b/' || page_id || '.xml' WHEN 1 THEN 'ft/' || page_id || '.xml'
           WHEN 2 THEN id || '.xml' WHEN 3 THEN id || '.xml' END AS replaced,
         '/data/' || id AS input_path
       FROM p"""
)
def simple_paths(spark, sf_dir):
    page = F.col("page_id")
    name = page.cast("string")
    doc_id = (
        F.when(page % 6 == 0, F.concat(F.lit("a.b/"), name, F.lit(".html.gz")))
        .when(page % 6 == 1, F.concat(F.lit("ft/"), name, F.lit(".html")))
        .when(page % 6 == 2, F.concat(F.lit("a.b/c"), name))
        .when(page % 6 == 3, F.concat(F.lit("x/.hidden"), name))
        .when(page % 6 == 4, F.concat(F.lit("../up"), name))
        .otherwise(F.concat(F.lit("/abs/"), name, F.lit(".txt")))
    )
    pages = table(spark, sf_dir, "pages").select("page_id", doc_id.alias("id"))
    path = lambda replace: naming.output_path(F.col("id"), empty_map(), extension=".xml", replace=replace)
    return pages.select(
        "page_id",
        path(False).alias("appended"),
        path(True).alias("replaced"),
        naming.under("/data", F.col("id")).alias("input_path"),
    )


# --- chunks ----------------------------------------------------------------


@query(
    """WITH b AS (SELECT doc_id, strlen(text) AS size,
           coalesce(sum(strlen(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING
                    AND 1 PRECEDING), 0) AS bytes_before FROM documents)
       SELECT CAST(bytes_before // 200000 AS BIGINT) AS chunk,
              printf('part-%03d', CAST(bytes_before // 200000 AS BIGINT)) || '.json.gz' AS file,
              count(*) AS docs, CAST(sum(size) AS BIGINT) AS bytes, min(doc_id) AS first_doc
       FROM b GROUP BY ALL"""
)
def chunk_assignment(spark, sf_dir):
    sizes = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length("text").cast("long").alias("size")
    )
    placed = with_chunk(sizes, F.col("size"), 200_000, order_by=["doc_id"])
    return (
        placed.groupBy("chunk")
        .agg(
            F.count("*").alias("docs"),
            F.sum("size").alias("bytes"),
            F.min("doc_id").alias("first_doc"),
        )
        .withColumn("file", naming.chunk_name(F.col("chunk"), extension=".json.gz"))
    )


# --- JSON identifiers ------------------------------------------------------


@query(
    """SELECT event_id, json_extract_string(props, '$.k') AS doc_id FROM events
       WHERE json_extract_string(props, '$.k') IS NOT NULL"""
)
def json_pointer_id(spark, sf_dir):
    events = balanced(table(spark, sf_dir, "events").select("event_id", "props")).select(
        "event_id", id_rules.id_by_pointer(F.col("props"), "/k").alias("doc_id")
    )
    return events.filter(id_rules.is_document(F.col("doc_id")))


@query(
    """SELECT event_id, CASE event_id % 4
           WHEN 0 THEN 'c' || user_id || '_' || event_id ELSE 'g' || event_type || '_' || event_id END AS doc_id
       FROM events WHERE event_id % 8 <> 5"""
)
def json_template_id(spark, sf_dir):
    n, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    channel = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"id":'), user, F.lit("}")))
        .when(F.col("event_id") % 4 == 1, F.lit('{"id":null}'))
        .when(F.col("event_id") % 4 == 2, F.lit('{"id":{"x":1}}'))
        .otherwise(F.lit("{}"))
    )
    group = F.when(F.col("event_id") % 8 == 5, F.lit("[]")).otherwise(
        F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    )
    objects = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(
            F.lit('{"channel":'), channel, F.lit(',"group":{"id":'), group,
            F.lit('},"id":'), n, F.lit("}"),
        ).alias("json"),
    )
    found = balanced(objects).select(
        "event_id",
        id_rules.id_by_template(
            F.col("json"), "c{/channel/id}_{/id}|g{/group/id}_{/id}"
        ).alias("doc_id"),
    )
    return found.filter(id_rules.is_document(F.col("doc_id")))


@query(
    """SELECT page_id, CASE WHEN page_id % 2 = 0
           THEN '<id recordOffset="' || page_id * 1000 || '" recordPosition="' || page_id || '">' || url || '</id>'
           ELSE url END AS id_text,
         page_id % 2 = 1 OR page_id % 4 = 0 AS same
       FROM pages"""
)
def id_text(spark, sf_dir):
    page = F.col("page_id")
    one = F.create_map(
        F.lit("recordPosition"), page.cast("string"), F.lit("recordOffset"), (page * 1000).cast("string")
    )
    other = F.create_map(
        F.lit("recordOffset"), (page * 1000).cast("string"),
        F.lit("recordPosition"), F.when(page % 4 == 0, page.cast("string")).otherwise("none"),
    )
    attrs = lambda m: F.when(page % 2 == 0, m).otherwise(empty_map())
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", attrs(one).alias("one"), attrs(other).alias("other")
    )
    return pages.select(
        "page_id",
        id_rules.id_text(F.col("url"), F.col("one")).alias("id_text"),
        id_rules.same_id(F.col("url"), F.col("one"), F.col("url"), F.col("other")).alias("same"),
    )


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
              CASE WHEN doc_id % 2 = 0 THEN source || '/' || doc_id END AS by_feature,
              'http://index/' || doc_id AS by_namespace
       FROM documents"""
)
def index_uri(spark, sf_dir):
    source = table(spark, sf_dir, "documents")
    uri = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    features = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("uri"), uri)).otherwise(empty_map())
    docs = as_documents(source, "doc_id", "text", features=features)
    return docs.select(
        "doc_id",
        render.index_uri(F.col("doc_id"), F.col("features"), "uri").alias("by_feature"),
        render.index_uri(F.col("doc_id"), F.col("features"), None, "http://index/").alias("by_namespace"),
    )


# --- rendered documents ----------------------------------------------------


@query(
    f"""WITH {ANN},
      e AS (SELECT doc_id, type, string_agg('{{"indices":[' || start || ',' || "end" || ']'
              || CASE WHEN number IS NULL THEN '' ELSE ',"number":"' || number || '"' END
              || ',"kind":"' || type || '"}}', ',' ORDER BY start, "end", ann_id) AS items
            FROM ann GROUP BY doc_id, type),
      g AS (SELECT doc_id, string_agg('"' || type || '":[' || items || ']', ',' ORDER BY type) AS groups
            FROM e GROUP BY doc_id),
      j AS (SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
              '{{"text":' || CAST(to_json(text) AS VARCHAR) || ',"entities":{{' || coalesce(groups, '') || '}}}}' AS json
            FROM documents d LEFT JOIN g ON g.doc_id = CAST(d.doc_id AS VARCHAR))
      SELECT doc_id, md5(json) AS digest, CAST(length(json) AS BIGINT) AS chars FROM j"""
)
def json_render(spark, sf_dir):
    done = render.with_json(annotated(spark, sf_dir), by="type", type_property="kind")
    return _digest(done)


def _digest(done: DataFrame) -> DataFrame:
    return done.select(
        "doc_id",
        F.md5(F.col("rendered")).alias("digest"),
        F.length("rendered").cast("long").alias("chars"),
    )


@query(
    f"""WITH {ANN}, {TITLE},
      w AS (SELECT d.doc_id, text, coalesce(t.start, 0) AS s, coalesce(t."end", length(text)) AS e,
                   t.doc_id IS NOT NULL AS titled
            FROM documents d LEFT JOIN title t ON t.doc_id = CAST(d.doc_id AS VARCHAR)),
      i AS (SELECT w.doc_id, set_name,
              string_agg('{{"indices":[' || start - s || ',' || "end" - s || ']'
                || CASE WHEN number IS NULL THEN '' ELSE ',"number":"' || number || '"' END || '}}',
                ',' ORDER BY start, "end", ann_id) AS items
            FROM w JOIN ann ON ann.doc_id = CAST(w.doc_id AS VARCHAR) AND start >= s AND "end" <= e
            GROUP BY w.doc_id, set_name),
      g AS (SELECT doc_id, string_agg('"' || CASE WHEN set_name = '' THEN 'default' ELSE set_name END
              || '":[' || items || ']', ',' ORDER BY CASE WHEN set_name = '' THEN 'default' ELSE set_name END) AS groups
            FROM i GROUP BY doc_id),
      j AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id,
              '{{"text":' || CAST(to_json(substr(text, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT))) AS VARCHAR)
              || ',"entities":{{' || coalesce(groups, '') || '}}'
              || CASE WHEN titled THEN ',"number":"0"' ELSE '' END || '}}' AS json
            FROM w LEFT JOIN g USING (doc_id))
      SELECT doc_id, md5(json) AS digest, CAST(length(json) AS BIGINT) AS chars FROM j"""
)
def json_window_render(spark, sf_dir):
    cut = apply_window(with_window(_titled(annotated(spark, sf_dir)), "Title", "Layout"))
    return _digest(render.with_json(cut, by="set"))


@query(
    f"""WITH {ANN},
      a AS (SELECT doc_id, string_agg('<annotation set="' || set_name || '" id="' || ann_id || '" type="' || type
              || '" start="' || start || '" end="' || "end" || '">'
              || CASE WHEN number IS NULL THEN '' ELSE '<feature name="number" value="' || number || '"/>' END
              || '</annotation>' || chr(10), '' ORDER BY set_name, start, "end", ann_id) AS items
            FROM ann GROUP BY doc_id),
      x AS (SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
              '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<document id="' || d.doc_id || '">' || chr(10)
              || '<features></features>' || chr(10) || '<text>' || {_XML_ESCAPED.format('text')} || '</text>' || chr(10)
              || coalesce(items, '') || '</document>' || chr(10) AS xml
            FROM documents d LEFT JOIN a ON a.doc_id = CAST(d.doc_id AS VARCHAR))
      SELECT doc_id, md5(xml) AS digest, CAST(length(xml) AS BIGINT) AS chars FROM x"""
)
def standoff_render(spark, sf_dir):
    return _digest(render.with_standoff(annotated(spark, sf_dir)))


@query(
    f"""WITH {ANN},
      a AS (SELECT doc_id, string_agg('<struct type="' || type || '" from="' || start || '" to="' || "end" || '">'
              || CASE WHEN number IS NULL THEN '' ELSE '<feat name="number" value="' || number || '"/>' END
              || '</struct>' || chr(10), '' ORDER BY start, "end", ann_id) AS items
            FROM ann GROUP BY doc_id),
      x AS (SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
              '<?xml version="1.0" encoding="UTF-8"?>' || chr(10)
              || '<cesAna version="1.0" xmlns="http://www.xces.org/schema/2003">' || chr(10)
              || coalesce(items, '') || '</cesAna>' || chr(10) AS xml
            FROM documents d LEFT JOIN a ON a.doc_id = CAST(d.doc_id AS VARCHAR))
      SELECT doc_id, md5(xml) AS digest, CAST(length(xml) AS BIGINT) AS chars FROM x"""
)
def xces_render(spark, sf_dir):
    return _digest(render.with_xces(annotated(spark, sf_dir)))


@query(
    f"""WITH p AS (SELECT doc_id, pos, piece, CASE
              WHEN piece = '' THEN NULL
              WHEN regexp_full_match(piece, '[^@\\s]+@[^@\\s]+\\.[A-Za-z]+') THEN 'Email'
              WHEN regexp_full_match(piece, '[A-Z][a-z]+') THEN 'Capitalised' ELSE 'Token' END AS type
            FROM ({_PIECES.format(sep=' ')})),
      x AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, '<document>' || string_agg(CASE WHEN type IS NULL THEN ''
              ELSE '<' || type || '>' || {_XML_ESCAPED.format('piece')} || '</' || type || '>' END,
              ' ' ORDER BY pos) || '</document>' AS xml FROM p GROUP BY doc_id)
      SELECT doc_id, md5(xml) AS digest, CAST(length(xml) AS BIGINT) AS chars FROM x"""
)
def inline_render(spark, sf_dir):
    found = select_annotations(annotated(spark, sf_dir), [Selection("")])
    return _digest(render.with_inline(found))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS digest,
              CAST(length(text) AS BIGINT) AS chars FROM documents"""
)
def plain_render(spark, sf_dir):
    return _digest(render.with_plain(as_documents(table(spark, sf_dir, "documents"), "doc_id", "text")))
