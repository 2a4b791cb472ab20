"""Registered queries that go through files, jobs and streams and come back."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, functions as F

from annoflow.model import JobSpec, Output, Selection
from annoflow.operators import enumerate as listing
from annoflow.operators.annotate import lines, tokens
from annoflow.plans import derived, ledger as ledgers, report_xml
from annoflow.plans.catalog import (
    ANN,
    _with_quality,
    annotated,
    documents,
    query,
    table,
)
from annoflow.plans.job import run
from annoflow.session import scratch_path
from annoflow.sinks.chunks import write_chunks
from annoflow.sinks.named_files import write_named_files
from annoflow.sinks.push import push
from annoflow.sinks.tables import load_documents, save_annotations, save_documents
from annoflow.sources import archives, files, json_stream, zips
from annoflow.streaming import arrivals

# --- results ---------------------------------------------------------------

_RESULTS = f"""
  email AS (SELECT doc_id, count(*) AS n FROM ann WHERE type = 'Email' GROUP BY doc_id),
  lined AS (SELECT doc_id, count(*) AS n FROM ann WHERE type = 'Line' GROUP BY doc_id),
  res AS (SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, CAST(strlen(text) AS BIGINT) AS file_size,
            CAST(length(text) AS BIGINT) AS document_length, coalesce(e.n, 0) AS emails,
            coalesce(l.n, 0) AS lined, coalesce(e.n, 0) > 1 AS failed
          FROM documents d LEFT JOIN email e ON e.doc_id = CAST(d.doc_id AS VARCHAR)
            LEFT JOIN lined l ON l.doc_id = CAST(d.doc_id AS VARCHAR))"""

_KEPT = [Selection("", ("Email",)), Selection("Layout")]


def _results(spark, sf_dir) -> DataFrame:
    """Results of a run that fails documents with more than one address."""
    found = annotated(spark, sf_dir)
    emails = F.size(F.filter("annotations", lambda a: a["type"] == "Email"))
    found = found.withColumn("error", F.coalesce("error", F.when(emails > 1, "two <addresses> & more")))
    return ledgers.result_rows(found, "run", _KEPT)


@query(
    f"""WITH {ANN}, {_RESULTS}
      SELECT doc_id, CASE WHEN failed THEN 'FAIL' ELSE 'SUCCESS' END AS return_code, file_size,
             document_length, CASE WHEN NOT failed THEN CAST(emails AS BIGINT) END AS emails,
             CASE WHEN NOT failed THEN CAST(lined AS BIGINT) END AS lined,
             CASE WHEN failed THEN 'two <addresses> & more' END AS error FROM res"""
)
def result_rows(spark, sf_dir):
    return _flat_results(_results(spark, sf_dir))


def _flat_results(results: DataFrame) -> DataFrame:
    return results.select(
        "doc_id",
        "return_code",
        "file_size",
        "document_length",
        F.col("annotation_counts")[":Email"].alias("emails"),
        F.col("annotation_counts")["Layout"].alias("lined"),
        "error",
    )


@query(
    f"""WITH {ANN}, {_RESULTS}
      SELECT 'FINISHED' AS final_state, count(*) AS total_documents,
             CAST(count_if(NOT failed) AS BIGINT) AS successfully_processed, CAST(count_if(failed) AS BIGINT) AS with_error,
             CAST(sum(file_size) AS BIGINT) AS total_bytes,
             CAST(sum(document_length) AS BIGINT) AS total_characters FROM res"""
)
def batch_summary(spark, sf_dir):
    return ledgers.summary(_results(spark, sf_dir), "run").drop("run_id", "execution_ms")


@query(
    f"""WITH {ANN}, {_RESULTS}
      SELECT doc_id, CASE WHEN failed THEN 'FAIL' ELSE 'SUCCESS' END AS return_code, file_size,
             document_length, CASE WHEN NOT failed THEN CAST(emails AS BIGINT) END AS emails,
             CASE WHEN NOT failed THEN CAST(lined AS BIGINT) END AS lined,
             CASE WHEN failed THEN 'two <addresses> & more' END AS error FROM res"""
)
def report_round_trip(spark, sf_dir):
    path = scratch_path(spark, "report.xml")
    results = _results(spark, sf_dir)
    report_xml.write_report(results, ledgers.summary(results, "run"), path)
    return _flat_results(report_xml.import_xml(spark, path))


# --- JSON streams ----------------------------------------------------------


def _turns(spark, sf_dir) -> DataFrame:
    """Conversation turns as JSON objects, with the space a stream may hold."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.replace(
            F.to_json(F.struct("conv_id", "turn", "role", "text")), F.lit('"turn":'), F.lit('"turn" : ')
        ).alias("json"),
    )


def _turn_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.get_json_object("text", "$.role").alias("role"),
        F.length(F.get_json_object("text", "$.text")).cast("long").alias("chars"),
        F.col("text").contains('"turn":').alias("is_compact"),
    )


_TURN_SQL = """SELECT conv_id || '_' || turn AS doc_id, role, CAST(length(text) AS BIGINT) AS chars,
                      true AS is_compact FROM conversations"""
_TURN_ID = {"id_template": "{/conv_id}_{/turn}"}


@query(_TURN_SQL)
def conversation_docs(spark, sf_dir):
    path = scratch_path(spark, "turn-lines")
    _turns(spark, sf_dir).select(F.col("json").alias("value")).write.option("compression", "gzip").text(path)
    return _turn_rows(json_stream.json_documents(json_stream.read_lines(spark, path), **_TURN_ID))


@query(_TURN_SQL)
def json_array_docs(spark, sf_dir):
    made = derived.write_containers(
        _turns(spark, sf_dir), F.col("conv_id"), "conv_id", "turns", ".json.gz", derived.json_array_of
    )
    return _turn_rows(json_stream.json_documents(json_stream.read_objects(made, "any"), **_TURN_ID))


@query(_TURN_SQL)
def json_block_docs(spark, sf_dir):
    """Arrays that are not compressed, each read by several tasks."""
    made = derived.write_containers(_turns(spark, sf_dir), F.col("conv_id"), "conv_id", "turns", ".json", derived.plain_json_array_of)
    return _turn_rows(json_stream.json_documents(json_stream.read_objects(made, block_bytes=10_000), **_TURN_ID))


@query(_TURN_SQL)
def json_chunk_docs(spark, sf_dir):
    root = scratch_path(spark, "turn-chunks")
    turns = _turns(spark, sf_dir).withColumnRenamed("json", "rendered")
    wrote = write_chunks(turns, root, chunk_bytes=20_000, extension=".json.gz", compression="gzip")
    made = wrote.select(F.concat(F.lit(root + "/"), "file").alias("path"))
    return _turn_rows(json_stream.json_documents(json_stream.read_objects(made, "gzip"), **_TURN_ID))


@query("SELECT doc_id, CAST(2 AS BIGINT) AS times FROM documents")
def rewritten_chunks(spark, sf_dir):
    """Every document, written in two halves that share a folder: the first half, the
    second, and the first again under its key, which must leave the second's files alone."""
    root = scratch_path(spark, "rewritten")
    docs = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 2).alias("half"), F.to_json(F.struct("doc_id", "text")).alias("rendered")
    )
    files = []
    for half, key in ((0, "run/a"), (1, "run_a"), (0, "run/a")):
        files.append(write_chunks(docs.where(F.col("half") == half), root, chunk_bytes=200_000, key=key).select("file"))
    listed = files[1].union(files[2]).select(F.concat(F.lit(root + "/"), "file").alias("path"))
    there = spark.read.text(root, pathGlobFilter="part-*.json").select(F.col("value").alias("json"))
    rows = json_stream.read_objects(listed, None).select("json").union(there)
    ids = rows.select(F.get_json_object("json", "$.doc_id").cast("long").alias("doc_id"))
    return ids.groupBy("doc_id").agg(F.count("*").alias("times"))


@query(
    """SELECT CASE event_id % 5 WHEN 0 THEN event_id || '.0' WHEN 1 THEN CAST(event_id AS VARCHAR) WHEN 2 THEN 'e' || event_id
                   WHEN 3 THEN CAST(event_id AS VARCHAR) || '.5' ELSE 'true' || event_id END AS doc_id,
              event_id % 5 <> 4 AS has_number
       FROM events"""
)
def json_hard_ids(spark, sf_dir):
    """IDs of objects with decimals, numbers past a double's range, repeated keys, lone
    surrogates, and lines of white space among them."""
    n, five = F.col("event_id").cast("string"), F.col("event_id") % 5
    line = (
        F.when(five == 0, F.concat(F.lit('{"id": '), n, F.lit(".0, \t\"x\": 1e400}\n\t")))
        .when(five == 1, F.concat(F.lit('{"id": 0, "id": '), n, F.lit("}")))
        .when(five == 2, F.concat(F.lit('{"id": "e'), n, F.lit('", "text": "\\ud800 cut"}\n \n')))
        .when(five == 3, F.concat(F.lit('{"text": "\\t", "id": '), n, F.lit(".5}")))
        .otherwise(F.concat(F.lit('{"id": "true'), n, F.lit('"}')))
    )
    path = scratch_path(spark, "hard-lines")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    docs = json_stream.json_documents(json_stream.read_lines(spark, path), id_pointer="/id")
    return docs.select("doc_id", (~F.col("doc_id").startswith("true")).alias("has_number"))


# --- files and ZIP files ---------------------------------------------------

_FILE_SQL = """SELECT 'in/' || lang || '/' || doc_id || '.txt' AS doc_id, md5(text) AS digest,
                      CAST(length(text) AS BIGINT) AS document_length
               FROM documents WHERE lang <> 'de'"""


def _named(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"),
        "text",
    )


@query(_FILE_SQL)
def file_round_trip(spark, sf_dir):
    root = scratch_path(spark, "files")
    ready = _named(spark, sf_dir).select(
        "row_id", F.col("text").alias("rendered"), F.concat(F.lit("in/"), "name", F.lit(".gz")).alias("path")
    )
    write_named_files(ready, root, compression="gzip").write.format("noop").mode("overwrite").save()
    ids = files.list_files(spark, root + "/in", "**/*.gz", "de/**", prefix="in/")
    plain = ids.withColumn("doc_id", F.regexp_replace("doc_id", r"\.gz$", ""))
    docs = files.read_files(plain, root, extension=".gz", compression="gzip")
    return docs.select("doc_id", F.md5("text").alias("digest"), "document_length")


@query(_FILE_SQL)
def zip_round_trip(spark, sf_dir):
    rows = _named(spark, sf_dir).withColumn("name", F.concat(F.lit("in/"), "name"))
    made = derived.write_containers(rows, F.col("row_id"), "row_id", "docs", ".zip", derived.zip_of)
    ids = zips.list_zip_entries(made, "in/**/*.txt", "in/de/")
    docs = zips.read_zip_entries(ids)
    return docs.select("doc_id", F.md5("text").alias("digest"), "document_length")


# --- web archives ----------------------------------------------------------

_ARCHIVE_SQL = """
  WITH p AS (SELECT *, row_number() OVER (PARTITION BY page_id // 50 ORDER BY page_id) AS n,
      CASE page_id % 7 WHEN 0 THEN '301' WHEN 1 THEN '404' WHEN 3 THEN NULL ELSE '200' END AS status
    FROM pages)
  SELECT url AS doc_id, CAST({position} AS BIGINT) AS position,
    CAST({body} AS BIGINT) AS document_length,
    CASE WHEN status IS NULL OR page_id % 5 = 4 THEN 'windows-1252'
         WHEN page_id % 5 = 1 THEN 'UTF-8' ELSE 'utf-8' END AS encoding,
    CASE WHEN status IS NOT NULL AND page_id % 5 <> 4 THEN md5(html) END AS digest,
    strftime(TIMESTAMP '2024-01-01' + to_minutes(page_id)
      + CASE WHEN page_id % 2 = 0 AND status IS NOT NULL THEN INTERVAL 0 DAY ELSE INTERVAL 1 DAY END,
      '%Y-%m-%dT%H:%M:%SZ') AS retrieved,
    {header} AS header
  FROM p WHERE {kept}"""

_FETCHED = """(status = '200' AND page_id % 11 <> 0 AND page_id % 5 <> 2)"""


def _archived(spark, sf_dir, made: DataFrame, header: str) -> DataFrame:
    ids = listing.record_ids(
        archives.read_records(made, with_body=False), mime_types="text/html text/plain no-type"
    )
    return _archive_rows(archives.documents_from(archives.read_records_at(ids)), header)


def _archive_rows(docs: DataFrame, header: str) -> DataFrame:
    whole = F.col("encoding") != "windows-1252"
    return docs.select(
        "doc_id",
        F.col("features")["archive_position"].cast("long").alias("position"),
        "document_length",
        "encoding",
        F.when(whole, F.md5("text")).alias("digest"),
        F.col("features")["retrievedAt"].alias("retrieved"),
        F.col("features")[header].alias("header"),
    )


def _records(spark, sf_dir) -> DataFrame:
    return derived.pages_as_records(spark, table(spark, sf_dir, "pages"))


@query(
    _ARCHIVE_SQL.format(
        position="2 * n",
        body="length(html)",
        header="url",
        kept=_FETCHED,
    )
)
def warc_documents(spark, sf_dir):
    made = derived.write_containers(
        _records(spark, sf_dir), F.col("page_id"), "page_id", "crawl", ".warc.gz", derived.warc_of
    )
    return _archived(spark, sf_dir, made, "arc_header_WARC-Target-URI")


@query(
    _ARCHIVE_SQL.format(
        position="2 * n",
        body="length(html)",
        header="'crawl-' || lpad(CAST(page_id // 50 AS VARCHAR), 6, '0') || '.warc.gz'",
        kept=_FETCHED,
    )
)
def archive_scan_documents(spark, sf_dir):
    """The same documents from one pass over the archives, cut into stretches of a few records."""
    made = derived.write_containers(
        _records(spark, sf_dir), F.col("page_id"), "page_id", "crawl", ".warc.gz", derived.warc_of
    )
    found = archives.archive_documents(made, mime_types="text/html text/plain no-type", stretch_bytes=20_000)
    return _archive_rows(found, "archive_name")


@query(
    _ARCHIVE_SQL.format(
        position="n",
        body="CASE WHEN status IS NULL THEN 17 ELSE length(html) END",
        header="CASE WHEN status IS NOT NULL THEN CASE page_id % 5 WHEN 0 THEN 'text/html; charset=\"utf-8\"' "
        "WHEN 1 THEN 'text/plain; charset=UTF-8' WHEN 3 THEN 'text/html; charset=utf-8' "
        "ELSE 'text/html' END END",
        kept=f"{_FETCHED} OR (status IS NULL AND page_id % 5 <> 2)",
    )
)
def arc_documents(spark, sf_dir):
    made = derived.write_containers(
        _records(spark, sf_dir), F.col("page_id"), "page_id", "crawl", ".arc", derived.arc_of
    )
    return _archived(spark, sf_dir, made, "http_header_Content-Type")


# --- whole documents -------------------------------------------------------


@query(
    f"""WITH {ANN}
      SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, md5(text) AS digest, count(ann.doc_id) AS n,
             CAST(coalesce(sum(start), 0) AS BIGINT) AS starts
      FROM documents d LEFT JOIN ann ON ann.doc_id = CAST(d.doc_id AS VARCHAR)
      GROUP BY d.doc_id, text"""
)
def saved_documents(spark, sf_dir):
    path = scratch_path(spark, "saved")
    save_documents(annotated(spark, sf_dir), path)
    total = F.aggregate("annotations", F.lit(0).cast("long"), lambda t, a: t + a["start"])
    return load_documents(spark, path).select(
        "doc_id", F.md5("text").alias("digest"), F.size("annotations").cast("long").alias("n"),
        total.alias("starts"),
    )


@query(
    f"""WITH {ANN} SELECT doc_id, start, "end" FROM ann WHERE type = 'Email'"""
)
def saved_annotations(spark, sf_dir):
    path = scratch_path(spark, "annotations")
    save_annotations(annotated(spark, sf_dir), path)
    found = spark.read.parquet(path)
    return found.filter("type = 'Email'").select("doc_id", "start", "end")


class _Refusing:
    """A sender that refuses documents with an address in them."""

    def __call__(self, rows):
        for row in rows:
            if any(a["type"] == "Email" for a in row["annotations"]):
                raise ValueError(f"refused {row['uri']}")


@query(
    f"""WITH {ANN}, e AS (SELECT DISTINCT doc_id FROM ann WHERE type = 'Email')
      SELECT d.doc_id AS row_id, CASE WHEN e.doc_id IS NOT NULL THEN 'refused x:' || d.doc_id END AS error
      FROM documents d LEFT JOIN e ON e.doc_id = CAST(d.doc_id AS VARCHAR)"""
)
def pushed_documents(spark, sf_dir):
    found = annotated(spark, sf_dir)
    ready = found.select(
        F.col("doc_id").cast("long").alias("row_id"),
        F.concat(F.lit("x:"), "doc_id").alias("uri"),
        F.filter("annotations", lambda a: a["type"] == "Email").alias("annotations"),
    )
    return push(ready, _Refusing, batch_rows=1)


# --- jobs and streams ------------------------------------------------------


@query(
    f"""WITH {ANN},
      saved AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents JOIN labels USING (doc_id)
                WHERE quality = 1),
      one AS (SELECT doc_id FROM ann WHERE type = 'Email' GROUP BY doc_id HAVING count(*) > 1)
      SELECT 'conditional' AS output, count(*) AS docs,
             CAST((SELECT count(*) FROM ann JOIN saved USING (doc_id) WHERE type = 'Capitalised') AS BIGINT) AS items
      FROM saved
      UNION ALL SELECT 'everything', (SELECT count(*) FROM documents), count(*) FROM ann
      UNION ALL SELECT 'windowed', (SELECT count(*) FROM documents) - (SELECT count(*) FROM one), NULL
      UNION ALL SELECT 'failed', (SELECT count(*) FROM one), NULL"""
)
def multi_output(spark, sf_dir):
    root = scratch_path(spark, "outputs")
    place = lambda name: posixpath.join(root, name)
    outputs = [
        Output("json", place("conditional"), [Selection("", ("Capitalised",))], "save", "chunks"),
        Output("parquet", place("everything")),
        Output("json", place("windowed"), layout="chunks", options={"window_type": "Email"}),
    ]
    spec = JobSpec(
        "multi", place("ledger"), [tokens(), lines()], documents=_with_quality(spark, sf_dir), outputs=outputs
    )
    run(spark, spec, run_id="first")

    def json_items(name: str) -> DataFrame:
        parsed = F.from_json("value", "entities map<string,array<struct<indices:array<bigint>>>>")
        sizes = F.aggregate(
            F.map_values(parsed["entities"]), F.lit(0).cast("long"), lambda t, x: t + F.size(x)
        )
        return spark.read.text(place(name)).select(F.lit(name).alias("output"), sizes.alias("items"))

    everything = load_documents(spark, place("everything")).select(
        F.lit("everything").alias("output"), F.size("annotations").cast("long").alias("items")
    )
    windowed = json_items("windowed").withColumn("items", F.lit(None).cast("long"))
    failed = ledgers.read_ledger(spark, place("ledger")).filter("return_code = 'FAIL'").select(
        F.lit("failed").alias("output"), F.lit(None).cast("long").alias("items")
    )
    rows = json_items("conditional").union(everything).union(windowed).union(failed)
    # A row of zero for each, so that an output that took nothing shows.
    each = F.explode(F.array(*(F.lit(n) for n in ("conditional", "everything", "windowed", "failed"))))
    names = spark.range(1).select(each.alias("output"), F.lit(0).cast("long").alias("docs"), F.lit(None).cast("long").alias("items"))
    counted = names.union(rows.select("output", F.lit(1).cast("long"), "items"))
    return counted.groupBy("output").agg(F.sum("docs").alias("docs"), F.sum("items").alias("items"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'SUCCESS' AS return_code,
              CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) THEN 'earlier' ELSE 'later' END AS run_id
       FROM documents
       UNION ALL SELECT CAST(doc_id AS VARCHAR), 'FAIL', 'earlier' FROM labels WHERE toxic <> 0"""
)
def restarted_run(spark, sf_dir):
    root = scratch_path(spark, "restart")
    labels = table(spark, sf_dir, "labels")
    earlier = labels.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("toxic") == 0, "SUCCESS").otherwise("FAIL").alias("return_code"),
        F.lit("earlier").alias("run_id"),
        *(F.lit(None).cast("long").alias(c) for c in ("file_size", "document_length", "execution_ms")),
        F.lit(None).cast("map<string,bigint>").alias("annotation_counts"),
        F.lit(None).cast("string").alias("error"),
    )
    ledgers.write_results(earlier, root)
    spec = JobSpec("restart", root, [tokens()], documents=documents(spark, sf_dir))
    run(spark, spec, run_id="later")
    run(spark, spec, run_id="idle")
    return ledgers.read_ledger(spark, root).select("doc_id", "return_code", "run_id")


class _Breaks:
    """An application that ends its task at one document, as a lost machine would."""

    def __init__(self, at: str):
        self.at = at

    def annotate(self, doc: dict) -> list[dict]:
        if doc["doc_id"] == self.at:
            raise MemoryError("the first run ends here")
        return []


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(1 AS BIGINT) AS times, true AS any_earlier, true AS any_later
       FROM documents"""
)
def interrupted_run(spark, sf_dir):
    """A run in slices dies in the middle; another does the rest, and each document is done once."""
    root = scratch_path(spark, "interrupted")
    docs = documents(spark, sf_dir)
    middle = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 2).agg(F.max("doc_id")).first()[0]
    spec = JobSpec("interrupted", root, lambda: _Breaks(middle), documents=docs)
    try:
        run(spark, spec, run_id="first", slices=4)
    except Exception as error:
        if "the first run ends here" not in str(error):
            raise
    run(spark, JobSpec("interrupted", root, [tokens()], documents=docs), run_id="second", slices=4)
    done = ledgers.read_ledger(spark, root).where("return_code = 'SUCCESS'")
    runs = done.agg(F.max(F.col("run_id") == "first").alias("any_earlier"), F.max(F.col("run_id") == "second").alias("any_later")).first()
    return done.groupBy("doc_id").agg(F.count("*").alias("times")).select(
        "doc_id", "times", F.lit(runs["any_earlier"]).alias("any_earlier"), F.lit(runs["any_later"]).alias("any_later")
    )


@query(
    """SELECT conv_id || '_' || turn AS doc_id, 'SUCCESS' AS return_code,
              CAST(length(text) AS BIGINT) AS chars
       FROM conversations"""
)
def streamed_run(spark, sf_dir):
    """The turns arrive in two folders' worth of files; the first half is seen
    twice, the second time by a stream that has lost its checkpoint."""
    root = scratch_path(spark, "stream")
    place = lambda name: posixpath.join(root, name)
    turns = _turns(spark, sf_dir)
    lines_of = lambda rows: rows.select(F.col("json").alias("value"))
    even = F.col("conv_id") % 2 == 0
    lines_of(turns.filter(even)).write.text(place("in"))
    start = lambda checkpoint: arrivals.annotate_stream(
        arrivals.arriving_lines(spark, place("in")),
        "turns",
        [tokens()],
        place("ledger"),
        place(checkpoint),
        to_documents=arrivals.documents_of_lines(**_TURN_ID),
        outputs=[Output("json", place("out"), layout="chunks", options={"group_by": "set"})],
        run_id=checkpoint,
    )
    start("first").awaitTermination()
    lines_of(turns.filter(~even)).write.mode("append").text(place("in"))
    start("second").awaitTermination()
    written_docs = (
        spark.read.text(place("out"))
        .select(F.get_json_object("value", "$.text").alias("json"))
        .select(
            F.concat(
                F.get_json_object("json", "$.conv_id"), F.lit("_"), F.get_json_object("json", "$.turn")
            ).alias("doc_id"),
            F.length(F.get_json_object("json", "$.text")).cast("long").alias("chars"),
        )
    )
    results = ledgers.read_ledger(spark, place("ledger")).select("doc_id", "return_code")
    return results.join(written_docs, "doc_id")
