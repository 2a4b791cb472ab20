import bz2
import gzip
import json
import lzma
import os
import random
import zipfile
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from annoflow.operators import enumerate as listing
from annoflow.operators.lookup import lookup
from annoflow.model import as_documents, empty_map
from annoflow.operators.spread import spread
from annoflow.sources import archives, files, json_blocks, json_stream, storage, zips
from annoflow.sources.archive_frames import Frames


def ids_of(spark, *names, **attrs):
    df = spark.createDataFrame([(n,) for n in names], "doc_id string")
    pairs = [c for k, v in attrs.items() for c in (F.lit(k), F.lit(v))]
    return df.withColumn("id_attrs", F.create_map(*pairs) if pairs else empty_map())


def rows_by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- files -----------------------------------------------------------------


@pytest.fixture
def folder(tmp_path):
    for name, data in {
        "a.txt": "héllo".encode(),
        "b/c.TXT": b"upper",
        "b/d/e.txt.gz": gzip.compress("zipped".encode()),
        "b/d/_under.txt": b"",
        "b/x~": b"backup",
        ".git/config": b"git",
        "bad.gz": b"not gzip",
        "latin.txt": "é".encode("latin-1"),
        "s.snappy": storage.snappy_frame(b"snap" * 20_000),
    }.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(tmp_path)


def test_list_files(spark, folder):
    names = lambda *a, **k: [r["doc_id"] for r in listing.in_order(files.list_files(spark, folder, *a, **k)).collect()]
    everything = names()
    assert everything == sorted(everything)
    assert everything == ["a.txt", "b/c.TXT", "b/d/_under.txt", "b/d/e.txt.gz", "bad.gz", "latin.txt", "s.snappy"]
    assert ".git/config" in names(default_excludes="off") and "b/x~" in names(default_excludes="off")
    assert names("**/*.txt", "b/**", prefix="large/") == ["large/a.txt", "large/latin.txt"]
    sizes = rows_by_id(files.list_files(spark, folder))
    assert sizes["a.txt"]["file_size"] == 6 and sizes["b/d/_under.txt"]["file_size"] == 0
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, folder + "/none")


def test_read_files(spark, folder):
    got = rows_by_id(files.read_files(ids_of(spark, "a.txt", "b/d/_under.txt", "none.txt"), folder, mime_type="text/plain"))
    assert (got["a.txt"]["text"], got["a.txt"]["file_size"], got["a.txt"]["document_length"]) == ("héllo", 6, 5)
    assert got["a.txt"]["mime_type"] == "text/plain" and got["a.txt"]["load_error"] is None
    assert got["b/d/_under.txt"]["text"] == ""
    assert "none.txt" in got["none.txt"]["load_error"] and got["none.txt"]["text"] is None
    assert files.read_files(ids_of(spark, "latin.txt"), folder, encoding="latin-1").first()["text"] == "é"
    assert files.read_files(ids_of(spark, "a"), folder, extension=".txt").first()["text"] == "héllo"


def test_read_compressed_files(spark, folder):
    got = rows_by_id(files.read_files(ids_of(spark, "b/d/e.txt.gz", "bad.gz"), folder, compression="gzip"))
    assert got["b/d/e.txt.gz"]["text"] == "zipped"
    assert got["b/d/e.txt.gz"]["file_size"] == len(gzip.compress(b"zipped"))
    assert got["bad.gz"]["load_error"]
    snappy = files.read_files(ids_of(spark, "s.snappy", "a.txt"), folder, compression="snappy")
    got = rows_by_id(snappy)
    assert got["s.snappy"]["text"] == "snap" * 20_000
    assert "framing" in got["a.txt"]["load_error"]
    with pytest.raises(LookupError):
        files.read_files(ids_of(spark, "a.txt"), folder, encoding="no-such")


def test_list_of_ids(spark, tmp_path):
    (tmp_path / "ids").write_text("  a \n\n\tb/é\n", encoding="utf-8")
    (tmp_path / "latin").write_bytes("xé, \"y\"\n\n€\n".encode("cp1252"))
    names = lambda *a: sorted(r["doc_id"] for r in listing.ids_from_lines(spark, *a).collect())
    assert names(str(tmp_path / "ids"), "p/") == ["p/", "p/a", "p/b/é"]
    assert names(str(tmp_path / "latin"), None, "windows-1252") == ["", 'xé, "y"', "€"]
    with pytest.raises(ValueError):
        names(str(tmp_path / "ids"), None, "UTF-16")


def test_loading_is_spread_by_the_work(spark, monkeypatch):
    from annoflow.operators import spread as spreading

    monkeypatch.setattr(spreading, "TASK_BYTES", 1000)
    ids = spark.range(100, numPartitions=1).select(
        F.col("id").cast("string").alias("doc_id"), F.lit("hot").alias("zip"), F.lit(500).alias("n")
    )
    by_size = spreading.spread(ids, "zip", "doc_id", size=F.col("n"))
    assert by_size.rdd.getNumPartitions() == 50
    held = [len(p) for p in by_size.rdd.glom().collect()]
    assert sum(held) == 100 and max(held) < 30
    assert spreading.spread(ids).rdd.getNumPartitions() == 8
    assert spreading.spread(ids.limit(0), "zip").count() == 0


def test_lookup_keeps_every_id(spark):
    docs = as_documents(spark.createDataFrame([("a", "A")], "i string, t string"), "i", "t")
    got = lookup(ids_of(spark, "a", "a", "z", k="v"), docs).collect()
    assert len(got) == 3
    assert {r["load_error"] for r in got} == {None, "Unknown document z"}
    assert got[0]["id_attrs"] == {"k": "v"}


def test_union_and_order(spark):
    both = listing.union_ids([ids_of(spark, "b", "a"), ids_of(spark, "a", k="v"), ids_of(spark, "a")])
    assert [r["doc_id"] for r in listing.in_order(both).collect()] == ["a", "a", "a", "b"]
    assert listing.union_ids([both.drop("src_ord")], distinct=True).count() == 3


# --- ZIP -------------------------------------------------------------------


def test_zip(spark, tmp_path):
    path = str(tmp_path / "x.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("d")
        z.writestr("d/a.txt", "A" * 100)
        z.writestr("d/é.txt", "Latin")
        z.writestr("b.xml", "<b/>")
    ids = zips.list_zip_entries(zips.paths_frame(spark, path), "**/*.txt")
    assert [(r["doc_id"], r["file_size"]) for r in ids.collect()] == [("d/a.txt", 100), ("d/é.txt", 5)]
    got = rows_by_id(zips.read_zip_entries(ids.unionByName(ids_of(spark, "gone", zip=path), True)))
    assert got["d/a.txt"]["text"] == "A" * 100 and got["d/a.txt"]["file_size"] == 100
    assert got["gone"]["load_error"].strip("'") == f"{path} holds no entry gone"
    got = rows_by_id(zips.read_zip_entries(ids_of(spark, "b.xml"), path, mime_type="text/xml"))
    assert got["b.xml"]["text"] == "<b/>" and got["b.xml"]["mime_type"] == "text/xml"


def test_zip_file_name_charset(spark, tmp_path):
    path = str(tmp_path / "old.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xx.txt", "hi")
    raw = open(path, "rb").read().replace(b"xx.txt", "é€.txt".encode("cp1252"))
    open(path, "wb").write(raw)
    ids = zips.list_zip_entries(zips.paths_frame(spark, path), file_name_encoding="cp1252")
    got = zips.read_zip_entries(ids, file_name_encoding="cp1252").first()
    assert (got["doc_id"], got["text"]) == ("é€.txt", "hi")


# --- web archives ----------------------------------------------------------


def response(body, status="200 OK", **headers):
    lines = [f"HTTP/1.1 {status}"] + [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + body


def warc(*records, zipped):
    out = []
    for kind, url, mime, content in records:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2008-04-30T20:48:25Z\r\n"
        head += f"Content-Type: {mime}\r\nContent-Length: {len(content)}\r\n\r\n"
        record = head.encode() + content + b"\r\n\r\n"
        out.append(gzip.compress(record) if zipped else record)
    return b"".join(out)


HTTP = "application/http; msgtype=response"


@pytest.fixture(params=[True, False])
def crawl(request, tmp_path):
    data = warc(
        ("warcinfo", "", "application/warc-fields", b"software: x"),
        ("response", "http://h/ok", "application/http;msgtype=response",
         response("café".encode("utf-8"), content_type="text/html; charset='utf-8'", Date="Sun, 06 Nov 1994 08:49:37 GMT")),
        ("request", "http://h/ok", "application/http; msgtype=request", b"GET / HTTP/1.0\r\n\r\n"),
        ("response", "http://h/default", "APPLICATION/HTTP;  msgtype=RESPONSE",
         response("€".encode("cp1252"), content_type="text/plain", Location="a", location="b")),
        ("response", "http://h/empty", HTTP, response(b"", content_type="text/html")),
        ("response", "http://h/moved", HTTP, response(b"moved", "301 Moved", content_type="text/html")),
        ("response", "http://h/broken", HTTP, b"garbage"),
        ("response", "http://h/chunked", HTTP,
         response(b"3;x=y\r\nabc\r\n2\r\nde\r\n0\r\n\r\n", Transfer_Encoding="Chunked", Date="not a date")),
        ("response", "http://h/cut", HTTP, response(b"9\r\nabc\r\n", Transfer_Encoding="chunked")),
        ("metadata", "http://h/ok", "application/warc-fields", b"a: b"),
        zipped=request.param,
    )
    path = tmp_path / ("c.warc.gz" if request.param else "c.warc")
    path.write_bytes(data)
    return str(path)


def test_warc_enumeration(spark, crawl):
    records = archives.read_records(zips.paths_frame(spark, crawl), with_body=False)
    assert sorted(r["position"] for r in records.collect()) == list(range(10))
    found = {
        r["doc_id"]: int(r["id_attrs"]["recordPosition"]) for r in listing.record_ids(records).collect()
    }
    assert found == {"http://h/ok": 1, "http://h/default": 3, "http://h/chunked": 7, "http://h/cut": 8}
    everything = listing.record_ids(records, exclude_status="")
    assert "http://h/moved" in {r["doc_id"] for r in everything.collect()}
    html = listing.record_ids(records, mime_types="text/html application/pdf")
    assert {r["doc_id"] for r in html.collect()} == {"http://h/ok"}
    none = listing.record_ids(records, mime_types="_not_found_")
    assert {r["doc_id"] for r in none.collect()} == {"http://h/chunked", "http://h/cut"}


def test_warc_documents(spark, crawl):
    ids = listing.record_ids(archives.read_records(zips.paths_frame(spark, crawl), with_body=False))
    docs = rows_by_id(archives.documents_from(archives.read_records_at(ids), mime_type="text/html"))
    ok = docs["http://h/ok"]
    assert (ok["text"], ok["encoding"], ok["file_size"], ok["document_length"]) == ("café", "utf-8", 5, 4)
    assert ok["features"]["archive_name"] == crawl
    assert ok["features"]["archive_position"] == "1"
    assert ok["features"]["retrievedAt"] == "1994-11-06T08:49:37Z"
    assert ok["features"]["original_size"] == "5"
    assert ok["features"]["arc_header_WARC-Type"] == "response"
    assert ok["features"]["http_header_Date"] == "Sun, 06 Nov 1994 08:49:37 GMT"
    default = docs["http://h/default"]
    assert (default["text"], default["encoding"]) == ("€", "windows-1252")
    assert default["features"]["retrievedAt"] == "2008-04-30T20:48:25Z"
    chunked = docs["http://h/chunked"]
    assert (chunked["text"], chunked["file_size"]) == ("abcde", 5)
    assert chunked["features"]["retrievedAt"] == "2008-04-30T20:48:25Z"
    assert docs["http://h/cut"]["load_error"] == "chunked body ends early"


def test_record_settings_are_checked(spark, crawl):
    cases = {
        "no attributes": {},
        "bad offset": {"recordOffset": "x", "recordLength": "5"},
        "empty length": {"recordOffset": "0", "recordLength": ""},
        "beyond": {"recordOffset": "99999999", "recordLength": "5"},
    }
    for name, attrs in cases.items():
        row = archives.read_records_at(ids_of(spark, name, **attrs), crawl).first()
        assert row["load_error"], name
    row = archives.read_records_at(ids_of(spark, "x", recordOffset="0", recordLength="5")).first()
    assert "No archive" in row["load_error"]


@pytest.mark.parametrize(
    "http, archive, want",
    [
        ("Sun, 06 Nov 1994 08:49:37 GMT", None, "1994-11-06T08:49:37Z"),
        ("Sunday, 06-Nov-24 08:49:37 GMT", None, "2024-11-06T08:49:37Z"),
        ("Sun Nov  6 08:49:37 1994", None, "1994-11-06T08:49:37Z"),
        ("yesterday", "20080430204825", "2008-04-30T20:48:25Z"),
        (None, "20080430204825", "2008-04-30T20:48:25Z"),
        (None, "2008", None),
    ],
)
def test_retrieval_dates(spark, http, archive, want):
    df = spark.createDataFrame([(archive, [("DATE", http)])], "date string, http_headers array<struct<name:string,value:string>>")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert df.select(archives._in_utc(archives.retrieved_at())).first()[0] == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_arc(spark, tmp_path):
    def record(url, mime, content):
        return f"{url} 1.2.3.4 20080430204825 {mime} {len(content)}\n".encode() + content + b"\n"

    data = (
        record("filedesc://x.arc", "text/plain", b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n")
        + record("http://h/a", "text/html", response(b"<a>", content_type='text/html; charset="UTF-8"'))
        + record("dns:h", "text/dns", b"20080430\nh. IN A 1.2.3.4\n")
        + record("http://h/404", "text/html", response(b"no", "404 Not Found"))
        + record("http://h/empty", "text/html", response(b""))
    )
    path = str(tmp_path / "x.arc")
    open(path, "wb").write(data)
    records = archives.read_records(zips.paths_frame(spark, path))
    ids = listing.record_ids(records)
    assert {r["doc_id"]: r["id_attrs"]["recordPosition"] for r in ids.collect()} == {"http://h/a": "1", "dns:h": "2"}
    docs = rows_by_id(archives.documents_from(archives.read_records_at(ids)))
    assert docs["http://h/a"]["text"] == "<a>"
    assert docs["http://h/a"]["features"]["arc_header_ip-address"] == "1.2.3.4"
    assert docs["dns:h"]["features"]["retrievedAt"] == "2008-04-30T20:48:25Z"


# --- listings and ZIP indexes at scale -------------------------------------------


def test_many_directories_are_listed_in_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_LISTINGS", 50)
    root = tmp_path / "tree"
    want = set()
    for i in range(1500):
        folder = root / f"a{i % 7}" / f"b{i % 61}" / f"c{i}"
        folder.mkdir(parents=True)
        if i % 3 == 0:
            (folder / "f.txt").write_text("x" * (i % 5))
            want.add((f"a{i % 7}/b{i % 61}/c{i}/f.txt", i % 5))
    deep = root
    for i in range(120):
        deep = deep / "d"
    deep.mkdir(parents=True)
    (deep / "end #1?.txt").write_text("")
    want.add(("d/" * 120 + "end #1?.txt", 0))
    got = files.list_files(spark, str(root)).collect()
    assert len(got) == len(want) and {(r["doc_id"], r["file_size"]) for r in got} == want
    (tmp_path / "none").mkdir()
    assert files.list_files(spark, str(tmp_path / "none")).count() == 0


def test_a_zip_directory_is_read_once(spark, tmp_path):
    """The directories go after the listing: reading the entries must not need them."""
    paths, want = [], {}
    for k, method in enumerate((zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2)):
        path = tmp_path / f"{k}.zip"
        with zipfile.ZipFile(path, "w", method) as z:
            for i in range(300):
                z.writestr(f"{k}/é{i}.txt", f"text {i} é " * (i % 30))
                want[f"{k}/é{i}.txt"] = f"text {i} é " * (i % 30)
        paths.append(str(path))
    ids = list_once = zips.list_zip_entries(zips.paths_frame(spark, paths))
    assert ids.count() == 900
    for path in paths:
        with open(path, "r+b") as f:
            at = f.read().index(b"PK\x01\x02")
            f.truncate(at)
    docs = {d["doc_id"]: d for d in zips.read_zip_entries(list_once).collect()}
    assert {i: d["text"] for i, d in docs.items()} == want and not any(d["load_error"] for d in docs.values())
    assert all(d["file_size"] == len(want[i].encode()) for i, d in docs.items())


def test_zip_entries_fail_alone(spark, tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w") as z:
        for i in range(4):
            z.writestr(f"{i}", f"text {i}")
        z.writestr("twice", "old")
        z.writestr("twice", "new")
    data = bytearray(path.read_bytes())
    data[data.index(b"text 2")] = ord("T")
    path.write_bytes(bytes(data))
    (tmp_path / "no.zip").write_bytes(b"no zip at all")
    ids = ids_of(spark, "0", "1", "2", "twice", "missing", zip=str(path)).union(ids_of(spark, "other", zip=str(tmp_path / "no.zip"))).union(ids_of(spark, "lost"))
    docs = {d["doc_id"]: d for d in zips.read_zip_entries(ids).collect()}
    assert {i: d["text"] for i, d in docs.items() if d["load_error"] is None} == {"0": "text 0", "1": "text 1", "twice": "new"}
    errors = {i: d["load_error"] for i, d in docs.items() if d["load_error"]}
    assert "check sum" in errors["2"] and "holds no entry" in errors["missing"] and "zip" in errors["other"].lower() and "no ZIP file" in errors["lost"]


# --- archives in stretches ------------------------------------------------------


def arc(*records):
    head = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    lines = [f"filedesc://x.arc 0.0.0.0 20240101000000 text/plain {len(head)}\n".encode() + head]
    lines += [f"{url} 1.2.3.4 20080430204825 {mime} {len(content)}\n".encode() + content for _, url, mime, content in records]
    return lines


def many_records(draw, inner):
    """Records of very different sizes; some hold archives, whose records must not be taken for their own."""
    out = []
    for i in range(60):
        body = bytes(draw.choices(b"abc \n", k=draw.choice([0, 5, 60, 900])))
        if i % 7 == 3:
            body = draw.choice([inner, b"text\n" + inner + b"\r\n\r\n" + inner])
        out.append(("response", f"http://h/{i}", HTTP, response(body, content_type="text/html")))
    return out


@pytest.fixture(params=["warc", "warc.gz", "arc", "arc.gz"])
def big_archive(request, tmp_path):
    draw = random.Random(request.param)
    zipped = request.param.endswith("gz")
    # stored, not compressed: the members within are there byte by byte
    stored = lambda r: gzip.compress(r, 0 if len(r) > 2000 else 6)
    if request.param.startswith("warc"):
        inner = warc(*(("response", f"http://inner/{i}", HTTP, response(b"inner" * 40)) for i in range(12)), zipped=zipped)
        parts = [warc(r, zipped=False) for r in many_records(draw, inner)]
    else:
        inner = arc(*(("", f"http://inner/{i}", "text/html", response(b"inner" * 40)) for i in range(12)))
        inner = b"".join(gzip.compress(r + b"\n") if zipped else r + b"\n" for r in inner)
        parts = [r + b"\n" for r in arc(*(("", u, "text/html", c) for _, u, _, c in many_records(draw, inner)))]
    path = tmp_path / f"big.{request.param}"
    path.write_bytes(b"".join(stored(p) if zipped else p for p in parts))
    return str(path)


def test_stretches_give_what_one_scan_gives(spark, big_archive):
    frame = zips.paths_frame(spark, big_archive)
    wanted = {tuple(r) for r in archives.read_records(frame, with_body=False).select("position", "offset", "url", "body_length", "load_error").collect()}
    urls = [w[2] for w in sorted(wanted)]
    assert urls[-60:] == [f"http://h/{i}" for i in range(60)] and len(urls) <= 61 and not any(w[4] for w in wanted)
    for size in (300, 1111, 5000):
        got = archives.read_records(frame, stretch_bytes=size).select("position", "offset", "url", "body_length", "load_error").collect()
        assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted
    docs = archives.archive_documents(frame, stretch_bytes=2000).select("doc_id", F.md5("text"), F.col("features")["archive_name"]).collect()
    ids = listing.record_ids(archives.read_records(frame, with_body=False))
    fetched = archives.documents_from(archives.read_records_at(ids)).select("doc_id", F.md5("text")).collect()
    assert sorted(tuple(d)[:2] for d in docs) == sorted(map(tuple, fetched)) and len(docs) > 30
    assert {d[2] for d in docs} == {os.path.basename(big_archive)}


def test_an_archive_is_read_by_many_tasks_and_once(spark, tmp_path):
    draw = random.Random(5)
    records = [("response", f"http://h/{i}", HTTP, response(draw.randbytes(draw.randrange(40_000)), content_type="text/html")) for i in range(400)]
    for zipped in (False, True):
        path = str(tmp_path / f"w{zipped}")
        with open(path, "wb") as f:
            f.write(warc(*records, zipped=zipped))
        size, stretch, read, found = os.path.getsize(path), 1 << 20, 0, []
        for begin in range(0, size, stretch):
            with storage.open_input(path) as f:
                frames = Frames(f, step=1 << 14)
                found += [x.offset for x in frames.between(begin, min(begin + stretch, size), begin == 0)]
                read += frames.window.read
        assert len(found) == 400 == len(set(found)) and read <= 1.1 * size
    scanned = archives.read_records(zips.paths_frame(spark, path), with_body=False, stretch_bytes=1 << 20)
    assert scanned.count() == 400
    stretches = scanned.sparkSession.createDataFrame([(path,)], "path string").mapInArrow(archives._stretches(1 << 20), archives._STRETCH)
    assert spread(stretches, "archive", "begin", size=F.col("size")).rdd.getNumPartitions() == min(stretches.count(), 8)


@pytest.mark.parametrize("zipped", [False, True])
def test_a_broken_record_fails_alone(spark, tmp_path, zipped):
    parts = [warc(("response", f"http://h/{i}", HTTP, response(b"text %d" % i, content_type="text/html")), zipped=zipped) for i in range(9)]
    parts[2] = parts[2][:40] + b"#" * 20 + parts[2][60:] if zipped else parts[2].replace(b"Content-Length", b"Contents")
    parts[5] = parts[5].replace(b"WARC/1.0", b"HARM/1.0") if not zipped else gzip.compress(b"no record at all")
    parts[8] = parts[8][:-30]
    path = tmp_path / "broken"
    path.write_bytes(b"".join(parts))
    for size in (1 << 20, 200):
        docs = archives.archive_documents(zips.paths_frame(spark, str(path)), stretch_bytes=size).collect()
        texts = {d["doc_id"]: d["text"] for d in docs if d["load_error"] is None}
        assert texts == {f"http://h/{i}": f"text {i}" for i in (1, 3, 4, 6, 7)}
        starts = [sum(map(len, parts[:i])) for i in (2, 5, 8)]
        assert sorted(d["doc_id"] for d in docs if d["load_error"]) == sorted(f"{path}@{s}" for s in starts)


def test_archive_names(spark, tmp_path):
    path = tmp_path / "n.warc"
    path.write_bytes(warc(("warcinfo", "", "x/y", b""), ("response", "http://h/1", HTTP, response(b"a")), zipped=False))
    found = archives.read_records(zips.paths_frame(spark, f"file://{path}"), with_body=False)
    name = lambda docs: docs.first()["features"]["archive_name"]
    assert name(archives.documents_from(archives.read_records_at(listing.record_ids(found)))) == str(path)
    plain = listing.record_ids(found, with_archive=False)
    assert name(archives.documents_from(archives.read_records_at(plain, str(path)))) == "n.warc"


# --- JSON streams ----------------------------------------------------------

OBJECTS = [{"id": "é1", "x": [1, {"y": "]}"}]}, {"id": 2, "n": None}, {"delete": {"id": 3}}, {"id": ""}, {"id": None}]
LAYOUTS = {
    "array": json.dumps(OBJECTS),
    "pretty": "\n".join(json.dumps(o, indent=2) for o in OBJECTS),
    "run on": "".join(json.dumps(o) for o in OBJECTS),
    "lines": "\n".join(json.dumps(o) for o in OBJECTS) + "\n",
    "spaced array": " \n[ " + " ,\n ".join(json.dumps(o) for o in OBJECTS) + " ] \n",
}
CODECS = {
    "gz": gzip.compress, "gzip": lambda d: gzip.compress(d[:20]) + gzip.compress(d[20:]), "bzip2": bz2.compress,
    "xz": lzma.compress, "lzma": lambda d: lzma.compress(d, lzma.FORMAT_ALONE), "deflate": zlib.compress,
    "snappy-raw": lambda d: pa.Codec("snappy").compress(d, asbytes=True), "none": lambda d: d,
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_json_layouts(spark, tmp_path, layout):
    path = str(tmp_path / "x.json")
    open(path, "w", encoding="utf-8").write(LAYOUTS[layout])
    docs = json_stream.json_documents(json_stream.read_objects(zips.paths_frame(spark, path)), id_pointer="/id", mime_type="m")
    got = rows_by_id(docs)
    assert set(got) == {"é1", "2"}
    assert got["é1"]["text"] == '{"id":"é1","x":[1,{"y":"]}"}]}'
    assert got["2"]["mime_type"] == "m" and got["2"]["file_size"] is None


@pytest.mark.parametrize("codec", CODECS)
def test_json_codecs(tmp_path, codec):
    path = tmp_path / "x"
    path.write_bytes(CODECS[codec](LAYOUTS["lines"].encode()))
    read = lambda name: list(json_stream.values_in(storage.decompressed(open(path, "rb"), name)))
    assert len(read(codec)) == 5
    if codec not in ("deflate", "snappy-raw"):
        assert len(read("any")) == 5


def test_unsupported_codecs(spark, tmp_path):
    for name in ("pack200", "z", "lzop -dc"):
        with pytest.raises(ValueError):
            json_stream.read_objects(zips.paths_frame(spark, "x"), name)


@pytest.mark.parametrize(
    "text, same",
    [
        ('{"x": 1e400, "y": [10.0, -2.50E+3]}', '{"x":1e400,"y":[10.0,-2.50E+3]}'),
        ('{"x": "\\ud800 \\u00e9"}', '{"x":"\\ud800 é"}'),
        ('{"a": 1, "a": 2.0}', '{"a":2.0}'),
        (" 12.50 ", "12.50"),
    ],
)
def test_values_keep_their_numbers_and_surrogates(text, same):
    assert list(json_stream.values_in(iter([text.encode()]))) == [same]
    assert list(json_stream.values_in(bytes([b]) for b in text.encode())) == [same]
    assert json_stream._compact(text) == same


@pytest.mark.parametrize("text", ['{"a": NaN}', "[Infinity]"])
def test_what_is_not_json_fails(text):
    with pytest.raises(ValueError):
        list(json_stream.values_in(iter([text.encode()])))


def test_an_object_that_cannot_be_parsed_is_no_object_without_an_id(spark):
    rows = spark.createDataFrame([('{"id": 1, "id": 2}',), ('{"id": 3}',), ("{}",)], "json string")
    docs = {d["doc_id"]: d for d in json_stream.json_documents(rows, id_pointer="/id").collect()}
    assert len(docs) == 2 and docs["3"]["load_error"] is None
    bad = next(d for i, d in docs.items() if i != "3")
    assert bad["load_error"].startswith("cannot parse a JSON object") and bad["text"] is None


def scanned_in_blocks(data, size, piece):
    """Values, with their places, of blocks that are entered as their effects say."""
    begins = list(range(0, max(len(data), 1), size))
    cut = lambda b, e: (data[i : min(i + piece, e)] for i in range(b, e, piece))
    found = json_blocks.entries([json_blocks.effect(cut(b, min(b + size, len(data))), data[:b]) for b in begins])
    out = []
    for b, entry in zip(begins, found):
        out += json_blocks.TopValues(b, entry, data[:b], b + size if b + size < len(data) else float("inf")).read(cut(b, len(data)))
    return out


strings = st.text(st.sampled_from('ab"\\\\[]{},: \n\u00e9'), max_size=8)
tricky = st.recursive(
    strings | st.integers() | st.booleans(), lambda x: st.lists(x, max_size=3) | st.dictionaries(strings, x, max_size=3), max_leaves=6
)


@settings(max_examples=150, deadline=None)
@given(st.lists(tricky, max_size=6), st.integers(1, 30), st.integers(1, 9), st.booleans(), st.sampled_from([" ", "\n", ",\n"]))
def test_blocks_give_what_one_scan_gives(values, size, piece, as_array, space):
    if as_array:
        text = "[" + (space if "," in space else ",").join(json.dumps(v, ensure_ascii=False) for v in values) + "]"
    else:
        text = space.replace(",", "").join(json.dumps(v, ensure_ascii=False) for v in values)
        if text.startswith("["):
            text = "{} " + text
            values = [{}, *values]
    data = text.encode()
    got = scanned_in_blocks(data, size, piece)
    assert [json.loads(t) for _, t, _ in got] == values and not any(p for *_, p in got)
    assert [p for p, *_ in got] == sorted({p for p, *_ in got})


@pytest.mark.parametrize("text, wrong", [
    ('{"a":1} x {"b":2}', 1), ('[{"a":1},{"b"},3]', 1), ('{"a":1}} {"b":2}', 1), ('[{"a":1},', 1), ('{"a":1} {"b":[', 1), ('[1,"ab', 2), ('{"a":1},{"b":2}', 0),
])
def test_bad_values_fail_alone(spark, tmp_path, text, wrong):
    path = tmp_path / "x.json"
    path.write_text(text)
    for size in (1 << 20, 3):
        rows = json_stream.read_objects(zips.paths_frame(spark, str(path)), block_bytes=size).collect()
        want = len(rows) - sum(r["json"] is not None for r in rows)
        assert want >= wrong and all(r["place"].startswith(f"{path}@") for r in rows)
        if "a" in text and not text.startswith('[1'):
            assert '{"a":1}' in {r["json"] for r in rows}
        if text.endswith('{"b":2}'):
            assert '{"b":2}' in {r["json"] for r in rows}
    docs = json_stream.json_documents(json_stream.read_objects(zips.paths_frame(spark, str(path)), block_bytes=3), id_pointer="/a").collect()
    assert sum(d["load_error"] is not None for d in docs) >= wrong


def test_one_array_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "big.json")
    texts = F.concat(F.lit('\\"{['), F.repeat(F.lit("x}"), (F.col("id") % 40).cast("int")))
    lines = spark.range(60_000).select(F.to_json(F.struct("id", texts.alias("t"))).alias("j"))
    lines.coalesce(1).write.text(str(tmp_path / "lines"))
    lines = [line for p in sorted((tmp_path / "lines").glob("part*")) for line in p.read_text().splitlines()]
    with open(path, "w") as f:
        f.write("[" + ",\n".join(lines) + "]")
    rows = json_stream.read_objects(zips.paths_frame(spark, path), block_bytes=400_000)
    found = rows.withColumn("task", F.spark_partition_id())
    assert found.select("task").distinct().count() >= 4
    assert sorted(json.loads(r["json"])["id"] for r in found.collect()) == list(range(60_000))
    assert found.agg(F.count_distinct("json")).first()[0] == 60_000


@pytest.mark.parametrize("text", ['[{"a":1},', '{"a":1}{"a"', '{"a":1} x', '[{"a":1}'])
def test_broken_stream_fails(text):
    with pytest.raises(ValueError):
        list(json_stream.values_in(iter([text.encode()])))


def test_cut_compressed_stream_fails(tmp_path):
    (tmp_path / "x").write_bytes(gzip.compress(b'{"a":1}' * 1000)[:-20])
    with pytest.raises(EOFError):
        list(json_stream.values_in(storage.decompressed(open(tmp_path / "x", "rb"), "gz")))


plain = st.text(st.characters(exclude_categories=["Cs"]), max_size=5)
json_values = st.recursive(
    st.none() | st.booleans() | st.integers() | plain,
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(plain, inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.dictionaries(plain, json_values, max_size=3), max_size=5),
    st.integers(1, 7), st.booleans(), st.sampled_from(["", " ", "\n"]),
)
def test_stream_in_any_pieces(objects, size, as_array, space):
    text = json.dumps(objects, ensure_ascii=False) if as_array else space.join(
        json.dumps(o, ensure_ascii=False) for o in objects
    )
    data = text.encode()
    pieces = (data[i : i + size] for i in range(0, len(data), size))
    assert [json.loads(v) for v in json_stream.values_in(pieces)] == objects


def test_lines_are_compacted(spark, tmp_path):
    path = str(tmp_path / "x.json")
    open(path, "w").write('{"id" : 1 ,"a": "x  y"}\n\n{"id":2}\n')
    got = sorted(r["json"] for r in json_stream.read_lines(spark, path).collect())
    assert got == ['{"id":1,"a":"x  y"}', '{"id":2}']


def test_an_id_setting_is_required(spark):
    with pytest.raises(ValueError):
        json_stream.json_documents(spark.createDataFrame([("{}",)], "json string"))


def test_lookup_scans_documents_once(spark, tmp_path):
    docs = as_documents(spark.range(500).select(F.col("id").cast("string").alias("i"), F.concat(F.lit("text "), "id").alias("t")), "i", "t")
    docs.write.parquet(str(tmp_path / "docs"))
    kept = spark.read.schema(docs.schema).parquet(str(tmp_path / "docs"))
    ids = spark.range(300).select(F.when(F.col("id") < 200, "7").otherwise(F.col("id") * 3).cast("string").alias("doc_id"), empty_map().alias("id_attrs"))
    for limit in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            found = lookup(ids, kept)
            rows = found.collect()
            plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert plan.count("FileScan parquet") == 1
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert len(rows) == 300 and sum(r["text"] == "text 7" for r in rows) == 200
        missing = {r["doc_id"] for r in rows if r["load_error"]}
        assert missing == {str(3 * i) for i in range(200, 300) if 3 * i >= 500}
        assert all(r["load_error"] == f"Unknown document {r['doc_id']}" for r in rows if r["doc_id"] in missing)


def test_paths_below_a_uri_are_taken_as_they_stand(monkeypatch):
    asked = []

    def from_uri(uri):
        asked.append(uri)
        scheme, rest = uri.split("://")
        return f"{scheme} system", rest.rstrip("/") if scheme == "s3" else "/"

    storage._connected.cache_clear()
    monkeypatch.setattr(storage.pafs, "FileSystem", type("Fake", (), {"from_uri": staticmethod(from_uri)}))
    try:
        odd = "a b/c#d?e=%20.txt"
        assert storage.locate(storage.join("hdfs://host:9000/in", odd)) == ("hdfs system", "/in/" + odd)
        assert storage.locate(storage.join("s3a://bucket/in/", odd)) == ("s3 system", "bucket/in/" + odd)
        assert storage.locate("s3://bucket/x") == ("s3 system", "bucket/x")
        assert asked == ["hdfs://host:9000/", "s3://bucket/"]
        assert storage.locate("file:///x/" + odd)[1] == "/x/" + odd and storage.locate("/x/" + odd)[1] == "/x/" + odd
    finally:
        storage._connected.cache_clear()
