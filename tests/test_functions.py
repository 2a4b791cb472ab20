import json

import pytest
from pyspark.sql import functions as F

from annoflow.functions import globs, ids, naming, render
from annoflow.model import empty_map


def one(spark, column, **values):
    ddl = ", ".join(f"{k} string" for k in values) or "x string"
    df = spark.createDataFrame([tuple(values.values()) or ("",)], ddl)
    return df.select(column.alias("out")).first()["out"]


# --- naming ----------------------------------------------------------------


@pytest.mark.parametrize(
    "doc_id, extension, replace, want",
    [
        ("ft/03082001", ".html", False, "ft/03082001.html"),
        ("ft/03082001.html", ".xml", True, "ft/03082001.xml"),
        ("a.b/c", ".xml", True, "a.b/c.xml"),
        ("a/.hidden", ".xml", True, "a/.hidden.xml"),
        ("a/x.html.gz", ".xml", True, "a/x.xml"),
        (".gz", ".xml", True, ".gz.xml"),
        ("plain", None, True, "plain"),
        ("../x", ".xml", False, None),
        ("a/../../x", ".xml", False, None),
        ("/abs", ".xml", False, None),
        ("file:///etc/x", ".xml", False, None),
        ("", ".xml", False, ".xml"),
        ("a..b/c..d", ".xml", False, "a..b/c..d.xml"),
    ],
)
def test_output_path(spark, doc_id, extension, replace, want):
    path = naming.output_path(F.col("i"), empty_map(), naming.by_id, extension, replace)
    assert one(spark, path, i=doc_id) == want


def test_input_path(spark):
    path = naming.under("/data/", naming.with_extension(F.col("i"), ".html"))
    assert one(spark, path, i="ft/03082001") == "/data/ft/03082001.html"


@pytest.mark.parametrize(
    "position, url, pattern, want",
    [
        ("1", "http://example.com/file.html", "3/3", "000/001_example.com_file.html"),
        ("1", "http://example.org/file.html?param=value", "3/3", "000/001_example.org_file.html"),
        ("1234567", "x", "3/3", "1234/567_x"),
        ("1234567", "x", "2/2/2", "123/45/67_x"),
        ("5", "http://h/é/ü#frag", "3", "005_h_~_~"),
        ("junk", "a\\b:c", "3/3", "000/000_a_b_c"),
    ],
)
def test_archive_path(spark, position, url, pattern, want):
    attrs = F.create_map(F.lit("recordPosition"), F.col("p"))
    assert one(spark, naming.by_position(pattern)(F.col("u"), attrs), p=position, u=url) == want


def test_archive_path_without_position_or_url(spark):
    assert one(spark, naming.by_position()(F.col("u"), empty_map()), u="h/x") == "000/000_h_x"
    assert one(spark, naming.by_position()(F.col("u"), empty_map()), u="") == "000/000"


def test_bad_number_pattern():
    with pytest.raises(ValueError):
        naming.number_path(None, "3-3")


def test_chunk_name(spark):
    assert one(spark, naming.chunk_name(F.lit(3), extension=".json.gz")) == "part-003.json.gz"


# --- IDs -------------------------------------------------------------------

POST = {
    "date": "2023-05-30", "serial": 24, "id": 5, "nested": {"id": "n"}, "list": [1, {"x": "deep"}],
    "null": None, "yes": True, "num": 1.5, "a/b": 1, "m~n": 2, "}": 3, "|": 4, "0": "zero",
}


@pytest.mark.parametrize(
    "pointer, want",
    [
        ("/date", "2023-05-30"), ("/serial", "24"), ("/nested/id", "n"), ("/nested", None), ("/list", None),
        ("/list/0", "1"), ("/list/1/x", "deep"), ("/null", None), ("/yes", "true"), ("/num", "1.5"),
        ("/a~1b", "1"), ("/m~0n", "2"), ("/missing", None), ("/0", "zero"),
    ],
)
def test_pointer(spark, pointer, want):
    assert one(spark, ids.id_by_pointer(F.col("j"), pointer), j=json.dumps(POST)) == want


@pytest.mark.parametrize(
    "template, want",
    [
        ("{/date}_{/serial}", "2023-05-30_24"),
        ("c{/channel/id}_{/id}|g{/nested/id}_{/id}", "gn_5"),
        ("{/null}|{/nested}|{/list}", None),
        ("{/~2}-{/~3}", "3-4"),
        ("x{/yes}y", "xtruey"),
    ],
)
def test_template(spark, template, want):
    assert one(spark, ids.id_by_template(F.col("j"), template), j=json.dumps(POST)) == want


def test_template_needs_pointers():
    with pytest.raises(ValueError):
        ids.id_by_template(F.lit("x"), "{/id}|fixed")


def test_broken_json_has_no_id(spark):
    assert one(spark, ids.id_by_pointer(F.col("j"), "/a"), j='{"a":') is None


# --- globs -----------------------------------------------------------------


@pytest.mark.parametrize(
    "path, includes, excludes, defaults, want",
    [
        ("a/b/x.xml", "**/*.xml", None, None, True),
        ("x.xml", "**/*.xml", None, None, True),
        ("X.XML", "**/*.xml", None, None, False),
        ("x.xml", "**/*.xml,**/*.XML", "**/x.*", None, False),
        ("a/b/c", "a/", None, None, True),
        ("a/b/c", "a/**/c", None, None, True),
        ("a/c", "a/**/c", None, None, True),
        ("ab/c", "a/**", None, None, False),
        ("a/b", "*", None, None, False),
        ("abc", "a?c", None, None, True),
        ("a/c", "a?c", None, None, False),
        ("x~", None, None, None, False),
        ("x~", None, None, "off", True),
        ("x~", None, None, "no", True),
        ("a/.git/config", None, None, "yes", False),
        ("a.b+c", "a.b+c", None, None, True),
        ("aXb+c", "a.b+c", None, None, False),
        ("a/b/c.txt", "**/b/**", "**/*.tmp", None, True),
    ],
)
def test_globs(spark, path, includes, excludes, defaults, want):
    assert one(spark, globs.path_matches(F.col("p"), includes, excludes, defaults), p=path) is want


# --- rendering -------------------------------------------------------------

WILD = 'a "q" <&> \\ \n\té'


def test_json(make_annotated):
    anns = [
        ("", "T", 2, 5, {"k": 'v"\n', "indices": "no"}), ("", "T", 0, 1, {}), ("S", 'odd"type', 0, 1, {"n": None}),
    ]
    row = render.with_json(make_annotated({"a": (WILD, anns)}), type_property="type").first()
    assert json.loads(row["rendered"]) == {
        "text": WILD,
        "entities": {
            "T": [{"indices": [0, 1], "type": "T"}, {"indices": [2, 5], "k": 'v"\n', "type": "T"}],
            'odd"type': [{"indices": [0, 1], "n": None, "type": 'odd"type'}],
        },
    }


def test_json_plain_features(make_annotated):
    anns = [("", "T", 0, 1, {"n": "1.5e3", "t": "true", "q": "12", "x": "01", "z": None})]
    row = render.with_json(make_annotated({"a": ("x", anns)}), plain_features=["n", "t", "x", "z"]).first()
    assert json.loads(row["rendered"])["entities"]["T"] == [
        {"indices": [0, 1], "n": 1500.0, "t": True, "q": "12", "x": "01", "z": None}
    ]


def test_json_without_annotations(make_annotated):
    row = render.with_json(make_annotated({"a": ("}", [])}), by="set").first()
    assert json.loads(row["rendered"]) == {"text": "}", "entities": {}}


def test_utf16_offsets(make_annotated):
    df = make_annotated({"a": ("😀a😀 b", [("", "T", 1, 3, {}), ("", "T", 4, 5, {})])})
    got = json.loads(render.with_json(df).first()["rendered"])["entities"]["T"]
    assert [g["indices"] for g in got] == [[2, 5], [6, 7]]
    got = json.loads(render.with_json(df, offsets="codepoint").first()["rendered"])["entities"]["T"]
    assert [g["indices"] for g in got] == [[1, 3], [4, 5]]


def test_inline_nesting_and_crossing(make_annotated):
    anns = [
        ("", "Outer", 0, 9, {"b": '"<', "a": "1"}),
        ("", "Inner", 0, 4, {}),
        ("", "Crossing", 2, 6, {}),
        ("", "Empty", 9, 9, {}),
        ("", "Tail", 9, 10, {}),
    ]
    df = make_annotated({"a": ("ab<d efgh&", anns)})
    row = render.with_inline(df, include_features=True).first()
    assert row["rendered"] == (
        '<document><Outer a="1" b="&quot;&lt;"><Inner>ab&lt;d</Inner> efgh</Outer>'
        "<Tail><Empty></Empty>&amp;</Tail></document>"
    )
    assert row["crossing"] == 1
    plain = render.with_inline(df).first()["rendered"]
    assert "a=" not in plain


def test_xml_forms_parse_back(make_annotated):
    from xml.etree import ElementTree

    anns = [("S&", "T<", 0, 1, {"k": '"v"\n'}), ("", "U", 1, 2, {})]
    df = make_annotated({'id"1': (WILD + "\x01", anns)})
    tree = ElementTree.fromstring(render.with_standoff(df).first()["rendered"].encode())
    assert tree.get("id") == 'id"1'
    assert tree.findtext("text") == WILD + " "
    assert [(a.get("set"), a.get("type"), a.get("start")) for a in tree.iter("annotation")] == [
        ("", "U", "1"), ("S&", "T<", "0"),
    ]
    assert tree.find("annotation/feature").get("value") == '"v"\n'
    tree = ElementTree.fromstring(render.with_xces(df).first()["rendered"].encode())
    space = "{http://www.xces.org/schema/2003}"
    assert [(s.get("type"), s.get("from"), s.get("to")) for s in tree.iter(space + "struct")] == [
        ("T<", "0", "1"), ("U", "1", "2"),
    ]


def test_offsets_of_a_long_text_of_wide_characters(spark, make_annotated):
    """A megabyte of them with 50,000 annotations, in seconds; and all places against Python."""
    import time

    text = "\U0001f600a" * 200_000
    spans = [("", "T", 8 * i, 8 * i + 5, {}) for i in range(50_000 - 1)]
    df = make_annotated({"long": (text, spans)})
    began = time.monotonic()
    found = render.utf16_annotations(df).select("annotations").first()[0]
    assert time.monotonic() - began < 30
    wide = lambda o: o + (o + 1) // 2
    assert [(a.start, a.end) for a in found] == [(wide(s), wide(e)) for _, _, s, e, _ in spans]
    short = "x\U0001f600￿\U0010ffffé\U00010000z"
    every = [("", "T", i, j, {}) for i in range(len(short) + 1) for j in range(i, len(short) + 1)]
    units = lambda n: len(short[:n].encode("utf-16-le")) // 2
    got = render.utf16_annotations(make_annotated({"short": (short, every)})).first()["annotations"]
    assert [(a.start, a.end) for a in got] == [(units(s), units(e)) for _, _, s, e, _ in every]


def test_inline_names_are_names(spark, make_annotated):
    from xml.etree import ElementTree

    odd = ["ok", "two words", "1st", "a:b", "", "<x>", "é-ñ.1", "\U0001f600", "-", "a\"b"]
    spans = [("", t, i, i + 1, {t: "v<\"&\n", "k": None}) for i, t in enumerate(odd)]
    got = render.with_inline(make_annotated({"d": ("abcdefghij & more", spans)}), include_features=True).first()
    root = ElementTree.fromstring(got["rendered"])
    assert [e.tag for e in root] == ["ok", "two_words", "_1st", "a_b", "_", "_x_", "é-ñ.1", "_", "_-", "a_b"]
    assert "".join(root.itertext()) == "abcdefghij & more" and got["crossing"] == 0
    assert all(e.get("k") == "" and e.get(e.tag if e.tag != "k" else "k") == 'v<"&\n' for e in root)
