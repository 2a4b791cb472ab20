"""Documents as text: JSON, standoff XML, inline XML, XCES, plain.

Each form is one string column over an annotated row. All but inline XML are
Column expressions; inline XML walks annotations and text together, which
Spark's substring would turn into a scan of the text per annotation, so it runs
in ``mapInArrow``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.column import Column

from annoflow.fixed_values import (
    XCES_ANNOTATION,
    XCES_FEATURE,
    XCES_NAMESPACE,
    XCES_ROOT,
    XCES_VERSION,
)
from annoflow.functions.values import bind
from annoflow.operators.annotate import small_parts
from annoflow.operators.group import with_groups

# Characters XML 1.0 cannot hold are written as spaces.
_NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"
_PAST_BMP = r"[\x{10000}-\x{10FFFF}]"


# --- offsets ---------------------------------------------------------------


def utf16_annotations(annotated: DataFrame) -> DataFrame:
    """Count annotation offsets in UTF-16 units instead of code points.

    They differ only after a character past U+FFFF, so documents without one
    keep their annotations untouched. The places of those characters are found once; how many stand
    before an offset is found by bisection, so a text costs its length and each offset a few steps.
    """
    wide = F.filter(
        F.transform(F.split("text", ""), lambda c, i: F.when(c >= F.lit("\U00010000"), i)),
        lambda i: i.isNotNull(),
    )

    def shifted(places: Column) -> Column:
        # halving steps, from the largest power of two that the places reach
        steps = F.filter(F.array(*(F.lit(1 << k) for k in range(30, -1, -1))), lambda s: s <= F.size(places))

        def before(offset: Column, halves: Column) -> Column:
            def step(found, s):
                ahead = found + s
                return F.when((ahead <= F.size(places)) & (F.element_at(places, F.least(ahead, F.size(places))) < offset), ahead).otherwise(found)

            return F.aggregate(halves, F.lit(0), step)

        def moved(halves: Column) -> Column:
            later = lambda offset: offset + before(offset, halves)
            return F.transform(
                "annotations", lambda a: a.withField("start", later(a["start"])).withField("end", later(a["end"]))
            )

        return bind(steps, moved)

    return annotated.withColumn(
        "annotations",
        F.when(F.col("text").rlike(_PAST_BMP), bind(wide, shifted)).otherwise(F.col("annotations")),
    )


# --- JSON ------------------------------------------------------------------


def _json_string(value: Column) -> Column:
    """A JSON string; only text that needs escapes goes through the JSON writer."""
    listed = F.to_json(F.array(value))
    return F.when(
        value.rlike(r'["\\\x00-\x1F\x7F]'), F.substring(listed, F.lit(2), F.length(listed) - 2)
    ).otherwise(F.concat(F.lit('"'), value, F.lit('"')))


# A JSON number, true or false.
_JSON_SCALAR = r"^(?:-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false)$"


def _json_members(features: Column, reserved: Sequence[str], plain: Sequence[str]) -> Column:
    """The features as JSON object members, each led by a comma.

    Values are strings, but those of ``plain`` features go unquoted where they
    read as numbers or truth values.
    """
    kept = F.map_filter(features, lambda key, _: ~key.isin(*reserved))
    if plain:
        one = lambda e: F.concat(
            F.lit(","),
            _json_string(e["key"]),
            F.lit(":"),
            F.when(e["value"].isNull(), F.lit("null"))
            .when(e["key"].isin(*plain) & e["value"].rlike(_JSON_SCALAR), e["value"])
            .otherwise(_json_string(e["value"])),
        )
        led = F.array_join(F.transform(F.map_entries(kept), one), "")
    else:
        inner = F.btrim(F.to_json(kept, {"ignoreNullFields": "false"}), F.lit("{}"))
        led = F.regexp_replace(inner, "^(?=.)", ",")
    return F.when(F.cardinality(features) > 0, led).otherwise(F.lit(""))


def json_entity(
    annotation: Column, type_property: str | None = None, plain_features: Sequence[str] = ()
) -> Column:
    reserved = ["indices"]
    typed: list[Column] = []
    if type_property:
        reserved.append(type_property)
        name = json.dumps(type_property, ensure_ascii=False)
        typed = [F.lit(f",{name}:"), _json_string(annotation["type"])]
    return F.concat(
        F.lit('{"indices":['),
        annotation["start"].cast("string"),
        F.lit(","),
        annotation["end"].cast("string"),
        F.lit("]"),
        _json_members(annotation["features"], reserved, plain_features),
        *typed,
        F.lit("}"),
    )


def with_json(
    annotated: DataFrame,
    *,
    by: str = "type",
    type_property: str | None = None,
    plain_features: Sequence[str] = (),
    offsets: str = "utf16",
) -> DataFrame:
    """Add ``rendered``: ``text``, ``entities`` by label, and window features.

    Labels are in order and so are the entities of each. If the row has a
    ``window`` column, text and annotations must already be cut to it; its
    features become top-level members beside ``text`` and ``entities``. Values of
    ``plain_features`` that read as numbers or truth values go unquoted.
    """
    counted = utf16_annotations(annotated) if offsets == "utf16" else annotated
    grouped = with_groups(counted, by, lambda a: json_entity(a, type_property, plain_features))
    groups = F.transform(
        "groups",
        lambda g: F.concat(
            _json_string(g["label"]),
            F.lit(":["),
            F.array_join(F.transform(g["items"], lambda x: x["payload"]), ","),
            F.lit("]"),
        ),
    )
    extra = (
        _json_members(F.col("window.features"), ("text", "entities"), plain_features)
        if "window" in annotated.columns
        else F.lit("")
    )
    rendered = F.concat(
        F.rtrim(F.to_json(F.struct("text")), F.lit("}")),
        F.lit(',"entities":{'),
        F.array_join(groups, ","),
        F.lit("}"),
        extra,
        F.lit("}"),
    )
    return grouped.withColumn("rendered", rendered).drop("groups")


# --- XML -------------------------------------------------------------------


def xml_text(value: Column) -> Column:
    clean = F.regexp_replace(value, _NOT_XML, " ")
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        clean = F.replace(clean, F.lit(plain), F.lit(entity))
    return clean


# Attribute values with none of these, most of them, need no escaping.
_XML_SPECIAL = r'[&<>"\x00-\x1F\uFFFE\uFFFF]'


def xml_attribute(value: Column) -> Column:
    clean = xml_text(value)
    for plain, entity in (('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        clean = F.replace(clean, F.lit(plain), F.lit(entity))
    return F.when(value.rlike(_XML_SPECIAL), clean).otherwise(value)


def _features_xml(entries: Column, tag: str) -> Column:
    """Feature entries (key, value) as elements in key order."""
    each = F.transform(
        F.array_sort(entries),
        lambda e: F.concat(
            F.lit(f'<{tag} name="'),
            xml_attribute(e["key"]),
            F.lit('" value="'),
            F.coalesce(xml_attribute(e["value"]), F.lit("")),
            F.lit('"/>'),
        ),
    )
    return F.when(F.size(entries) > 0, F.array_join(each, "")).otherwise(F.lit(""))


def _ordered(annotations: Column) -> Column:
    """Annotations as sortable structs: set, start, end, number, type, entries."""
    return F.sort_array(
        F.transform(
            annotations,
            lambda a: F.struct(
                a["set_name"].alias("set_name"),
                a["start"].alias("start"),
                a["end"].alias("end"),
                a["ann_id"].alias("ann_id"),
                a["type"].alias("type"),
                F.map_entries(a["features"]).alias("features"),
            ),
        )
    )


def with_standoff(annotated: DataFrame, *, offsets: str = "utf16") -> DataFrame:
    """Add ``rendered``: features, text, then every annotation with its offsets."""
    counted = utf16_annotations(annotated) if offsets == "utf16" else annotated
    one = lambda a: F.concat(
        F.lit('<annotation set="'),
        xml_attribute(a["set_name"]),
        F.lit('" id="'),
        a["ann_id"].cast("string"),
        F.lit('" type="'),
        xml_attribute(a["type"]),
        F.lit('" start="'),
        a["start"].cast("string"),
        F.lit('" end="'),
        a["end"].cast("string"),
        F.lit('">'),
        _features_xml(a["features"], "feature"),
        F.lit("</annotation>\n"),
    )
    rendered = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<document id="'),
        xml_attribute(F.col("doc_id")),
        F.lit('">\n<features>'),
        _features_xml(F.map_entries("features"), "feature"),
        F.lit("</features>\n<text>"),
        F.replace(xml_text(F.col("text")), F.lit("\r"), F.lit("&#13;")),
        F.lit("</text>\n"),
        F.array_join(F.transform(_ordered(F.col("annotations")), one), ""),
        F.lit("</document>\n"),
    )
    return counted.withColumn("rendered", rendered)


def with_xces(annotated: DataFrame, *, offsets: str = "utf16") -> DataFrame:
    """Add ``rendered``: XCES structs of all annotations in text order."""
    counted = utf16_annotations(annotated) if offsets == "utf16" else annotated
    in_order = F.sort_array(
        F.transform(
            "annotations",
            lambda a: F.struct(
                a["start"].alias("start"),
                a["end"].alias("end"),
                a["ann_id"].alias("ann_id"),
                a["type"].alias("type"),
                F.map_entries(a["features"]).alias("features"),
            ),
        )
    )
    one = lambda a: F.concat(
        F.lit(f'<{XCES_ANNOTATION} type="'),
        xml_attribute(a["type"]),
        F.lit('" from="'),
        a["start"].cast("string"),
        F.lit('" to="'),
        a["end"].cast("string"),
        F.lit('">'),
        _features_xml(a["features"], XCES_FEATURE),
        F.lit(f"</{XCES_ANNOTATION}>\n"),
    )
    rendered = F.concat(
        F.lit(
            '<?xml version="1.0" encoding="UTF-8"?>\n'
            f'<{XCES_ROOT} version="{XCES_VERSION}" xmlns="{XCES_NAMESPACE}">\n'
        ),
        F.array_join(F.transform(in_order, one), ""),
        F.lit(f"</{XCES_ROOT}>\n"),
    )
    return counted.withColumn("rendered", rendered)


def with_plain(annotated: DataFrame) -> DataFrame:
    return annotated.withColumn("rendered", F.col("text"))


def with_inline(annotated: DataFrame, *, include_features: bool = False) -> DataFrame:
    """Add ``rendered``, the text with annotations as tags, and ``crossing``.

    Tags must nest. Annotations are taken by start, longer first, then number;
    one that would end after an enclosing one is left out and counted in
    ``crossing``. ``text`` and ``annotations`` do not come back from Python.
    """
    used = ["text", "annotations"]
    kept = [f for f in annotated.schema.fields if f.name not in used]
    schema = T.StructType(
        kept + [T.StructField("rendered", T.StringType()), T.StructField("crossing", T.LongType())]
    )
    names = [f.name for f in kept]
    fields = ["start", "end", "ann_id", "type", *(["features"] if include_features else [])]
    slim = F.transform("annotations", lambda a: F.struct(*(a[n].alias(n) for n in fields)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in small_parts(whole)):
            done = list(_inline_batch(batch, include_features))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array([d[0] for d in done], pa.string()),
                    pa.array([d[1] for d in done], pa.int64()),
                ],
                names=[*names, "rendered", "crossing"],
            )

    return annotated.withColumn("annotations", slim).mapInArrow(run, schema)


_SPECIAL = re.compile("[&<>\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
_XML_SPACES = {c: " " for c in [*range(9), 11, 12, *range(14, 32), 0xFFFE, 0xFFFF]}
_XML_TEXT = {ord("&"): "&amp;", ord("<"): "&lt;", ord(">"): "&gt;", **_XML_SPACES}
_XML_ATTRIBUTE = {ord('"'): "&quot;", 10: "&#10;", 13: "&#13;", 9: "&#9;", **_XML_TEXT}


# What a name in XML 1.0 may begin with, and what else it may hold. Colons would claim a namespace.
_NAME_START = "A-Z_a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02ff\u0370-\u037d\u037f-\u1fff\u200c\u200d\u2070-\u218f\u2c00-\u2fef\u3001-\ud7ff\uf900-\ufdcf\ufdf0-\ufffd"
_NAME_OTHER = "-.0-9\u00b7\u0300-\u036f\u203f\u2040"
_NOT_IN_NAME = re.compile(f"[^{_NAME_START}{_NAME_OTHER}]")
_NO_START = re.compile(f"^(?![{_NAME_START}])")


@lru_cache(maxsize=10_000)
def _xml_name(name: str) -> str:
    """A name that XML takes: other characters are written as underscores, and one more leads what may not begin a name."""
    return _NO_START.sub("_", _NOT_IN_NAME.sub("_", name))


def _attributes(features: list) -> str:
    """Features as attributes, in order of their names; of names that come out equal the first counts."""
    named: dict[str, str] = {}
    for key, value in sorted(features):
        named.setdefault(_xml_name(key), (value or "").translate(_XML_ATTRIBUTE))
    return "".join(f' {k}="{v}"' for k, v in named.items())


def _inline_batch(batch: pa.RecordBatch, with_features: bool) -> Iterator[tuple[str, int]]:
    column = batch.column("annotations")
    bounds = np.asarray(column.offsets)
    items = column.values.slice(bounds[0], bounds[-1] - bounds[0])
    bounds = (bounds - bounds[0]).tolist()
    start, end, number = (pc.struct_field(items, n).to_numpy() for n in ("start", "end", "ann_id"))
    types = pc.struct_field(items, "type").to_pylist()
    features = pc.struct_field(items, "features").to_pylist() if with_features else None
    for i, text in enumerate(batch.column("text").to_pylist()):
        rows = slice(bounds[i], bounds[i + 1])
        order = bounds[i] + np.lexsort((number[rows], -end[rows], start[rows]))
        spans = zip(start[order].tolist(), end[order].tolist(), order.tolist())
        yield _inline(text or "", spans, types, features)


def _inline(text: str, spans, types: list[str], features: list | None) -> tuple[str, int]:
    out = ["<document>"]
    open_tags: list[tuple[int, str]] = []
    at = crossing = 0
    special = _SPECIAL.search(text) is not None

    def text_until(end: int) -> None:
        nonlocal at
        if end > at:
            piece = text[at:end]
            out.append(piece.translate(_XML_TEXT) if special else piece)
            at = end

    def close_until(offset: int) -> None:
        while open_tags and open_tags[-1][0] <= offset:
            end, name = open_tags.pop()
            text_until(end)
            out.append(f"</{name}>")

    for start, end, row in spans:
        close_until(start)
        if open_tags and open_tags[-1][0] < end:
            crossing += 1
            continue
        text_until(start)
        name = _xml_name(types[row])
        if features and features[row]:
            out.append(f"<{name}{_attributes(features[row])}>")
        else:
            out.append(f"<{name}>")
        open_tags.append((end, name))
    close_until(len(text))
    text_until(len(text))
    out.append("</document>")
    return "".join(out), crossing


# --- index URI -------------------------------------------------------------


def index_uri(
    doc_id: Column, features: Column, uri_feature: str | None = None, namespace: str = ""
) -> Column:
    """The URI a document is indexed under: a feature if one is named (null where
    missing), else the namespace and the document's ID."""
    if uri_feature:
        return features[uri_feature]
    return F.concat(F.lit(namespace), doc_id)
