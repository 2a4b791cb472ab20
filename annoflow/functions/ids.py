"""Document IDs: taken from JSON, rendered, compared.

Pointers and templates are compiled on the driver into Column expressions over
a parsed variant, so each JSON object is parsed once in the JVM.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import functions as F
from pyspark.sql.column import Column

from annoflow.functions.values import bind


def _steps(pointer: str) -> list[str]:
    if pointer == "":
        return []
    if not pointer.startswith("/"):
        raise ValueError(f"a JSON pointer starts with '/': {pointer!r}")
    return [s.replace("~1", "/").replace("~0", "~") for s in pointer[1:].split("/")]


def _paths(pointer: str) -> list[str]:
    """The variant paths a pointer may mean: a numeric step is a key or an index."""
    choices = []
    for step in _steps(pointer):
        quote = "'" if "'" not in step else '"'
        if quote in step:
            raise ValueError(f"a key with both quote characters cannot be addressed: {step!r}")
        ways = [f"[{quote}{step}{quote}]"]
        if re.fullmatch(r"0|[1-9]\d*", step):
            ways.append(f"[{step}]")
        choices.append(ways)
    return ["$" + "".join(path) for path in product(*choices)]


def pointer_value(variant: Column, pointer: str, json: Column | None = None) -> Column:
    """The scalar at a JSON Pointer as text; null for anything else.

    Absent, JSON null, objects and arrays all give null. With ``json``, the text that
    ``variant`` was parsed from, a number that is not whole in its text keeps
    its point: 10.0 is another ID than 10.
    """
    found = []
    for path in _paths(pointer):
        node = F.try_variant_get(variant, path, "variant")
        kind = F.schema_of_variant(node)
        scalar = ~(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        text = F.try_variant_get(variant, path, "string")
        if json is not None and '"' not in path:
            written = F.trim(F.get_json_object(json, path), F.lit('"'))
            text = F.when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.coalesce(written, text)).otherwise(text)
        found.append(F.when(scalar, text))
    return F.coalesce(*found)


def id_by_pointer(json: Column, pointer: str) -> Column:
    """ID at a pointer. Null or empty means the object is not a document."""
    return bind(F.try_parse_json(json), lambda variant: id_from_pointer(variant, json, pointer))


def id_from_pointer(variant: Column, json: Column, pointer: str) -> Column:
    """``id_by_pointer`` of JSON that is parsed already."""
    return pointer_value(variant, pointer, json)


def id_by_template(json: Column, template: str) -> Column:
    """ID from a template such as ``c{/channel/id}_{/id}|g{/group/id}_{/id}``.

    The leftmost alternative whose pointers all resolve to scalars wins; null if
    none does. Inside braces ``~2`` stands for ``}`` and ``~3`` for ``|``.
    """
    return bind(F.try_parse_json(json), lambda variant: id_from_template(variant, json, template))


def id_from_template(variant: Column, json: Column, template: str) -> Column:
    """``id_by_template`` of JSON that is parsed already."""
    compiled: list[list[tuple[str, bool]]] = []
    for alternative in template.rstrip("|").split("|"):
        pieces = re.split(r"\{([^}]+)\}", alternative)
        if len(pieces) < 3:
            raise ValueError("every alternative of an ID template needs a pointer")
        compiled.append(
            [
                (piece.replace("~3", "|").replace("~2", "}") if i % 2 else piece, bool(i % 2))
                for i, piece in enumerate(pieces)
                if piece
            ]
        )

    return F.coalesce(
        *(
            F.concat(*(pointer_value(variant, piece, json) if is_pointer else F.lit(piece) for piece, is_pointer in parts))
            for parts in compiled
        )
    )


def is_document(doc_id: Column) -> Column:
    """Whether a stream object has an ID at all."""
    return doc_id.isNotNull() & (doc_id != "")


def sorted_attrs(id_attrs: Column) -> Column:
    return F.array_sort(F.map_entries(F.coalesce(id_attrs, F.create_map().cast("map<string,string>"))))


def id_text(doc_id: Column, id_attrs: Column) -> Column:
    """An ID as text: plain, or an element carrying its attributes in key order."""
    attributes = F.array_join(
        F.transform(
            sorted_attrs(id_attrs),
            lambda e: F.concat(F.lit(" "), e["key"], F.lit('="'), e["value"], F.lit('"')),
        ),
        "",
    )
    return F.when(
        F.size(sorted_attrs(id_attrs)) > 0,
        F.concat(F.lit("<id"), attributes, F.lit(">"), doc_id, F.lit("</id>")),
    ).otherwise(doc_id)


def same_id(left_id: Column, left_attrs: Column, right_id: Column, right_attrs: Column) -> Column:
    """Equality over text and attributes, the order of attributes aside."""
    return (left_id == right_id) & (sorted_attrs(left_attrs) == sorted_attrs(right_attrs))
