"""Small value rules shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import functions as F
from pyspark.sql.column import Column

from annoflow.fixed_values import TRUE_WORDS
from annoflow.model import Selection


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    A column used inside a lambda may be inlined by the optimizer and computed
    again for every array element; a lambda variable never is.
    """
    return F.transform(F.array(value), use)[0]


def truthy(value: Column) -> Column:
    """Whether text means true: a true word, ignoring case and outer white space and control characters."""
    inner = F.regexp_replace(value, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return F.coalesce(F.lower(inner).isin(*TRUE_WORDS), F.lit(False))


def selected(set_name: Column, type_: Column, selections: Sequence[Selection]) -> Column:
    """Predicate for the annotations some selection covers.

    No selections means everything. Several selections of one set add up.
    """
    if not selections:
        return F.lit(True)
    covered = F.lit(False)
    for selection in selections:
        wanted = set_name == F.lit(selection.set_key)
        if selection.types:
            wanted &= type_.isin(*selection.types)
        covered |= wanted
    return covered


def with_type_property(features: Column, type_: Column, name: str | None) -> Column:
    """Add the annotation type to its features under ``name``."""
    if not name:
        return features
    others = F.map_filter(features, lambda key, _: key != F.lit(name))
    return F.map_concat(others, F.create_map(F.lit(name), type_))
