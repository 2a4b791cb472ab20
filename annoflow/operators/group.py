"""Counting and grouping the annotations of each document."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from annoflow.fixed_values import DEFAULT_SET_LABEL
from annoflow.functions.values import bind, selected
from annoflow.model import Selection


def count_keys(selections: Sequence[Selection]) -> dict[str, Selection]:
    """One key per selection: ``set``, or ``set:type`` for each type wanted."""
    keys: dict[str, Selection] = {}
    for selection in selections:
        if not selection.types:
            keys[selection.set_key] = Selection(selection.set_key)
        for type_ in selection.types:
            keys[f"{selection.set_key}:{type_}"] = Selection(selection.set_key, (type_,))
    return keys


def annotation_counts(annotations: Column, selections: Sequence[Selection]) -> Column:
    """Map of count key to number of annotations, zeros included.

    Counted inside the row, so zeros need no join and no document is shuffled.
    """
    keys = count_keys(selections)
    if not keys:
        return F.create_map().cast("map<string,bigint>")
    pairs: list[Column] = []
    for key, one in keys.items():
        pairs += [F.lit(key), F.size(_covered(annotations, one)).cast("long")]
    return F.create_map(*pairs)


def _covered(annotations: Column, selection: Selection) -> Column:
    return F.filter(annotations, lambda a: selected(a["set_name"], a["type"], [selection]))


def label_of(by: str) -> Callable[[Column], Column]:
    """How entities are labelled: by ``type``, else by annotation set."""
    if by == "type":
        return lambda a: a["type"]
    return lambda a: F.when(a["set_name"] == "", F.lit(DEFAULT_SET_LABEL)).otherwise(a["set_name"])


def with_groups(
    annotated: DataFrame, by: str = "type", payload: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add ``groups``: array of (label, items), items in text order.

    Text order is start, end, then annotation number. ``payload`` maps an
    annotation to what an item carries (default: set, type and number). Each
    document is sorted once and cut where the label changes, so many labels
    cost no more than few.
    """
    label = label_of(by)
    if payload is None:
        payload = lambda a: F.struct(a["set_name"].alias("set_name"), a["type"].alias("type"))
    ordered = F.sort_array(
        F.transform(
            "annotations",
            lambda a: F.struct(
                label(a).alias("label"),
                a["start"].alias("start"),
                a["end"].alias("end"),
                a["ann_id"].alias("ann_id"),
                payload(a).alias("payload"),
            ),
        )
    )
    return annotated.withColumn("groups", bind(ordered, _cut_by_label))


def _cut_by_label(items: Column) -> Column:
    """Cut an array sorted by ``label`` into (label, items)."""
    places = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items))).otherwise(
        F.array().cast("array<int>")
    )
    label_at = lambda i: F.element_at(items, i)["label"]
    begins = F.filter(places, lambda i: (i == 1) | (label_at(i) != label_at(F.greatest(i - 1, F.lit(1)))))
    return bind(
        begins,
        lambda starts: F.transform(
            starts,
            lambda begin, i: F.struct(
                label_at(begin).alias("label"),
                F.slice(
                    items, begin, F.coalesce(F.get(starts, i + 1), F.size(items) + 1) - begin
                ).alias("items"),
            ),
        ),
    )


def entities(annotated: DataFrame, by: str = "type") -> DataFrame:
    """One row per document and label: ``label`` and ``items`` in text order."""
    grouped = with_groups(annotated, by)
    # The outer form: the plain one makes the optimizer add a filter that would
    # group every document a second time.
    return grouped.select("doc_id", F.inline_outer("groups")).filter("label is not null")


def merged(annotated: DataFrame) -> DataFrame:
    """All sets of a document as one collection, identical annotations once.

    Identical means same number, type, offsets and features. The result is the
    long form without ``set_name``.
    """
    ordered = F.sort_array(
        F.transform(
            "annotations",
            lambda a: F.struct(
                a["ann_id"].alias("ann_id"),
                a["type"].alias("type"),
                a["start"].alias("start"),
                a["end"].alias("end"),
                F.array_sort(F.map_entries(a["features"])).alias("features"),
            ),
        )
    )
    # Equal neighbours of a sorted array: array_distinct compares all pairs.
    once = bind(
        ordered,
        lambda items: F.filter(
            items, lambda a, i: (i == 0) | (a != F.element_at(items, F.greatest(i, F.lit(1))))
        ),
    )
    return (
        annotated.select("doc_id", F.inline_outer(once))
        .filter("ann_id is not null")
        .withColumn("features", F.map_from_entries("features"))
    )
