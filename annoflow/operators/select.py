"""Which documents and annotations reach an output.

All of these work on the nested form, inside the row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from annoflow.functions.values import bind, selected, truthy
from annoflow.model import Selection, empty_map


def explode_annotations(annotated: DataFrame, *carry: str) -> DataFrame:
    """Long form: one row per annotation, with ``doc_id`` and ``carry`` columns."""
    return annotated.select(
        "doc_id", *carry, F.inline("annotations")
    )


def selected_annotations(annotations: Column, selections: Sequence[Selection]) -> Column:
    if not selections:
        return annotations
    return F.filter(annotations, lambda a: selected(a["set_name"], a["type"], selections))


def select_annotations(annotated: DataFrame, selections: Sequence[Selection]) -> DataFrame:
    """Keep only the selected annotations; documents stay, even left with none."""
    return annotated.withColumn(
        "annotations", selected_annotations(F.col("annotations"), selections)
    )


def condition(features: Column, feature_name: str | None) -> Column:
    """Whether an output conditional on a feature takes a document."""
    name = (feature_name or "").strip()
    return truthy(features[name]) if name else F.lit(True)


def save_if(annotated: DataFrame, feature_name: str | None) -> DataFrame:
    return annotated.filter(condition(F.col("features"), feature_name))


def with_window(
    annotated: DataFrame, window_type: str | None, set_name: str | None = ""
) -> DataFrame:
    """Add ``window`` (start, end, features) and fail documents with two or more.

    The window is the one annotation of ``window_type`` in ``set_name``; without
    it the window is the whole text and has no features.
    """
    whole = F.struct(
        F.lit(0).cast("long").alias("start"),
        F.length("text").cast("long").alias("end"),
        empty_map().alias("features"),
    )
    if not window_type:
        return annotated.withColumn("window", whole)
    found = F.filter(
        "annotations",
        lambda a: (a["set_name"] == F.lit(set_name or "")) & (a["type"] == F.lit(window_type)),
    )
    conflict = F.concat(
        F.lit("document "), F.col("doc_id"), F.lit(f" has several {window_type} annotations, so no window")
    )
    one = lambda windows: F.when(
        F.size(windows) > 0,
        F.struct(
            windows[0]["start"].alias("start"),
            windows[0]["end"].alias("end"),
            windows[0]["features"].alias("features"),
        ),
    )
    return annotated.withColumns(
        {
            "window": F.coalesce(bind(found, one), whole),
            "error": F.coalesce("error", F.when(F.size(found) > 1, conflict)),
        }
    )


def inside_window(annotations: Column, window: Column) -> Column:
    """The annotations that lie within the window."""
    return bind(
        window,
        lambda w: F.filter(
            annotations, lambda a: (a["start"] >= w["start"]) & (a["end"] <= w["end"])
        ),
    )


def window_text(text: Column, window: Column) -> Column:
    return F.substring(
        text, (window["start"] + 1).cast("int"), (window["end"] - window["start"]).cast("int")
    )


def apply_window(annotated: DataFrame) -> DataFrame:
    """Cut text and annotations down to ``window``, offsets relative to it."""
    window = F.col("window")
    moved = bind(
        window["start"],
        lambda origin: F.transform(
            inside_window(F.col("annotations"), window),
            lambda a: a.withField("start", a["start"] - origin).withField("end", a["end"] - origin),
        ),
    )
    return annotated.withColumns(
        {"annotations": moved, "text": window_text(F.col("text"), window)}
    )
