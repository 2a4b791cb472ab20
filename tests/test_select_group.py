from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from annoflow.functions.values import truthy, with_type_property
from annoflow.model import Selection
from annoflow.operators.group import annotation_counts, entities, merged
from annoflow.operators.select import (
    apply_window, explode_annotations, save_if, select_annotations, with_window,
)


@pytest.fixture
def found(make_annotated):
    return make_annotated(
        {
            "a": (
                "one two three",
                [
                    ("", "T", 4, 7, {"k": "v"}),
                    ("", "T", 0, 3, {}),
                    ("S", "T", 0, 3, {}),
                    ("S", "U", 0, 13, {"id": "7"}),
                ],
            ),
            "b": ("nothing", []),
            "c": ("w1 w2 w3", [("S", "U", 3, 5, {"id": "8"}), ("S", "U", 0, 2, {}), ("", "T", 3, 5, {})]),
        },
        features={"a": {"save": " TRUE "}, "b": {"save": "1"}},
    )


def kept(df):
    return {
        (r["doc_id"], r["set_name"], r["type"], r["start"]) for r in explode_annotations(df).collect()
    }


def test_selection(found):
    assert kept(select_annotations(found, [Selection(None, ["T"])])) == {
        ("a", "", "T", 4), ("a", "", "T", 0), ("c", "", "T", 3),
    }
    assert len(kept(select_annotations(found, []))) == 7
    # Two selections of one set add up.
    both = kept(select_annotations(found, [Selection("S", ["T"]), Selection("S", ["U"])]))
    assert both == {("a", "S", "T", 0), ("a", "S", "U", 0), ("c", "S", "U", 3), ("c", "S", "U", 0)}
    assert select_annotations(found, [Selection("none")]).count() == 3


def test_conditional_save(found):
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(save_if(found, "save")) == ["a"]
    assert ids(save_if(found, "  ")) == ["a", "b", "c"]
    assert ids(save_if(found, None)) == ["a", "b", "c"]
    assert ids(save_if(found, "other")) == []


def test_counts_have_zeros(found):
    keys = [Selection(""), Selection("S", ["U", "X"]), Selection("Y")]
    counts = {
        r["doc_id"]: r["c"]
        for r in found.select("doc_id", annotation_counts(F.col("annotations"), keys).alias("c")).collect()
    }
    assert counts["a"] == {"": 2, "S:U": 1, "S:X": 0, "Y": 0}
    assert counts["b"] == {"": 0, "S:U": 0, "S:X": 0, "Y": 0}
    assert found.select(annotation_counts(F.col("annotations"), []).alias("c")).first()["c"] == {}


def test_window(found):
    rows = {r["doc_id"]: r for r in apply_window(with_window(found, "U", "S")).collect()}
    assert rows["c"]["error"].endswith("has several U annotations, so no window")
    assert rows["b"]["text"] == "nothing" and rows["b"]["error"] is None
    assert rows["a"]["window"]["features"] == {"id": "7"}
    one = rows["a"]
    assert one["text"] == "one two three" and len(one["annotations"]) == 4


def test_window_moves_offsets(make_annotated):
    df = make_annotated({"a": ("aé😀 inner end", [("", "W", 4, 9, {}), ("", "T", 4, 9, {}), ("", "T", 3, 5, {})])})
    row = apply_window(with_window(df, "W")).first()
    assert row["text"] == "inner"
    assert [(a["type"], a["start"], a["end"]) for a in row["annotations"]] == [("W", 0, 5), ("T", 0, 5)]


def test_merged_is_without_copies(make_annotated):
    df = make_annotated({"a": ("abc", [("", "T", 0, 1, {"x": "1"}), ("S", "T", 0, 1, {"x": "1"})])})
    twice = df.withColumn("annotations", F.concat("annotations", "annotations"))
    rows = merged(twice).collect()
    assert sorted((r["ann_id"], r["features"]["x"]) for r in rows) == [(0, "1"), (1, "1")]


def test_type_property_replaces(spark):
    df = spark.createDataFrame([({"kind": "old", "a": "1"}, "New")], "f map<string,string>, t string")
    got = df.select(with_type_property(F.col("f"), F.col("t"), "kind").alias("f")).first()["f"]
    assert got == {"kind": "New", "a": "1"}


def test_truthy(spark):
    values = [("true", True), (" Yes\t", True), (" YES ", True), ("on", True), ("y", False), (None, False)]
    df = spark.createDataFrame([(v,) for v, _ in values], "v string")
    assert [r[0] for r in df.select(truthy(F.col("v"))).collect()] == [w for _, w in values]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["", "S", "Z"]), st.sampled_from("TUVW"), st.integers(0, 9), st.integers(0, 9)),
        max_size=25,
    )
)
def test_entities_match_brute_force(make_annotated, anns):
    anns = [(s, t, b, b + n, {}) for s, t, b, n in anns]
    df = make_annotated({"a": ("x" * 20, anns)})
    for by, label in (("type", lambda s, t: t), ("set", lambda s, t: s or "default")):
        want = defaultdict(list)
        for i, (s, t, b, e, _) in enumerate(anns):
            want[label(s, t)].append((b, e, i))
        got = {
            r["label"]: [(x["start"], x["end"], x["ann_id"]) for x in r["items"]]
            for r in entities(df, by).collect()
        }
        assert got == {k: sorted(v) for k, v in want.items()}
