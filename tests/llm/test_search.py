"""Decontamination, licences, nearest vectors, quality and the pipeline."""

import random
import zlib

import numpy as np
import pytest

from annoflow.llm import decontaminate, graph_search, licenses, quality
from annoflow.llm.common import with_key

SF = "/root/testdata/sf0.001"


def plain_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if ord(c) >= 128 or c.isascii() and c.isalnum():
            word += c.lower() if c.isascii() else c
        elif word:
            out.append(word)
            word = ""
    return out


def brute_contamination(docs, items):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item)
    out = {}
    for doc_id, text in docs:
        words = plain_words(text)
        hit, found = set(), set()
        for window, ids in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= ids
        out[doc_id] = (len(words), len(hit), len(found))
    return out


@pytest.fixture(scope="module")
def suspects():
    draw = random.Random(1)
    names = "the of and to in Zug Éclair don't 42 a river".split()
    items = [(i, " ".join(draw.choice(names) for _ in range(draw.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(25)]
    items += [(50, None), (51, items[3][1]), (52, "?!")]
    docs = []
    for i in range(60):
        parts = [draw.choice(names) for _ in range(draw.randrange(40))]
        if i % 2:
            parts += (draw.choice(items)[1] or "").upper().split() * draw.randrange(1, 3)
        docs.append((i, ", ".join(parts)))
    return docs + [(90, None), (91, ""), (92, "the " * 5000)], items


def test_contamination(spark, make_docs, suspects):
    docs, items = suspects
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS key", "2 AS words")
    got = decontaminate.contamination(make_docs(docs), table).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got} == brute_contamination(docs, items)
    assert all(r.contaminated == (r.n_hit > 0) for r in got)


def test_contamination_of_and_by_nothing(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(make_docs([(1, "a b"), (1, "a b"), (None, None)]), none).collect()
    assert sorted((r.n_words, r.n_hit, r.n_items) for r in got) == [(0, 0, 0), (2, 0, 0), (2, 0, 0)]
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(make_docs([]), items).count() == 0


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity(spark, make_docs, slop):
    draw = random.Random(2)
    docs = [(i, " ".join(draw.choice("abcdefg") for _ in range(40))) for i in range(30)]
    items = [(0, "a b c"), (1, "d"), (2, "g g e b")]
    phrases = decontaminate.item_windows(spark.createDataFrame(items, "item_id long, text string"))
    keyed = with_key(make_docs(docs).select("doc_id", "text"))
    keyed = keyed.withColumn("words", decontaminate.words_of(keyed.text))
    index = decontaminate.build_index(keyed.select("key", "words"), phrases.windows)
    near = decontaminate.proximity_matches(index, phrases.windows, slop)
    exact = decontaminate.phrase_matches(index, phrases.windows)
    names = {bytes(r.key): r.doc_id for r in keyed.select("key", "doc_id").collect()}
    items_of = {bytes(r.wid): r.item_id for r in phrases.items.collect()}
    got = {(names[bytes(r.key)], items_of[bytes(r.wid)], r.place) for r in near.collect()}
    times = {}
    for _, text in docs:
        for w in text.split():
            times[w] = times.get(w, 0) + 1
    want = set()
    for doc_id, text in docs:
        words = text.split()
        for item, phrase in items:
            parts = phrase.split()
            rare = min(range(len(parts)), key=lambda o: (times.get(parts[o], 0), o))
            for p, w in enumerate(words):
                place = p - rare
                if w == parts[rare] and all(
                    any(words[q] == part and abs(q - o - place) <= slop for q in range(len(words))) for o, part in enumerate(parts) if o != rare
                ):
                    want.add((doc_id, item, place))
    assert got == want
    if slop == 0:
        assert {(names[bytes(r.key)], items_of[bytes(r.wid)], r.start) for r in exact.collect()} == {x for x in want if x[2] >= 0}


def test_licenses(spark):
    rows = [
        (1, "LICENSE", "Licensed under the Apache License, Version 2.0."),
        (2, "a/x.py", "code\n# This work is licensed under the GNU General Public License, version 3.\nmore"),
        (3, "a/y.py", "nothing of the kind"),
        (4, "a/b/COPYING.txt", "Released under the MIT License."),
        (5, "a/b/c/z.py", None),
        (6, "a/bb/z.py", ""),
        (7, None, "the of and under this"),
        (8, "a/b/LICENSE", "Licensed under CC BY-NC 4.0.\n" + "and so on " * 400),
        (6, "a/bb/z.py", ""),
    ]
    files = spark.createDataFrame(rows, "file long, path string, text string").selectExpr("*", "1 AS license", "2 AS words", "3 AS part")
    got = {(r.file, r.license, r.origin, r.license_path) for r in licenses.license_scan(files).collect()}
    assert got == {
        (1, "Apache-2.0", "own", "LICENSE"), (2, "GPL-3.0", "own", "a/x.py"), (3, "Apache-2.0", "inherited", "LICENSE"),
        (4, "MIT", "own", "a/b/COPYING.txt"), (5, "CC-BY-NC-4.0", "inherited", "a/b/LICENSE"), (6, "Apache-2.0", "inherited", "LICENSE"),
        (7, "Apache-2.0", "inherited", "LICENSE"), (8, "CC-BY-NC-4.0", "own", "a/b/LICENSE"),
    }
    assert licenses.license_scan(files).count() == len(rows)
    assert licenses.license_scan(files.limit(0)).count() == 0


def test_license_bodies_and_wrapped_headers(spark):
    texts = {n: open(f"{licenses.__file__.rsplit('/', 1)[0]}/license_texts/{n}.txt").read() for n in ("LGPL-3.0", "GPL-3.0", "GPL-2.0", "BSD-3-Clause", "BSD-2-Clause", "MIT", "ISC", "Apache-2.0")}
    header = """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() { return 0; }
"""
    rows = [(i, f"{n}/LICENSE", "Copyright (c) 2019 Some One\n\n" + t) for i, (n, t) in enumerate(texts.items())]
    rows += [(50, "x/m.c", header), (51, "x/n.c", "int licensed(int permission) { return permission; }"), (52, "MIT/a.py", "code")]
    got = {r.file: (r.license, r.origin) for r in licenses.license_scan(spark.createDataFrame(rows, "file long, path string, text string")).collect()}
    want = {i: (n, "own") for i, n in enumerate(texts)}
    assert got == want | {50: ("GPL-3.0", "own"), 51: (None, None), 52: ("MIT", "inherited")}


def test_licenses_go_by_row(spark):
    mit, cc = "Released under the MIT License.", "Licensed under CC BY-NC 4.0."
    rows = [(None, "a/x.py", mit), (None, "a/x.py", "nothing"), (1, "b/y.py", mit), (1, "b/y.py", cc), (1, "b/y.py", cc)]
    got = licenses.license_scan(spark.createDataFrame(rows, "file long, path string, text string")).collect()
    assert sorted((r.path, str(r.license)) for r in got) == [
        ("a/x.py", "MIT"), ("a/x.py", "None"), ("b/y.py", "CC-BY-NC-4.0"), ("b/y.py", "CC-BY-NC-4.0"), ("b/y.py", "MIT"),
    ]


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(30, 24))
    return (centres[draw.integers(0, 30, 3000)] + draw.normal(size=(3000, 24)) * 0.6).astype(np.float32)


def brute_nearest(points, ids, query, k):
    far = np.sqrt(((points.astype(float) - points[query].astype(float)) ** 2).sum(1))
    far[query] = np.inf
    return [(int(ids[i]), far[i]) for i in np.lexsort((ids, far))[:k] if np.isfinite(far[i])]


def test_nearest(spark, vectors):
    points = vectors.copy()
    points[500:900] = points[7]  # a large group of equal vectors
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    odd = [(5000, None), (5100, []), (5200, [0.0] * 24), (5300, [float("nan")] * 24), (5400, [None] + [1.0] * 23), (5500, [float("inf")] * 24), (None, rows[0][1])]
    table = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS point")
    got = graph_search.nearest(table, lambda i: i % 100 == 0, k=10, shard_points=700).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids = np.arange(len(points))
    hits = 0
    assert set(found) == set(range(0, 3000, 100))
    for query, near in found.items():
        near.sort()
        want = brute_nearest(points, ids, query, 10)
        assert [n[0] for n in near] == list(range(1, 11))
        hits += len({n[1] for n in near} & {w[0] for w in want})
        if 500 <= query < 900:
            assert [n[1] for n in near] == [w[0] for w in want]
    assert hits / (10 * len(found)) >= 0.9


def test_nearest_of_few(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r.rank, r.vec_id) for r in graph_search.nearest(few, lambda i: i % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 1)]
    assert graph_search.nearest(few.limit(0), lambda i: i % 100 == 0).count() == 0


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.score(docs, quality.train(docs, labels)).join(labels.drop("toxic"), "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.97
    assert rows[rows.quality == 1].predicted.mean() > 0.98
    assert rows.score.between(0, 1).all()


def test_held_out_rows_teach_nothing(spark, make_docs):
    rows = [(i, "good words, plainly said. " * 9 if i % 2 else "BUY!! NOW!! " * 9) for i in range(300)]
    labels = [(i, i % 2, None) for i in range(300)]
    docs = make_docs(rows)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, t) for i, y, t in labels]
    trees = [quality.train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped)]
    scores = [{r.doc_id: (r.score, r.held_out) for r in quality.score(docs, t).collect()} for t in trees]
    assert scores[0] == scores[1]
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, (_, h) in scores[0].items())
    assert all((s >= 0.3) == (i % 2 == 1) for i, (s, _) in scores[0].items())


def test_quality_without_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = make_docs([(1, None), (2, ""), (2, ""), (None, "x")])
    got = quality.score(docs, quality.train(docs, none)).collect()
    assert [r.score for r in got] == [0.5] * 4
    assert quality.score(make_docs([]), quality.train(make_docs([]), none)).count() == 0


def test_trees_walk_as_written():
    draw = np.random.default_rng(4)
    rows = draw.normal(size=(800, len(quality.FEATURES))).astype(np.float32)
    labels = ((rows[:, 3] > 0.2) ^ (rows[:, 7] > 0)).astype(float)
    trees = quality.fit(rows, labels, rounds=20)

    def one(row):
        total = trees.base
        for at in trees.roots:
            while trees.child[at] != at:
                at = trees.child[at] + (row[trees.feature[at]] > trees.cut[at])
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.scores(rows), [one(r) for r in rows])
    assert ((trees.scores(rows) > 0.5) == labels).mean() > 0.9
