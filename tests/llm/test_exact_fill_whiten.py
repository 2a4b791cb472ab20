"""Exact duplicates, fill-in-the-middle and whitening against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoflow.llm import exact_dedup, fill_middle, whitening
from annoflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- exact duplicates -----------------------------------------------------------


@pytest.mark.parametrize("region_bits", [0, 3, 9])
def test_filters_keep_and_merge_all(region_bits):
    draw = np.random.default_rng(1)
    both = []
    for size in (1, 5, 400):
        parts = []
        for _ in range(3):
            prints = np.unique(draw.integers(0, 1 << 12, size, dtype=np.uint64) * np.uint64(0x10003) & np.uint64((1 << (64 - region_bits)) - 1))
            counts = draw.choice([1, 1, 1, 2, 300, 1 << 40], len(prints))
            region = 5 if region_bits else 0
            prints = np.unique(prints | np.uint64(region) << np.uint64(64 - region_bits) if region_bits else prints)
            got = exact_dedup.unpack_filter(exact_dedup.pack_filter(prints, counts[: len(prints)], region_bits), region, region_bits)
            assert got[0].tolist() == prints.tolist() and got[1].tolist() == counts[: len(prints)].tolist()
            parts.append(got)
        total = Counter()
        for prints, counts in parts:
            for p, c in zip(prints.tolist(), counts.tolist()):
                total[p] += c
        prints, counts = exact_dedup.merged(parts)
        assert dict(zip(prints.tolist(), counts.tolist())) == total and prints.tolist() == sorted(total)
        both.append(len(total))
    assert both[-1] > 400


def brute_exact(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for plain, members in groups.items():
        first = min(members)
        for m in members:
            out.append((rows[m[3]][0], rows[first[3]][0], len(members), m == first, hashlib.sha256(plain.encode()).hexdigest()))
    return out


EXACT_ROWS = [
    (1, "a b"), (2, "ab "), (3, "a\tb\n"), (4, None), (5, ""), (6, " \x0b\x0c\r"), (7, "a b"), (8, "ab" * 50_000), (9, "ab" * 50_000),
    (None, "a  b  "), (None, "lone"), (11, "same"), (11, "same"), (12, "sa me"), (13, "é"), (14, "é"), *((100 + i, "hot") for i in range(40)),
]


def test_exact_classes(make_docs, monkeypatch):
    got = lambda: Counter(map(tuple, exact_dedup.exact_classes(make_docs(EXACT_ROWS)).collect()))
    want = Counter(brute_exact(EXACT_ROWS))
    assert got() == want
    # hot groups, and lists too long to be sent
    monkeypatch.setattr(exact_dedup, "GROUP_ROWS", 2)
    monkeypatch.setattr(exact_dedup, "HOT_GROUPS", 1000)
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", 1)
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", 7)
    monkeypatch.setattr(exact_dedup, "REGION_ROWS", 3)
    assert got() == want


def test_bytes_decide_where_digests_do_not(make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "fingerprint", lambda plain: F.xxhash64(F.substring(plain, 1, 1)))
    monkeypatch.setattr(exact_dedup, "digest", lambda plain: F.substring(plain, 1, 1).cast("binary"))
    got = exact_dedup.exact_classes(make_docs(EXACT_ROWS)).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(r[:4] for r in brute_exact(EXACT_ROWS))


def test_exact_classes_of_nothing(make_docs):
    assert exact_dedup.exact_classes(make_docs([])).collect() == []


# --- fill-in-the-middle ---------------------------------------------------------


def brute_fill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def fill_rows():
    draw = random.Random(3)
    word = lambda: draw.choice(["river", "Éclair", "x" * 300, "日本語", "a1b2", "\U0001f600", "<P", "S>", "<", "\n\n", "the"])
    passage = " ".join(word() for _ in range(600))
    rows = [(i, " ".join(word() for _ in range(draw.randrange(60)))) for i in range(150)]
    rows += [(200 + i, " ".join(word() for _ in range(i)) + passage + word()) for i in range(40)]
    rows += [(300, None), (301, ""), (302, "<P>"), (303, "a"), (304, "z" * 100_000), (305, "é" * 30_000), (None, "no id"), (306, passage * 40), (306, passage)]
    return rows


def test_fill_in_middle(make_docs, fill_rows):
    done = fill_middle.fill_in_middle(make_docs(fill_rows)).withColumn("before", fill_middle.restored(F.col("form"), F.col("output")))
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.before) for r in done.collect())
    assert got == Counter((i, *brute_fill(i, t), t or "") for i, t in fill_rows)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(make_docs([])).collect() == []


def test_chunks_of_a_passage_are_counted_once():
    draw = random.Random(4)
    passage = " ".join(str(draw.randrange(10**6)) + "word" for _ in range(4000))
    one, two = passage.encode(), ("something else before " + passage).encode()
    summaries = fill_middle.Summaries()
    whole = fill_middle.counted(one, summaries)
    assert whole.units[-1] == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", passage)) and whole.points[-1] == len(passage)
    before = len(summaries.known)
    fill_middle.counted(two, summaries)
    assert before > 20 and len(summaries.known) - before <= 3
    small = fill_middle.Summaries(5000)
    assert fill_middle.counted(one, small).units == whole.units and small.size <= 5000 + fill_middle.MOST


def test_every_place_is_found():
    draw = random.Random(6)
    text = "".join(draw.choice(["ab", "é", "z" * 700, " ", "\U0001f600", "q"]) for _ in range(400))
    cuts = fill_middle.counted(text.encode(), fill_middle.Summaries())
    ends = [0]
    for unit in re.findall(r"[A-Za-z]+|[^A-Za-z]", text):
        ends.append(ends[-1] + len(unit))
    assert [cuts.place(i)[1] for i in range(cuts.units[-1] + 1)] == ends
    assert [cuts.place(i)[0] for i in range(cuts.units[-1] + 1)] == [len(text[:e].encode()) for e in ends]


# --- whitening ------------------------------------------------------------------


def brute_whitening(rows):
    keep = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    whole = [[int(np.floor(np.float64(c) * 256)) for c in v] for _, v in keep]
    fit = sorted(set(map(tuple, whole)))
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    centred = np.array([[(n * x[d] - sums[d]) / n for d in range(dims)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    out = []
    for (i, _), x in zip(keep, whole):
        apart = np.array([(n * x[d] - sums[d]) / n for d in range(dims)])
        out.append((i, n, sum((n * x[d] - sums[d]) ** 2 for d in range(dims)), apart @ vectors / np.sqrt(values)))
    return out, values / np.trace(covariance)


def assert_whitened(df, rows):
    want, shares = brute_whitening(rows)
    got = df.toPandas()
    assert len(got) == len(want) * len(shares) and set(got.n) == {want[0][1]}
    assert Counter(zip(got.vec_id.fillna(-1), got.component, got.deviation)) == Counter(
        (-1 if i is None else i, c + 1, d) for i, _, d, _ in want for c in range(len(shares))
    )
    for c, share in enumerate(shares, 1):
        of = got[got.component == c]
        assert np.allclose(of.explained, share, rtol=1e-9)
        # deviations tell rows that share an ID apart
        found = {(i, d): w for i, d, w in zip(of.vec_id.fillna(-1), of.deviation, of.whitened)}
        pairs = [(found[-1 if i is None else i, d], w[c - 1]) for i, _, d, w in want]
        signed, values = (np.array(x) for x in zip(*pairs))
        assert np.allclose(signed, values, atol=1e-7) or np.allclose(signed, -values, atol=1e-7)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-6


def test_bit_planes_count_products():
    draw = np.random.default_rng(5)
    for rows in (draw.integers(-200, 200, (130, 5)), draw.integers(-3, 2, (1, 3)), draw.integers(-(1 << 62), 1 << 62, (70, 4)), np.zeros((9, 2), np.int64)):
        sums, products = whitening.cross_products(rows)
        exact = rows.astype(object)
        assert sums == exact.sum(0).tolist()
        assert [products[i][j - i] for i in range(rows.shape[1]) for j in range(i, rows.shape[1])] == [
            (exact[:, i] * exact[:, j]).sum() for i in range(rows.shape[1]) for j in range(i, rows.shape[1])
        ]


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 100)
    draw = np.random.default_rng(8)
    spread = np.array([3.0, 1.0, 0.5, 0.2, 0.1, 0.05])
    rows = [(i, (draw.normal(size=6) * spread).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)] + [(5, rows[7][1]), (None, rows[9][1])]
    odd = [(2000, None), (2001, []), (2002, [1.0, None] + [0.0] * 4), (2003, [float("nan")] * 6), (2004, [float("inf")] + [0.0] * 5), (2005, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit(c) for c in ("x", "i", "n", "component")})
    assert_whitened(whitening.whitened(df), rows)


def test_whitening_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert_whitened(QUERIES["op11_whitening"](spark, SF), rows)


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([(1, None)], schema)).collect() == []
    one = whitening.whitened(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    ]
    huge = whitening.whitened(spark.createDataFrame([(1, [3e38, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 0.0])], schema)).collect()
    assert {r.deviation for r in huge} == {None} and {r.n for r in huge} == {2}
    assert all((r.whitened is None) == (r.component == 2) for r in huge)
