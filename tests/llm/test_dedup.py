"""Suffix, chunk, line and near-duplicate operators against brute force."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from annoflow.llm import chunk_dedup, line_dedup, near_dup, suffix_dedup
from annoflow.llm.components import components
from annoflow.llm.line_dedup import LINES_SQL, later_lines, without_lines


def prose(draw, n, words="the of and ing tion ent her ation was with from that blend stone river cloud"):
    return " ".join(draw.choice(words.split()) + draw.choice(["", "s", "ed", str(draw.randrange(999))]) for _ in range(n))


# --- suffix arrays --------------------------------------------------------------


def brute_repeats(texts, length=400):
    data = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        spans = []
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        gone = set().union(*(range(s, e) for s, e in spans))
        kept = bytes(c for i, c in enumerate(b) if i not in gone)
        out.append((len(b), len(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def repeated_texts():
    draw = random.Random(1)
    passage, other = prose(draw, 90), prose(draw, 150)
    texts = [None, "", "short", passage, passage, "x" * 399, "x" * 400, "ab" * 700, prose(draw, 400)]
    texts += [prose(draw, draw.randrange(80)) + passage + prose(draw, draw.randrange(80)) for _ in range(25)]
    texts += [other[: 600 + i] + "é" + other[600 + i :] for i in range(8)] + [other[3:-5]]
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_suffix_dedup(make_docs, repeated_texts, monkeypatch, small):
    if small:  # many blocks and shards, and an anchor spread over several
        monkeypatch.setattr(suffix_dedup, "BLOCK", 512)
        monkeypatch.setattr(suffix_dedup, "SHARD", 4096)
    rows = list(enumerate(repeated_texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_bytes(make_docs(rows)).collect()}
    assert got == dict(enumerate(brute_repeats(repeated_texts)))


def test_suffix_dedup_counts_repeated_rows(make_docs):
    draw = random.Random(2)
    text, other = prose(draw, 200), prose(draw, 90)
    rows = [(1, text), (1, text), (2, "x" + text[5:700]), (None, "abc"), (None, "abc"), (None, other), (None, other), (3, other[:399])]
    got = suffix_dedup.repeated_bytes(make_docs(rows)).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(brute_repeats([t for _, t in rows]))
    assert suffix_dedup.repeated_bytes(make_docs([])).count() == 0


def test_suffix_array_and_common_prefixes():
    draw = random.Random(3)
    for alphabet in (b"ab", b"abc\x00", b"a"):
        for _ in range(60):
            text = bytes(draw.choice(alphabet) for _ in range(draw.randrange(1, 80)))
            words = suffix_dedup.words_at(np.frombuffer(text, np.uint8))
            order = suffix_dedup.suffix_array(np.frombuffer(text, np.uint8), words)
            want = sorted(range(len(text)), key=lambda i: text[i:])
            assert order.tolist() == want
            shared = suffix_dedup.common_prefixes(words, order, 1000)
            for one, two in zip(want, want[1:]):
                n = 0
                while n < len(text) - max(one, two) and text[one + n] == text[two + n]:
                    n += 1
                assert shared[two] == n


# --- chunks ---------------------------------------------------------------------


def brute_chunks(rows):
    seen, out = {}, {}
    for doc_id, text in rows:
        data, at, later, lengths = (text or "").encode(), 0, {}, []
        for i, end in enumerate(chunk_dedup.chunk_ends(data)):
            chunk = data[at:end]
            if chunk in seen:
                later[i] = seen[chunk]
            else:
                seen[chunk] = doc_id
            lengths.append(end - at)
            at = end
        runs = chunk_dedup.later_runs(lengths, later)
        gone = set().union(*(range(b, e) for b, e, _ in runs))
        kept = bytes(c for i, c in enumerate(data) if i not in gone)
        out[doc_id] = (len(data), len(lengths), len(gone), len(runs), hashlib.sha256(kept).hexdigest(), sorted({d for *_, x in runs for d in x}))
    return out


def test_chunk_dedup(make_docs, repeated_texts):
    rows = list(enumerate(repeated_texts))
    got = chunk_dedup.chunk_dedup(make_docs(rows)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_chunks, r.n_removed, r.n_spans, r.kept_sha256, r.first_docs) for r in got} == brute_chunks(rows)
    assert chunk_dedup.chunk_dedup(make_docs([])).count() == 0


def test_chunks_resist_insertions():
    draw = random.Random(4)
    data = prose(draw, 3000).encode()
    shifted = data[:5000] + b"some more bytes" + data[5000:]

    def cut(x):
        ends = [0, *chunk_dedup.chunk_ends(x)]
        return [x[a:b] for a, b in zip(ends, ends[1:])]

    assert b"".join(cut(shifted)) == shifted
    assert all(len(c) <= chunk_dedup.LONGEST for c in cut(data))
    assert len(set(cut(shifted)) - set(cut(data))) <= 6


def test_gear_hash_rolls():
    data = prose(random.Random(5), 60).encode()
    hashes = chunk_dedup.gear_hashes(data)
    for i in range(16, len(data)):
        rolled = 0
        for byte in data[i - 15 : i + 1]:
            rolled = (rolled * 2 + int(chunk_dedup.GEAR[byte])) % 2**32
        assert hashes[i] == rolled


def test_passages_of_fifty_words_are_caught_and_clean_texts_left(make_docs):
    draw = random.Random(8)
    passage = prose(draw, 60)
    rows = [(i, prose(draw, 200) + " " + (passage + " " if i % 2 else "") + prose(draw, 100)) for i in range(20)]
    got = {r.doc_id: r for r in chunk_dedup.chunk_dedup(make_docs(rows)).collect()}
    assert all(got[i].n_removed == 0 for i in range(0, 20, 2))
    assert all(got[i].n_removed > 0 and got[i].first_docs == [1] for i in range(3, 20, 2))


def test_short_copies_and_single_chunks_go(make_docs):
    draw = random.Random(14)
    data = prose(draw, 300)
    ends = chunk_dedup.chunk_ends(data.encode())
    i = next(i for i, (a, b) in enumerate(zip(ends, ends[1:])) if i > 3 and b - a < 60)
    begin, end = ends[i], ends[i + 1]
    # both neighbours of the chunk are edited, before the bytes that its cuts depend on
    edited = data[: begin - 20] + "#" + data[begin - 19 : end + 18] + "#" + data[end + 19 :]
    rows = [(1, "a short text"), (2, "a short text"), (3, "a short text"), (4, data), (5, edited)]
    got = {r.doc_id: r for r in chunk_dedup.chunk_dedup(make_docs(rows)).collect()}
    assert [got[i].n_removed for i in (1, 2, 3, 4)] == [0, 12, 12, 0]
    assert (begin, end) in {(s.begin, s.end) for s in got[5].spans}
    kept = {r.doc_id: r for r in chunk_dedup.chunk_dedup(make_docs(rows), least_run=96).collect()}
    assert kept[2].n_removed == 0 and (begin, end) not in {(s.begin, s.end) for s in kept[5].spans}


# --- lines ----------------------------------------------------------------------


def brute_lines(rows):
    earlier, out = [], {}
    for doc_id, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            words = set(line.split())
            if not words or not any(5 * len(words & w) >= 4 * len(words | w) for w in earlier):
                kept.append(line)
            earlier.append(words)
        out[doc_id] = "\n".join(kept)
    return out


def test_line_dedup(make_docs):
    draw = random.Random(7)
    common = prose(draw, 30).split()
    lines = [" ".join(draw.sample(common, draw.randrange(1, 12))) for _ in range(60)]
    base = prose(draw, 40).split()
    near = [" ".join(base[:i] + ["new%d" % i] + base[i + draw.randrange(1, 9) :]) for i in range(30)]
    rows = [(i, "\n".join(draw.choice([*lines, *near, "", "  ", prose(draw, 9)]) for _ in range(draw.randrange(1, 9)))) for i in range(60)]
    rows += [(90, None), (91, ""), (92, "\n\n"), (93, "a"), (94, "a\ta  a"), (95, " ".join(base * 300))]
    docs = make_docs(rows)
    got = without_lines(docs, later_lines(docs), counts=True).collect()
    want = brute_lines(rows)
    assert {r.doc_id: r.text or "" for r in got} == want
    assert all(r.n_lines - r.n_removed == len(want[r.doc_id].split("\n")) or want[r.doc_id] == "" for r in got)


def test_line_dedup_of_nothing_and_of_repeated_rows(make_docs):
    assert later_lines(make_docs([])).count() == 0
    docs = make_docs([(1, "one two\nthree"), (1, "one two\nthree"), (None, "three")])
    got = without_lines(docs, later_lines(docs), counts=True).collect()
    assert {(r.key, r.num, r.a) for r in got} == {("key", "num", "a")}
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "three"), (1, "one two"), (1, "one two")]


def test_line_dedup_agrees_with_sql_on_odd_rows(spark, make_docs):
    draw = random.Random(21)
    line = lambda: " ".join(draw.sample("a b c d e f g h i j".split(), 6))
    text = lambda: "\n".join(line() for _ in range(5))
    one, two = text(), text()
    rows = [(3, one), (3, one), (3, two), (3, text()), (None, one), (None, text()), (None, None), (2, two), (5, ""), (5, None), (4, two + "\n" + one)]
    draw.shuffle(rows)
    for parts in (1, 4):
        docs = make_docs(rows).repartition(parts)
        kept = without_lines(docs, later_lines(docs), counts=True)
        got = Counter((r.doc_id, r.n_lines, r.n_removed, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect())
        con = duckdb.connect()
        con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
        assert got == Counter(con.sql(LINES_SQL).fetchall())


def test_prefixes_are_gone_when_candidates_are_sought(make_docs, monkeypatch):
    tables, real = {}, line_dedup.written

    def seen(df, name, *args, **kwargs):
        if name == "aimed-words":
            root = Path(next(iter(tables.values()))).parent
            there.extend(x for x in tables if (root / Path(tables[x]).name).exists())
        out = real(df, name, *args, **kwargs)
        if out.inputFiles():
            tables[name] = str(Path(out.inputFiles()[0].removeprefix("file://")).parent)
        return out

    there = []
    monkeypatch.setattr(line_dedup, "written", seen)
    draw = random.Random(22)
    words = prose(draw, 30).split()
    rows = [(i, "\n".join(" ".join(draw.sample(words, 10)) for _ in range(4))) for i in range(30)]
    later_lines(make_docs(rows)).count()
    assert "slim-lines" in there and "shared-words" in there
    assert not {"lines", "copied-lines", "rarity"} & set(there)


def test_words_and_pairs_of_lines_are_never_rows_of_a_table(make_docs, monkeypatch):
    rows_of, real = Counter(), line_dedup.written

    def seen(df, name, *args, **kwargs):
        out = real(df, name, *args, **kwargs)
        rows_of[name] = max(rows_of[name], out.count())
        return out

    draw = random.Random(23)
    words = ["w%d" % i for i in range(60)]
    # lists of hundreds of lines of all lengths under each word, few of them alike
    lines = [draw.sample(words, draw.randrange(6, 40)) for _ in range(300)]
    lines += [[*line[1:], "new%d" % i] for i, line in enumerate(lines[:40])]
    rows = [(i, "\n".join(map(" ".join, lines[i::40]))) for i in range(40)]
    docs = make_docs(rows)
    monkeypatch.setattr(line_dedup, "written", seen)
    monkeypatch.setattr(line_dedup, "SHARE_WORDS", 300, raising=False)
    got = without_lines(docs, later_lines(docs)).collect()
    assert {r.doc_id: r.text or "" for r in got} == brute_lines(rows)
    assert max(n for name, n in rows_of.items() if name != "rarity") <= len(lines)


# --- near duplicates --------------------------------------------------------------


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment():
    draw = random.Random(9)
    pairs = []
    for _ in range(200):
        a = [draw.choice("abcdefgh") for _ in range(draw.randrange(40))]
        b = [x for x in a if draw.random() > 0.1] + [draw.choice("xyz")] * draw.randrange(6)
        pairs.append((a, b))
    for _ in range(200):
        a = ["w%d" % draw.randrange(60) for _ in range(draw.randrange(60))]
        b = [x if draw.random() > 0.2 else "v%d" % draw.randrange(9) for x in a if draw.random() > 0.05]
        at = draw.randrange(len(b) + 1)
        pairs.append((a, draw.choice([b, b[at:] + b[:at], b[:at] + ["new"] + b[at:]])))
    hashes = [[near_dup.word_hashes(" ".join(x)) for x in side] for side in zip(*pairs)]
    want = [word_edits(a, b) for a, b in pairs]
    for band in (2, 9, 50):
        found = near_dup.edits_within(*hashes, band)
        assert all(f == w for f, w in zip(found, want) if min(f, w) <= band)
    for x, y, w in zip(*hashes, want):
        assert near_dup.edits_at_least(x, y) <= w <= near_dup.edits_at_most(x, y)
    assert near_dup.similar(*hashes, 0.8) == [w <= near_dup.allowed(len(a), len(b), 0.8) for w, (a, b) in zip(want, pairs)]


def test_near_classes(make_docs):
    draw = random.Random(10)
    texts = []
    for _ in range(12):
        words = prose(draw, draw.randrange(60, 160)).split()
        texts.append(" ".join(words))
        for _ in range(draw.randrange(4)):
            copy = list(words)
            for _ in range(len(copy) // 25):
                copy[draw.randrange(len(copy))] = "changed%d" % draw.randrange(99)
            texts.append(" ".join(copy))
    passage = prose(draw, 30)
    texts += [passage + " " + prose(draw, 20) for _ in range(15)] + [texts[0], texts[0], None, "", "", "  ", "one", "one"]
    rows = [(i + 5, t) for i, t in enumerate(texts)]
    draw.shuffle(rows)
    parent = {i: i for i, _ in rows}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, a in rows:
        for j, b in rows:
            if i < j:
                x, y = (a or "").split(), (b or "").split()
                same = (a or "") == (b or "") if not x or not y else word_edits(x, y) <= near_dup.allowed(len(x), len(y), 0.8)
                if same:
                    parent[max(root(i), root(j))] = min(root(i), root(j))
    got = near_dup.near_classes(make_docs(rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: root(i) for i, _ in rows}
    assert sorted(r.doc_id for r in got if r.kept) == sorted({root(i) for i, _ in rows})
    assert all(r.class_size == sum(x.class_id == r.class_id for x in got) for r in got)


def test_order_counts():
    words = near_dup.word_hashes(" ".join("w%d" % i for i in range(60)))
    turned = np.concatenate([words[30:], words[:30]])
    one, two = (near_dup.shingle_hashes(w) for w in (words, turned))
    keys = [set(near_dup.sketches(s, near_dup.labelled(s), near_dup.SEEDS, 2).tolist()) for s in (one, two)]
    # nearly all shingles are common to both, but pairs from both halves stand in the other order
    assert len(set(one.tolist()) & set(two.tolist())) == 52
    assert len(keys[0] & keys[1]) < 0.75 * near_dup.SKETCHES


def edited(draw, words, places):
    copy = list(words)
    for i in places:
        copy[i] = "other%d" % draw.randrange(10**9)
    return " ".join(copy)


def unlike(draw, n):
    return ["w%d" % draw.randrange(10**9) for _ in range(n)]


def test_near_classes_of_one_text_with_many_copies(make_docs):
    draw = random.Random(12)
    base, n = unlike(draw, 200), 300
    rows = [(i, edited(draw, base, draw.sample(range(200), draw.randrange(20, 31)))) for i in range(n)]
    rows[n // 2] = (n // 2, " ".join(base))
    passage = unlike(draw, 60)
    rows += [(n + i, " ".join(passage + unlike(draw, 40))) for i in range(40)]
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(make_docs(rows)).collect()}
    assert got == {i: 0 if i < n else i for i in range(n + 40)}


def test_unlike_texts_with_a_common_passage_are_told_apart_before_they_are_paired(make_docs, monkeypatch):
    rows, real = [], near_dup.written

    def counted(df, name, *args, **kwargs):
        out = real(df, name, *args, **kwargs)
        if name == "pairs":
            rows.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "written", counted)
    draw = random.Random(16)
    passage = unlike(draw, 60)
    texts = [" ".join(passage + unlike(draw, 240)) for _ in range(40)]
    # few different words, each many times over
    texts += [" ".join(passage + [w for w in unlike(draw, 20) for _ in range(draw.randrange(11, 14))]) for _ in range(40)]
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(make_docs(list(enumerate(texts)))).collect()}
    assert got == {i: i for i in range(80)}
    assert len(rows) > 3 and sum(rows[1:]) < 40


def test_bits_bound_the_edits():
    draw = random.Random(17)
    for _ in range(200):
        a = [draw.choice("abcdefgh") for _ in range(draw.randrange(60))]
        b = [draw.choice([x, x, x, x, "y"]) for x in a if draw.random() > 0.1] + ["z"] * draw.randrange(4)
        for longs in (near_dup.PARITY, near_dup.FINE):
            one, two = (near_dup.parity_bits(near_dup.labelled(near_dup.word_hashes(" ".join(x))), longs) for x in (a, b))
            apart = sum(int(x).bit_count() for x in (one ^ two).view(np.uint64))
            assert apart + abs(len(a) - len(b)) <= 2 * word_edits(a, b)


def test_near_classes_at_the_limit(make_docs):
    draw = random.Random(13)
    rows = []
    for n in (5, 6, 7, 8, 9, 10, 12, 20, 24, 30, 31, 60, 100, 101, 300):
        for share in (0.1, 0.15, 0.2):
            words, edits = unlike(draw, n), int(share * n + 1e-9) or 1
            rows += [" ".join(words), edited(draw, words, draw.sample(range(n), edits))]
        words = unlike(draw, n)
        rows += [" ".join(words), edited(draw, words, range(2, n, 5))]
        words = unlike(draw, n)
        rows += [" ".join(words), " ".join(w for i, w in enumerate(words) if i % 5 != 2 or i + 3 > n)]
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(make_docs(list(enumerate(rows)))).collect()}
    want = {i: i - i % 2 if word_edits(rows[i - i % 2].split(), rows[i - i % 2 + 1].split()) <= near_dup.allowed(len(rows[i - i % 2].split()), len(rows[i - i % 2 + 1].split()), 0.8) else i for i in range(len(rows))}
    assert got == want
    assert sum(want[i] == i for i in want) < 0.6 * len(want)


def test_near_classes_of_nothing_and_of_repeated_rows(make_docs):
    assert near_dup.near_classes(make_docs([])).count() == 0
    got = near_dup.near_classes(make_docs([(3, "same text here"), (3, "same text here"), (None, "same text here")])).collect()
    assert [r.class_id for r in got] == [3, 3, 3]
    assert sum(r.kept for r in got) == 1


def test_components(spark):
    draw = random.Random(11)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101 + i) for i in range(40)] + [(200, 200)]
    draw.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 141)}
