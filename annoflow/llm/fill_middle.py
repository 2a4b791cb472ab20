"""Fill-in-the-middle documents: a text is cut in three and put together in another order.

Where the cuts fall depends on how many units a text has: runs of letters, and each other character
alone. Texts are cut into chunks where a hash of the bytes before says so; the chunks of a passage are the
same wherever it stands. What a chunk adds is told by a summary: its units, its code points, and
whether it begins and ends within a run of letters. Summaries are kept by content, so
a chunk that many documents share is counted once by a task. Added up, they say which chunk
holds a cut, and only that chunk is looked into.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from annoflow.llm.common import id_and_text, map_batches
from annoflow.llm.hashing import prefix_sums, window_hashes

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes hashed for a cut, and the least, usual and most bytes of a chunk.
WINDOW, LEAST, USUAL, MOST = 24, 256, 1024, 8192
#: Bytes of chunks whose summaries a task keeps before it starts afresh.
CACHE_BYTES = 64 << 20
#: Of a hundred documents with marks to set: those left as they are, and of the others those with the suffix first.
PLAIN_FROM, SUFFIX_FIRST = 90, 20

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


class Summary(NamedTuple):
    """What a chunk adds: units, code points, whether its first and last byte are letters."""

    units: int
    points: int
    opens: bool
    closes: bool


def chunk_bounds(data: bytes) -> list[int]:
    """Where the chunks of a text in UTF-8 end; no code point is cut."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    hashes = window_hashes(prefix_sums(raw), WINDOW)
    cuts = (np.flatnonzero(hashes & np.uint64(USUAL - 1) == 0) + WINDOW).tolist()
    ends, at, i = [], 0, 0
    while n - at > LEAST:
        while i < len(cuts) and cuts[i] < at + LEAST:
            i += 1
        end = min(cuts[i] if i < len(cuts) else n, at + MOST, n)
        while end < n and raw[end] & 0xC0 == 0x80:
            end += 1
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


def unit_starts(data: bytes) -> np.ndarray:
    """Places of the bytes that begin a unit, if the bytes before are no letter."""
    raw = np.frombuffer(data, np.uint8)
    letter = _LETTERS[raw]
    follows = np.concatenate([[False], letter[:-1]])
    return np.flatnonzero((raw & 0xC0 != 0x80) & ~(letter & follows))


def summary(data: bytes) -> Summary:
    raw = np.frombuffer(data, np.uint8)
    points = int(np.count_nonzero(raw & 0xC0 != 0x80))
    return Summary(len(unit_starts(data)), points, bool(_LETTERS[raw[0]]), bool(_LETTERS[raw[-1]]))


class Summaries:
    """Summaries by the content of the chunk, as many as ``most`` bytes of chunks give."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.size, self.known = most, 0, {}

    def of(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            if self.size + len(chunk) > self.most:
                self.known.clear()
                self.size = 0
            found = self.known[chunk] = summary(chunk)
            self.size += len(chunk)
        return found


class Counted(NamedTuple):
    """A text by its chunks: where each begins, and the units and code points before it."""

    data: bytes
    begins: list[int]
    units: list[int]
    points: list[int]
    joined: list[bool]

    def place(self, unit: int) -> tuple[int, int]:
        """The byte and the code point after the first ``unit`` units."""
        if unit == self.units[-1]:
            return len(self.data), self.points[-1]
        i = int(np.searchsorted(self.units, unit, "right")) - 1
        chunk = self.data[self.begins[i] : self.begins[i + 1]]
        starts = unit_starts(chunk)
        if self.joined[i]:
            starts = starts[1:]
        at = int(starts[unit - self.units[i]])
        before = np.frombuffer(chunk, np.uint8, at)
        return self.begins[i] + at, self.points[i] + int(np.count_nonzero(before & 0xC0 != 0x80))


def counted(data: bytes, summaries: Summaries) -> Counted:
    begins, units, points, joined = [0], [0], [0], []
    closes = False
    for end in chunk_bounds(data):
        one = summaries.of(data[begins[-1] : end])
        # a run of letters that goes over a chunk's edge is one unit
        joins = closes and one.opens
        joined.append(joins)
        units.append(units[-1] + one.units - joins)
        points.append(points[-1] + one.points)
        begins.append(end)
        closes = one.closes
    return Counted(data, begins, units, points, joined)


def draws(doc_id) -> list[int]:
    """Four numbers below 2^32 that depend on the ID alone."""
    found = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(found[i : i + 4]) for i in range(0, 16, 4)]


def transformed(doc_id, text: str, summaries: Summaries) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the new text of a document."""
    cuts = counted(text.encode(), summaries)
    n = cuts.units[-1]
    h1, h2, h3, h4 = draws(doc_id)
    if not text or h3 % 100 >= PLAIN_FROM or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    (_, a), (_, b) = (cuts.place(unit) for unit in sorted((h1 % (n + 1), h2 % (n + 1))))
    before, middle, after = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, SUFFIX + after + PREFIX + before + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + before + SUFFIX + after + MIDDLE + middle


_SUMMARIES = Summaries()  # of this Python worker


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points) and output of every text.

    The form is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``: the
    text as it is, with null for both lengths. Null and empty texts are plain and stay empty; so are texts that hold a mark.
    A document without ID draws as if its ID were empty; rows that repeat an ID draw alike. No rows: no
    result. Other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [transformed(i, text, _SUMMARIES) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        n, form, before, middle, output = zip(*rows) if rows else ([],) * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = ["n", "form", "prefix_chars", "middle_chars", "output"]
        columns = [pa.array(values, kind) for values, kind in zip((n, form, before, middle, output), kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    rows = id_and_text(docs, id_col, text_col)
    key = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {key}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column) -> Column:
    """The text a document was before: no part of it holds a mark, so the first of each kind is the one set."""

    def after(text: Column, skipped: Column | int) -> Column:
        return F.substr(text, F.lit(1) + skipped)

    def parts(first: str, second: str, third: str) -> list[Column]:
        body = after(output, len(first))
        one = F.substring_index(body, second, 1)
        rest = after(body, F.length(one) + len(second))
        two = F.substring_index(rest, third, 1)
        return [one, two, after(rest, F.length(two) + len(third))]

    psm, spm = parts(PREFIX, SUFFIX, MIDDLE), parts(SUFFIX, PREFIX, MIDDLE)
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )


FILL_SQL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM units),
cut AS (
  SELECT doc_id, text, n,
         array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
         array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
         array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
