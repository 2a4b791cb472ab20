"""Token counts: lengths only, from batches balanced by bytes.

Long texts are cut at safe boundaries, where no token can go over the cut, so
the counts of the parts add up to the count of the whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from annoflow.llm.common import id_and_text, map_batches

SPACE = "▁"
#: Characters sent to the library at once.
BATCH_CHARS = 1 << 18
#: Known lengths of short parts kept in a Python worker before it starts afresh.
CACHE_ENTRIES = 400_000


class PieceLengths:
    """Lengths by a SentencePiece model.

    No piece of a supported model has a space after another character, and the
    library puts one space in front of each text. So the words between spaces,
    each with further spaces that stand before it, can be encoded one by one.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        joined = any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.safe = not joined and self.model.encode("  a b", out_type=str) == [SPACE * 2, SPACE + "a", SPACE + "b"]

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.safe:
            return [text]
        words = text.replace(SPACE, " ").split(" ")
        if "" not in words:
            return words
        parts, spaces = [], 0
        for word in words[:-1]:
            if word:
                parts.append(" " * spaces + word)
                spaces = 0
            else:
                spaces += 1
        return [*parts, " " * spaces + words[-1]]

    def lengths(self, parts: list[str]) -> list[int]:
        # an empty part is a lone space at the end of a text
        found = self.model.encode([p or " " for p in parts], num_threads=1)
        return [len(ids) if p else len(self.model.encode("a ")) - len(self.model.encode("a")) for p, ids in zip(parts, found)]


class JsonLengths:
    """Lengths by a tokenizer file.

    The supported pre-tokenizers never join white space to what stands before
    it; special strings hold no white space. Cuts are made there, unless a
    special string takes white space around it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        added = self.model.get_added_tokens_decoder().values()
        self.safe = not any(t.lstrip or t.rstrip or re.search(r"\s", t.content) for t in added)

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.safe:
            return [text]
        parts, start = [], 0
        while len(text) - start > BATCH_CHARS:
            at = next((m.start() + 1 for m in re.compile(r"\S[ \n]").finditer(text, start + BATCH_CHARS)), None)
            if at is None:
                break
            parts.append(text[start:at])
            start = at
        return [*parts, text[start:]]

    def lengths(self, parts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch_fast(parts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def lengths_of(path: str) -> PieceLengths | JsonLengths:
    return JsonLengths(path) if path.endswith(".json") else PieceLengths(path)


def count_batch(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text. Parts whose length is not known yet go to the library
    in runs of about ``BATCH_CHARS`` characters."""
    model = lengths_of(path)
    known: dict[str, int] = _caches.setdefault(path, {})
    totals = [0] * len(texts)
    waiting: dict[str, dict[int, int]] = {}
    size = 0

    def settle() -> None:
        nonlocal size
        parts = list(waiting)
        for part, n in zip(parts, model.lengths(parts)):
            for row, times in waiting[part].items():
                totals[row] += n * times
            if len(part) <= 64:
                known[part] = n
        waiting.clear()
        size = 0
        if len(known) > CACHE_ENTRIES:
            known.clear()

    for row, text in enumerate(texts):
        total = 0
        for part in model.parts(text):
            n = known.get(part)
            if n is not None:
                total += n
                continue
            rows = waiting.get(part)
            if rows is None:
                rows = waiting[part] = {}
                size += len(part)
            rows[row] = rows.get(row, 0) + 1
            if size >= BATCH_CHARS:
                settle()
        totals[row] += total
    if waiting:
        settle()
    return totals


_caches: dict[str, dict[str, int]] = {}


def token_counts(
    docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text.

    Null and empty texts have 0 of both. Repeated rows are counted as often as
    they come. No special tokens are added, nothing is cut off or padded; special
    strings inside a text are what the library takes them for. Other columns are
    not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        counts = count_batch(path, texts)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array([n > limit for n in counts], pa.bool_()),
            ],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    rows = id_and_text(docs, id_col, text_col)
    key = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {key}, n_bytes long, n_tokens long, over_limit boolean")
