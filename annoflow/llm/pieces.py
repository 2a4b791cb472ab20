"""Merge-type SentencePiece encoding by backtracking, and decoding.

A sequence of pieces is the one that merging arrives at exactly when every two
neighbours, merged again by themselves, stay as they are. So a text is encoded
without merging it whole: at each position take the longest piece that an
Aho-Corasick automaton found there; keep it if it goes with the piece before;
else try the next shorter one; if none is left, the position has failed for
good (one bit) and the piece before it is taken back.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from math import inf

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from annoflow.llm.common import id_and_text, map_batches

#: What stands for a space inside pieces.
SPACE = "▁"
#: What the decoder puts for an unknown piece: fixed value of the format.
UNKNOWN_SURFACE = " ⁇ "
#: Entries kept in each cache of a Python worker before it starts afresh.
CACHE_ENTRIES = 200_000


class PieceCoder:
    """Encoder and decoder for one model file with byte fallback."""

    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.unknown = model.unk_id()
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte_id: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.silent: set[int] = set()
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.byte_of[i] = i, value
            elif model.is_control(i) or model.is_unused(i):
                self.silent.add(i)
            elif i != self.unknown:
                self.id_of[piece] = i
                self.score[piece] = model.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("pieces that go on over a space are not supported")
        if model.encode("a  b", out_type=str)[0] != SPACE + "a" or model.decode(model.encode(" a")) != " a":
            raise ValueError("only models that keep spaces and put one in front are supported")
        self.letters = {c for p in self.id_of for c in p}
        known = re.escape("".join(sorted(self.letters)))
        self.stretches = re.compile(f"([{known}]+)")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self.automaton.add_word(piece, (i, len(piece) - 1))
        self.automaton.make_automaton()
        self.length = [len(p) for p in self.pieces]
        #: of each piece, the longest piece that it starts with, or -1
        self.shorter = [-1] * len(self.pieces)
        for piece, i in self.id_of.items():
            starts = (self.id_of.get(piece[:n]) for n in range(len(piece) - 1, 0, -1))
            self.shorter[i] = next((j for j in starts if j is not None), -1)
        #: text of each piece that is neither a byte, unknown nor silent
        self.surface = {i: p.replace(SPACE, " ") for p, i in self.id_of.items()}
        self.fits: dict[int, bool] = {}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.units: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    # --- encoding ---------------------------------------------------------

    def merged(self, text: str) -> list[tuple]:
        """Merge best first, leftmost of equals: used on one or two pieces only.

        Each part comes as (text, left part, right part, time): a part is made
        once its own rank and those of all parts in it have come up, so its time
        is the largest rank in its tree.
        """
        parts: list[tuple] = [(c, None, None, -inf) for c in text]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i][0] + parts[i + 1][0])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            left, right = parts[at], parts[at + 1]
            parts[at : at + 2] = [(left[0] + right[0], left, right, max(-best, left[3], right[3]))]
        return parts

    def spines(self, piece: int) -> tuple[list, list] | None:
        """(text, time it is made, time it is used up) along the left and the right
        edge of a piece, earliest first; None if merging its text gives other pieces."""
        if piece not in self.edges:
            parts = self.merged(self.pieces[piece])
            self.edges[piece] = (_edge(parts[0], 1), _edge(parts[0], 2)) if len(parts) == 1 else None
        return self.edges[piece]

    def go_together(self, before: int, piece: int) -> bool:
        """Whether merging the two pieces again leaves them; ``before`` is -1 at the start.

        Only merges over the cut can change them. At any time one part of each
        piece touches the cut; such a merge comes about if it is due before either
        part is used up within its own piece.
        """
        if len(self.fits) >= CACHE_ENTRIES:
            self.fits.clear()
        known = self.fits[before << 32 | piece] = self._go_together(before, piece)
        return known

    def _go_together(self, before: int, piece: int) -> bool:
        right = self.spines(piece)
        if right is None or before < 0:
            return right is not None
        left = self.spines(before)
        if left is None:
            return False
        a, b, i, j = left[1], right[0], 0, 0
        while True:
            (x, made_x, used_x), (y, made_y, used_y) = a[i], b[j]
            score = self.score.get(x + y)
            until = min(used_x, used_y)
            if score is not None:
                due = max(-score, made_x, made_y)
                if due < until:
                    return False
                if due == until < inf:  # a tie: let the merging itself decide
                    return [p[0] for p in self.merged(self.pieces[before] + self.pieces[piece])] == [
                        self.pieces[before], self.pieces[piece]]
                if until == inf:
                    return False
            if until == inf:
                return True
            if used_x == until:
                i += 1
            if used_y == until:
                j += 1

    def backtrack(self, text: str) -> list[int]:
        """Encode a stretch of letters that all occur in pieces."""
        size = len(text)
        longest = [-1] * size
        for last, (piece, before_last) in self.automaton.iter(text):
            longest[last - before_last] = piece  # longer ones at a place come later
        length, shorter, fits = self.length, self.shorter, self.fits
        taken: list[int] = []
        failed = 0
        at, before, piece = 0, -1, longest[0]
        while True:
            while piece >= 0:
                end = at + length[piece]
                if not failed >> end & 1:
                    fit = fits.get(before << 32 | piece)
                    if fit is None:
                        fit = self.go_together(before, piece)
                    if fit:
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                if end == size:
                    return taken
                at, before, piece = end, piece, longest[end]
            else:
                failed |= 1 << at
                if not taken:
                    raise ValueError("this vocabulary has no sequence for the text")
                piece = taken.pop()
                at -= length[piece]
                before = taken[-1] if taken else -1
                piece = shorter[piece]

    def encode_unit(self, unit: str) -> list[int]:
        """Encode text in which no piece can go on over either end."""
        ids: list[int] = []
        for i, part in enumerate(self.stretches.split(unit)):
            if i % 2:
                ids += self.backtrack(part)
            else:
                for letter in part:
                    if self.byte_id:
                        ids += [self.byte_id[b] for b in letter.encode()]
                    else:
                        ids.append(self.unknown)
        return ids

    @staticmethod
    def units_of(text: str) -> list[str]:
        """Cut before each space that follows another character: no piece has
        a space after anything else, so nothing merges over such a cut."""
        if not text:
            return []
        words = text.replace(SPACE, " ").split(" ")
        if "" not in words:
            return words
        units, spaces = [], 0
        for word in words[:-1]:
            if word:
                units.append(SPACE * spaces + word)
                spaces = 0
            else:
                spaces += 1
        units.append(SPACE * spaces + words[-1])
        return units

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units_of(text) for i in self.encode_unit(SPACE + unit)]

    # --- decoding ---------------------------------------------------------

    def decode(self, ids: list[int], first: bool = True) -> str:
        """Text of ``ids``; ``first``: they open the text, whose added space goes."""
        if not first:
            try:
                return "".join([self.surface[i] for i in ids])
            except KeyError:
                pass  # bytes among them
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_bytes_text(bytes(run)))
                run.clear()
            if i == self.unknown:
                out.append(UNKNOWN_SURFACE)
            elif i not in self.silent:
                piece = self.pieces[i].replace(SPACE, " ")
                out.append(piece[1:] if first and not out and piece.startswith(" ") else piece)
        if run:
            out.append(_bytes_text(bytes(run)))
        return "".join(out)

    # --- whole documents --------------------------------------------------

    def unit(self, unit: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by commas, and their decoded text."""
        known = self.units.get(unit)
        if known is None:
            known = self.older.get(unit)
        if known is None:
            ids = self.encode_unit(SPACE + unit)
            known = (len(ids), ",".join(map(str, ids)), self.decode(ids, first=False))
        if unit not in self.units:
            if len(unit) <= 64:
                if len(self.units) >= CACHE_ENTRIES:
                    self.older, self.units = self.units, {}
                self.units[unit] = known
        return known

    def document(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, decoded text of a whole text."""
        lookup, unit = self.units.get, self.unit
        parts = [lookup(u) or unit(u) for u in self.units_of(text)]
        if not parts:
            return 0, "", ""
        return sum(p[0] for p in parts), ",".join([p[1] for p in parts]), "".join([p[2] for p in parts])[1:]


def _edge(part: tuple, side: int) -> list[tuple[str, float, float]]:
    """Parts down one side (1 left, 2 right) of a merged part, earliest first."""
    edge, used = [], inf
    while part is not None:
        edge.append((part[0], part[3], used))
        used, part = part[3], part[side]
    return edge[::-1]


def _bytes_text(run: bytes) -> str:
    """UTF-8 text of a run of byte pieces; each byte that is part of no character
    becomes one replacement character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def coder(model_path: str) -> PieceCoder:
    """One coder per Python worker and model."""
    return PieceCoder(model_path)


def encode_documents(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode and decode every text.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, decoded_equal, and with
    ``with_ids`` the ids themselves. Null and empty texts
    have no tokens. Repeated rows come back as often as they came. Other columns
    are not read. Model files are read on each executor from ``model_path``.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = coder(model_path)
        texts = batch.column(1)
        counts, ids, decoded, equal, raw = [], [], [], [], []
        for value in texts:
            text = value.as_py()
            n, joined, back = code.document(text)
            counts.append(n)
            ids.append(hashlib.sha256(joined.encode()).hexdigest())
            decoded.append(hashlib.sha256(back.encode()).hexdigest())
            equal.append(back == text)
            if with_ids:
                raw.append(np.fromstring(joined, np.int32, sep=","))
        out = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
               pa.array(decoded, pa.string()), pa.array(equal, pa.bool_())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_equal"]
        if with_ids:
            offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
            out.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(raw))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(out, names=names)

    rows = id_and_text(docs, id_col, text_col)
    key = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_equal boolean"
    return map_batches(rows, run, schema + (", ids array<int>" if with_ids else ""))
