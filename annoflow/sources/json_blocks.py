"""Where the top-level values of JSON data begin and end, from any byte on.

What a byte means depends on all before it: it may stand in a string, and at any depth. A block
is therefore looked at twice over, as if it began outside and as if inside a string; what it does to the state
either way is a few numbers. Put together in order, these tell how each block really begins, and
then each can be read by itself: a value belongs to the block in which it starts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PIECE = 1 << 22
_SPACE = b" \t\r\n"
_MARK = b"\xef\xbb\xbf"
_QUOTE, _BACK = 34, 92
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
#: What stands between containers: a string, or anything else up to a separator.
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*"|"|[^ \t\r\n,"]+', re.S)
_RUN = re.compile(rb'[^ \t\r\n,"{}\[\]]*')
#: A depth that no data reaches.
FAR = 1 << 40


@dataclass
class Entry:
    """How a block begins: in a string or not, how deep, the depth of top-level values there (1 in an array),
    whether they are an array's, and whether anything came before."""

    in_string: bool = False
    depth: int = 0
    base: int = 0
    in_array: bool = False
    started: bool = False


def structure(data: np.ndarray, in_string: bool, escaped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Places and steps (1, -1) of the brackets outside strings, places of the quotes that begin or end one, and whether
    the data ends in a string.

    ``escaped``: the first byte stands after an odd number of backslashes.
    """
    quotes = np.flatnonzero(data == _QUOTE)
    backs = np.flatnonzero(data == _BACK)
    if len(quotes) and (len(backs) or escaped):
        if len(backs):
            # a quote after an odd run of backslashes is none
            run = np.arange(len(backs)) - np.maximum.accumulate(
                np.where(np.concatenate([[True], np.diff(backs) > 1]), np.arange(len(backs)), 0)
            )
            odd = run % 2 == 0
            if escaped and backs[0] == 0:
                first = backs - np.arange(len(backs)) == 0
                odd = odd ^ first
            quotes = np.setdiff1d(quotes, backs[odd] + 1, assume_unique=True)
        if escaped and not (len(backs) and backs[0] == 0):
            quotes = quotes[quotes != 0]
    steps = _STEP[data]
    places = np.flatnonzero(steps)
    inside = (np.searchsorted(quotes, places) + in_string) % 2 == 1
    places = places[~inside]
    return places, steps[places].astype(np.int64), quotes, bool((len(quotes) + in_string) % 2)


def odd_backslashes(before: bytes) -> bool:
    """Whether data ends in an odd number of backslashes."""
    return (len(before) - len(before.rstrip(b"\\"))) % 2 == 1


def effect(pieces: Iterator[bytes], before: bytes) -> dict:
    """What a block does to either state, outside (0) and inside (1) a string: the string state after it, the change of depth and the
    least depth after any bracket; and its first byte that is no space (-1: none)."""
    state, first, escaped = [[bool(e), 0, FAR] for e in (0, 1)], -1, odd_backslashes(before)
    for piece in pieces:
        data = np.frombuffer(piece, np.uint8)
        for one in state:
            _, steps, _, one[0] = structure(data, one[0], escaped)
            if len(steps):
                depths = one[1] + np.cumsum(steps)
                one[1], one[2] = int(depths[-1]), min(one[2], int(depths.min()))
        if first < 0:
            held = piece.lstrip(_SPACE)
            first = held[0] if held else -1
        escaped = odd_backslashes(piece) if piece.strip(b"\\") else odd_backslashes(piece) ^ escaped
    names = [f"{name}{e}" for e in (0, 1) for name in ("ends_in", "deeper", "least")]
    return dict(zip(names, [x for one in state for x in one])) | {"first": first}


def entries(effects: list[dict]) -> list[Entry]:
    """How each block of a file begins, from the effects of all, in order."""
    out, now = [], Entry()
    least = FAR
    array = None
    for one in effects:
        out.append(Entry(**vars(now)))
        e = int(now.in_string)
        if array is None and one["first"] >= 0:
            array = one["first"] == ord("[")
            now.started = True
        least = min(least, now.depth + one[f"least{e}"])
        now.in_string, now.depth = bool(one[f"ends_in{e}"]), now.depth + one[f"deeper{e}"]
        now.base = min(1 if array else 0, least)
        now.in_array = bool(array) and now.base == 1
    return out


class TopValues:
    """The top-level values of a stretch of data, by the brackets and quotes alone.

    ``read`` gives (place, text, problem): the bytes of each value that starts before ``limit`` (none: the data's end), or
    what is wrong there. Values are not parsed.
    """

    def __init__(self, begin: int = 0, entry: Entry | None = None, before: bytes = b"", limit: float = float("inf")):
        entry = entry or Entry()
        self.at, self.limit, self.before = begin, limit, before
        self.in_string, self.escaped, self.depth = entry.in_string, odd_backslashes(before), entry.depth
        self.base, self.in_array, self.started = entry.base, entry.in_array, entry.started
        self.held, self.held_at = b"", begin
        #: Where the value that is being read began; -1 if before this stretch.
        self.open: int | None = -1 if entry.depth > entry.base else None
        self.in_foreign_string = entry.in_string and self.open is None
        self.done = False

    def read(self, pieces: Iterator[bytes]) -> Iterator[tuple[int, bytes | None, str | None]]:
        for piece in pieces:
            if not self.held:
                self.held_at = self.at
            self.held += piece
            places, steps, quotes, ends_in = structure(np.frombuffer(piece, np.uint8), self.in_string, self.escaped)
            self._begin(piece, quotes)
            after = self.depth + np.cumsum(steps)
            near = np.flatnonzero(np.minimum(after, after - steps) <= self.base)
            for place, step, depth in zip((places[near] + self.at).tolist(), steps[near].tolist(), after[near].tolist()):
                yield from self._bracket(place, step, depth)
                if self.done:
                    return
            self.at += len(piece)
            self.depth = int(after[-1]) if len(after) else self.depth
            self.escaped = odd_backslashes(piece) ^ (self.escaped and not piece.strip(b"\\"))
            self.in_string = ends_in
            if self.open == -1 or self.in_foreign_string:
                self.held = b""
            elif self.open is None:
                yield from self._between(self.at, final=False)
                if self.held_at >= self.limit:
                    return
        if self.open is not None:
            if 0 <= self.open < self.limit:
                yield self.open, None, "the data ends inside a value"
            return
        yield from self._between(self.at, final=True)
        if self.in_array and self.limit == float("inf"):
            yield self.at, None, "the data ends inside an array"

    def _begin(self, piece: bytes, quotes: np.ndarray) -> None:
        """Find out whether the data is an array, and pass over what is left of a string or of other bytes without a
        separator that began before this stretch."""
        if not self.started:
            if self.held_at == 0 and self.held.startswith(_MARK):
                self._drop(len(_MARK))
            start = self.held.lstrip(_SPACE)
            if start:
                self.started, self.in_array = True, start[:1] == b"["
                self.base = int(self.in_array)
        if self.in_foreign_string:
            if len(quotes):
                self._drop(int(quotes[0]) + 1)
                self.in_foreign_string = False
            self.before = b""
        elif self.before:
            run = 0
            if self.open is None and _RUN.match(self.before[-1:]).end():
                run = _RUN.match(self.held).end()
            ended = run < len(self.held)
            self._drop(run)
            self.before = b"" if ended else piece[-1:]

    def _drop(self, n: int) -> None:
        self.held, self.held_at = self.held[n:], self.held_at + n

    def _bracket(self, place: int, step: int, depth: int) -> Iterator[tuple[int, bytes | None, str | None]]:
        if self.open is not None:
            if depth == self.base and step < 0:
                if self.open >= 0:
                    text = self.held[self.open - self.held_at : place + 1 - self.held_at]
                    if self.open < self.limit:
                        yield self.open, text, None
                self._drop(place + 1 - self.held_at)
                self.open = None
        elif step > 0 and depth - 1 == self.base:
            yield from self._between(place, final=True)
            self.open, self.done = place, place >= self.limit
        elif step > 0:
            self._drop(place + 1 - self.held_at)  # the array's own bracket
        else:
            yield from self._between(place, final=True)
            if not self.in_array and place < self.limit:
                yield place, None, "a bracket closes nothing"
            self._drop(place + 1 - self.held_at)
            self.base, self.in_array = self.base - 1, False

    def _between(self, end: int, final: bool) -> Iterator[tuple[int, bytes | None, str | None]]:
        """Values up to ``end`` that are no containers."""
        text = self.held[: end - self.held_at]
        skipped = _SPACE + b"," if self.in_array else _SPACE
        done = 0
        if text.strip(skipped):
            for m in _TOKEN.finditer(text):
                place, broken = self.held_at + m.start(), m.group() == b'"'
                if not final and (broken or (m.end() == len(text) and text[m.start()] != _QUOTE)):
                    break  # it may go on
                if not self.in_array and b"," in text[done : m.start()] and place < self.limit:
                    yield place, None, "a comma outside an array"
                if place < self.limit:
                    yield place, None if broken else m.group(), "the data ends inside a value" if broken else None
                done = m.end()
                if broken:
                    break
        rest = text[done:]
        self._drop(len(text) if final else done + len(rest) - len(rest.lstrip(skipped)))
