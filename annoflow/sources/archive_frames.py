"""Where the records of a web archive begin and end, from any byte on.

Records follow one another without an index: a plain record tells its length in its head, a
compressed archive has one gzip member a record. A reader that starts in the middle looks for bytes that
may begin a record and takes the first place that holds one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

#: Bytes read at a time, and of a record's head at most.
STEP, HEAD = 1 << 18, 1 << 16
_GZIP = b"\x1f\x8b\x08"
_WARC_START = re.compile(rb"WARC/\d")
_ARC_START = re.compile(rb"[A-Za-z][A-Za-z0-9+.\-]*:\S* \S+ \d+ [^\r\n]* ?\d+\r?\n")
#: What may stand before a record's first byte, and how far back a start can hide at the end of a piece.
_BREAKS, _OVERLAP = b"\r\n", 1 << 14
#: Bytes within which the first line of a record ends.
_HEAD_LINE = 1 << 14


class Window:
    """An open file read forward in pieces; the bytes in hand are not read again."""

    def __init__(self, f, step: int = STEP):
        self.f, self.step, self.size = f, step, f.size()
        self.begin, self.data = 0, b""
        self.read = 0

    def peek(self, offset: int, n: int) -> bytes:
        """``n`` bytes from ``offset`` on, or what the file has of them."""
        at = offset - self.begin
        if not 0 <= at <= len(self.data):
            self.begin, self.data, at = offset, b"", 0
        if len(self.data) - at < n and self.begin + len(self.data) < self.size:
            kept = self.data[at:]
            self.f.seek(offset + len(kept))
            more = self.f.read(max(self.step, n - len(kept)))
            self.read += len(more)
            self.begin, self.data, at = offset, kept + more, 0
        return self.data[at : at + n]

    def glance(self, offset: int, n: int) -> bytes:
        """Like ``peek`` for a few bytes further on, leaving the bytes in hand alone."""
        at = offset - self.begin
        if 0 <= at and at + n <= len(self.data):
            return self.data[at : at + n]
        self.f.seek(offset)
        data = self.f.read(n)
        self.read += len(data)
        return data


class Framed(NamedTuple):
    """A record's bytes (none, if it is broken), where it stands, where the next can begin, and what is wrong."""

    offset: int
    after: int
    record: bytes | None
    problem: str | None


class Frames:
    """The records of one archive."""

    def __init__(self, f, step: int = STEP):
        self.window = Window(f, step)
        self.zipped = self.window.peek(0, 2) == _GZIP[:2]
        head = self._inflated(0, _HEAD_LINE) if self.zipped else self.window.peek(0, _HEAD_LINE)
        self.start = _ARC_START if head is not None and not _WARC_START.match(head.lstrip(_BREAKS)) and b":" in head else _WARC_START

    def at(self, offset: int) -> tuple[bytes, int]:
        """The record at ``offset`` and where it ends."""
        return self._member(offset) if self.zipped else self._plain(offset)

    def between(self, begin: int, end: int, exact: bool) -> Iterator[Framed]:
        """The records that start in a stretch of the file; with ``exact`` the first starts at its beginning.

        A broken record is told and the next one looked for. Blank members and line ends between records
        are passed over, so ``after`` is where a record starts or the file ends.
        """
        offset = self._past_blanks(begin) if exact else self.next_start(begin, end)
        while offset < end:
            try:
                record, after = self.at(offset)
                if not self.start.match(record):
                    raise ValueError(f"no record begins at {offset}")
                problem = None
                after = self._past_blanks(after)
            except MemoryError:
                raise
            except Exception as error:
                record, problem = None, str(error) or type(error).__name__
                after = self.next_start(offset + 1, self.window.size)
            yield Framed(offset, after, record, problem)
            offset = after

    def next_start(self, begin: int, end: int) -> int:
        """The first place from ``begin`` on where a record starts, or the file's size if none does before ``end``."""
        at = begin
        while at < end:
            piece = self.window.peek(at, self.window.step)
            for place in self._candidates(at, piece):
                if place >= end:
                    break
                if self._holds(place):
                    return place
            if at + len(piece) >= self.window.size:
                break
            at += max(1, len(piece) - (2 if self.zipped else _OVERLAP))
        return self.window.size

    def _candidates(self, at: int, piece: bytes) -> list[int]:
        if self.zipped:
            return [at + m.start() for m in re.finditer(re.escape(_GZIP), piece)]
        found = (at + m.start() for m in self.start.finditer(piece))
        return [p for p in found if p == 0 or self.window.glance(p - 1, 1) in (b"\n", b"\r")]

    def _holds(self, place: int) -> bool:
        """Whether a record can be read at ``place``; of a plain one, whether it ends like one."""
        if self.zipped:
            head = self._inflated(place, _HEAD_LINE)
            return head is not None and self.start.match(head) is not None
        try:
            after = place + self._length(place)
        except (ValueError, EOFError):
            return False
        if after > self.window.size:
            return False
        following = self.window.glance(after, 512)
        ends = b"\r\n\r\n" if self.start is _WARC_START else (b"\n", b"\r\n")
        return not following or following.startswith(ends) or self.start.match(following) is not None

    def _past_blanks(self, offset: int) -> int:
        while offset < self.window.size:
            if self.zipped:
                if self.window.glance(offset, 3) != _GZIP:
                    return offset
                # most members hold a record: only what starts with a blank is read on
                if (self._inflated(offset, 1) or b"x") not in (b"\r", b"\n"):
                    return offset
                record, after = self._member(offset)
                if record.strip(_BREAKS):
                    return offset
                offset = after
            else:
                head = self.window.peek(offset, 64)
                blank = len(head) - len(head.lstrip(_BREAKS))
                if not blank:
                    return offset
                offset += blank
        return self.window.size

    # --- compressed

    def _inflated(self, offset: int, n: int) -> bytes | None:
        """The first bytes of a gzip member, or None where there is none."""
        try:
            return zlib.decompressobj(31).decompress(self.window.peek(offset, max(64, n)), n)
        except zlib.error:
            return None

    def _member(self, offset: int) -> tuple[bytes, int]:
        decoder, out, at = zlib.decompressobj(31), [], offset
        while piece := self.window.peek(at, 1 << 16):
            out.append(decoder.decompress(piece))
            at += len(piece)
            if decoder.eof:
                return b"".join(out), at - len(decoder.unused_data)
        raise EOFError(f"the archive ends inside the record at {offset}")

    # --- plain

    def _length(self, offset: int) -> int:
        """Bytes of a plain record, as its head says."""
        head, size = self.window.peek(offset, 1 << 12), 1 << 12
        mark = b"\r\n\r\n" if self.start is _WARC_START else b"\n"
        while (found := head.find(mark)) < 0:
            if len(head) < size or size >= HEAD:
                raise ValueError(f"no record begins at {offset}")
            size *= 4
            head = self.window.peek(offset, size)
        begin = found + len(mark)
        if self.start is _WARC_START:
            length = re.search(rb"(?im)^content-length:\s*(\d+)", head[:begin])
            if length is None:
                raise ValueError(f"the record at {offset} has no length")
            return begin + int(length.group(1))
        return begin + int(head[:begin].split()[-1])

    def _plain(self, offset: int) -> tuple[bytes, int]:
        total = self._length(offset)
        record = self.window.peek(offset, total)
        if len(record) < total:
            raise EOFError(f"the archive ends inside the record at {offset}")
        return record, offset + total
