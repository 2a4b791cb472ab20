"""Opening files from inside tasks, and the compressions that inputs come in."""

from __future__ import annotations

import bz2
import lzma
import os
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs as pafs

CHUNK = 1 << 20
BATCH_BYTES = 32 << 20


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for a plain path or a URI (``file:``, ``hdfs:``, ``s3:``, ``s3a:`` ...).

    Only the scheme and the host of a URI are taken apart; the rest is a path as it stands, so that IDs below a root
    may hold any character (``#``, ``?``, ``%``).
    """
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)(.*)", path, re.S)
    if found is None:
        return pafs.LocalFileSystem(), path
    scheme, host, rest = found.groups()
    system, base = _connected("s3" if scheme in ("s3a", "s3n") else scheme, host)
    return system, base.rstrip("/") + (rest or "/")


@lru_cache
def _connected(scheme: str, host: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(f"{scheme}://{host}/")


def open_input(path: str) -> pa.NativeFile:
    system, place = locate(path)
    return system.open_input_file(place)


def read_bytes(path: str) -> bytes:
    with open_input(path) as f:
        return f.read()


def chunks_of(f, size: int = CHUNK) -> Iterator[bytes]:
    while data := f.read(size):
        yield data


def join(root: str, relative: str) -> str:
    return root.rstrip("/") + "/" + relative


def batches(rows: Iterable[dict], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded bytes, so contents never pile up."""
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += size_of(row)
        if held_bytes >= BATCH_BYTES or len(held) >= 10_000:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


# --- compression -----------------------------------------------------------

# The leading bytes and names of the supported formats.
_MAGIC = (
    ("gz", b"\x1f\x8b"),
    ("bzip2", b"BZh"),
    ("xz", b"\xfd7zXZ\x00"),
    ("snappy-framed", b"\xff\x06\x00\x00sNaPpY"),
    ("z", b"\x1f\x9d"),
    ("lzma", b"\x5d\x00\x00"),
)
_ALIASES = {"gzip": "gz", "bz2": "bzip2", "": "none"}
_SUPPORTED = ("none", "gz", "bzip2", "xz", "lzma", "deflate", "snappy-framed", "snappy-raw", "any")
_XERIAL = b"\x82SNAPPY\x00"


def compression_name(name: str | None) -> str:
    name = (name or "none").strip().lower()
    name = _ALIASES.get(name, name)
    if name not in _SUPPORTED:
        raise ValueError(f"unsupported compression {name!r}")
    return name


def is_packed(head: bytes, compression: str | None) -> bool:
    """Whether a file that begins so has to be read from its start to be decompressed."""
    name = compression_name(compression)
    return name != "none" if name != "any" else any(head.startswith(magic) for _, magic in _MAGIC)


def decompressed(f, compression: str | None) -> Iterator[bytes]:
    """The contents of an open file, piece by piece.

    ``any`` goes by the leading bytes and takes an unknown start as plain data.
    """
    name = compression_name(compression)
    pieces = chunks_of(f)
    if name == "any":
        first = next(pieces, b"")
        name = next((n for n, magic in _MAGIC if first.startswith(magic)), "none")
        compression_name(name)
        pieces = _with_first(first, pieces)
    if name == "none":
        return pieces
    if name == "snappy-raw":
        return iter([_snappy_block(b"".join(pieces))])
    if name == "snappy-framed":
        return _snappy_framed(pieces)
    return _members(pieces, name)


def _with_first(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def _decoder(name: str):
    return {
        "gz": lambda: zlib.decompressobj(31),
        "deflate": lambda: zlib.decompressobj(15),
        "bzip2": bz2.BZ2Decompressor,
        "xz": lambda: lzma.LZMADecompressor(lzma.FORMAT_XZ),
        "lzma": lambda: lzma.LZMADecompressor(lzma.FORMAT_ALONE),
    }[name]()


def _members(pieces: Iterator[bytes], name: str) -> Iterator[bytes]:
    """All members of a file, one after the other; a cut one is an error."""
    decoder, begun = _decoder(name), False
    for piece in pieces:
        while piece:
            begun = True
            out = decoder.decompress(piece)
            if out:
                yield out
            piece = b""
            if decoder.eof:
                piece, decoder, begun = decoder.unused_data, _decoder(name), False
                if not piece.strip(b"\x00"):
                    piece = b""
    if begun:
        raise EOFError(f"compressed {name} data ends early")


def _snappy_size(block: bytes) -> int:
    size = shift = 0
    for byte in block[:10]:
        size |= (byte & 0x7F) << shift
        if byte < 0x80:
            return size
        shift += 7
    raise ValueError("not a snappy block")


def _snappy_block(block: bytes) -> bytes:
    if not block:
        return b""
    return pa.Codec("snappy").decompress(block, decompressed_size=_snappy_size(block)).to_pybytes()


def _snappy_framed(pieces: Iterator[bytes]) -> Iterator[bytes]:
    held = b""
    for piece in pieces:
        held += piece
        while len(held) >= 4:
            kind, size = held[0], int.from_bytes(held[1:4], "little")
            if len(held) < 4 + size:
                break
            body, held = held[4 : 4 + size], held[4 + size :]
            if kind == 0x00:
                yield _snappy_block(body[4:])
            elif kind == 0x01:
                yield body[4:]
            elif 0x02 <= kind <= 0x7F:
                raise ValueError("unknown snappy frame")
    if held:
        raise EOFError("snappy data ends early")


def unpack_file(data: bytes, compression: str | None) -> bytes:
    """A whole document file: plain, gzip, or block-framed snappy."""
    name = (compression or "none").lower()
    if name in ("none", ""):
        return data
    if name in ("gzip", "gz"):
        return b"".join(_members(iter([data]), "gz"))
    if name == "snappy":
        return snappy_unframe(data)
    raise ValueError(f"unsupported compression {compression!r}")


def pack_file(data: bytes, compression: str | None) -> bytes:
    name = (compression or "none").lower()
    if name in ("none", ""):
        return data
    if name in ("gzip", "gz"):
        packer = zlib.compressobj(wbits=31)
        return packer.compress(data) + packer.flush()
    if name == "snappy":
        return snappy_frame(data)
    raise ValueError(f"unsupported compression {compression!r}")


def snappy_frame(data: bytes, block: int = 32 * 1024) -> bytes:
    """Snappy in the block framing of Java's snappy streams."""
    out = [_XERIAL, (1).to_bytes(4, "big"), (1).to_bytes(4, "big")]
    for i in range(0, len(data), block):
        packed = pa.Codec("snappy").compress(data[i : i + block], asbytes=True)
        out += [len(packed).to_bytes(4, "big"), packed]
    return b"".join(out)


def snappy_unframe(data: bytes) -> bytes:
    if not data.startswith(_XERIAL):
        raise ValueError("snappy data without the expected block framing")
    out, at = [], 16
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        block = data[at + 4 : at + 4 + size]
        if len(block) < size:
            raise EOFError("snappy data ends early")
        out.append(_snappy_block(block))
        at += 4 + size
    return b"".join(out)


# --- writing ---------------------------------------------------------------


def write_atomically(path: str, data: bytes, attempt: str) -> None:
    """Write under a temporary name, then rename, so a retry replaces it whole."""
    system, place = locate(path)
    system.create_dir(posixpath.dirname(place), recursive=True)
    temporary = posixpath.join(posixpath.dirname(place), f".{posixpath.basename(place)}.{attempt}")
    with system.open_output_stream(temporary) as out:
        out.write(data)
    move_over(system, temporary, place)


def read_if_there(path: str) -> bytes | None:
    """A small file, or None where there is none."""
    try:
        with open_input(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


def create_new(path: str, data: bytes) -> bool:
    """Put a whole file in place unless one is there already; tells which.

    Exact where the file system refuses to link or rename onto a file that exists, as local disks and HDFS
    do. Elsewhere two writers within the same instant may both be told yes.
    """
    system, place = locate(path)
    system.create_dir(posixpath.dirname(place), recursive=True)
    temporary = posixpath.join(posixpath.dirname(place), f".{posixpath.basename(place)}.{uuid.uuid4().hex}")
    with system.open_output_stream(temporary, compression=None) as out:
        out.write(data)
    try:
        if isinstance(system, pafs.LocalFileSystem):
            os.link(temporary, place)
        elif system.get_file_info(place).type != pafs.FileType.NotFound:
            raise FileExistsError(place)
        else:
            system.move(temporary, place)
            return True
        created = True
    except OSError:
        if system.get_file_info(place).type == pafs.FileType.NotFound:
            raise
        created = False
    system.delete_file(temporary)
    return created


def delete_folder(path: str) -> None:
    """Delete a folder if it is there."""
    system, place = locate(path)
    if system.get_file_info(place).type == pafs.FileType.Directory:
        system.delete_dir(place)


def move_over(system: pafs.FileSystem, source: str, target: str) -> None:
    """Rename onto a path that may exist; some file systems refuse that."""
    try:
        system.move(source, target)
    except OSError:
        if system.get_file_info(target).type != pafs.FileType.File:
            raise
        system.delete_file(target)
        system.move(source, target)
