"""Landing files of any size, cut into the elements of their JSON array.

A landing file holds one JSON array of objects (or one object). It is read as a
stream of bytes, in pieces of fixed size, and never held whole: brackets and
quotes are counted with numpy over each piece, and every element becomes a row
of its own, which Spark's JSON functions then parse. A task therefore needs
memory for one element and one piece, whatever the size of the file.

Two passes over a file. The first only counts, to tell whether the file is one
whole value with nothing but white space after it; the second emits. A file
that fails the first pass (a second value, a broken tail, no JSON at all) is
emitted as it stands, marked bad: in one row if it has at most ``PIECE_BYTES``,
else cut behind elements into rows of about that size, which together are the
text of the file.

The listing comes from Spark's file source without the contents, so streams
keep their checkpoints, rate limits and ``cleanSource``. Files are opened with
``pyarrow.fs``. In a store it cannot open, Spark reads the contents instead, up
to 2 GB a file. Files whose name ends in .gz, .bz2, .zst or .lz4 are unpacked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LISTING = "path string, modificationTime timestamp, length long, content binary"
ELEMENTS = "value binary, bad boolean"
PIECE_BYTES = 1024 * 1024
BATCH_BYTES = 8 * 1024 * 1024
BATCH_ROWS = 5_000

_OPEN, _CLOSE = b"[{", b"]}"
_COMMA, _QUOTE, _BACKSLASH = ord(","), ord('"'), ord("\\")
_SPACE = b" \t\r\n"
_BOM = b"\xef\xbb\xbf"
_TABLE = np.zeros(256, bool)
_TABLE[list(b"[]{},")] = True


class Scanner:
    """Follows brackets and strings through consecutive pieces of a text."""

    def __init__(self):
        self.depth = 0
        self.in_string = False
        self.backslashes = 0  # at the end of the last piece

    def marks(self, piece: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The brackets and commas of ``piece`` outside strings: (place, byte,
        depth after it)."""
        data = np.frombuffer(piece, np.uint8)
        quotes = np.flatnonzero(data == _QUOTE)
        back = data == _BACKSLASH
        if back.any() or self.backslashes:
            # A quote is text where an odd number of backslashes stands before it.
            place = np.arange(len(data))
            other = np.maximum.accumulate(np.where(back, -1, place))  # the last byte that is none
            before = quotes - 1
            last = np.where(before >= 0, other[before], -1)
            run = before - last + np.where(last < 0, self.backslashes, 0)
            quotes = quotes[run % 2 == 0]
            tail = len(data) - 1 - int(other[-1])
            self.backslashes = tail + (self.backslashes if other[-1] < 0 else 0)
        at = np.flatnonzero(_TABLE[data])
        inside = (np.searchsorted(quotes, at) + self.in_string) % 2 == 1
        at = at[~inside]
        self.in_string = bool((len(quotes) + self.in_string) % 2)
        kind = data[at]
        step = np.isin(kind, list(_OPEN)).astype(np.int64) - np.isin(kind, list(_CLOSE))
        depth = self.depth + np.cumsum(step)
        self.depth = int(depth[-1]) if len(depth) else self.depth
        return at, kind, depth


def _pieces(handle) -> Iterator[bytes]:
    first = True
    while piece := handle.read(PIECE_BYTES):
        if first and piece.startswith(_BOM):
            piece = piece[len(_BOM):]
        first = False
        if piece:
            yield piece


def is_whole(pieces: Iterator[bytes]) -> tuple[bool, bool]:
    """``(blank, whole)``: whether the text is only white space, and whether it
    is one bracketed value with nothing after it."""
    scanner, blank, ended = Scanner(), True, False
    for piece in pieces:
        if blank:
            rest = piece.lstrip(_SPACE)
            blank = not rest
            if not blank and rest[:1] not in (b"[", b"{"):
                return False, False
        at, _, depth = scanner.marks(piece)
        if ended:
            if piece.strip(_SPACE):
                return False, False
            continue
        closed = np.flatnonzero(depth <= 0)
        if len(closed):
            if piece[int(at[closed[0]]) + 1:].strip(_SPACE):
                return False, False
            ended = True
    return blank, ended and not scanner.in_string


def elements(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The elements of a whole array, one by one; the text itself if it is no
    array. An empty array has none."""
    scanner, held, array, seen = Scanner(), [], None, 0
    for piece in pieces:
        at, kind, depth = scanner.marks(piece)
        begin = 0
        if array is None:
            start = len(piece) - len(piece.lstrip(_SPACE))
            if start == len(piece):
                continue
            array = piece[start:start + 1] == b"["
            begin = start + array
        if array:
            cut = ((kind == _COMMA) & (depth == 1)) | (depth == 0)
            for end, after in zip(at[cut].tolist(), depth[cut].tolist()):
                element = b"".join([*held, piece[begin:end]])
                held, begin = [], end + 1
                if after or seen or element.strip(_SPACE):  # else the array is empty
                    yield element
                seen += 1
        held.append(piece[begin:])
    if array is False:
        yield b"".join(held)


def broken_pieces(pieces: Iterator[bytes], size: int | None) -> Iterator[bytes]:
    """The text in stretches of about ``PIECE_BYTES``, cut behind a comma or a
    bracket next to the outermost level where there is one; whole if ``size``
    is at most that."""
    if size is not None and size <= PIECE_BYTES:
        yield b"".join(pieces)
        return
    scanner, held = Scanner(), b""
    for piece in pieces:
        at, _, depth = scanner.marks(piece)
        cuts = at[depth <= 1]
        end = int(cuts[-1]) + 1 if len(cuts) else len(piece) if len(held) + len(piece) > 2 * PIECE_BYTES else 0
        if end:
            yield held + piece[:end]
            held = b""
        held += piece[end:]
    if held:
        yield held


def file_elements(opened: Callable, size: int | None) -> Iterator[tuple[bytes, bool]]:
    """(text, bad) rows of one file; ``opened`` opens it anew for each pass."""
    with opened() as handle:
        blank, whole = is_whole(_pieces(handle))
    if blank:
        return
    with opened() as handle:
        if whole:
            for element in elements(_pieces(handle)):
                yield element, False
        else:
            for text in broken_pieces(_pieces(handle), size):
                yield text, True


def _uri(path: str) -> str:
    """Spark's spelling of a path as pyarrow takes it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return "s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path


def _compression(path: str) -> str | None:
    return {"gz": "gzip", "bz2": "bz2", "zst": "zstd", "lz4": "lz4"}.get(path.rpartition(".")[2])


def opens_with_arrow(path: str) -> bool:
    """Whether tasks can open files under ``path`` by themselves."""
    try:
        if ":" in path.split("/")[0]:
            fs.FileSystem.from_uri(_uri(path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _batches(rows: Iterator[tuple[bytes, bool]]) -> Iterator[pa.RecordBatch]:
    texts, flags, size = [], [], 0
    for text, bad in rows:
        texts.append(text)
        flags.append(bad)
        size += len(text)
        if size >= BATCH_BYTES or len(texts) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(flags)], names=["value", "bad"])
            texts, flags, size = [], [], 0
    if texts:
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(flags)], names=["value", "bad"])


def _from_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            store, inner = fs.FileSystem.from_uri(_uri(path))
            packed = _compression(path)
            yield from _batches(file_elements(
                lambda: store.open_input_stream(inner, compression=packed), None if packed else size))


def _from_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, path in enumerate(batch.column(0).to_pylist()):
            content, packed = batch.column(2)[i].as_buffer(), _compression(path)

            def opened():
                reader = pa.BufferReader(content)
                return pa.CompressedInputStream(reader, packed) if packed else reader

            yield from _batches(file_elements(opened, None if packed else content.size))


def array_elements(files: DataFrame, path: str) -> DataFrame:
    """(value string, bad boolean): the elements of the listed ``files``, a
    binaryFile frame or stream over ``path``. ``value`` is the text of one
    element, or a stretch of a file that is no whole array, marked ``bad``."""
    if opens_with_arrow(path):
        rows = files.select("path", "length").mapInArrow(_from_paths, ELEMENTS)
    else:
        rows = files.select("path", "length", "content").mapInArrow(_from_contents, ELEMENTS)
    return rows.select(F.col("value").cast("string").alias("value"), "bad")
