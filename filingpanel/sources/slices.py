"""Cutting files into pieces that can be decoded apart.

A first pass opens a file once, in one task, and only cuts its bytes at row ends; the pieces are
then spread evenly over all tasks, where the expensive decoding happens. One archive, member or
file that holds much of the data is thereby decoded by many tasks.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 4 * 1024 * 1024
# A row cannot be longer: it is decoded by one task, from one slice.
MOST_ROW = 256 * 1024 * 1024
# Row numbers of a text slice start here times its number; they order rows, without gaps mattering.
ROWS_PER_SLICE = 1 << 32
SLICE_SCHEMA = (
    "path string, source_name string, member_ordinal int, slice_no int, first_row bigint, rows int, "
    "encoding string, head binary, body binary, body_size int, error string"
)
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("source_name", pa.string()),
        ("member_ordinal", pa.int32()),
        ("slice_no", pa.int32()),
        ("first_row", pa.int64()),
        ("rows", pa.int32()),
        ("encoding", pa.string()),
        ("head", pa.binary()),
        ("body", pa.binary()),
        ("body_size", pa.int32()),
        ("error", pa.string()),
    ]
)

csv.field_size_limit(2**31 - 1)


def slice_batch(body: bytes | None = None, **values) -> pa.RecordBatch:
    """One slice (or, with ``error``, one unreadable member) as a batch of one row.

    The body is compressed here, so what a task receives at a time is bounded by the size of its
    shuffle partition; a slice is unpacked only when its turn comes.
    """
    if body is not None:
        values |= {"body": _codec().compress(body, asbytes=True), "body_size": len(body)}
    return pa.RecordBatch.from_pylist([values], schema=_ARROW)


def body_of(piece: dict) -> bytes:
    """The bytes of a slice."""
    return _codec().decompress(piece["body"], decompressed_size=piece["body_size"], asbytes=True)


def _codec() -> pa.Codec:
    return pa.Codec("lz4")


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of a task, slices for instance, one by one."""
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch.slice(row, 1).to_pylist()[0]
        del batch  # before the next one is read


def check_readable(archive: zipfile.ZipFile) -> None:
    """Encrypted members are bad input, told apart here from mistakes that raise the same error."""
    if any(member.flag_bits & 1 for member in archive.infolist()):
        raise ValueError("the archive is encrypted")


def spread(slices: DataFrame) -> DataFrame:
    """Slices in partitions of even size, whatever file they come from."""
    return slices.hint("rebalance")


def text_slices(stream: BinaryIO, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """The stream's bytes in pieces that end where a row ends.

    A line break inside quotes ends no row. Lines without any quote need no look inside; the others are
    followed field by field, each once, so that a quote that is never closed costs no more than another.
    """
    waiting: list[bytes] = []  # since the last row end
    rest, held, quoted = b"", 0, False
    while piece := stream.read(size):
        end = piece.rfind(b"\n") + 1
        if held + len(rest) > MOST_ROW:
            raise ValueError(f"a row goes on for more than {MOST_ROW} bytes")
        if not end:
            rest += piece
            continue
        lines, rest = rest + piece[:end], piece[end:]
        cut = 0
        if not quoted and b'"' not in lines:
            cut = len(lines)
        else:
            at = 0
            while at < len(lines):
                after = lines.index(b"\n", at) + 1
                quoted = stays_quoted(lines[at:after], quoted)
                cut = cut if quoted else after
                at = after
        if cut:
            yield b"".join([*waiting, lines[:cut]])
            waiting, held = [], 0
        if cut < len(lines):
            waiting.append(lines[cut:])
            held += len(lines) - cut
    if waiting or rest:
        yield b"".join([*waiting, rest])


def stays_quoted(line: bytes, quoted: bool) -> bool:
    """Whether a line ends within quotes, if it begins within (``quoted``) or at the start of a row.

    Quotes count at the start of a field; two of them within one stand for themselves.
    """
    at = 0
    while True:
        if not quoted:
            if line[at : at + 1] == b'"':
                quoted, at = True, at + 1
            else:
                at = line.find(b"\t", at) + 1
                if not at:
                    return False
                continue
        at = line.find(b'"', at) + 1
        if not at:
            return True
        if line[at : at + 1] == b'"':
            at += 1
            continue
        quoted = False
        at = line.find(b"\t", at) + 1
        if not at:
            return False


def _rows_with_ends(data: bytes) -> Iterator[tuple[list[str], int]]:
    """The rows of ``data`` and where each ends."""
    consumed = 0

    def lines() -> Iterator[str]:
        nonlocal consumed
        # Latin-1 maps every byte to one character, so lengths are byte counts.
        for line in io.StringIO(data.decode("latin-1"), newline=""):
            consumed += len(line)
            yield line

    for fields in csv.reader(lines(), delimiter="\t"):
        yield fields, consumed


def header_end(data: bytes) -> int:
    """Where the first row that is not blank ends."""
    ends = (end for fields, end in _rows_with_ends(data) if any(field.strip() for field in fields))
    return next(ends, len(data))
