"""Files of any size as blocks of bytes, and the members of archives among them.

A file that does not fit into a row is read by Spark's line reader, which splits it over tasks and uses the
session's own file systems. Lines end at byte 10 and nowhere else, so lines are bytes, and the sums of their
lengths over the splits before say where in the file they stand. Of an archive the end is read first, which lists
the members; blocks then go to the members they belong to, and each member is unpacked as a stream by one
task, whatever its size.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingpanel.session import staged
from filingpanel.sources.files import literal_paths
from filingpanel.sources.slices import pieces_of

#: Bytes that make a block, and bytes of a file's end in which its list of members is looked for first.
BLOCK_BYTES, TAIL_BYTES = 4 << 20, 4 << 20

_LINES = "path string, split long, place int, data binary"
_MEMBERS = "path string, ordinal int, name string, first long, last long, method int, packed long, crc long, problem string, more boolean"
_MEMBERS_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("ordinal", pa.int32()),
        ("name", pa.string()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("method", pa.int32()),
        ("packed", pa.int64()),
        ("crc", pa.int64()),
        ("problem", pa.string()),
        ("more", pa.bool_()),
    ]
)
_LOCAL = struct.Struct("<4s5H3I2H")


def _same_path(path: Column) -> Column:
    """A path in one form: listings have ``file:/a b`` where the metadata of rows has ``file:///a%20b``."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def line_blocks(files: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """``(path, length, split, place, data)`` of files given as ``(path, length)``; the driver sees their paths.

    Blocks are whole lines, each with an end, in order by ``split`` and ``place``. The reader does not tell whether a file's
    last line has one. A mark of UTF-8 that begins a file is left out, as the line reader does.
    """
    spark, block_bytes = files.sparkSession, block_bytes or BLOCK_BYTES
    lines = spark.read.option("lineSep", "\n").text(literal_paths(files))
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("line"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, at, place = [], 0, None, 0

        def block() -> pa.RecordBatch:
            nonlocal held, size, place
            data = b"".join(held)
            held, size, place = [], 0, place + 1
            return pa.RecordBatch.from_pydict({"path": [at[0]], "split": [at[1]], "place": pa.array([place], pa.int32()), "data": [data]})

        for batch in batches:
            paths, splits, lines = batch.columns
            lines = pc.binary_join_element_wise(lines.cast(pa.binary()), b"", b"\n")
            ends, data = np.frombuffer(lines.buffers()[1], "int32")[lines.offset : lines.offset + len(lines) + 1], lines.buffers()[2]
            begin = 0
            for end in run_ends(paths, splits):
                own = paths[begin].as_py(), splits[begin].as_py()
                if own != at:
                    if held:
                        yield block()
                    at, place = own, 0
                while begin < end:
                    # Up to the line that fills the block.
                    until = min(end, int(np.searchsorted(ends, int(ends[begin]) + block_bytes - size)))
                    held.append(data[int(ends[begin]) : int(ends[until])].to_pybytes())
                    size, begin = size + len(held[-1]), until
                    if size >= block_bytes:
                        yield block()
        if held:
            yield block()

    encoded = F.regexp_replace(F.col("path"), r"\+", "%2B")
    blocks = lines.mapInArrow(joined, _LINES).withColumn("path", _same_path(F.url_decode(encoded)))
    listed = files.select(F.col("path").alias("file"), "length", _same_path(F.col("path")).alias("path"))
    return blocks.join(listed, "path").select(F.col("file").alias("path"), "length", "split", "place", "data")


def run_ends(*columns: pa.Array) -> list[int]:
    """Where runs of equal values end."""
    ends = {len(columns[0])} if len(columns[0]) else set()
    for column in columns:
        ends |= set(pc.run_end_encode(column).run_ends.to_pylist())
    return sorted(ends)


def file_blocks(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(path, length, offset, data)`` of files given as ``(path, length)``, written.

    Offsets count from after a mark that the line reader leaves out.
    """
    blocks = staged(line_blocks(files, block_bytes), "blocks")
    before = Window.partitionBy("path").orderBy("split", "place").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("path", "split", "place", F.octet_length("data").cast("long").alias("size"))
    offsets = offsets.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    placed = blocks.join(offsets, ["path", "split", "place"])
    left = F.greatest(F.lit(0), F.least(F.octet_length("data"), F.col("length") - F.col("offset"))).cast("int")
    return placed.select("path", "length", "offset", F.substring(F.col("data"), F.lit(1), left).alias("data")).where("octet_length(data) > 0")


class _Beyond(Exception):
    """What lies before the bytes at hand is asked for."""


class _Tail(io.RawIOBase):
    """A file of which only the end is at hand."""

    def __init__(self, data: bytes, length: int):
        self.data, self.length, self.at = data, length, 0

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.length)[whence]
        if self.at < 0:
            raise OSError("before the beginning")
        return self.at

    def read(self, size: int = -1) -> bytes:
        end = self.length if size < 0 else min(self.length, self.at + size)
        skipped = self.length - len(self.data)
        if self.at < skipped:
            raise _Beyond
        found = self.data[self.at - skipped : end - skipped]
        self.at += len(found)
        return found


def listed_members(path: str, tail: bytes, length: int, wanted: Callable[[str], bool], errors: tuple) -> list[dict]:
    """A row for each wanted member of an archive, or one that tells a problem, or that ``more`` of its end is needed."""
    empty = dict.fromkeys(_MEMBERS_ARROW.names) | {"path": path, "more": False}
    try:
        with zipfile.ZipFile(_Tail(tail, length)) as archive:
            entries = archive.infolist()
            if any(e.flag_bits & 1 for e in entries):
                raise ValueError("the archive is encrypted")
            starts = sorted(e.header_offset for e in entries) + [archive.start_dir]
            after = dict(zip(starts, starts[1:]))
            members = [e for e in entries if wanted(e.filename)]
            return [
                empty | {"ordinal": k, "name": e.filename, "first": e.header_offset, "last": after[e.header_offset], "method": e.compress_type, "packed": e.compress_size, "crc": e.CRC}
                for k, e in enumerate(members)
            ]
    except _Beyond:
        return [empty | {"more": True}]
    except errors as problem:
        return [empty | {"problem": f"{type(problem).__name__}: {problem}"}]


def archive_members(blocks: DataFrame, wanted: Callable[[str], bool], errors: tuple) -> DataFrame:
    """Members of all archives (``_MEMBERS``), written; archives that cannot be read have one row with a ``problem``.

    As much of an archive's end is looked at as its list of members takes: first a little, then more.
    """

    def directory(rows: pa.Table) -> pa.Table:
        found = sorted(rows.to_pylist(), key=lambda r: r["offset"])
        # Offsets may count from after a mark that the reader has left out; no archive begins with one.
        length = found[-1]["offset"] + len(found[-1]["data"])
        tail = b"".join(r["data"] for r in found)
        return pa.Table.from_pylist(listed_members(found[0]["path"], tail, length, wanted, errors), schema=_MEMBERS_ARROW)

    found, size, left = [], TAIL_BYTES, blocks
    while True:
        ends = left.where(F.col("offset") + F.octet_length("data") > F.col("length") - size)
        part = staged(ends.groupBy("path").applyInArrow(directory, _MEMBERS), "members")
        found.append(part.where(~F.col("more")))
        if not part.where("more").limit(1).count():
            break
        left, size = left.join(part.where("more").select("path"), "path", "left_semi"), size * 16
    members = found[0]
    for part in found[1:]:
        members = members.unionByName(part)
    return members


def member_parts(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` with the bytes between ``first`` and ``last``: a row for each block that has some, with its ``offset``.

    Blocks and members meet in cells of equal size, so each is copied once for each cell it lies in.
    """
    cell = BLOCK_BYTES

    def cells(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / cell), F.floor((last - 1) / cell)))

    begin, end = F.col("offset"), F.col("offset") + F.octet_length("data")
    left = blocks.select("path", "offset", "data", cells(begin, end).alias("cell"))
    right = members.select("*", cells(F.col("first"), F.col("last")).alias("cell"))
    meet = F.floor(F.greatest("offset", "first") / cell) == F.col("cell")
    both = left.join(right, ["path", "cell"]).where(meet & (begin < F.col("last")) & (end > F.col("first")))
    skipped = F.greatest(F.lit(0), F.col("first") - begin)
    size = F.least(end, F.col("last")) - begin - skipped
    data = F.substring(F.col("data"), (skipped + 1).cast("int"), size.cast("int"))
    return both.select(*members.columns, (begin + skipped).alias("offset"), data.alias("data"))


class MemberStream(io.RawIOBase):
    """The unpacked bytes of one member, from its parts in order; wrong checksums are found at the end."""

    def __init__(self, parts: Iterator[bytes], method: int | None, packed: int, crc: int):
        self.parts, self.left, self.crc, self.sum, self.waiting = parts, packed, crc, 0, b""
        self.plain = method is None
        self.unpack = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
        if method not in (None, zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            raise NotImplementedError("That compression method is not supported")
        if not self.plain:
            self._skip_header()

    def _skip_header(self) -> None:
        while len(self.waiting) < _LOCAL.size and (part := next(self.parts, None)):
            self.waiting += part
        if len(self.waiting) < _LOCAL.size or self.waiting[:4] != b"PK\x03\x04":
            raise zipfile.BadZipFile("Bad magic number for file header")
        name, extra = _LOCAL.unpack_from(self.waiting)[-2:]
        while len(self.waiting) < _LOCAL.size + name + extra and (part := next(self.parts, None)):
            self.waiting += part
        self.waiting = self.waiting[_LOCAL.size + name + extra :]
        self.source, self.waiting = self.waiting, b""

    def _more(self) -> bytes | None:
        """The next unpacked bytes, or none at the end."""
        if self.plain:
            return next(self.parts, None)
        data, self.source = self.source, b""
        if not data and self.left:
            data = next(self.parts, b"")
            if not data:
                raise EOFError("the member ends early")
        data, self.left = data[: self.left], self.left - min(self.left, len(data))
        if not data:
            if self.sum != self.crc:
                raise zipfile.BadZipFile("Bad CRC-32 for the member")
            return None
        found = self.unpack.decompress(data) if self.unpack else data
        self.sum = zlib.crc32(found, self.sum)
        return found

    def read(self, size: int = -1) -> bytes:
        held, n = [self.waiting], len(self.waiting)
        while size < 0 or n < size:
            found = self._more()
            if found is None:
                break
            held.append(found)
            n += len(found)
        data = b"".join(held)
        size = len(data) if size < 0 else size
        self.waiting = data[size:]
        return data[:size]


def members_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """The members of a task one by one, from ``member_parts`` in order: what is known of each, and its parts."""
    for _, own in groupby(pieces_of(batches), lambda r: (r["path"], r["ordinal"])):
        first = next(own)
        yield first, (r["data"] for r in _again(first, own))


def _again(first: dict, rest: Iterator[dict]) -> Iterator[dict]:
    yield first
    yield from rest
