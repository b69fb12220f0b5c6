"""Tab-delimited schedules, loose or as members of ZIP archives."""

from __future__ import annotations

import codecs
import csv
import io
import zipfile
from collections.abc import Iterator
from functools import reduce
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.functions.names import base_name
from filingpanel.functions.periods import period_from_bulk_name
from filingpanel.operators.columns import find_filer_column
from filingpanel.session import staged
from filingpanel.sources import cells, slices
from filingpanel.sources.blocks import MemberStream, archive_members, file_blocks, line_blocks, member_parts, members_of
from filingpanel.sources.files import is_archive, open_file, read_files
from filingpanel.sources.headers import unique_names

PATTERN = "*.{txt,csv,zip}"
#: Larger archives, and larger loose files, are read in blocks. Bytes that go through a task as one row are there
#: several times over: in the row, in the row's copy, on their way to Python and in Python.
INLINE_BYTES, LOOSE_BYTES = 256 << 20, 16 << 20
_SURPLUS = "\x00surplus"
LOOSE = "utf-8, ignoring other bytes"


def read_delimited(spark: SparkSession, paths, keep=None, pattern: str = PATTERN, most_bytes: int = INLINE_BYTES) -> DataFrame:
    """Decoded rows (``cells.CELL_SCHEMA``) of all schedules below ``paths``; files over ``most_bytes`` are read in blocks."""
    return decode_delimited(read_files(spark, paths, pattern, keep=keep, most_bytes=most_bytes, loose_bytes=LOOSE_BYTES), most_bytes)


def decode_delimited(files: DataFrame, most_bytes: int = INLINE_BYTES) -> DataFrame:
    """Decode files given as ``(path, file_name, length, content)``; one header, then rows, per member."""
    held = F.col("length") <= F.when(is_archive(F.col("file_name")), most_bytes).otherwise(min(most_bytes, LOOSE_BYTES))
    inside, beyond = files.where(held), files.where(~held)
    cut = inside.select("path", "file_name", "content").mapInArrow(_cut, slices.SLICE_SCHEMA)
    large = beyond.select("path", "file_name", "length")  # known from the listing; content is not read for it
    if large.limit(1).count():
        cut = cut.unionByName(_cut_large(large))
    # Derived once per slice and carried along: the pattern search is too dear to repeat per row.
    dated = cut.withColumn("period", period_from_bulk_name(base_name(F.col("path"))))
    return slices.spread(dated).mapInArrow(_parse, cells.CELL_SCHEMA)


def _cut_large(files: DataFrame) -> DataFrame:
    """Slices of files beyond a row: each loose file, and each member of an archive, is cut as a stream by one task.

    Members are unpacked twice, first to learn their encoding and whether they are whole.
    """
    large = staged(files, "large")
    zipped = is_archive(F.col("file_name"))
    kinds = ((large.where(~zipped), _cut_loose_files), (large.where(zipped), _cut_archives))
    return reduce(DataFrame.unionByName, [cut(own) for own, cut in kinds if own.limit(1).count()])


def _cut_loose_files(files: DataFrame) -> DataFrame:
    """Blocks of lines need no more than their order: they go from the reader to the file's task, and are not written."""
    blocks = line_blocks(files).join(files.select("path", F.col("file_name").alias("name")), "path").withColumn("ordinal", F.lit(0))
    ordered = blocks.repartition("path").sortWithinPartitions("path", "split", "place")
    return ordered.mapInArrow(_cut_loose, slices.SLICE_SCHEMA)


def _cut_loose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for first, parts in members_of(batches):
        try:
            yield from _cut_member(first["path"], first["name"], 0, MemberStream(_up_to(first["length"], parts), None, 0, 0), LOOSE)
        except cells.DECODE_ERRORS as problem:
            yield _failed(first["path"], first["name"], cells.WHOLE_FILE, problem)


def _up_to(length: int, parts: Iterator[bytes]) -> Iterator[bytes]:
    """Without the end that a file's last line does not have: the line reader does not tell."""
    for part in parts:
        part, length = part[:length], length - min(length, len(part))
        if part:
            yield part


def _cut_archives(large: DataFrame) -> DataFrame:
    blocks = staged(file_blocks(large.select("path", "length")), "placed")
    members = archive_members(blocks, lambda name: name.endswith((".txt", ".csv")), cells.DECODE_ERRORS)
    parts = member_parts(blocks, members.where(F.col("problem").isNull())).select("path", "ordinal", "name", "method", "packed", "crc", "offset", "data")
    key = ["path", "ordinal"]
    ordered = parts.where(F.col("method").isNotNull()).repartition(*key).sortWithinPartitions(*key, "offset")
    verdicts = staged(ordered.mapInArrow(_encodings, "path string, ordinal int, encoding string, problem string"), "encodings")
    known = parts.join(verdicts, key, "left").repartition(*key).sortWithinPartitions(*key, "offset")
    cut = known.mapInArrow(_cut_streams, slices.SLICE_SCHEMA)
    broken = members.where(F.col("problem").isNotNull()).join(large.select("path", "file_name"), "path")
    failed = {"path": F.col("path"), "source_name": F.col("file_name"), "member_ordinal": F.lit(cells.WHOLE_FILE), "error": F.col("problem")}
    columns = [failed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in cut.schema]
    return cut.unionByName(broken.select(*columns))


def _stream(first: dict, parts: Iterator[bytes]) -> MemberStream:
    return MemberStream(parts, first["method"], first["packed"] or 0, first["crc"] or 0)


def _encodings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for first, parts in members_of(batches):
        encoding = problem = None
        try:
            encoding = encoding_of(_stream(first, parts))
        except cells.DECODE_ERRORS as found:
            problem = cells.error_text(found)
        row = {"path": first["path"], "ordinal": first["ordinal"], "encoding": encoding, "problem": problem}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("path", pa.string()), ("ordinal", pa.int32()), ("encoding", pa.string()), ("problem", pa.string())]))


def _cut_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for first, parts in members_of(batches):
        if first["problem"] is not None:  # one member that cannot be unpacked rejects its archive, as below that size
            yield _failed(first["path"], first["path"].rsplit("/", 1)[-1], cells.WHOLE_FILE, first["problem"])
            continue
        try:
            yield from _cut_member(first["path"], first["name"], first["ordinal"], _stream(first, parts), first["encoding"] or LOOSE)
        except cells.DECODE_ERRORS as problem:
            yield _failed(first["path"], first["name"], first["ordinal"], problem)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, name, content in zip(*(batch.column(i) for i in range(3))):
            path, name = path.as_py(), name.as_py()
            try:
                with open_file(content.as_buffer()) as stream:
                    yield from _cut_file(path, name, stream)
            except cells.DECODE_ERRORS as problem:
                yield _failed(path, name, cells.WHOLE_FILE, problem)


def _failed(path: str, source: str, ordinal: int, problem: Exception | str) -> pa.RecordBatch:
    return slices.slice_batch(
        path=path, source_name=source, member_ordinal=ordinal, error=cells.error_text(problem)
    )


def _cut_file(path: str, name: str, stream: BinaryIO) -> Iterator[pa.RecordBatch]:
    if not name.lower().endswith(".zip"):
        # A loose file is always read as UTF-8, without the bytes that are not.
        yield from _cut_member(path, name, 0, stream, LOOSE)
        return
    with zipfile.ZipFile(stream) as archive:
        slices.check_readable(archive)
        members = [m for m in archive.namelist() if m.endswith((".txt", ".csv"))]
        for ordinal, member in enumerate(members):
            with archive.open(member) as probe:
                encoding = encoding_of(probe)
            with archive.open(member) as data:
                yield from _cut_member(path, member, ordinal, data, encoding)


def encoding_of(stream) -> str:
    """UTF-8 if every byte of the member fits it, else Latin-1; reads in pieces."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    valid = True
    # Reads to the end in any case: only then is the archive's checksum compared.
    while piece := stream.read(1 << 20):
        try:
            if valid:
                decoder.decode(piece)
        except UnicodeDecodeError:
            valid = False
    try:
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        valid = False
    return "utf-8" if valid else "latin-1"


def _cut_member(path: str, source: str, ordinal: int, data: BinaryIO, encoding: str) -> Iterator[pa.RecordBatch]:
    head = None
    for number, piece in enumerate(slices.text_slices(data)):
        if head is None:
            end = slices.header_end(piece)
            head, piece = piece[:end], piece[end:]
        yield slices.slice_batch(
            path=path,
            source_name=source,
            member_ordinal=ordinal,
            slice_no=number,
            first_row=number * slices.ROWS_PER_SLICE,
            encoding=encoding,
            head=head,
            body=piece,
        )
    if head is None:
        yield _failed(path, source, ordinal, "empty")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = slices.pieces_of(batches)
    yield from cells.regrouped(decoded for piece in pieces for decoded in _parse_slice(piece))


def _parse_slice(piece: dict) -> Iterator[pa.RecordBatch]:
    """Rows with a usable filer id. An error in any slice rejects the member as a whole later on."""
    if piece["error"] is not None:
        yield cells.error_batch(piece, piece["error"])
        return
    encoding, errors = ("utf-8", "ignore") if piece["encoding"] == LOOSE else (piece["encoding"], "strict")
    try:
        names = _names(piece["head"].decode(encoding, errors))
        id_column = find_filer_column(names, mode="first")
        if id_column is None:
            yield cells.error_batch(piece, "no filer id column")
            return
        variables = [n.upper() for n in names if n != id_column]
        if piece["slice_no"] == 0:
            yield cells.header_batch(piece, variables, [None] * len(variables))
        # One column more than the header has: the parser takes the first row of what it is given
        # for regular, however long. Trailing empty fields are no surplus.
        rows = pd.read_csv(
            io.BytesIO(slices.body_of(piece)),
            sep="\t",
            dtype=str,
            header=None,
            names=[*names, _SURPLUS],
            index_col=False,
            encoding=encoding,
            encoding_errors=errors,
        )
        if rows[_SURPLUS].notna().any():
            raise ValueError(f"a row has more than {len(names)} fields")
        ids = pd.to_numeric(rows[id_column], errors="coerce").replace([np.inf, -np.inf], np.nan)
        valid = ids.notna()
        ids = np.trunc(ids[valid])
        rows = rows.loc[valid].drop(columns=[id_column, _SURPLUS])
        # Some rows at a time: only the text of a slice is there as a whole.
        step = -(-cells.BATCH_CELLS // (1 + len(variables)))
        for at in range(0, len(rows), step):
            texts = rows.iloc[at : at + step].to_numpy(dtype=object)
            numbers = np.full(texts.shape, np.nan)
            yield cells.value_batch(piece | {"first_row": piece["first_row"] + at}, ids.iloc[at : at + step], None, variables, numbers, texts)
    except pd.errors.EmptyDataError:
        return  # no rows
    except (ValueError, csv.Error) as problem:
        yield cells.error_batch(piece, problem)


def _names(head: str) -> list[str]:
    """The column names of a header row, after any blank lines."""
    rows = csv.reader(io.StringIO(head.removeprefix("\ufeff"), newline=""), delimiter="\t")
    return unique_names(next((fields for fields in rows if any(f.strip() for f in fields)), []))
