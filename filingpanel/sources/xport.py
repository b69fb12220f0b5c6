"""SAS transport files of the historical quarters, loose or in ZIP archives."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.constants import CALL_NAME, CENTURY_FROM, CODE_COLUMN, ID_COLUMN
from filingpanel.functions.periods import period_from_call_name, quarter_label
from filingpanel.operators.columns import find_filer_column
from filingpanel.sources import cells, slices
from filingpanel.sources.files import open_file, plain_name, read_files

PATTERN = "*.{xpt,zip}"
# What the decoder returns for a stored zero: 16 to the power of -65, the format's least exponent.
_STORED_ZERO = 2.0**-260


def read_xport(
    spark: SparkSession,
    paths,
    start: dt.date | None = None,
    end: dt.date | None = None,
    blank_is_data: bool = True,
    pattern: str = PATTERN,
    skip_quarters: Sequence[str] = (),
    keep: Column | None = None,
) -> DataFrame:
    """Decoded rows (``cells.CELL_SCHEMA``) of the quarter files below ``paths``.

    Files whose own name has a quarter outside [start, end], or one to skip, are never opened. An
    archive without a quarter in its name is opened, but a member that is not wanted is not decoded.
    """
    wanted = name_wanted(plain_name(), start, end, skip_quarters)
    files = read_files(spark, paths, pattern, keep=wanted if keep is None else wanted & keep)
    return decode_xport(files, start, end, blank_is_data, skip_quarters)


def name_state(name: Column, start: dt.date | None, end: dt.date | None, skip_quarters: Sequence[str]) -> Column:
    """Why a file is not opened, from its name alone; null where it is."""
    period = period_from_call_name(name)
    outside = F.lit(False)
    if start is not None:
        outside = outside | (period < F.lit(start))
    if end is not None:
        outside = outside | (period > F.lit(end))
    skipped = quarter_label(period).isin(*skip_quarters) if skip_quarters else F.lit(False)
    undated = period.isNull() & ~F.lower(name).endswith(".zip")
    state = F.when(undated, cells.UNDATED).when(F.coalesce(outside, F.lit(False)), cells.OUT_OF_RANGE)
    return state.when(F.coalesce(skipped, F.lit(False)), cells.SKIPPED)


def name_wanted(name: Column, start: dt.date | None, end: dt.date | None, skip_quarters: Sequence[str]) -> Column:
    return name_state(name, start, end, skip_quarters).isNull()


def decode_xport(
    files: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    blank_is_data: bool = True,
    skip_quarters: Sequence[str] = (),
) -> DataFrame:
    """Decode files given as ``(path, file_name, content)``; one quarter file per row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name, content in zip(*(batch.column(i) for i in range(3))):
                path, name = path.as_py(), name.as_py()
                try:
                    yield from _cut_file(path, name, content.as_py(), start, end, tuple(skip_quarters))
                except cells.DECODE_ERRORS as problem:
                    yield slices.slice_batch(
                        path=path,
                        source_name=name,
                        member_ordinal=cells.WHOLE_FILE,
                        error=cells.error_text(problem),
                    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = slices.pieces_of(batches)
        yield from cells.regrouped(decoded for piece in pieces for decoded in _parse_slice(piece, blank_is_data))

    pieces = files.select("path", "file_name", "content").mapInArrow(cut, slices.SLICE_SCHEMA)
    dated = pieces.withColumn("period", period_from_call_name("source_name"))
    return slices.spread(dated).mapInArrow(parse, cells.CELL_SCHEMA)


def _state_of(name: str, start: dt.date | None, end: dt.date | None, skip: tuple[str, ...]) -> str | None:
    """Why a member's quarter is not decoded; the month's last days decide nothing."""
    match = re.search(CALL_NAME, name.lower())
    year, month = (int(match[1][:2]), int(match[1][2:])) if match else (0, 0)
    if month not in (3, 6, 9, 12):
        return cells.UNDATED
    year += 1900 if year >= CENTURY_FROM else 2000
    low = start.year * 12 + start.month if start else 0
    high = end.year * 12 + end.month if end else year * 12 + month
    if not low <= year * 12 + month <= high:
        return cells.OUT_OF_RANGE
    return cells.SKIPPED if f"{year}Q{month // 3}" in skip else None


def _cut_file(path, name, content, start, end, skip=()) -> Iterator[pa.RecordBatch]:
    with open_file(content) as stream:
        if not name.lower().endswith(".zip"):
            source, member = name, None
        else:
            archive = zipfile.ZipFile(stream)
            slices.check_readable(archive)
            member = next((m for m in archive.namelist() if m.lower().endswith(".xpt")), None)
            if member is None:
                raise ValueError("no transport file in the archive")
            source = member.rsplit("/", 1)[-1]
        state = _state_of(source, start, end, skip)
        if state is not None:
            yield slices.slice_batch(path=path, source_name=source, member_ordinal=cells.WHOLE_FILE, error=state)
        elif member is None:
            yield from _cut_quarter(path, source, stream)
        else:
            with archive:
                yield from _cut_quarter(path, source, io.BytesIO(archive.read(member)))


def _cut_quarter(path: str, source: str, stream: BinaryIO) -> Iterator[pa.RecordBatch]:
    """Rows have a fixed length, so every piece is the file's header with some of its rows."""
    layout = pd.read_sas(stream, format="xport", iterator=True)
    begin, length = layout.record_start, layout.record_length
    stream.seek(0)
    head = stream.read(begin)
    rows = _row_count(stream, begin, length)
    per_slice = max(1, slices.SLICE_BYTES // max(length, 1))
    for number, first in enumerate(range(0, max(rows, 1), per_slice)):
        count = min(per_slice, rows - first)
        stream.seek(begin + first * length)
        yield slices.slice_batch(
            path=path,
            source_name=source,
            member_ordinal=0,
            slice_no=number,
            first_row=first,
            rows=count,
            head=head,
            body=stream.read(count * length),
        )


def _row_count(stream: BinaryIO, begin: int, length: int) -> int:
    """Rows between the header and the blank padding, which can look like rows if they are short."""
    size = stream.seek(0, io.SEEK_END)
    rows = (size - begin) // length if length else 0
    while rows:
        stream.seek(begin + (rows - 1) * length)
        if begin + (rows - 1) * length < size - 79 or stream.read(length).strip(b" "):
            break
        rows -= 1
    return rows


def _parse_slice(piece: dict, blank_is_data: bool) -> Iterator[pa.RecordBatch]:
    if piece["error"] is not None:
        yield cells.error_batch(piece, piece["error"])
        return
    try:
        yield from _decode_slice(piece, blank_is_data)
    except cells.DECODE_ERRORS as problem:
        yield cells.error_batch(piece, problem)


def _decode_slice(piece: dict, blank_is_data: bool) -> Iterator[pa.RecordBatch]:
    body = slices.body_of(piece)
    padding = b" " * (-len(body) % 80)
    reader = pd.read_sas(io.BytesIO(piece["head"] + body + padding), format="xport", iterator=True)
    names = list(reader.columns)
    upper = [n.upper() for n in names]
    if CODE_COLUMN not in upper:
        yield cells.error_batch(piece, f"no {CODE_COLUMN} column")
        return
    numeric = [field["ntype"] == "numeric" for field in reader.fields]
    kept = [i for i, n in enumerate(upper) if n != ID_COLUMN]
    variables = [upper[i] for i in kept]
    if piece["slice_no"] == 0:
        yield cells.header_batch(piece, variables, [numeric[i] for i in kept])
    if not piece["rows"]:
        return
    reader.nobs = piece["rows"]  # known exactly; the reader estimates it from the padding
    rows = reader.read()
    numbers = np.full((len(rows), len(kept)), np.nan)
    texts = np.full((len(rows), len(kept)), None, dtype=object)
    for position, i in enumerate(kept):
        column = rows.iloc[:, i]
        if numeric[i]:
            values = column.to_numpy(dtype=float)
            numbers[:, position] = np.where(np.abs(values) == _STORED_ZERO, 0.0, values)
        else:
            decoded = column.map(_text, na_action="ignore")
            texts[:, position] = decoded if blank_is_data else decoded.where(decoded != "", None)
    id_column = find_filer_column(names)
    ids = pd.Series(np.nan, index=rows.index)
    if id_column is not None:
        ids = np.trunc(pd.to_numeric(rows[id_column], errors="coerce"))
    codes = pd.to_numeric(rows.iloc[:, upper.index(CODE_COLUMN)], errors="coerce")
    codes = codes.where(codes == np.trunc(codes))
    yield cells.value_batch(piece, ids, codes, variables, numbers, texts)


def _text(value) -> str:
    if not isinstance(value, bytes):
        return str(value)
    try:
        return value.decode("utf-8")
    except UnicodeDecodeError:
        return value.decode("latin-1")
