"""The row shape that all archive decoders emit.

One row per filer row of a member file, with its present values as an array: the path and keys are
stored once per filer instead of once per value, roster reads prune the array away, and value
reads explode it inside Spark. A header row (``row_no`` = -1) lists every column of the member,
so columns without any value stay known. A row with ``error`` marks a member that could not be
read.
"""

from __future__ import annotations

import csv
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

HEADER_ROW = -1
_MEMBER = ("path", "source_name", "member_ordinal", "period")
# Member number of an error that concerns the whole file.
WHOLE_FILE = -1
# Not errors: why a file's quarter, known once its archive was opened, was not decoded.
UNDATED, OUT_OF_RANGE, SKIPPED = "undated", "out_of_range", "skipped"
NOT_DECODED = (UNDATED, OUT_OF_RANGE, SKIPPED)
# Kinds of rows; a staged table is partitioned by them, so that headers and errors are read apart.
ROWS, HEADERS, PROBLEMS = "rows", "headers", "problems"
# What undecodable bytes raise. Errors of reading from a file system are not among them: they
# fail the task, which Spark repeats. Neither are mistakes of the decoding code itself.
DECODE_ERRORS = (
    ValueError,
    EOFError,
    ArithmeticError,
    NotImplementedError,
    csv.Error,
    struct.error,
    zlib.error,
    zipfile.BadZipFile,
)
CELL_SCHEMA = (
    "path string, source_name string, member_ordinal int, period date, row_no bigint, filer_id bigint, "
    "entity_code int, error string, "
    "cells array<struct<variable:string, ordinal:int, num:double, raw:string>>"
)
_CELL = pa.struct(
    [("variable", pa.string()), ("ordinal", pa.int32()), ("num", pa.float64()), ("raw", pa.string())]
)
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("source_name", pa.string()),
        ("member_ordinal", pa.int32()),
        ("period", pa.date32()),
        ("row_no", pa.int64()),
        ("filer_id", pa.int64()),
        ("entity_code", pa.int32()),
        ("error", pa.string()),
        ("cells", pa.list_(_CELL)),
    ]
)


#: Rows and cells that make a batch.
BATCH_CELLS = 200_000


def regrouped(batches: Iterable[pa.RecordBatch], cells: int = BATCH_CELLS) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches: many small members would otherwise travel one by one."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows + len(batch.column("cells").flatten())
        if size >= cells:
            yield from _combined(waiting)
            waiting, size = [], 0
    if waiting:
        yield from _combined(waiting)


def _combined(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return batches if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()


def header_batch(piece: dict, variables: list[str], numeric: list[bool | None]) -> pa.RecordBatch:
    """The header row of a member. ``raw`` of its cells holds a type already known, else null."""
    kinds = [None if n is None else ("double" if n else "string") for n in numeric]
    cells = [
        {"variable": v, "ordinal": i, "num": None, "raw": k} for i, (v, k) in enumerate(zip(variables, kinds))
    ]
    return _one_row(piece, {"row_no": HEADER_ROW, "cells": cells})


def error_batch(piece: dict, problem: Exception | str) -> pa.RecordBatch:
    """A row that marks an unreadable member (or file, if it has the member number ``WHOLE_FILE``)."""
    return _one_row(piece, {"error": error_text(problem)})


def _one_row(piece: dict, values: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{k: piece[k] for k in _MEMBER} | values], schema=_ARROW)


def error_text(problem: Exception | str) -> str:
    return problem if isinstance(problem, str) else f"{type(problem).__name__}: {problem}"


def value_batch(
    piece: dict,
    ids: pd.Series,
    codes: pd.Series | None,
    variables: list[str],
    numbers: np.ndarray,
    texts: np.ndarray,
) -> pa.RecordBatch:
    """Rows with their present values, from one matrix of numbers and one of texts.

    ``numbers`` (float, NaN = absent) and ``texts`` (object, None/NaN = absent) have one column
    per variable; a value is in at most one of them.
    """
    rows, columns = numbers.shape
    has_text = ~pd.isna(texts)
    has_number = ~np.isnan(numbers)
    present = has_text | has_number
    column = np.broadcast_to(np.arange(columns, dtype="int32"), (rows, columns))[present]
    cells = pa.StructArray.from_arrays(
        [
            pa.array(variables, pa.string()).take(pa.array(column)),
            pa.array(column, pa.int32()),
            pa.array(numbers[present], pa.float64(), mask=~has_number[present]),
            pa.array(np.where(has_text, texts, None)[present], pa.string()),
        ],
        fields=list(_CELL),
    )
    offsets = np.concatenate([[0], np.cumsum(present.sum(axis=1))]).astype("int32")

    def same(value, kind):
        return pa.repeat(pa.scalar(value, kind), rows)

    def whole(values: pd.Series | None, kind):
        if values is None:
            return pa.nulls(rows, kind)
        return pa.array(values.to_numpy(dtype=float), from_pandas=True).cast(kind)

    return pa.RecordBatch.from_arrays(
        [
            *[same(piece[k], _ARROW.field(k).type) for k in _MEMBER],
            pa.array(np.arange(rows) + piece["first_row"], pa.int64()),
            whole(ids, pa.int64()),
            whole(codes, pa.int32()),
            pa.nulls(rows, pa.string()),
            pa.ListArray.from_arrays(pa.array(offsets), cells),
        ],
        schema=_ARROW,
    )
