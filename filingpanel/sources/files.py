"""File listings, and opening of files inside tasks."""

from __future__ import annotations

import io
import re
from collections.abc import Buffer, Sequence
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.functions.names import base_name, decoded_file_name

# A row cannot hold more than this. Larger delimited files and archives are read in blocks (``sources.blocks``).
MOST_BYTES = 2_000_000_000


def _reader(spark: SparkSession, pattern: str | None, recursive: bool):
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", str(recursive).lower())


def list_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None, recursive: bool = False
) -> DataFrame:
    """``(path, file_name, length, modificationTime)``; no file is opened."""
    listing = _reader(spark, pattern, recursive).load(paths if isinstance(paths, str) else list(paths))
    return listing.select("path", base_name(F.col("path")).alias("file_name"), "length", "modificationTime")


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    pattern: str | None = None,
    recursive: bool = False,
    keep: Column | None = None,
    most_bytes: int = MOST_BYTES,
    loose_bytes: int | None = None,
) -> DataFrame:
    """``(path, file_name, length, content)`` of the files whose name satisfies ``keep``; limits as in ``with_content``.

    ``keep`` is written over ``decoded_file_name()``, which depends on the listing alone: the
    files it rejects are never opened.
    """
    files = _reader(spark, pattern, recursive).load(paths if isinstance(paths, str) else list(paths))
    return with_content(files if keep is None else files.where(keep), most_bytes, loose_bytes, plain_name())


def read_listed(listed: DataFrame, most_bytes: int = MOST_BYTES, loose_bytes: int | None = None) -> DataFrame:
    """``read_files`` of the files of a listing, by ``path``; the driver sees their paths."""
    paths = literal_paths(listed)
    if not paths:
        return listed.sparkSession.createDataFrame([], "path string, file_name string, length bigint, content binary")
    return read_files(listed.sparkSession, paths, most_bytes=most_bytes, loose_bytes=loose_bytes)


def literal_paths(listed: DataFrame) -> list[str]:
    """The paths of a listing, for a reader that takes patterns."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", r["path"]) for r in listed.select("path").collect()]


def with_content(
    files: DataFrame, most_bytes: int = MOST_BYTES, loose_bytes: int | None = None, name: Column | None = None
) -> DataFrame:
    """``(path, file_name, length, content)`` of a file listing; null content where a row is not to hold it.

    That is a file over ``most_bytes``, or over ``loose_bytes`` if it is no archive by its ``name``, which must depend
    on the listing alone. Every file is read by Spark's own reader, with the session's file systems and credentials.
    """
    columns = ("path", base_name(F.col("path")).alias("file_name"), "length")
    length, none = F.col("length"), F.lit(None).cast("binary").alias("content")
    if loose_bytes is None or loose_bytes >= most_bytes:
        inside = files.where(length <= most_bytes).select(*columns, "content")
        return inside.unionByName(files.where(length > most_bytes).select(*columns, none))
    # Conditions one scan each: it opens no file that they reject.
    inside = files.where(length <= loose_bytes).unionByName(files.where((length > loose_bytes) & (length <= most_bytes) & is_archive(name)))
    beyond = files.where((length > most_bytes) | ((length > loose_bytes) & ~is_archive(name)))
    return inside.select(*columns, "content").unionByName(beyond.select(*columns, none))


def is_archive(name: Column) -> Column:
    return F.lower(name).endswith(".zip")


def plain_name() -> Column:
    """The file name to build ``keep`` conditions on."""
    return decoded_file_name()


class _Held(io.RawIOBase):
    """Bytes that something else holds, as a stream that copies no more than what is read."""

    def __init__(self, data):
        self.data, self.at = memoryview(data), 0

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = max(0, offset + (0, self.at, len(self.data))[whence])
        return self.at

    def read(self, size: int | None = -1) -> bytes:
        end = len(self.data) if size is None or size < 0 else self.at + size
        found = bytes(self.data[self.at : end])
        self.at += len(found)
        return found


def open_file(content: Buffer | None) -> BinaryIO:
    """A file's bytes, or a buffer of them, as a seekable stream."""
    if content is None:
        raise ValueError(f"the file has more than {MOST_BYTES} bytes")
    return io.BytesIO(content) if isinstance(content, bytes) else _Held(content)
