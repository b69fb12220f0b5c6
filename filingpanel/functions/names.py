"""File paths and sizes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEGABYTE = 1024 * 1024


def base_name(path: Column) -> Column:
    """The last part of a path."""
    return F.regexp_extract(path, r"([^/]*)/?$", 1)


def parent_name(path: Column) -> Column:
    """The name of the folder that holds a path."""
    return F.regexp_extract(path, r"([^/]*)/[^/]*/?$", 1)


def megabytes(length: Column) -> Column:
    """Bytes as MB of 1024 x 1024 bytes."""
    return length / F.lit(MEGABYTE)


def decoded_file_name() -> Column:
    """The plain name of the file a row comes from.

    Spark hands out the name URL-encoded; digits of an encoded space would otherwise run into
    the digits of a date. A filter on this expression prunes files before they are opened.
    """
    return F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), r"\+", "%2B"))
