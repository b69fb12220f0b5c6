"""Number and size of files by folder or kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.functions.names import megabytes, parent_name


def folder_of(path: Column, known: Sequence[str]) -> Column:
    """The parent folder's name if it is a known one, else ``Other``."""
    parent = parent_name(path)
    return F.when(parent.isin(*known), parent).otherwise(F.lit("Other"))


def size_by(files: DataFrame, group: Column, name: str = "group") -> DataFrame:
    """``(name, files, size_mb)`` per group of a file listing ``(path, length, ...)``."""
    return files.groupBy(group.alias(name)).agg(
        F.count("*").alias("files"), F.sum(megabytes(F.col("length"))).alias("size_mb")
    )


def partition_sizes(files: DataFrame, keys: Sequence[str] = ("entity_type", "quarter")) -> DataFrame:
    """``(*keys, file_size_mb, file_path)`` of a dataset written with ``keys`` as partition folders."""
    values = {k: F.url_decode(F.regexp_extract("path", rf"{k}=([^/]+)/", 1)) for k in keys}
    return (
        files.withColumns(values)
        .groupBy(*keys)
        .agg(
            F.sum(megabytes(F.col("length"))).alias("file_size_mb"),
            F.min("path").alias("file_path"),
        )
    )
