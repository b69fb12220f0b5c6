"""Column names and order of a wide filing table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.constants import ID_COLUMN, PERIOD_COLUMN
from filingpanel.functions.periods import QUARTER_END, reporting_period

# Exact names tried in turn for the filer id, and names that only look like one.
_ID_PRIORITY = ("RSSD9001", "IDRSSD", "RSSD_ID")
_ID_LOOKALIKES = ("RSSD9999", "RSSDDATE")


def upper_columns(df: DataFrame) -> DataFrame:
    """All column names in upper case."""
    return df.toDF(*[c.upper() for c in df.columns])


def order_columns(df: DataFrame, lead: Sequence[str], rest: str = "original") -> DataFrame:
    """Lead columns first, the others in their original or in sorted order."""
    if rest not in ("original", "sorted"):
        raise ValueError(f"unknown order {rest!r}")
    others = [c for c in df.columns if c not in lead]
    if rest == "sorted":
        others = sorted(others)
    return df.select(*[c for c in lead if c in df.columns], *others)


def find_filer_column(columns: Sequence[str], mode: str = "priority") -> str | None:
    """The column that holds the filer id.

    ``priority`` tries the known names first (as written) and then the first name containing
    RSSD that is no lookalike; ``first`` takes the first name containing RSSD.
    """
    candidates = [c for c in columns if "RSSD" in c.upper()]
    if mode == "first":
        return next(iter(candidates), None)
    if mode != "priority":
        raise ValueError(f"unknown mode {mode!r}")
    known = [name for name in _ID_PRIORITY if name in columns]
    fallback = [c for c in candidates if c.upper() not in _ID_LOOKALIKES]
    return next(iter(known + fallback), None)


def attach_filer_id(df: DataFrame, mode: str = "priority", name: str = ID_COLUMN) -> DataFrame:
    """Add the filer id. ``priority`` keeps its source column, ``first`` renames it."""
    source = find_filer_column(df.columns, mode)
    if source is None:
        if mode == "first":
            raise ValueError(f"no filer id among {df.columns[:10]}")
        return df
    if mode == "first":
        return df.withColumnRenamed(source, name)
    return df if source == name else df.withColumn(name, F.col(source))


def attach_period(
    df: DataFrame, date: Column | str, style: str = QUARTER_END, name: str = PERIOD_COLUMN
) -> DataFrame:
    """Add the reporting period of a date."""
    return df.withColumn(name, reporting_period(date, style))
