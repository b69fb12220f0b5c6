"""Quarter calendars and the files expected for them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.constants import ARCHIVE_FIRST, ARCHIVE_LAST
from filingpanel.functions.periods import call_file_name, clamp, label_from_index, period_from_index, quarter_index


def explode_quarters(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row ``(quarter, period)`` per quarter whose end lies in [start, end], for each row of ``df``.

    Counts quarters, not dates: stepping a date by three months drifts off the quarter ends.
    """
    first = quarter_index(start)
    last = quarter_index(end) - F.when(end < F.last_day(period_from_index(quarter_index(end))), 1).otherwise(0)
    indexes = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return df.select(F.explode(indexes).alias("_q")).select(
        label_from_index("_q").alias("quarter"), period_from_index("_q").alias("period")
    )


def archive_calendar(
    spark: SparkSession,
    start_year: int = 1985,
    end_year: int = 2021,
    first: dt.date = ARCHIVE_FIRST,
    last: dt.date = ARCHIVE_LAST,
) -> DataFrame:
    """The quarters from one year to another for which historical archives are published."""
    start = clamp(F.lit(dt.date(start_year, 3, 31)), F.lit(first), F.lit(last))
    end = F.least(F.lit(dt.date(end_year, 12, 31)), F.lit(last))
    return explode_quarters(spark.range(1), start, end)


def expected_files(calendar: DataFrame, files: DataFrame, name: str = "file_name") -> DataFrame:
    """``(quarter, period, file_name, present)``: the archive of every quarter and whether it is there."""
    there = files.select(F.lower(name).alias("file_name")).distinct().withColumn("_there", F.lit(True))
    expected = calendar.withColumn("file_name", call_file_name("period"))
    return expected.join(there, "file_name", "left").select(
        "quarter", "period", "file_name", F.coalesce("_there", F.lit(False)).alias("present")
    )


def pending_files(calendar: DataFrame, files: DataFrame, name: str = "file_name") -> DataFrame:
    """The expected archives that are not there yet."""
    return expected_files(calendar, files, name).where(~F.col("present")).drop("present")
