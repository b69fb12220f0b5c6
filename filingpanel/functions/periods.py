"""Reporting periods and quarters as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingpanel.constants import BULK_YEARS, CALL_NAME, CENTURY_FROM, EIGHT_DIGITS

QUARTER_END = "quarter_end"
MONTH_START = "month_start"

def _as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def quarter_index(date: Column | str) -> Column:
    """A running number of quarters; consecutive quarters differ by one across year ends."""
    date = _as_col(date)
    return (F.year(date) * 4 + F.quarter(date) - 1).cast("int")


def label_from_index(index: Column | str) -> Column:
    """``YYYYQn`` of a running quarter number."""
    index = _as_col(index)
    year = F.floor(index / 4).cast("int").cast("string")
    return F.concat(year, F.lit("Q"), (F.pmod(index, F.lit(4)) + 1).cast("int").cast("string"))


def period_from_index(index: Column | str, style: str = QUARTER_END) -> Column:
    """The date that stands for a quarter: its last day, or the first day of its last month."""
    index = _as_col(index)
    month = (F.pmod(index, F.lit(4)) + 1) * 3
    start = F.make_date(F.floor(index / 4).cast("int"), month.cast("int"), F.lit(1))
    return _styled(start, style)


def quarter_label(date: Column | str) -> Column:
    """``YYYYQn`` of a date."""
    date = _as_col(date)
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def quarter_end(date: Column | str) -> Column:
    """The last day of the quarter a date falls into."""
    date = _as_col(date)
    return F.last_day(F.add_months(F.trunc(date, "quarter"), 2))


def reporting_period(date: Column | str, style: str = QUARTER_END) -> Column:
    """The date that stands for the quarter of ``date``."""
    return _styled(F.add_months(F.trunc(_as_col(date), "quarter"), 2), style)


def next_quarter_label(date: Column | str) -> Column:
    """``YYYYQn`` of the quarter after the one ``date`` falls into."""
    return label_from_index(quarter_index(date) + 1)


def _styled(month_start: Column, style: str) -> Column:
    if style == QUARTER_END:
        return F.last_day(month_start)
    if style == MONTH_START:
        return month_start
    raise ValueError(f"unknown period style {style!r}")


def period_from_call_name(name: Column | str) -> Column:
    """Quarter end from a historical file name such as ``call8503.zip``.

    Two-digit years from 76 on belong to the 1900s. Names without the pattern, or with a month
    that ends no quarter, give null.
    """

    def read(number: Column) -> Column:
        year, month = F.floor(number / 100).cast("int"), number % 100
        century = F.when(year >= CENTURY_FROM, 1900).otherwise(2000)
        return F.when(month.isin(3, 6, 9, 12), F.last_day(F.make_date(century + year, month, F.lit(1))))

    return _once(_digits(F.regexp_extract(F.lower(_as_col(name)), CALL_NAME, 1)), read)


def period_from_bulk_name(name: Column | str, style: str = QUARTER_END) -> Column:
    """Period from the first eight digits of a bulk file name, MMDDYYYY before YYYYMMDD.

    Only the plausibility of month, day (1-31) and year (1985-2030) is checked; the quarter
    follows from the month. Names that fit neither order give null.
    """

    def quarter_start(year: Column, month: Column, day: Column) -> Column:
        plausible = year.between(*BULK_YEARS) & month.between(1, 12) & day.between(1, 31)
        return F.when(plausible, F.make_date(year, month, F.lit(1)))

    def read(number: Column) -> Column:
        high, low = F.floor(number / 10_000).cast("int"), number % 10_000
        first, second = F.floor(high / 100).cast("int"), F.floor(low / 100).cast("int")
        return F.coalesce(quarter_start(low, first, high % 100), quarter_start(high, second, low % 100))

    return reporting_period(_once(_digits(F.regexp_extract(_as_col(name), EIGHT_DIGITS, 1)), read), style)


def _digits(found: Column) -> Column:
    """What a pattern has found as a number; null where it found nothing (a cast of the empty text costs an error a row)."""
    return F.when(found != "", found.cast("int"))


def _once(value: Column, read) -> Column:
    """``read`` of a value that is evaluated a single time, however often ``read`` names it."""
    return F.element_at(F.transform(F.array(value), read), 1)


def call_file_name(period: Column | str, suffix: str = ".zip") -> Column:
    """The historical archive name of a quarter: ``call`` + two-digit year + month."""
    return F.concat(F.lit("call"), F.date_format(_as_col(period), "yyMM"), F.lit(suffix))


def clamp(date: Column | str, low: Column, high: Column) -> Column:
    """``date`` moved into [low, high]."""
    return F.least(F.greatest(_as_col(date), low), high)
