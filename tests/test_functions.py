import datetime as dt
import html
import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filingpanel.functions import names, periods, text
from filingpanel.operators import quarters


def values(spark, inputs, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_period_from_call_name(spark):
    found = values(
        spark,
        ["call8503.zip", "CALL1012.XPT", "call2106.zip", "callp7609", "cal7512", "call8504.zip", "other.zip", None],
        periods.period_from_call_name,
    )
    assert found == [
        dt.date(1985, 3, 31), dt.date(2010, 12, 31), dt.date(2021, 6, 30), dt.date(1976, 9, 30), dt.date(2075, 12, 31),
        None, None, None,
    ]


def test_period_from_bulk_name(spark):
    inputs = [
        "FFIEC_20240630.txt", "Call_20240630.txt", "FFIEC CDR Call Bulk All Schedules 03312011.zip", "x 05152012.zip",
        "Call_20241345.txt", "Call_99999999.txt", "Call_2024.txt", "01012031.txt",
    ]
    ends = values(spark, inputs, periods.period_from_bulk_name)
    assert ends == [
        dt.date(2024, 6, 30), dt.date(2024, 6, 30), dt.date(2011, 3, 31), dt.date(2012, 6, 30), None, None, None, None,
    ]
    starts = values(spark, inputs, lambda c: periods.period_from_bulk_name(c, periods.MONTH_START))
    assert starts[:3] == [dt.date(2024, 6, 1), dt.date(2024, 6, 1), dt.date(2011, 3, 1)]
    with pytest.raises(ValueError):
        periods.period_from_bulk_name("v", "other")


def test_quarter_arithmetic_wraps_years(spark):
    days = [dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2020, 5, 17)]
    assert values(spark, days, periods.quarter_label, "date") == ["2019Q4", "2020Q1", "2020Q2"]
    assert values(spark, days, periods.next_quarter_label, "date") == ["2020Q1", "2020Q2", "2020Q3"]
    assert values(spark, days, periods.quarter_end, "date") == [
        dt.date(2019, 12, 31), dt.date(2020, 3, 31), dt.date(2020, 6, 30)
    ]
    back = values(spark, days, lambda c: periods.period_from_index(periods.quarter_index(c), periods.MONTH_START), "date")
    assert back == [dt.date(2019, 12, 1), dt.date(2020, 3, 1), dt.date(2020, 6, 1)]


def test_archive_calendar(spark, rows):
    assert quarters.archive_calendar(spark).count() == 146
    everything = quarters.archive_calendar(spark, 1950, 2030)
    assert everything.count() == 182
    listed = rows(everything)
    assert listed[0] == ("1976Q1", dt.date(1976, 3, 31)) and listed[-1] == ("2021Q2", dt.date(2021, 6, 30))
    assert quarters.archive_calendar(spark, 2022, 2025).count() == 1
    assert rows(quarters.archive_calendar(spark, 2020, 2020)) == [
        (f"2020Q{q}", d) for q, d in enumerate(
            [dt.date(2020, 3, 31), dt.date(2020, 6, 30), dt.date(2020, 9, 30), dt.date(2020, 12, 31)], 1
        )
    ]


def test_expected_files(spark, rows):
    files = spark.createDataFrame([("call2003.zip",), ("call2009.zip",), ("call2009.zip",)], "file_name string")
    calendar = quarters.archive_calendar(spark, 2020, 2020)
    assert rows(quarters.expected_files(calendar, files), "file_name", "present") == [
        ("call2003.zip", True), ("call2006.zip", False), ("call2009.zip", True), ("call2012.zip", False)
    ]
    assert rows(quarters.pending_files(calendar, files), "quarter") == [("2020Q2",), ("2020Q4",)]


def clean(value):
    if value is None:
        return ""
    return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", html.unescape(value))).strip()


TRICKY = [
    None, "", "  ", "Total&nbsp;assets", "&lt;b&gt;x&lt;/b&gt;&nbsp;y", "a<br/>b", "1 < 2 and 3 > 2", "&ampx &copy",
    "a\x1cb\x85c d　e\x0bf", "&amp;lt;i&amp;gt;", "<a\nhref='x'>y</a>", "x<>y", "﻿z", "​q",
]


def test_clean_text_order_of_steps(spark):
    assert values(spark, TRICKY, text.clean_text) == [clean(v) for v in TRICKY]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab&;<>/ltgnbspqu \t\n\xa0 \x1d#0"), max_size=30), min_size=50, max_size=60))
def test_clean_text_like_python(spark, texts):
    assert values(spark, texts, text.clean_text) == [clean(v) for v in texts]


def test_numbers_like_pandas(spark):
    written = [
        "1", " 12 ", "-3.5", "+4", ".5", "5.", "1e3", "1E-2", "inf", "-Infinity", "1d", "0x1A", "1_0", "12.5%", "1,000",
        "e5", "--1", "1f", "1 2", "NA", "",
    ]
    found = values(spark, written, lambda c: text.parse_number(text.na_to_null(c)))
    expected = pd.to_numeric(pd.Series(written), errors="coerce")
    assert [None if v is None else v for v in found] == [None if pd.isna(v) else v for v in expected]


def test_filer_ids_truncate(spark):
    written = ["12", "12.9", "-1.5", "1e2", "inf", "x", None, "nan", "1e30"]
    assert values(spark, written, text.parse_filer_id) == [12, 12, -1, 100, None, None, None, None, None]


def test_na_tokens(spark):
    assert values(spark, ["NA", "N/A", "", "null", "NULL", "<NA>", "na", "0", " "], text.na_to_null) == [
        None, None, None, None, None, None, "na", "0", " "
    ]


def test_dates(spark):
    written = ["12/31/9999 12:00:00 AM", "3/1/2001", "2001-03-31", "20010331", "31-Mar-2001", "2001-03-31 10:11:12", "open", None, "13/45/2001"]
    assert values(spark, written, text.parse_date) == [
        dt.date(9999, 12, 31), dt.date(2001, 3, 1), dt.date(2001, 3, 31), dt.date(2001, 3, 31), dt.date(2001, 3, 31),
        dt.date(2001, 3, 31), None, None, None,
    ]


def test_decode_bytes(spark):
    assert values(spark, ["é".encode(), "é".encode("latin-1"), b"plain", b"\xff\xfe"], text.decode_bytes, "binary") == [
        "é", "é", "plain", "ÿþ"
    ]


def test_path_parts(spark):
    paths = ["file:/a/FFIEC_002/2020Q1.parquet", "/x/y.z/call.tar.gz", "plain"]
    assert values(spark, paths, names.base_name) == ["2020Q1.parquet", "call.tar.gz", "plain"]
    assert values(spark, paths, names.parent_name) == ["FFIEC_002", "y.z", ""]
    assert values(spark, [1048576, 524288], names.megabytes, "bigint") == [1.0, 0.5]
