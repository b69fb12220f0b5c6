"""Text cleaning and tolerant parsing as column expressions."""

from __future__ import annotations

import html
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from filingpanel.constants import NA_TOKENS

# Java's own \s is ASCII only; (?U) adds the Unicode spaces, and the four separators
# \x1c-\x1f count as white space in the delimited sources' cleaning rule too.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
_TAG = r"<[^>]+>"
_NUMBER = r"^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))$"

# A time of day at the end of a date, with or without seconds, fractions, AM or PM, and a zone.
_TIME = r"[T ]+\d{1,2}:\d\d(?::\d\d(?:\.\d+)?)?\s*(?:[AP]\.?M\.?)?\s*(?:Z|UTC|GMT|[+-]\d\d:?\d\d)?$"
_WEEKDAY = r"^(?:MON|TUE|WED|THU|FRI|SAT|SUN)[A-Z]*,? +"

# The forms of a date without its time, in capitals: a pattern, and which of its groups are year, month and day.
_DATE_FORMS = (
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$", 1, 2, 3),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})$", 3, 1, 2),
    (r"^(\d{4})(\d{2})(\d{2})$", 1, 2, 3),
    (r"^(\d{1,2})[- ]([A-Z]{3,9})\.?,?[- ](\d{4}|\d{2})$", 3, 2, 1),
    (r"^([A-Z]{3,9})\.? (\d{1,2}),? +(\d{4}|\d{2})$", 3, 1, 2),
)
_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
# Two-digit years from here on belong to the 1900s, as in the C library's %y.
_OLD_FROM = 69


# What html.unescape takes for an entity, known or not.
_ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@F.pandas_udf(ArrayType(StringType()))
def _unescape(entities: pd.Series) -> pd.Series:
    # Spark has no HTML entity decoder. Python sees the entities alone, and never a whole text.
    return entities.map(lambda found: [html.unescape(entity) for entity in found])


# A condition on the result would otherwise be pushed below it and decode every text twice.
_unescape = _unescape.asNondeterministic()


def clean_text(text: Column) -> Column:
    """Entities decoded, then tags removed, then white space collapsed and trimmed; null gives ''."""
    whole = F.coalesce(text, F.lit(""))
    between = F.split(whole, _ENTITY, -1)
    entities = _unescape(F.regexp_extract_all(whole, F.lit(_ENTITY), F.lit(0)))
    decoded = F.array_join(F.flatten(F.zip_with(between, entities, lambda part, entity: F.array(part, entity))), "")
    untagged = F.regexp_replace(decoded, _TAG, "")
    return F.trim(F.regexp_replace(untagged, _SPACES, " "))


def na_to_null(text: Column) -> Column:
    """Null for the texts that delimited readers treat as missing."""
    return F.when(~text.isin(*NA_TOKENS), text)


def parse_number(text: Column) -> Column:
    """Text as DOUBLE, null where it is no plain decimal number.

    The pattern keeps out what a Spark cast alone would accept, such as ``1d``.
    """
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def parse_filer_id(text: Column) -> Column:
    """Text as BIGINT filer id, truncated towards zero; null where it is no finite number."""
    return parse_number(text).try_cast("bigint")


def parse_date(text: Column) -> Column:
    """Text as DATE: numbers or month names in any usual order, with or without a time; null where there is no date.

    ``a/b/yyyy`` is month before day unless only the other order is a date. A time of day and a zone
    after it are left out, and letters may have any case.
    """
    bare = F.regexp_replace(F.regexp_replace(F.upper(F.trim(text)), _WEEKDAY, ""), _TIME, "")

    def read(date: Column) -> Column:
        found = F.lit(None).cast("date")
        for form, year, month, day in reversed(_DATE_FORMS):
            y, m, d = (F.regexp_extract(date, form, group) for group in (year, month, day))
            old = F.when(F.length(y) < 4, F.when(y.try_cast("int") >= _OLD_FROM, F.lit("19")).otherwise(F.lit("20"))).otherwise(F.lit(""))
            if "[A-Z]" in form:
                place = F.position(F.substring(m, 1, 3), F.lit(_MONTHS))
                m = F.when(place % 3 == 1, ((place + 2) / 3).cast("int").cast("string"))
            whole = _date_of(F.concat(old, y), m, d)
            if year == 3 and month == 1 and "[A-Z]" not in form:
                whole = F.coalesce(whole, _date_of(F.concat(old, y), d, m))
            found = F.when(date.rlike(form), whole).otherwise(found)
        return found

    # Bound once: the stripped text is looked at by every form.
    return F.element_at(F.transform(F.array(bare), read), 1)


def _date_of(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def decode_bytes(content: Column) -> Column:
    """BINARY as text: UTF-8 where the bytes are valid UTF-8, else Latin-1."""
    as_latin1 = F.decode(content, "ISO-8859-1")
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(as_latin1)
