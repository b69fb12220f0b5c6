"""Fixed values of the filing domain.

These have to equal the published codes, form names and file-name patterns for results to
agree with other users of the same filings, so they are stated plainly and kept together.
"""

from __future__ import annotations

import datetime as dt

# Filer type -> filer type codes, and the names of the forms each type files.
ENTITY_CODES = {
    "FFIEC_031_041": (1,),
    "FFIEC_002": (10, 11),
    "FRB_2886b": (13, 17),
}
ENTITY_FORMS = {
    "FFIEC_031_041": (
        "FFIEC 031",
        "FFIEC 041",
        "FFIEC 032",
        "FFIEC 033",
        "FFIEC 034",
        "FFIEC 051",
    ),
    "FFIEC_002": ("FFIEC 002", "FFIEC 002s"),
    "FRB_2886b": ("FR 2886b", "FR 2886a"),
}

# Commercial banks come from the bulk archives after this quarter.
CUTOFF_ENTITY = "FFIEC_031_041"
CUTOFF_PERIOD = dt.date(2010, 12, 31)

# Dictionary prefixes that belong to the filings.
DICTIONARY_PREFIXES = (
    "RCON",
    "RCFD",
    "RIAD",
    "RCFA",
    "RCFN",
    "RCFW",
    "RCOA",
    "RCOW",
)

# Lead columns of every panel, and columns that pruning never drops.
ID_COLUMN = "RSSD_ID"
PERIOD_COLUMN = "REPORTING_PERIOD"
CODE_COLUMN = "RSSD9331"
LEAD_COLUMNS = (PERIOD_COLUMN, ID_COLUMN)
ALWAYS_KEEP_HISTORICAL = ("REPORTING_PERIOD", "RSSD_ID", "RSSD9001", "RSSD9331", "IDRSSD")
ALWAYS_KEEP_BULK = ("REPORTING_PERIOD", "RSSD_ID", "RSSD9001", "IDRSSD")

# Quarters for which historical archives are published.
ARCHIVE_FIRST = dt.date(1976, 3, 31)
ARCHIVE_LAST = dt.date(2021, 6, 30)

# File-name patterns. A historical name holds two digits of the year and two of the
# month; two-digit years from 76 on belong to the 1900s. A bulk name holds a date of eight digits.
BULK_YEARS = (1985, 2030)
CALL_NAME = r"call?p?(\d{4})"
CENTURY_FROM = 76
EIGHT_DIGITS = r"(\d{8})"

# Texts that the default missing-value rule of delimited readers treats as null.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
