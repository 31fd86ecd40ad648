"""Date helpers: find ``dd.mm.yyyy`` tokens in free text, parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date token pattern and its format.
DATE_TOKEN = r"\b(\d{2})\.(\d{2})\.(\d{4})\b"
DATE_FORMAT = "dd.MM.yyyy"


def date_tokens(c: str | Column) -> Column:
    """All ``dd.mm.yyyy`` substrings of a string cell, as an array of text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(col, F.lit(DATE_TOKEN), 0)


def parse_dmy(c: str | Column) -> Column:
    """Parse ``dd.mm.yyyy``; an impossible date such as 31.02.2023 gives NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(DATE_FORMAT)).cast("date")
