"""Date scalars: F12-F14.  Dates travel as ``dd/mm/yyyy`` text, as in the
certificates; parsing is lenient on one-digit day/month like ``%d/%m/%Y``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, first_match

# Date formats and patterns.
DMY_IN = "d/M/yyyy"      # accepts 1/2/2024 and 01/02/2024
DMY_OUT = "dd/MM/yyyy"

ROW_END_DATE = r"(?d)(\d{2}/\d{2}/\d{4})$"
ANY_DATE = r"\b(\d{2}/\d{2}/\d{4})\b"
DASHED_DATE = r"(\d{2}-\d{2}-\d{4})"


def parse_dmy(s) -> Column:
    """Text -> DATE, null when it is not a valid day/month/year."""
    return F.try_to_date(col_(s), DMY_IN)


def date_normalise(s) -> Column:
    """re-render a day/month/year date zero-padded; null when invalid."""
    return F.date_format(parse_dmy(s), DMY_OUT)


def date_plus_180(s) -> Column:
    """"six months" in the rules is exactly 180 days (not add_months)."""
    return F.date_format(F.date_add(parse_dmy(s), 180), DMY_OUT)


def date_search(text, kind: str = "anywhere") -> Column:
    """``row_end`` (a date closing the text), ``anywhere`` (first whole
    date) or ``dashed`` (``dd-mm-yyyy`` rewritten with slashes)."""
    t = col_(text)
    if kind == "row_end":
        return first_match(t, ROW_END_DATE, 1)
    if kind == "anywhere":
        return first_match(t, ANY_DATE)
    if kind == "dashed":
        return F.replace(first_match(t, DASHED_DATE, 1), F.lit("-"), F.lit("/"))
    raise ValueError(f"unknown date search {kind!r}")
