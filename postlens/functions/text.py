"""Lenient parsing and text clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.fixed_values import WHITESPACE, WORD_BREAKS

# Texts that can be whole numbers. try_cast would turn the others into NULL as well,
# but at the price of an exception per cell, some twenty times a good cell's cost.
_WHOLE = r"^\s*[+-]?0*\d{1,19}\s*$"

# try_cast alone would take Java spellings such as '1.5d' or '0x1p3' for numbers.
_DECIMAL = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"

# Full English month names only; also spares an exception per unreadable cell.
_MONTH_DAY = (
    r"(?i)^(January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}$"
)

_BREAK = "([\\s" + re.escape(WORD_BREAKS) + "])"
_MARK = "\u0001 "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_long(c: Column | str) -> Column:
    """Whole number or NULL; fractions, exponents and separators are NULL."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint"))


def safe_double(c: Column | str) -> Column:
    """Floating point number or NULL."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def clean_number(c: Column | str, strip: str) -> Column:
    """Drop every character of ``strip`` (currency signs, separators, blanks)."""
    return F.translate(_col(c), strip, "")


def trim_all(c: Column | str) -> Column:
    """Trim every kind of white space, not only the blank."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return _col(c).isNull() | (trim_all(c) == "")


def extract(c: Column | str, pattern: str) -> Column:
    """First group of the first match, NULL without one.

    The patterns used here never match an empty group, so '' means no match.
    """
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def initcap_words(c: Column | str) -> Column:
    """Capitalise each word, where punctuation and underscores also end words.

    ``initcap`` only sees blanks, so each break is followed by a marked blank
    for the duration of the call.
    """
    marked = F.regexp_replace(F.lower(_col(c)), _BREAK, "$1" + _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def parse_month_day(c: Column | str, year: int) -> Column:
    """'June 8' in the given year as a date; anything else is NULL."""
    day = trim_all(c)
    return F.when(day.rlike(_MONTH_DAY), F.try_to_date(F.concat(day, F.lit(f" {year}")), "MMMM d yyyy"))
