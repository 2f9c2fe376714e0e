"""What a spreadsheet number format shows: decimals, dates, durations.

A format has sections parted by ``;``, the first for positive numbers. In it, text
between quotes and one character behind ``\\`` or ``_`` or ``*`` are literal; square
brackets hold a colour, condition or locale, or ``h``, ``m`` or ``s`` for a duration.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats that show a number as it is.
UNFORMATTED = ("", "General", "@")
DATE_LETTERS, ELAPSED = "dmyhs", ("h", "hh", "m", "mm", "s", "ss")


@lru_cache(maxsize=4096)
def scanned(number_format: str) -> tuple[int | None, bool, bool]:
    """Decimals (None: no digits are shown), whether a date is shown, whether that is a duration."""
    digits, decimals, date, elapsed = False, 0, False, False
    after_point = False
    counting = decimals_done = False
    at = 0
    while at < len(number_format) and number_format[at] != ";":
        c = number_format[at]
        if c == '"' or c == "[":
            close = number_format.find('"' if c == '"' else "]", at + 1)
            if close > 0:
                if c == "[" and number_format[at + 1 : close].lower() in ELAPSED:
                    date = elapsed = True
                at = close + 1
                continue
        elif c in "\\_*":
            at += 2
            counting = False
            continue
        if c.lower() in DATE_LETTERS:
            date = True
        if c == "0" and counting:
            decimals += 1
        elif counting:
            counting, decimals_done = False, decimals > 0
        if c == "." and not decimals_done:
            after_point = counting = True
        digits = digits or c in "0#"
        at += 1
    shown = decimals if after_point and decimals else 0
    return (shown if digits else None), date, elapsed


def decimals_of(number_format: str | None) -> int | None:
    if number_format is None or number_format in UNFORMATTED:
        return None
    return scanned(number_format)[0]


def shown_decimals(number_format: Column) -> Column:
    """:func:`decimals_of` for a column of formats."""

    @F.pandas_udf("int")
    def found(formats: pd.Series) -> pd.Series:
        return pd.Series([decimals_of(f) for f in formats], dtype="Int32")

    return found(number_format)
