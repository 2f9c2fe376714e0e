"""Cell and header text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes. Spark's trim()
# without a list removes U+0020 only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Java's \s is ASCII unless (?U) is set, and even then misses the four separators.
SPACE = r"(?U)[\s\x1c-\x1f]"

MAX_TITLE = 31

# A first cell with this text marks a filler row.
FILLER = "BLANK"

# Header words and their short forms, replaced in this order as
# plain substrings (so "county" becomes "cty").
KEY_WORDS = (
    ("medicare", "me"),
    ("year", "yr"),
    ("total", "tot"),
    ("enrollment", "enroll"),
    ("original", "orig"),
    ("percentage", "pct"),
    ("without", "wo"),
    ("count", "ct"),
    ("/", "_"),
)


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def non_empty_cells(cells: Column) -> Column:
    """Stripped cells without nulls and blanks; later cells move left into the holes."""
    kept = F.filter(F.transform(cells, stripped), lambda cell: cell != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def is_text_only(cells: Column) -> Column:
    """One non-empty cell that has an ASCII letter. ``cells`` are non-empty cells."""
    return (F.size(cells) == 1) & F.get(cells, F.lit(0)).rlike("[A-Za-z]")


def is_filler(cells: Column) -> Column:
    return F.get(cells, F.lit(0)) == FILLER


def simple_key(header: Column) -> Column:
    """Short lower-case form of a header."""
    key = F.regexp_replace(F.lower(header), f"medicare{SPACE}+advantage", "ma")
    for word, short in KEY_WORDS:
        key = F.replace(key, F.lit(word), F.lit(short))
    return F.regexp_replace(key, f"{SPACE}+", "_")


def sheet_title(file_name: Column) -> Column:
    """Title of a one-sheet file: its name without extension, 31 characters at most. Leading dots begin no extension."""
    stem = F.regexp_replace(file_name, r"(?s)^(.*[^.].*)\.[^.]*$", "$1")
    return F.substring(stem, 1, MAX_TITLE)
