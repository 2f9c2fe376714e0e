"""Which sheets of a workbook are loaded, and in what order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.grid import CELLS, ROW
from gridloom.operators.ordinal import with_ordinal

CONTENTS_SHEET = "Table of Contents"

# First cell of the header row of a contents sheet.
CONTENTS_HEADER = "Table Name"


def listed_sheets(contents: DataFrame, book: Sequence[str]) -> DataFrame:
    """Sheets named by contents sheets: ``sheet_name``, ``description``, ``sheet_index``.

    ``contents`` has the non-empty cells of the contents sheet of each book. A
    name listed twice keeps its first place and its last description.
    """
    book = list(book)
    entries = (
        contents.where(F.size(CELLS) > 1)
        .select(*book, ROW, F.get(CELLS, F.lit(0)).alias("sheet_name"), F.get(CELLS, F.lit(1)).alias("description"))
        .where(F.col("sheet_name") != CONTENTS_HEADER)
        .groupBy(*book, "sheet_name")
        .agg(F.min(ROW).alias("_place"), F.max_by("description", ROW).alias("description"))
    )
    return with_ordinal(entries, book, "_place", "sheet_index").drop("_place")


def select_sheets(sheets: DataFrame, listed: DataFrame, book: Sequence[str], has_contents: str) -> DataFrame:
    """Sheets to load with their ``sheet_index``.

    ``sheets`` has one row per sheet: ``sheet_name``, ``sheet_pos`` and the
    boolean ``has_contents``, the same for all sheets of a book. Books with a
    contents sheet give the listed names in listed order, with a null
    ``sheet_pos`` where the book has no such sheet; other books give all sheets,
    with a null ``description``.
    """
    book = list(book)
    by_list = listed.join(sheets.drop(has_contents), [*book, "sheet_name"], "left")
    in_order = sheets.where(~F.col(has_contents)).withColumn("sheet_index", F.col("sheet_pos").cast("long"))
    return by_list.unionByName(in_order.drop(has_contents), allowMissingColumns=True)
