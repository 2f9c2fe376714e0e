"""From ragged sheet rows to long key/value rows.

A *grid* has one row per sheet row: the columns that name the sheet, a 0-based
``row_idx`` and ``cells``, an array of strings. The first row with more than one
non-empty cell is the header; a later row with a single text cell is a heading
for the rows under it; every other row is data.

Headings and row numbers depend on all earlier rows of the sheet. Sheets have no
size bound, so a window over a whole sheet would put the largest one into one
task. Rows are shuffled by (sheet, chunk of rows) instead: windows run inside
chunks, one summary row per chunk carries the state across them, and a join on
the same key brings it back. Both sides of that join read the same shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text

CHUNK_ROWS = 32_768

PAIRS = "array<struct<table_key: string, table_key_simple: string, table_val: string>>"

ROW = "row_idx"
CELLS = "cells"


def compact(grid: DataFrame) -> DataFrame:
    """Cells without blanks, rows without cells left out.

    The cells pass through a one-element generator: the optimizer substitutes a
    plain projection into every filter above it and would strip each cell once
    per filter.
    """
    others = [c for c in grid.columns if c != CELLS]
    stripped = F.array(F.struct(text.non_empty_cells(F.col(CELLS)).alias(CELLS)))
    return grid.select(*others, F.inline(stripped)).where(F.size(CELLS) > 0)


def later_twin(head: Column) -> Column:
    """Per header cell, where its name comes next; null when no name comes twice.

    Lets a row of n cells drop the positions that a later one overrides
    (``twin < n``) without comparing names again.
    """
    twins = F.transform(
        head,
        lambda name, at: F.array_position(F.slice(head, at + 2, F.size(head)), name).cast("int"),
    )
    placed = F.transform(twins, lambda step, at: F.when(step > 0, at + step))
    return F.when(F.size(F.array_distinct(head)) < F.size(head), placed)


def paired_positions(width: Column, twin: Column) -> Column:
    """Positions 1..width-1 whose value is kept in a row of ``width`` cells."""
    positions = F.when(width > 1, F.sequence(F.lit(1), width - 1)).otherwise(F.array().cast("array<int>"))
    kept = F.filter(positions, lambda at: F.coalesce(F.get(twin, at) >= width, F.lit(True)))
    return F.when(twin.isNull(), positions).otherwise(kept)


def pair_count(width: Column, twin: Column) -> Column:
    return F.when(twin.isNull(), F.greatest(width - 1, F.lit(0))).otherwise(F.size(paired_positions(width, twin)))


def number_rows(
    compacted: DataFrame,
    sheet: Sequence[str],
    sheets: DataFrame | None = None,
    fitting: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Data rows with their heading, 0-based index and header.

    ``compacted`` comes from :func:`compact`. ``sheets`` names the sheets to keep
    and adds its other columns; it is joined to the chunk summaries, not to the
    rows, so a sheet that holds much of the data stays spread out. ``fitting``
    leaves out sheets that have a row wider than their header.

    Adds ``heading``, ``table_row_index``, ``head``, ``head_keys`` and ``twin``.
    """
    sheet = list(sheet)
    # One key that is never null, so that rows of a sheet with a null in its name meet too.
    key = F.struct(*sheet).alias("_sheet")
    chunk = ["_sheet", "_chunk"]
    extras = [c for c in sheets.columns if c not in sheet] if sheets is not None else []
    cells = F.col(CELLS)
    in_chunk = Window.partitionBy(*chunk).orderBy(ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    shuffled = (
        compacted.select(key, F.col(ROW), cells)
        # A lone filler cell is no header, heading or data; wider filler rows can be headers.
        .where((F.size(CELLS) > 1) | ~text.is_filler(cells))
        .withColumn("_chunk", F.floor(F.col(ROW) / chunk_rows))
        # The filters and the explicit shuffle make the exchange the same on both
        # sides of the join, so that it runs once.
        .where(_all_present([*chunk, ROW]))
        .repartition(*chunk)
    )
    carried = _carry(shuffled, ["_sheet"], sheets.select(key, *extras) if sheets is not None else None, fitting)

    rows = shuffled.withColumn("_data", _is_data()).select(
        "*",
        F.sum(F.col("_data").cast("long")).over(in_chunk).alias("_seen"),
        F.last(_heading(), True).over(in_chunk).alias("_heading"),
    )
    heading = F.coalesce("_heading", "_heading_before")
    return (
        # Rows are already partitioned and sorted by the key: merging moves only the carry.
        rows.join(carried.hint("merge"), chunk)
        .where(F.col("_data") & (F.col(ROW) > F.col("_head.at")))
        .select(
            *(F.col("_sheet")[c].alias(c) for c in sheet),
            *extras,
            ROW,
            F.when(heading["at"] > F.col("_head.at"), heading["text"]).otherwise("").alias("heading"),
            (F.col("_seen_before") + F.col("_seen") - F.col("_head.seen") - 1).alias("table_row_index"),
            CELLS,
            F.col("_head.cells").alias("head"),
            "head_keys",
            "twin",
        )
    )


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda left, right: left & right, (F.col(c).isNotNull() for c in columns))


def _is_data() -> Column:
    return ~text.is_text_only(F.col(CELLS)) & ~text.is_filler(F.col(CELLS))


def _heading() -> Column:
    """Place and text of a heading row, null in other rows."""
    cells = F.col(CELLS)
    return F.when(text.is_text_only(cells), F.struct(F.col(ROW).alias("at"), F.get(cells, F.lit(0)).alias("text")))


def _carry(shuffled: DataFrame, sheet: list[str], sheets: DataFrame | None, fitting: bool) -> DataFrame:
    """Per chunk: the header of its sheet and what the chunks before it add up to."""
    row, data, wide = F.col(ROW), _is_data(), F.size(CELLS) > 1
    chunks = (
        shuffled.groupBy(*sheet, "_chunk")
        .agg(
            F.min_by(F.struct(row.alias("at"), F.col(CELLS).alias("cells")), F.when(wide, row)).alias("_wide"),
            F.count_if(data).alias("_chunk_seen"),
            F.max(_heading()).alias("_chunk_heading"),
            F.max(F.when(wide & data, F.size(CELLS))).alias("_chunk_width"),
            # Data rows above a header are single numbers; at most one chunk of them.
            F.collect_list(F.when(data & ~wide, row)).alias("_lone"),
        )
        .withColumn(
            "_wide_seen",
            F.size(F.filter("_lone", lambda at: at < F.col("_wide.at")))
            + (~text.is_filler(F.col("_wide.cells"))).cast("int"),
        )
        .drop("_lone")
    )
    up_to = Window.partitionBy(*sheet).orderBy("_chunk")
    before = up_to.rowsBetween(Window.unboundedPreceding, -1)
    until = up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if sheets is not None:
        chunks = chunks.join(sheets, sheet)
    return (
        chunks.withColumn("_seen_before", F.coalesce(F.sum("_chunk_seen").over(before), F.lit(0)))
        .withColumn("_heading_before", F.last("_chunk_heading", True).over(before))
        .withColumn(
            "_head",
            F.first(
                F.when(
                    F.col("_wide.at").isNotNull(),
                    F.struct(
                        F.col("_wide.at").alias("at"),
                        F.col("_wide.cells").alias("cells"),
                        (F.col("_wide_seen") + F.col("_seen_before")).alias("seen"),
                    ),
                ),
                True,
            ).over(until),
        )
        .withColumn("_width", F.max("_chunk_width").over(Window.partitionBy(*sheet)))
        .where(F.col("_head").isNotNull())
        .where(F.lit(not fitting) | (F.coalesce("_width", F.lit(0)) <= F.size("_head.cells")))
        .withColumn("head_keys", F.transform("_head.cells", text.simple_key))
        .withColumn("twin", later_twin(F.col("_head.cells")))
        .drop("_wide", "_wide_seen", "_chunk_seen", "_chunk_heading", "_chunk_width", "_width")
    )


def wide_to_long(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per value cell: header name, its short form, value, first column.

    ``rows`` has ``cells``, ``head``, ``head_keys`` and ``twin``. Cells beyond the
    header get no pair; :func:`sheet_status` reports such sheets.
    """
    cells, head, keys, twin = F.col(CELLS), F.col("head"), F.col("head_keys"), F.col("twin")
    width = F.least(F.size(cells), F.size(head))
    values = F.greatest(width - 1, F.lit(0))
    straight = F.arrays_zip(*(F.slice(part, F.lit(2), values) for part in (head, keys, cells)))
    without_twins = F.transform(
        paired_positions(width, twin), lambda at: F.struct(F.get(head, at), F.get(keys, at), F.get(cells, at))
    )
    pairs = F.when(twin.isNull(), straight.cast(PAIRS)).otherwise(without_twins.cast(PAIRS))
    # The pairs are a column before they are taken apart, so that the generator
    # repeats the first cell per pair and not the whole row.
    return rows.select(
        *keep,
        F.get(head, F.lit(0)).alias("first_col_key"),
        F.get(cells, F.lit(0)).alias("first_col_val"),
        pairs.alias("_pairs"),
    ).select(*keep, "first_col_key", "first_col_val", F.inline("_pairs"))


def grid_to_facts(grid: DataFrame, sheet: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Long rows of every sheet, from raw cells."""
    rows = number_rows(compact(grid), sheet, chunk_rows=chunk_rows)
    return wide_to_long(rows, [*sheet, "heading", "table_row_index"])


def sheet_status(compacted: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """Per sheet: how many pairs it gives and the first row wider than its header.

    Rows are counted per (sheet, width) on the map side, so what is shuffled does
    not grow with the rows, and no window runs. Sheets without rows are absent.
    """
    sheet = list(sheet)
    cells = F.col(CELLS)
    real = ~text.is_filler(cells)
    widths = (
        compacted.where(F.size(CELLS) > 1)
        .groupBy(*sheet, F.size(cells).alias("_width"))
        .agg(
            F.min(ROW).alias("_first"),
            F.min_by(cells, F.col(ROW)).alias("_cells"),
            F.count_if(real).alias("_rows"),
            F.min(F.when(real, F.col(ROW))).alias("_first_real"),
        )
    )
    per_sheet = widths.groupBy(*sheet).agg(
        F.min_by("_cells", "_first").alias("head"),
        F.collect_list(F.struct(F.col("_width").alias("width"), F.col("_rows").alias("rows"), F.col("_first_real").alias("at"))).alias(
            "_widths"
        ),
    )
    head, twin = F.col("head"), F.col("_twin")
    zero = F.lit(0).cast("long")
    pairs = F.aggregate(
        "_widths",
        zero,
        lambda total, w: total + w["rows"] * pair_count(F.least(w["width"], F.size(head)), twin),
    )
    head_pairs = F.when(~text.is_filler(head), pair_count(F.size(head), twin)).otherwise(0)
    over = F.filter("_widths", lambda w: (w["width"] > F.size(head)) & w["at"].isNotNull())
    first_over = F.array_min(F.transform(over, lambda w: F.struct(w["at"].alias("at"), w["width"].alias("width"))))
    return per_sheet.withColumn("_twin", later_twin(head)).select(
        *sheet,
        F.size(head).alias("head_width"),
        (pairs - head_pairs).alias("pairs"),
        first_over.alias("over"),
    )


def overflow_message(over: Column, head_width: Column) -> Column:
    """Null when ``over`` is null. Row numbers are 1-based, as a spreadsheet shows them."""
    return F.when(
        over.isNotNull(),
        F.format_string("row %d: %d cells, header has %d", over["at"] + 1, over["width"], head_width),
    )
