"""Load of workbook files: pending files, decode, facts, ledger.

Files are taken in slices of bounded number and size. A slice is three writes:
the decoded grid goes to a staging folder, facts of good files are appended to the
partition of the slice, and the ledger comes last, as the record that the slice is
finished. A lost job is loaded again: its half-written facts stay invisible to
``sources.tables.loaded_facts``, and the next load drops them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import text
from gridloom.functions.ids import load_id, make_stamp
from gridloom.functions.uris import base_name, extension, folder_of
from gridloom.operators.contents import CONTENTS_SHEET, listed_sheets, select_sheets
from gridloom.operators.grid import CELLS, ROW, number_rows, overflow_message, sheet_status, wide_to_long
from gridloom.operators.pending import FAILED, LOADED, SOURCE, pending_files
from gridloom.sources.listing import ARCHIVES, list_files, read_bodies
from gridloom.sources.sinks import append_by_name, with_audit
from gridloom.sources.staging import discard, exists, new_folder, session_conf, staged
from gridloom.sources.tables import FACTS, LEDGER, STAMP, UNLISTED, drop_unfinished, stamp_of
from gridloom.sources.workbooks import FILE_LEVEL, decode_archives, decode_workbooks

SLICE_FILES = 10_000
SLICE_BYTES = 256 << 30

# Decoding costs far more than reading: tasks are cut smaller than for a scan, and
# small partitions of files that come out of a shuffle are not put together. A file counts
# for 256 KB more than it has, so that a task takes some sixty small ones and not four.
DECODE_CONF = {
    "spark.sql.files.maxPartitionBytes": str(16 << 20),
    "spark.sql.files.openCostInBytes": str(256 << 10),
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}

SHEET = ["load_id", "sheet_pos"]
# Sheet names that are broadcast; one takes less than a hundred bytes.
MOST_NAMES = 100_000

# What Spark says where a body or its decoding brings down a worker: only these are cornered by halving.
CRASHES = (
    "Python worker exited unexpectedly",
    "Cannot grow BufferHolder",
    "OutOfMemoryError",
    "NegativeArraySizeException",
)
# Rounds of halving in which nothing loads before the cluster is blamed and not the files.
PATIENCE = 5
MAX_LENGTH = "spark.sql.sources.binaryFile.maxLength"
NOT_DELIVERED = "the file is gone, or its storage cannot read it"

# Kinds of staged rows.
MARK, CONTENTS, DATA = "mark", "contents", "data"


@dataclass(frozen=True)
class LoadReport:
    """What a load did, and the stamps of its slices."""

    loaded: int = 0
    failed: int = 0
    rows: int = 0
    stamps: tuple[str, ...] = field(default=(), compare=False, repr=False)

    def __add__(self, other: LoadReport) -> LoadReport:
        return LoadReport(self.loaded + other.loaded, self.failed + other.failed, self.rows + other.rows, self.stamps + other.stamps)


def file_totals(spark: SparkSession, schema: str, report: LoadReport) -> DataFrame:
    """``zip_uri`` and ``row_count`` of every file that the reported load has loaded."""
    ledger = spark.table(f"{schema}.{LEDGER}").where(F.col("status") == LOADED)
    return ledger.where(stamp_of(F.col("load_id")).isin(*report.stamps)).select("zip_uri", "row_count")


def load_new_zips(spark: SparkSession, schema: str, prefix: str, recursive: bool = True, **options) -> LoadReport:
    """Loads every zip under ``prefix`` that has no ``loaded`` ledger row."""
    return load_listed(spark, schema, list_files(spark, prefix, ARCHIVES, recursive), **options)


def load_listed(
    spark: SparkSession,
    schema: str,
    listing: DataFrame,
    decode_uris: bool = True,
    zipped: bool = True,
    slice_files: int = SLICE_FILES,
    slice_bytes: int = SLICE_BYTES,
) -> LoadReport:
    """Loads the pending files of a listing (``path``, ``length``)."""
    # Rows another session has appended since this one last listed the ledger's files count too.
    spark.catalog.refreshTable(f"{schema}.{LEDGER}")
    drop_unfinished(spark, schema)
    pending = pending_files(listing, spark.table(f"{schema}.{LEDGER}"), decode_uris).orderBy("zip_uri", "path")
    report = LoadReport()
    for files in _slices(pending.toLocalIterator(), slice_files, slice_bytes):
        report += _load_slice(spark, schema, files, zipped)
    return report


def _load_slice(spark: SparkSession, schema: str, files: list[Row], zipped: bool) -> LoadReport:
    """Loads these files (``zip_uri``, ``path``, ``length``) and gives each a ledger row.

    Missing and unreadable bodies are skipped by the reader and found by comparing what was
    listed with what arrived. A body that crashes its worker is cornered by halving: all
    pieces of a round are tried, so that a healthy cluster shows in the other half. If rounds
    pass without any piece loaded, the error is raised and no file is blamed.
    """
    most = int(spark.conf.get(MAX_LENGTH))
    large = [(f, f"{f['length']} bytes, {MAX_LENGTH} is {most}") for f in files if f["length"] > most]
    pieces = [[f for f in files if f["length"] <= most]]
    report, crashed, barren, healthy = LoadReport(), [], 0, False
    while pieces and pieces[0]:
        halves, loaded, problem = [], False, None
        for piece in pieces:
            try:
                report += _load_piece(spark, schema, piece, zipped)
                loaded = True
            except Exception as crash:
                if not any(mark in str(crash) for mark in CRASHES):
                    raise
                problem, middle = crash, len(piece) // 2
                if middle:
                    halves += [piece[:middle], piece[middle:]]
                else:
                    crashed.append((piece[0], _first_line(crash)))
        healthy, barren = healthy or loaded, 0 if loaded else barren + 1
        if problem and (barren > PATIENCE or not halves and not healthy and len(crashed) > 1):
            raise problem
        pieces = halves
    return report + _record_failed(spark, schema, large + crashed)


def _load_piece(spark: SparkSession, schema: str, files: list[Row], zipped: bool) -> LoadReport:
    paths, gone = [f["path"] for f in files], None
    try:
        bodies = read_bodies(spark, paths, skip_unreadable=True)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        # A file is gone since it was listed; where its folder is gone too, the storage is lost.
        there = [p for p in paths if exists(spark, p)]
        if not there and not all(exists(spark, folder) for folder in {folder_of(p) for p in paths}):
            raise
        gone, bodies = problem, read_bodies(spark, there, skip_unreadable=True) if there else None
    if bodies is None:
        return _record_failed(spark, schema, [(f, _first_line(gone)) for f in files])
    listed = with_load_id(spark.createDataFrame([(f["zip_uri"], f["path"]) for f in files], "zip_uri string, path string"), "path")
    folder = new_folder(spark, "load")
    try:
        # As many rows as a slice has files, at most.
        grid, sheets = decode_and_judge(bodies.join(F.broadcast(listed), "path"), folder, zipped)
        ledger = staged(account(listed, ledger_rows(sheets)), "ledger", folder)
        report = _report(ledger)
        undelivered = ledger.where(F.col("error_message") == NOT_DELIVERED).count() if report.failed else 0
        if undelivered == len(files) > 1 and gone is None:
            raise OSError(f"none of {undelivered} listed files can be read, such as {paths[0]}")
        _append_facts(grid_facts(grid, sheets, base_name(F.col("zip_uri"))), schema)
        append_by_name(with_audit(ledger), f"{schema}.{LEDGER}")
        return report
    finally:
        discard(spark, folder)


def account(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """A ledger row for each listed file (``zip_uri``, ``path``, ``load_id``); what has none was not delivered."""
    arrived = F.col("status").isNotNull()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("sheet_count", "row_count")]
    return listed.join(ledger.drop("zip_uri", "zip_name"), "load_id", "left").select(
        "zip_uri",
        base_name(F.col("zip_uri")).alias("zip_name"),
        "load_id",
        F.coalesce("status", F.lit(FAILED)).alias("status"),
        *counts,
        F.when(arrived, F.col("error_message")).otherwise(NOT_DELIVERED).alias("error_message"),
        F.col("path").alias(SOURCE),
    )


def _first_line(problem: Exception) -> str:
    return next(iter(str(problem).splitlines()), "") or type(problem).__name__


def _record_failed(spark: SparkSession, schema: str, failed: list[tuple[Row, str]]) -> LoadReport:
    if not failed:
        return LoadReport()
    files = spark.createDataFrame([(f["zip_uri"], f["path"], e) for f, e in failed], "zip_uri string, path string, error string")
    rows = with_load_id(files, "path").select(
        "zip_uri",
        base_name(F.col("zip_uri")).alias("zip_name"),
        "load_id",
        F.lit(FAILED).alias("status"),
        *(F.lit(0).cast("long").alias(c) for c in ("sheet_count", "row_count")),
        F.col("error").alias("error_message"),
        F.col("path").alias(SOURCE),
    )
    append_by_name(with_audit(rows), f"{schema}.{LEDGER}")
    return LoadReport(failed=len(failed))


def _slices(files: Iterable[Row], most_files: int, most_bytes: int) -> Iterator[list[Row]]:
    taken: list[Row] = []
    size = 0
    for file in files:
        if taken and (len(taken) >= most_files or size + file["length"] > most_bytes):
            yield taken
            taken, size = [], 0
        taken.append(file)
        size += file["length"]
    if taken:
        yield taken


def load_bodies(files: DataFrame, schema: str, zipped: bool = True) -> LoadReport:
    """Loads all of ``files`` (``zip_uri``, ``content``), one ledger row each."""
    folder = new_folder(files.sparkSession, "load")
    try:
        return _append(*decode_and_judge(files, folder, zipped), schema)
    finally:
        discard(files.sparkSession, folder)


def _append_facts(facts: DataFrame, schema: str, stamp: Column | None = None) -> None:
    """Facts go to the partition of their load."""
    stamp = stamp_of(F.col("load_id")) if stamp is None else stamp
    append_by_name(with_audit(facts).withColumn(STAMP, stamp), f"{schema}.{FACTS}")


def _append(grid: DataFrame, sheets: DataFrame, schema: str) -> LoadReport:
    _append_facts(grid_facts(grid, sheets, base_name(F.col("zip_uri"))), schema)
    ledger = ledger_rows(sheets)
    append_by_name(with_audit(ledger), f"{schema}.{LEDGER}")
    return _report(ledger)


def load_workbook_files(
    spark: SparkSession, schema: str, prefix: str, zip_name: str = "placeholder.zip", name_glob: str = "*"
) -> LoadReport:
    """Loads workbooks that are not in a zip. Writes no ledger; a bad file is an error, and then nothing is loaded."""
    listing = list_files(spark, prefix, name_glob).select("path", "length")
    report, judged = LoadReport(), []
    folder = new_folder(spark, "load")
    try:
        for k, listed in enumerate(_slices(listing.toLocalIterator(), SLICE_FILES, SLICE_BYTES)):
            files = read_bodies(spark, [f["path"] for f in listed]).withColumnRenamed("path", "zip_uri")
            grid, sheets = decode_and_judge(files, f"{folder}/{k}", zipped=False)
            done = ledger_rows(sheets)
            bad = done.where(F.col("status") == FAILED).select("zip_uri", "error_message").first()
            if bad is not None:
                raise ValueError(f"{bad['zip_uri']}: {bad['error_message']}")
            judged.append((grid, sheets))
            report += _report(done)
        for grid, sheets in judged:
            _append_facts(grid_facts(grid, sheets, F.lit(zip_name)), schema, F.lit(UNLISTED))
    finally:
        discard(spark, folder)
    return report


def decode_and_judge(files: DataFrame, folder: str, zipped: bool = True) -> tuple[DataFrame, DataFrame]:
    """Grid rows of ``files`` and the verdicts on their sheets, both staged."""
    decode = decode_archives if zipped else decode_workbooks
    grid = stage_grid(decode(files if "load_id" in files.columns else with_load_id(files)), folder)
    return grid, staged(judge_sheets(grid), "sheets", folder)


def with_load_id(files: DataFrame, name: str = "zip_uri") -> DataFrame:
    return files.withColumn("load_id", load_id(make_stamp(), str(uuid.uuid4()), F.col(name)))


def stage_grid(decoded: DataFrame, folder: str) -> DataFrame:
    """The decoded rows with blanks removed, written once, apart by kind.

    Marks and contents rows are few; their readers need not pass over the rest.
    """
    kept = decoded.withColumn(CELLS, text.non_empty_cells(F.col(CELLS)))
    # Placed behind a generator for the reason given in operators.grid.compact.
    others = [c for c in decoded.columns if c != CELLS]
    kept = kept.select(*others, F.inline(F.array(F.struct(CELLS))))
    # A one-sheet text file has no contents sheet, whatever its name.
    contents = (F.col("sheet_name") == CONTENTS_SHEET) & (extension(F.col("unzipped_name")) != ".csv")
    kind = F.when(F.col(ROW).isNull(), MARK).when(contents, CONTENTS).otherwise(DATA)
    kept = kept.where((F.size(CELLS) > 0) | F.col(ROW).isNull()).withColumn("kind", kind)
    with session_conf(decoded.sparkSession, DECODE_CONF):
        return staged(kept, "grid", folder, split_by="kind")


def judge_sheets(grid: DataFrame) -> DataFrame:
    """What to load and what is wrong with it.

    One row per file (null ``sheet_index``) with the file's own error, and one
    per selected sheet with its number of pairs and its error. Rows of the grid
    are only counted here.
    """
    marks = grid.where(F.col("kind") == MARK)
    file = ["zip_uri", "load_id", "unzipped_name"]
    files = marks.where(F.col("sheet_pos") == FILE_LEVEL).select(*file, "error")

    named = (
        marks.where(F.col("sheet_pos") != FILE_LEVEL)
        .groupBy("load_id", "sheet_name")
        .agg(F.min("sheet_pos").alias("sheet_pos"), F.max("error").alias("read_error"), F.first("unzipped_name").alias("name"))
    )
    is_contents = (F.col("sheet_name") == CONTENTS_SHEET) & (extension(F.col("name")) != ".csv")
    books = named.where(is_contents).select("load_id", F.lit(True).alias("_contents"))
    named = (
        named.drop("name")
        .join(books, "load_id", "left")
        .withColumn("has_contents", F.coalesce("_contents", F.lit(False)))
        .drop("_contents")
    )
    contents = grid.where(F.col("kind") == CONTENTS)
    chosen = select_sheets(named, listed_sheets(contents, ["load_id"]), ["load_id"], "has_contents")

    broken_contents = (
        named.where(F.col("has_contents") & (F.col("sheet_name") == CONTENTS_SHEET) & F.col("read_error").isNotNull())
        .select("load_id", F.col("read_error").alias("contents_error"))
    )
    files = (
        files.join(broken_contents, "load_id", "left")
        .withColumn("error", F.coalesce("error", "contents_error"))
        .drop("contents_error")
    )
    missing = F.when(F.col("sheet_pos").isNull(), F.format_string("no sheet named %s", "sheet_name"))
    judged = (
        chosen.join(sheet_status(grid.where(F.col("kind") != MARK), SHEET), SHEET, "left")
        .join(files.drop("error"), "load_id")
        .select(
            *file,
            "sheet_pos",
            "sheet_name",
            "sheet_index",
            F.coalesce("pairs", F.lit(0)).alias("pairs"),
            F.coalesce(missing, "read_error", overflow_message(F.col("over"), F.col("head_width"))).alias("error"),
        )
    )
    return judged.unionByName(files, allowMissingColumns=True)


def ledger_rows(sheets: DataFrame) -> DataFrame:
    """One ledger row per file, without the audit columns; a failed file counts nothing."""
    error = F.coalesce("_own", "_first")
    counted = sheets.groupBy("zip_uri", "load_id").agg(
        F.max(F.when(F.col("sheet_index").isNull(), F.col("error"))).alias("_own"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("sheet_index"))).alias("_first"),
        F.count("sheet_index").alias("_sheets"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("_pairs"),
    )
    return counted.select(
        "zip_uri",
        base_name(F.col("zip_uri")).alias("zip_name"),
        "load_id",
        F.when(error.isNull(), LOADED).otherwise(FAILED).alias("status"),
        F.when(error.isNull(), F.col("_sheets")).otherwise(0).alias("sheet_count"),
        F.when(error.isNull(), F.col("_pairs")).otherwise(0).alias("row_count"),
        error.alias("error_message"),
    )


def grid_facts(grid: DataFrame, sheets: DataFrame, zip_name: Column) -> DataFrame:
    """Facts of the selected sheets of good files."""
    bad = sheets.where(F.col("error").isNotNull()).select("load_id").distinct()
    wanted = (
        sheets.where(F.col("sheet_index").isNotNull())
        .join(bad, "load_id", "left_anti")
        .select(*SHEET, zip_name.alias("zip_name"), "unzipped_name", "sheet_name", "sheet_index")
    )
    rows = number_rows(only_wanted(grid.where(F.col("kind") != MARK), wanted), SHEET, wanted)
    keep = ["load_id", "zip_name", "unzipped_name", "sheet_name", "sheet_index", "heading", "table_row_index"]
    return wide_to_long(rows, keep)


def only_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted sheets, so that no others are shuffled.

    The names are sent to all tasks if they are few enough, which is checked; a join by name
    would put a large sheet into one task. With more of them all rows are shuffled by
    chunk, and the others drop out there.
    """
    names = wanted.select(*SHEET).distinct()
    if names.count() > MOST_NAMES:
        return rows
    return rows.join(F.broadcast(names), SHEET, "left_semi")


def _report(ledger: DataFrame) -> LoadReport:
    ok = F.col("status") == LOADED
    stamps = F.collect_set(stamp_of(F.col("load_id"))).alias("stamps")
    total = ledger.agg(F.count_if(ok).alias("loaded"), F.count_if(~ok).alias("failed"), F.sum("row_count").alias("rows"), stamps).first()
    return LoadReport(total["loaded"], total["failed"], total["rows"] or 0, tuple(total["stamps"]))
