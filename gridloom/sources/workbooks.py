"""Decode job: workbook files to grid rows. The only Python per file.

A zip member cannot be split, so one task decodes one file; it streams rows out
in Arrow batches and never holds a whole sheet. A file that cannot be read gives
an error row and leaves the task alive.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections import deque
from collections.abc import Callable, Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.text import sheet_title
from gridloom.sources.xlsx import XlsxBook

FILE_LEVEL = -1

# One row per sheet row. Without row_idx: one row per file, one per sheet, one per error.
GRID_SCHEMA = T.StructType(
    [
        T.StructField("zip_uri", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("unzipped_name", T.StringType()),
        T.StructField("sheet_pos", T.IntegerType()),
        T.StructField("sheet_name", T.StringType()),
        T.StructField("row_idx", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

_ARROW = pa.schema(
    [
        ("zip_uri", pa.string()),
        ("load_id", pa.string()),
        ("unzipped_name", pa.string()),
        ("sheet_pos", pa.int32()),
        ("sheet_name", pa.string()),
        ("row_idx", pa.int64()),
        ("cells", pa.list_(pa.string())),
        ("error", pa.string()),
    ]
)
_BATCH_ROWS = 8_192
_BATCH_CELLS = 131_072

Rows = Iterator[tuple[int, list[str]]]
# A title, none where the file has none, and a reader.
Sheet = tuple[str | None, Callable[[], Rows]]


def decode_archives(files: DataFrame) -> DataFrame:
    """Grid rows of the first workbook in each zip. ``files``: zip_uri, load_id, content."""
    return _decode(files, True)


def decode_workbooks(files: DataFrame) -> DataFrame:
    """Grid rows of files that are workbooks themselves."""
    return _decode(files, False)


def _decode(files: DataFrame, zipped: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decode_batches(batches, zipped)

    rows = files.select("zip_uri", "load_id", "content").mapInArrow(run, GRID_SCHEMA)
    # The one sheet of a text file has no name of its own.
    untitled = F.col("sheet_name").isNull() & (F.col("sheet_pos") != FILE_LEVEL)
    return rows.withColumn("sheet_name", F.when(untitled, sheet_title(F.col("unzipped_name"))).otherwise(F.col("sheet_name")))


def decode_batches(batches: Iterator[pa.RecordBatch], zipped: bool) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    cells = 0
    for batch in batches:
        uris, loads, bodies = (batch.column(name) for name in ("zip_uri", "load_id", "content"))
        for at in range(batch.num_rows):
            for row in _file_rows(uris[at].as_py(), loads[at].as_py(), bodies[at].as_buffer(), zipped):
                rows.append(row)
                cells += len(row[6] or ())
                if len(rows) >= _BATCH_ROWS or cells >= _BATCH_CELLS:
                    yield _to_batch(rows)
                    rows, cells = [], 0
    if rows:
        yield _to_batch(rows)


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _file_rows(uri: str, load: str, body: pa.Buffer, zipped: bool) -> Iterator[tuple]:
    name = uri.rpartition("/")[2]
    try:
        file: IO[bytes] = pa.BufferReader(body)
        if zipped:
            name, file = find_workbook(file, uri)
        sheets = open_sheets(name, file)
    except Exception as problem:
        yield uri, load, name, FILE_LEVEL, None, None, None, _message(problem)
        return
    yield uri, load, name, FILE_LEVEL, None, None, None, None
    for pos, (title, rows) in enumerate(sheets):
        yield uri, load, name, pos, title, None, None, None
        try:
            for at, cells in rows():
                yield uri, load, name, pos, title, at, cells, None
        except Exception as problem:
            yield uri, load, name, pos, title, None, None, _message(problem)


def _message(problem: Exception) -> str:
    return str(problem) or type(problem).__name__


# The csv module refuses fields beyond 128 KiB; a file's own size is the bound here.
csv.field_size_limit((1 << 31) - 1)


def _csv_sheets(name: str, file: IO[bytes]) -> list[Sheet]:
    def rows() -> Rows:
        return enumerate(csv.reader(io.TextIOWrapper(file, encoding="utf-8-sig", newline="")))

    return [(None, rows)]


def _xlsx_sheets(name: str, file: IO[bytes]) -> list[Sheet]:
    book = XlsxBook(file)

    def reader(title: str, path: str, has_cells: bool) -> Callable[[], Rows]:
        def rows() -> Rows:
            if not has_cells:
                raise ValueError(f"sheet {title} is a chart and has no rows")
            return book.rows(path)

        return rows

    return [(title, reader(title, path, has_cells)) for title, path, has_cells in book.sheets]


READERS: dict[str, Callable[[str, IO[bytes]], list[Sheet]]] = {".csv": _csv_sheets, ".xlsx": _xlsx_sheets}


def _split_name(path: str) -> tuple[str, str]:
    """Name without extension, and the extension; a leading dot starts no extension."""
    name = path.rpartition("/")[2]
    dot = name.rfind(".")
    return (name[:dot], name[dot:]) if name[:dot].strip(".") else (name, "")


def extension(path: str) -> str:
    return _split_name(path)[1].lower()


def open_sheets(name: str, file: IO[bytes]) -> list[Sheet]:
    """Titles and row readers of a workbook, by the extension of its name."""
    reader = READERS.get(extension(name))
    if reader is None:
        raise ValueError(f"no reader for {extension(name)} files: {name}")
    return reader(name, file)


def find_workbook(file: IO[bytes], label: str) -> tuple[str, IO[bytes]]:
    """Name and stream of the first workbook in a zip or in the zips inside it.

    An archive comes before the ones it holds; inside one, the files nearest to
    its root come first, then the order is by path.
    """
    waiting: deque[Callable[[], IO[bytes]]] = deque([lambda: file])
    while waiting:
        archive = zipfile.ZipFile(waiting.popleft()())
        names = sorted(
            (i.filename for i in archive.infolist() if not i.is_dir()), key=lambda path: (path.count("/"), path)
        )
        for path in names:
            if extension(path) in READERS:
                member = archive.open(path)
                # An .xlsx is a zip again and needs random access.
                return path.rpartition("/")[2], io.BytesIO(member.read()) if extension(path) == ".xlsx" else member
        for path in names:
            if path.lower().endswith(".zip"):
                waiting.append(lambda a=archive, p=path: io.BytesIO(a.read(p)))
    raise FileNotFoundError(f"target file not found within {label}")
