"""Rows of an .xlsx file as the sheet displays them; a helper of the decode job.

Streams each sheet part, so memory holds the shared strings and the nodes of one chunk.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import re
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from typing import IO, Any
from xml.etree import ElementTree

from gridloom.functions.numfmt import decimals_of, scanned

# Number formats that a file refers to by id without spelling them out.
BUILTIN_FORMATS = {
    1: "0",
    2: "0.00",
    3: "#,##0",
    4: "#,##0.00",
    5: '"$"#,##0_);("$"#,##0)',
    6: '"$"#,##0_);[Red]("$"#,##0)',
    7: '"$"#,##0.00_);("$"#,##0.00)',
    8: '"$"#,##0.00_);[Red]("$"#,##0.00)',
    9: "0%",
    10: "0.00%",
    11: "0.00E+00",
    12: "# ?/?",
    13: "# ??/??",
    14: "mm-dd-yy",
    15: "d-mmm-yy",
    16: "d-mmm",
    17: "mmm-yy",
    18: "h:mm AM/PM",
    19: "h:mm:ss AM/PM",
    20: "h:mm",
    21: "h:mm:ss",
    22: "m/d/yy h:mm",
    37: "#,##0_);(#,##0)",
    38: "#,##0_);[Red](#,##0)",
    39: "#,##0.00_);(#,##0.00)",
    40: "#,##0.00_);[Red](#,##0.00)",
    41: r'_(* #,##0_);_(* \(#,##0\);_(* "-"_);_(@_)',
    42: r'_("$"* #,##0_);_("$"* \(#,##0\);_("$"* "-"_);_(@_)',
    43: r'_(* #,##0.00_);_(* \(#,##0.00\);_(* "-"??_);_(@_)',
    44: r'_("$"* #,##0.00_);_("$"* \(#,##0.00\);_("$"* "-"??_);_(@_)',
    45: "mm:ss",
    46: "[h]:mm:ss",
    47: "mmss.0",
    48: "##0.0E+0",
    49: "@",
}

EPOCH_1900 = dt.datetime(1899, 12, 30)
EPOCH_1904 = dt.datetime(1904, 1, 1)
DAY_MS = 86_400_000

_CHUNK_BYTES = 1 << 16

def shown_number(value: float, decimals: int | None) -> float | int:
    if decimals is None:
        return value
    return round(value, decimals) if decimals else int(round(value))


def shown_date(serial: float, elapsed: bool, epoch: dt.datetime) -> Any:
    """Duration, time of day or date of a serial number: days since the epoch, to the millisecond."""
    ms = round(serial * DAY_MS)
    if elapsed:
        return dt.timedelta(milliseconds=ms)
    if 0 <= ms < DAY_MS:
        return (epoch + dt.timedelta(milliseconds=ms)).time()
    # The 1900 calendar has a 29 February that never was, its day 60: days before it count from one later.
    if epoch == EPOCH_1900 and 0 < serial < 60:
        ms += DAY_MS
    return epoch + dt.timedelta(milliseconds=ms)


@lru_cache(maxsize=65_536)
def _date_text(serial: float, elapsed: bool, epoch: dt.datetime) -> str:
    return str(shown_date(serial, elapsed, epoch))


def iso_date(value: str) -> Any:
    text = value.removesuffix("Z")
    if "T" in text:
        return dt.datetime.fromisoformat(text)
    return dt.time.fromisoformat(text) if ":" in text else dt.date.fromisoformat(text)


@lru_cache(maxsize=65_536)
def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _children(node: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [child for child in node if _local(child.tag) == name]


def _attribute(node: ElementTree.Element, name: str) -> str | None:
    return next((value for key, value in node.attrib.items() if _local(key) == name), None)


def _text_of(node: ElementTree.Element) -> str:
    """Plain text and text of runs; phonetic readings are left out."""
    own = "".join(child.text or "" for child in _children(node, "t"))
    return own + "".join(t.text or "" for run in _children(node, "r") for t in _children(run, "t"))


def _inline_texts(node: ElementTree.Element) -> Iterator[str]:
    """Texts of an inline string and its runs, without phonetic readings."""
    for child in node:
        tag = _local(child.tag)
        if tag == "t":
            yield child.text or ""
        elif tag != "rPh":
            yield from _inline_texts(child)


def _finished_rows(node: ElementTree.Element, ended: bool) -> Iterator[ElementTree.Element]:
    """Takes what is finished out of a growing tree and gives the rows of sheet data in it; of children the last one may be open."""
    children, in_data = list(node), _local(node.tag) == "sheetData"
    for k, child in enumerate(children, start=1):
        over = ended or k < len(children)
        if not in_data:
            yield from _finished_rows(child, over)
        elif over and _local(child.tag) == "row":
            yield child
    del node[: len(children) if ended else -1]


class XlsxBook:
    """Sheets of a workbook in workbook order."""

    def __init__(self, file: IO[bytes]) -> None:
        self.archive = zipfile.ZipFile(file)
        self.parts = set(self.archive.namelist())
        book_path = self._related("").get("officeDocument", [("", "xl/workbook.xml")])[0][1]
        book = self._tree(book_path)
        related = {key: (kind, path) for kind, entries in self._related(book_path).items() for key, path in entries}
        by_kind = {kind: path for kind, path in related.values()}

        self.sheets: list[tuple[str, str, bool]] = []
        properties = next(iter(_children(book, "workbookPr")), None)
        flag = properties.get("date1904", "0") if properties is not None else "0"
        self.epoch = EPOCH_1904 if flag in ("1", "true") else EPOCH_1900
        for group in _children(book, "sheets"):
            for sheet in _children(group, "sheet"):
                kind, path = related.get(_attribute(sheet, "id") or "", ("", ""))
                if path in self.parts:
                    self.sheets.append((sheet.get("name", ""), path, kind != "chartsheet"))

        self.strings = self._shared_strings(by_kind.get("sharedStrings"))
        self.formats = self._formats(by_kind.get("styles"))

    def rows(self, path: str) -> Iterator[tuple[int, list[str]]]:
        """0-based row number and cells of each stored row, from left to right."""
        # The tree is built below a node of our own, and what is finished is taken out of it.
        builder = ElementTree.TreeBuilder()
        root = builder.start("part", {})
        parser = ElementTree.XMLParser(target=builder)
        number, ended = 0, False
        with self.archive.open(path) as part:
            while not ended:
                if chunk := part.read(_CHUNK_BYTES):
                    parser.feed(chunk)
                else:
                    parser.close()
                    ended = True
                for row in _finished_rows(root, ended):
                    number = int(float(row.get("r", number + 1)))
                    yield number - 1, self._cells(row)

    def _cells(self, row: ElementTree.Element) -> list[str]:
        """Shown values of a row, from left to right; of two in one place the later one."""
        cells, places, at, last, in_order = [], [], -1, -1, True
        for cell in row:
            if _local(cell.tag) != "c":
                continue
            get = cell.get
            letters = get("r", "").rstrip("0123456789")
            at = _letters_to_column(letters) if letters else at + 1
            stored = inline = None
            for node in cell:
                tag = _local(node.tag)
                if tag == "v":
                    stored = "".join(node.itertext()) if len(node) else node.text
                elif tag == "is":
                    inline = "".join(_inline_texts(node))
            kind, style = get("t", "n"), int(get("s", 0))
            value = self._number(stored, style) if kind == "n" and stored else self._value(kind, stored, inline)
            if value is not None:
                in_order, last = in_order and last < at, at
                places.append(at)
                cells.append(str(value))
        if in_order:
            return cells
        placed = dict(zip(places, cells))
        return [placed[at] for at in sorted(placed)]

    def _value(self, kind: str, stored: str | None, inline: str | None) -> Any:
        """Of cells that hold no number."""
        if kind == "inlineStr":
            return inline
        if not stored:
            return None
        if kind == "s":
            return self.strings[int(stored)]
        if kind == "b":
            return bool(int(stored))
        return iso_date(stored) if kind == "d" else stored

    def _number(self, stored: str, style: int) -> Any:
        value = float(stored) if "." in stored or "e" in stored or "E" in stored else int(stored)
        decimals, date, elapsed = self.formats[style] if style < len(self.formats) else (None, False, False)
        if date:
            try:
                return _date_text(value, elapsed, self.epoch)
            except (OverflowError, ValueError):
                return "#VALUE!"
        return shown_number(value, decimals) if isinstance(value, float) else value

    def _tree(self, path: str) -> ElementTree.Element:
        with self.archive.open(path) as part:
            return ElementTree.parse(part).getroot()

    def _related(self, path: str) -> dict[str, list[tuple[str, str]]]:
        """(id, path) of the parts that a part refers to, by kind."""
        folder, name = posixpath.split(path)
        index = posixpath.join(folder, "_rels", f"{name}.rels")
        found: dict[str, list[tuple[str, str]]] = {}
        if index not in self.parts:
            return found
        for node in self._tree(index):
            kind = node.get("Type", "").rpartition("/")[2]
            target = node.get("Target", "")
            if node.get("TargetMode") != "External":
                full = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
                found.setdefault(kind, []).append((node.get("Id", ""), full))
        return found

    def _shared_strings(self, path: str | None) -> list[str]:
        if path not in self.parts:
            return []
        strings = []
        with self.archive.open(path) as part:
            for _, node in ElementTree.iterparse(part):
                if _local(node.tag) == "si":
                    strings.append(_text_of(node).replace("x005F_", ""))
                    node.clear()
        return strings

    def _formats(self, path: str | None) -> list[tuple[int | None, bool, bool]]:
        """Per cell style: decimals, whether it shows a date, whether that date is a duration."""
        if path not in self.parts:
            return []
        styles = self._tree(path)
        codes = dict(BUILTIN_FORMATS)
        for group in _children(styles, "numFmts"):
            codes.update({int(f.get("numFmtId", 0)): f.get("formatCode", "") for f in _children(group, "numFmt")})
        used = [
            codes.get(int(style.get("numFmtId", 0)), "General")
            for group in _children(styles, "cellXfs")
            for style in _children(group, "xf")
        ]
        return [
            (decimals_of(code), *scanned(code)[1:])
            if code != "General"
            else (None, False, False)
            for code in used
        ]


@lru_cache(maxsize=65_536)
def _letters_to_column(letters: str) -> int:
    """0-based column of the letters of a cell reference such as ``AB12``."""
    column = 0
    for ch in letters.upper():
        column = column * 26 + ord(ch) - ord("A") + 1
    return column - 1
