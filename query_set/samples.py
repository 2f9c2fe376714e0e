"""Small zip and xlsx files, for queries and tests that need files of the given tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple
from xml.sax.saxutils import escape

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


class Shared(NamedTuple):
    """A cell whose text is in the workbook's table of strings."""

    at: int


def shared_strings(texts: Sequence[str]) -> dict[str, str]:
    """The table of strings as an extra part of a workbook."""
    entries = "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in texts)
    return {"xl/sharedStrings.xml": f'<sst xmlns="{_MAIN}">{entries}</sst>'}


def zip_bytes(members: Mapping[str, bytes | str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in members.items():
            archive.writestr(name, body)
    return out.getvalue()


def column_name(at: int) -> str:
    name = ""
    at += 1
    while at:
        at, digit = divmod(at - 1, 26)
        name = chr(ord("A") + digit) + name
    return name


def cell_xml(at: str, value: Any, style: int = 0) -> str:
    """A stored cell: text as a shared-less inline string, numbers and booleans as they are."""
    if type(value) is float or type(value) is int:
        return f'<c r="{at}" s="{style}"><v>{value!r}</v></c>'
    if isinstance(value, Shared):
        return f'<c r="{at}" t="s"><v>{value.at}</v></c>'
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float):
        return f'<c r="{at}" s="{style}"><v>{value!r}</v></c>'
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def sheet_xml(rows: Sequence[Sequence[Any]]) -> str:
    """A cell is a value or (value, style); None leaves a hole, an empty row is left out."""
    lines = []
    columns = [column_name(c) for c in range(max(map(len, rows), default=0))]
    for r, row in enumerate(rows, start=1):
        cells = []
        for column, cell in zip(columns, row):
            value, style = cell if type(cell) is tuple else (cell, 0)
            if value is not None:
                cells.append(cell_xml(f"{column}{r}", value, style))
        if cells:
            lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    return f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def xlsx_bytes(
    sheets: Mapping[str, Sequence[Sequence[Any]] | str],
    formats: Sequence[str] = (),
    extra: Mapping[str, str] | None = None,
    date1904: bool = False,
) -> bytes:
    """A workbook. Style 0 is General, style n shows ``formats[n - 1]``. A sheet may be raw XML."""
    refs, rels, parts = [], [], {}
    for n, (name, rows) in enumerate(sheets.items(), start=1):
        refs.append(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>')
        rels.append(f'<Relationship Id="rId{n}" Type="{_DOC}/worksheet" Target="worksheets/sheet{n}.xml"/>')
        parts[f"xl/worksheets/sheet{n}.xml"] = rows if isinstance(rows, str) else sheet_xml(rows)
    rels.append(f'<Relationship Id="rIdS" Type="{_DOC}/styles" Target="/xl/styles.xml"/>')
    rels.append(f'<Relationship Id="rIdT" Type="{_DOC}/sharedStrings" Target="sharedStrings.xml"/>')
    codes = "".join(f'<numFmt numFmtId="{164 + n}" formatCode="{escape(f, {chr(34): "&quot;"})}"/>' for n, f in enumerate(formats))
    styles = "".join(f'<xf numFmtId="{164 + n}"/>' for n in range(len(formats)))
    parts |= {
        "_rels/.rels": f'<Relationships xmlns="{_PKG}"><Relationship Id="rId1" Type="{_DOC}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><workbookPr date1904="{int(date1904)}"/>'
        f'<sheets>{"".join(refs)}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PKG}">{"".join(rels)}</Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><numFmts>{codes}</numFmts><cellXfs><xf numFmtId="0"/>{styles}</cellXfs></styleSheet>',
    }
    return zip_bytes(parts | dict(extra or {}))
