import io
import random

import pytest

from gridloom.functions.numfmt import scanned
from gridloom.sources import xlsx
from gridloom.sources.workbooks import find_workbook, open_sheets
from query_set.samples import xlsx_bytes, zip_bytes

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def read(body):
    book = xlsx.XlsxBook(io.BytesIO(body))
    return {name: list(book.rows(path)) for name, path, _ in book.sheets}


def raw(cells):
    return f'<worksheet xmlns="{MAIN}"><sheetData>{cells}</sheetData></worksheet>'


def test_values_as_displayed():
    formats = ["#,##0", "#,##0.00", "0.0", "0%", "0.00%", "yyyy-mm-dd", "hh:mm", "[h]:mm"]
    rows = [
        ["Year", None, "  text "],
        [(21324800.41667978, 1), (21324800.4166, 2), (2.5, 1), (0.25, 3), (0.45, 4), (0.12345, 5)],
        [],
        [(45000, 6), (0.5, 7), (1.25, 8), (61.75, 6), (59, 6)],
        [True, False, 7, 1e20, 4.123776525008132e7, (3, 2)],
    ]
    assert read(xlsx_bytes({"S": rows}, formats))["S"] == [
        (0, ["Year", "  text "]),
        (1, ["21324800", "21324800.42", "2", "0.2", "0", "0.12"]),
        (3, ["2023-03-15 00:00:00", "12:00:00", "1 day, 6:00:00", "1900-03-01 18:00:00", "1900-02-28 00:00:00"]),
        (4, ["True", "False", "7", "1e+20", "41237765.25008132", "3"]),
    ]


def test_dates_from_1904():
    assert read(xlsx_bytes({"S": [[(1, 1), (2.5, 1)]]}, ["d/m/yy"], date1904=True))["S"] == [
        (0, ["1904-01-02 00:00:00", "1904-01-03 12:00:00"])
    ]


def test_stored_forms():
    strings = (
        f'<sst xmlns="{MAIN}"><si><t>plain</t></si>'
        "<si><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si><si><t>a_x005F_b</t></si></sst>"
    )
    cells = (
        '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="A2" t="s"><v>1</v></c><c r="AA2" t="s"><v>2</v></c></row>'
        '<row><c t="str"><f>A1</f><v>cached</v></c><c t="e"><v>#N/A</v></c><c><v></v></c><c t="d"><v>2024-02-03T04:05:06Z</v></c></row>'
        '<row r="9"><c><f>1+1</f></c><c t="inlineStr"/><c r="D9"><v>12</v></c></row>'
    )
    found = read(xlsx_bytes({"S": raw(cells)}, extra={"xl/sharedStrings.xml": strings}))
    assert found["S"] == [
        (1, ["two runs", "plain", "a_b"]),
        (2, ["cached", "#N/A", "2024-02-03 04:05:06"]),
        (8, ["12"]),
    ]


def test_rows_are_taken_as_they_end_and_leave_no_nodes(monkeypatch):
    monkeypatch.setattr(xlsx, "_CHUNK_BYTES", 64)
    kept, take = [], xlsx._finished_rows

    def watched(node, ended):
        yield from take(node, ended)
        kept.append(sum(1 for _ in node.iter()))

    monkeypatch.setattr(xlsx, "_finished_rows", watched)
    cells = [f'<row r="{n}"><c r="A{n}" t="inlineStr"><is><r><t>a&amp;</t></r><t>{n}</t><rPh><t>no</t></rPh></is></c><c><v>{n}<!-- -->0</v></c></row>' for n in range(1, 400)]
    merged = "".join(f'<mergeCell ref="A{n}:B{n}"/>' for n in range(400))
    whole = f'<worksheet xmlns="{MAIN}"><cols><col/><row/></cols><sheetData>{"".join(cells)}</sheetData><mergeCells>{merged}</mergeCells></worksheet>'
    assert read(xlsx_bytes({"S": whole}))["S"] == [(n - 1, [f"a&{n}", f"{n}0"]) for n in range(1, 400)]
    assert max(kept) < 40
    with pytest.raises(SyntaxError):
        read(xlsx_bytes({"S": whole[:-20]}))


def test_rounding_is_pythons():
    rng = random.Random(3)
    values = [round(rng.uniform(-1e6, 1e6), 3) for _ in range(200)] + [0.5, 1.5, 2.5, 0.125, 2.675]
    rows = [[(v, 1), (v, 2), (v, 3)] for v in values]
    found = read(xlsx_bytes({"S": rows}, ["0", "0.0", "0.00"]))["S"]
    assert [c for _, c in found] == [[str(int(round(v))), str(round(v, 1)), str(round(v, 2))] for v in values]


@pytest.mark.parametrize(
    "code,expected",
    [("General", False), ("0.00", False), ("mm-dd-yy", True), ('"day" 0', False), ("[Red]0.0", False), ("[h]:mm", True), (r"0\d", False)],
)
def test_date_formats(code, expected):
    assert scanned(code)[1] is expected


def test_bad_number_is_an_error():
    with pytest.raises(ValueError):
        read(xlsx_bytes({"S": raw('<row r="1"><c r="A1"><v>abc</v></c></row>')}))


def test_first_workbook_of_nested_zips():
    inner = zip_bytes({"z/deep.csv": "deep", "y.csv": "shallow"})
    assert find_workbook(io.BytesIO(zip_bytes({"a/inner.ZIP": inner, "notes.txt": "n"})), "l")[0] == "y.csv"
    assert find_workbook(io.BytesIO(zip_bytes({"inner.zip": inner, "q/own.CSV": "own"})), "l")[0] == "own.CSV"
    with pytest.raises(FileNotFoundError, match="target file not found within l"):
        find_workbook(io.BytesIO(zip_bytes({"readme.txt": "x", ".csv": "hidden", "in.zip": zip_bytes({"a": "b"})})), "l")


def test_csv_sheet():
    body = '﻿code,label\n001,"al\npha"\n\n002,beta\n'.encode()
    ((title, rows),) = open_sheets("a_very_long_claims_extract_of_2024_x.csv", io.BytesIO(body))
    assert title is None
    assert list(rows()) == [(0, ["code", "label"]), (1, ["001", "al\npha"]), (2, []), (3, ["002", "beta"])]


def test_unknown_extension():
    with pytest.raises(ValueError, match="no reader for .nope files: x.nope"):
        open_sheets("x.nope", io.BytesIO(b""))


def test_chart_sheet_has_no_rows():
    body = xlsx_bytes({"S": [["a", "b"]]})
    import zipfile

    source = zipfile.ZipFile(io.BytesIO(body))
    parts = {n: source.read(n) for n in source.namelist()}
    rels = "xl/_rels/workbook.xml.rels"
    parts[rels] = parts[rels].replace(b"relationships/worksheet", b"relationships/chartsheet")
    ((title, rows),) = open_sheets("x.xlsx", io.BytesIO(zip_bytes(parts)))
    with pytest.raises(ValueError, match="sheet S is a chart"):
        list(rows())
