import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import text
from gridloom.functions.numfmt import decimals_of, shown_decimals
from gridloom.operators import grid
from gridloom.sources import xlsx
from tests.row_model import cells_of, facts_of, short_key

GRID = "sheet string, row_idx int, cells array<string>"
FACT = ["heading", "table_row_index", "table_key", "table_key_simple", "table_val", "first_col_key", "first_col_val"]


def make_grid(spark, sheets):
    rows = [(name, i, list(row)) for name, sheet in sheets.items() for i, row in enumerate(sheet)]
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, GRID)


def spark_facts(df):
    found = {}
    for row in df.select("sheet", *FACT).collect():
        found.setdefault(row[0], []).append(tuple(row[1:]))
    return {name: sorted(rows) for name, rows in found.items()}


def random_sheet(rng):
    words = ["BLANK", "Year", "Total", "a", "7", "2018", "", "  ", None, " x\x1f", "\t9\n", "Value", "Name"]
    wide = rng.choice([2, 3, 5])
    rows = []
    for _ in range(rng.randrange(0, 40)):
        size = rng.choice([0, 1, 1, 1, wide, wide, rng.randrange(1, wide + 1)])
        rows.append([rng.choice(words) for _ in range(size)])
    return rows


def test_non_empty_cells(spark):
    df = spark.createDataFrame([([None, "", "   ", "0", "Year", "  Year  ", "　\x1c z \x85"],)], "c array<string>")
    assert df.select(text.non_empty_cells(F.col("c"))).first()[0] == ["0", "Year", "Year", "z"]


def test_whitespace_is_what_python_strips():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@pytest.mark.parametrize(
    "cells,expected", [(["FooterNote", "Metric"], False), (["FooterNote"], True), (["12345"], False), ([], False)]
)
def test_text_only(spark, cells, expected):
    df = spark.createDataFrame([(cells,)], "c array<string>")
    assert df.select(text.is_text_only(F.col("c"))).first()[0] is expected


@pytest.mark.parametrize(
    "header",
    [
        "Medicare Advantage medicare Total  Enrollment Original Percentage Year Without Count Part A/B",
        "County percent PERCENTAGE",
        "Medicare  \x1f Advantage\n\nTotal",
        "",
    ],
)
def test_simple_key(spark, header):
    assert spark.range(1).select(text.simple_key(F.lit(header))).first()[0] == short_key(header)


def test_simple_key_literal(spark):
    header = "Medicare Advantage medicare Total  Enrollment Original Percentage Year Without Count Part A/B"
    key = spark.range(1).select(text.simple_key(F.lit(header))).first()[0]
    assert key == "ma_me_tot_enroll_orig_pct_yr_wo_ct_part_a_b"


FORMATS = {
    None: None,
    "": None,
    "General": None,
    "@": None,
    "#,##0": 0,
    "#,##0.00": 2,
    "yyyy-mm-dd": None,
    "#.##": 0,
    "0.0#": 1,
    "0.00%": 2,
    '"0.00"': None,
    "[$-409]0.000;[Red]0": 3,
    "0;0.00": 0,
}


def test_shown_decimals_column_and_helper(spark):
    df = spark.createDataFrame([(f,) for f in FORMATS], "f string")
    found = {r[0]: r[1] for r in df.select("f", shown_decimals(F.col("f"))).collect()}
    assert found == FORMATS
    assert {f: decimals_of(f) for f in FORMATS} == FORMATS


def test_heading_sample(spark):
    sheets = {"TestSheet": [["Year", "Metric", "Value"], ["I AM a Heading"], ["2023", "TotalEnroll", "100"], ["2024", "TotalEnroll", "200"]]}
    found = spark_facts(grid.grid_to_facts(make_grid(spark, sheets), ["sheet"]))["TestSheet"]
    assert len(found) == 4
    assert {row[0] for row in found} == {"I AM a Heading"}
    assert [row[4] for row in found if row[2] == "Value"] == ["100", "200"]


def test_no_header_gives_nothing(spark):
    assert grid.grid_to_facts(make_grid(spark, {"s": [["Title"], ["1"], []]}), ["sheet"]).count() == 0


EDGES = {
    "hole": [["Y", "A", "B"], ["1", "", "x"]],
    "twins": [["Y", "A", "B", "A"], ["1", "a1", "b", "a2"], ["2", "a1", "b"], ["3", "a1"]],
    "lone number": [["Y", "A"], ["5"], ["6", "x"]],
    "blank wide": [["Y", "A"], ["BLANK", "1", "2", "3"], ["6", "x"]],
    "blank header": [["BLANK", "A"], ["6", "x"]],
    "titles and notes": [["Title"], ["Y", "A"], ["BLANK"], ["1", "x"], ["Note: end"], ["2", "y"]],
    "number before header": [["7"], ["8"], ["Y", "A"], ["9"], ["1", "x"]],
    "padding": [[" Y\x1f", "A "], ["\x1c1", "x\x85"]],
    "first name again": [["Y", "Y"], ["1", "x"]],
}


@pytest.mark.parametrize("chunk_rows", [1, 2, 3, 100])
def test_edges_match_row_model(spark, chunk_rows):
    expected = {name: sorted(facts_of(rows)) for name, rows in EDGES.items()}
    found = spark_facts(grid.grid_to_facts(make_grid(spark, EDGES), ["sheet"], chunk_rows))
    assert found == {name: rows for name, rows in expected.items() if rows}


@pytest.mark.parametrize("chunk_rows", [1, 4, 1000])
def test_random_sheets_match_row_model(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    sheets = {f"s{i}": random_sheet(rng) for i in range(120)}
    expected = {name: facts_of(rows) for name, rows in sheets.items()}
    df = make_grid(spark, sheets)
    found = spark_facts(grid.grid_to_facts(df, ["sheet"], chunk_rows))
    fitting = grid.number_rows(grid.compact(df), ["sheet"], fitting=True, chunk_rows=chunk_rows)
    fitting = spark_facts(grid.wide_to_long(fitting, ["sheet", "heading", "table_row_index"]))
    assert fitting == {name: sorted(facts) for name, facts in expected.items() if facts}
    status = {r["sheet"]: r for r in grid.sheet_status(grid.compact(df), ["sheet"]).collect()}
    for name, facts in expected.items():
        over = name in status and status[name]["over"] is not None
        assert over == (facts is None), name
        if facts is not None:
            assert found.get(name, []) == sorted(facts), name
            assert (status[name]["pairs"] if name in status else 0) == len(facts), name


def test_overflow_message(spark):
    df = make_grid(spark, {"s": [["Y", "A"], ["1", "x"], ["2", "x", "y", "z"], ["3", "x", "y"]]})
    status = grid.sheet_status(grid.compact(df), ["sheet"])
    message = status.select(grid.overflow_message(F.col("over"), F.col("head_width"))).first()[0]
    assert message == "row 3: 4 cells, header has 2"


def test_rows_are_shuffled_once_and_never_by_sheet(spark):
    df = make_grid(spark, EDGES).withColumn("cells", F.concat("cells", F.array(F.lit("z"))))
    facts = grid.grid_to_facts(df, ["sheet"])
    facts.collect()
    plan = spark._jvm.PythonSQLUtils.explainString(facts._jdf.queryExecution(), "simple").split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1
    bulk = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len([line for line in bulk if "ReusedExchange" not in line]) == 1
    assert "BroadcastExchange" not in plan


def test_model_strips_like_spark():
    assert cells_of([None, " a ", " "]) == ["a"]


def test_a_null_sheet_name_is_a_sheet(spark):
    rows = [["Y", "A"], ["1", "x"], ["2", "y"]]
    df = make_grid(spark, {None: rows, "s": rows})
    found = spark_facts(grid.grid_to_facts(df, ["sheet"], chunk_rows=2))
    assert found[None] == found["s"] and len(found["s"]) == 2
    wanted = spark.createDataFrame([(None, 7)], "sheet string, extra int")
    kept = grid.number_rows(grid.compact(df), ["sheet"], wanted).select("sheet", "extra").collect()
    assert [tuple(r) for r in kept] == [(None, 7)] * 2


def test_only_wanted_sheets_are_shuffled(spark, monkeypatch):
    from gridloom.plans import ingest

    rows = [(f"l{n % 3}", n % 5, k, ["a", "b"] if not k else [str(k), "x"], "data") for n in range(15) for k in range(40)]
    grid_rows = spark.createDataFrame(rows, "load_id string, sheet_pos int, row_idx long, cells array<string>, kind string").repartition(4)
    wanted = spark.createDataFrame([("l1", 2)], "load_id string, sheet_pos int")
    kept = ingest.only_wanted(grid_rows, wanted)
    assert kept.count() == grid_rows.where("load_id = 'l1' and sheet_pos = 2").count() == 40
    plan = spark._jvm.PythonSQLUtils.explainString(grid.number_rows(kept, ingest.SHEET, wanted)._jdf.queryExecution(), "simple")
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(_sheet" in line]
    assert shuffles and plan.index("LeftSemi") > plan.index(shuffles[0])
    monkeypatch.setattr(ingest, "MOST_NAMES", 0)
    assert ingest.only_wanted(grid_rows, wanted).count() == 600
