import datetime as dt
import os
import random
import re
import time
import uuid

import pytest
from pyspark.sql import functions as F

from gridloom.functions.ids import ascending_letters, load_id, make_batch_id
from gridloom.functions.uris import base_name, decoded_uri, extension
from gridloom.operators.pending import pending_files
from gridloom.plans import ingest
from gridloom.sources import listing
from gridloom.sources.staging import session_conf
from gridloom.sources.tables import FACTS, LEDGER, loaded_facts
from gridloom.sources.listing import list_files
from gridloom.sources.tables import register_folders
from gridloom.streaming.arrivals import load_arrivals
from query_set import queries
from query_set.samples import xlsx_bytes, zip_bytes
from tests.row_model import facts_of

ENROLL = (
    "Visits of Gardens,,\r\n"
    '"Total, All ""X"" Gates",,\r\n'
    "Year,Total Enrollment,Total Original Percent\r\n"
    "BLANK,,\r\n"
    "2018,31250117.50004111,58.25\r\n"
    "2019,32874400.12509876,57.5\r\n"
    ",,\r\n"
    '"NOTES: one\nand two",,\r\n'
)


def put(folder, files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, body in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body if isinstance(body, bytes) else body.encode())
    return str(folder)


def ledger(spark, schema):
    return {r["zip_name"]: r for r in spark.table(f"{schema}.{LEDGER}").collect()}


def facts(spark, schema):
    return spark.table(f"{schema}.{FACTS}")


def test_nested_zip_is_loaded_once(spark, schema, tmp_path):
    inner = zip_bytes({"deep/sub/Enroll.csv": ENROLL, "readme.txt": "x"})
    prefix = put(tmp_path / "in", {"nested.zip": zip_bytes({"wrap/inner.zip": inner})})

    first = ingest.load_new_zips(spark, schema, prefix)
    again = ingest.load_new_zips(spark, schema, prefix)

    assert first == ingest.LoadReport(loaded=1, rows=4)
    assert again == ingest.LoadReport()
    rows = facts(spark, schema).where("first_col_val = '2018' and table_key = 'Total Enrollment'").collect()
    assert len(rows) == 1
    assert {
        "zip_name": "nested.zip",
        "unzipped_name": "Enroll.csv",
        "sheet_name": "Enroll",
        "sheet_index": 0,
        "heading": "",
        "table_row_index": 0,
        "table_key_simple": "tot_enroll",
        "table_val": "31250117.50004111",
        "first_col_key": "Year",
    }.items() <= rows[0].asDict().items()
    assert rows[0]["created_at"] is not None
    row = ledger(spark, schema)["nested.zip"]
    assert (row["status"], row["sheet_count"], row["row_count"], row["error_message"]) == ("loaded", 1, 4, None)
    assert row["load_id"] == rows[0]["load_id"]
    assert re.fullmatch(r"\d{8}_\d{4}_[A-Z]{4}_[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", row["load_id"])


def test_bad_files_fail_alone_and_are_retried(spark, schema, tmp_path):
    prefix = put(
        tmp_path / "in",
        {
            "good.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"}),
            "corrupt.zip": b"not a zip",
            "empty.zip": zip_bytes({"readme.txt": "x"}),
            "latin.zip": zip_bytes({"a.csv": "Y,A\n1,\xe9\n".encode("latin-1")}),
            "wide.zip": zip_bytes({"a.csv": "Y,A\n1,x\n2,x,y\n"}),
            "sub/deep.zip": zip_bytes({"b.csv": "Y,A\n1,x\n"}),
            "other.ZIP": zip_bytes({"a.csv": "Y,A\n1,x\n"}),
        },
    )
    assert ingest.load_new_zips(spark, schema, prefix) == ingest.LoadReport(loaded=2, failed=4, rows=2)
    rows = ledger(spark, schema)
    assert {n for n, r in rows.items() if r["status"] == "failed"} == {"corrupt.zip", "empty.zip", "latin.zip", "wide.zip"}
    assert rows["corrupt.zip"]["error_message"] == "File is not a zip file"
    assert rows["empty.zip"]["error_message"].startswith("target file not found within ")
    assert "codec can't decode" in rows["latin.zip"]["error_message"]
    assert rows["wide.zip"]["error_message"] == "row 3: 3 cells, header has 2"
    assert all((r["sheet_count"], r["row_count"]) == (0, 0) for r in rows.values() if r["status"] == "failed")
    assert facts(spark, schema).count() == 2

    put(tmp_path / "in", {"corrupt.zip": zip_bytes({"a.csv": "Y,A,B\n1,x,y\n"})})
    assert ingest.load_new_zips(spark, schema, prefix) == ingest.LoadReport(loaded=1, failed=3, rows=2)
    assert spark.table(f"{schema}.{LEDGER}").where("zip_name = 'corrupt.zip'").count() == 2


def test_odd_file_names(spark, schema, tmp_path):
    names = ["a+b.zip", "b[1].zip", "{x}.zip", "e%20f.zip", "bad%zz.zip", "sp ace.zip", "q#?.zip"]
    prefix = put(tmp_path / "in", {n: zip_bytes({"a.csv": f"Y,A\n1,{i}\n"}) for i, n in enumerate(names)})
    assert ingest.load_new_zips(spark, schema, prefix).loaded == len(names)
    assert set(ledger(spark, schema)) == {n.replace("%20", " ") for n in names}
    assert ingest.load_new_zips(spark, schema, prefix) == ingest.LoadReport()


def test_slices_give_the_same_as_one_batch(spark, schema, tmp_path):
    prefix = put(tmp_path / "in", {f"{i}.zip": zip_bytes({"a.csv": f"Y,A\n1,{i}\n"}) for i in range(5)})
    assert ingest.load_new_zips(spark, schema, prefix, slice_files=2) == ingest.LoadReport(loaded=5, rows=5)
    assert facts(spark, schema).select("load_id").distinct().count() == 5


def test_file_that_stops_a_job_is_cornered(spark, schema, tmp_path):
    rng = random.Random(1)
    big = "Y,A\n" + "\n".join(f"{rng.random()},{rng.random()}" for _ in range(2000))
    files = {f"{i}.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"}) for i in range(4)} | {"big.zip": zip_bytes({"a.csv": big})}
    prefix = put(tmp_path / "in", files)
    with session_conf(spark, {"spark.sql.sources.binaryFile.maxLength": "10000"}):
        assert ingest.load_new_zips(spark, schema, prefix) == ingest.LoadReport(loaded=4, failed=1, rows=4)
    row = ledger(spark, schema)["big.zip"]
    assert row["status"] == "failed" and row["error_message"] and row["zip_uri"].endswith("/in/big.zip")
    assert ingest.load_new_zips(spark, schema, prefix) == ingest.LoadReport(loaded=1, rows=2000)


def test_contents_sheet_selects_and_orders(spark, schema, tmp_path):
    data = [["Year", "Value"], ["2023", 1]]
    contents = [
        ["Workbook title"],
        ["Table Name", "Description"],
        ["SHEET_B", "", "Description B", "more"],
        [None, "only a description"],
        ["SHEET_A", "Description A"],
        ["SHEET_B", "Description B again"],
    ]
    book = {"SHEET_A": data, "HIDDEN": [["Y", "A"], [1, 2, 3]], "Table of Contents": contents, "SHEET_B": [*data, ["2024", 2]]}
    missing = {"Table of Contents": [["Table Name", "D"], ["GONE", "x"]], "SHEET_A": data}
    empty = {"Table of Contents": [["Table Name", "D"]], "SHEET_A": data}
    prefix = put(
        tmp_path / "in",
        {
            "toc.zip": zip_bytes({"t.xlsx": xlsx_bytes(book)}),
            "missing.zip": zip_bytes({"t.xlsx": xlsx_bytes(missing)}),
            "empty.zip": zip_bytes({"t.XLSX": xlsx_bytes(empty)}),
            "text.zip": zip_bytes({"Table of Contents.csv": "Y,A\n1,x\n"}),
            "bare.zip": zip_bytes({"t.xlsx": xlsx_bytes({"ONE": [["only"]], "TWO": data})}),
        },
    )
    ingest.load_new_zips(spark, schema, prefix)
    rows = ledger(spark, schema)
    found = facts(spark, schema).select("zip_name", "sheet_name", "sheet_index", "first_col_val", "table_val").collect()
    assert sorted(tuple(r)[1:] for r in found if r[0] == "toc.zip") == [
        ("SHEET_A", 1, "2023", "1"),
        ("SHEET_B", 0, "2023", "1"),
        ("SHEET_B", 0, "2024", "2"),
    ]
    assert (rows["toc.zip"]["status"], rows["toc.zip"]["sheet_count"], rows["toc.zip"]["row_count"]) == ("loaded", 2, 3)
    assert (rows["missing.zip"]["status"], rows["missing.zip"]["error_message"]) == ("failed", "no sheet named GONE")
    assert (rows["empty.zip"]["status"], rows["empty.zip"]["sheet_count"]) == ("loaded", 0)
    assert (rows["text.zip"]["status"], rows["text.zip"]["row_count"]) == ("loaded", 1)
    assert [tuple(r)[1:] for r in found if r[0] == "bare.zip"] == [("TWO", 1, "2023", "1")]
    assert (rows["bare.zip"]["sheet_count"], rows["bare.zip"]["row_count"]) == (2, 1)


def test_broken_sheet_matters_only_if_selected(spark, schema, tmp_path):
    good, broken = [["Y", "A"], ["1", "x"]], "<worksheet><sheetData><row><c><v>1</v></c></row>"
    contents = {n: [["Table Name", "D"], [n, "d"], [n, "again"]] for n in ("GOOD", "BROKEN")}
    books = {
        "unlisted.zip": {"BROKEN": broken, "Table of Contents": contents["GOOD"], "GOOD": good},
        "listed.zip": {"BROKEN": broken, "Table of Contents": contents["BROKEN"], "GOOD": good},
        "all.zip": {"GOOD": good, "BROKEN": broken},
        "contents.zip": {"GOOD": good, "Table of Contents": broken},
    }
    prefix = put(tmp_path / "in", {n: zip_bytes({"b.xlsx": xlsx_bytes(b)}) for n, b in books.items()})
    assert ingest.load_new_zips(spark, schema, prefix) == ingest.LoadReport(loaded=1, failed=3, rows=1)
    rows = ledger(spark, schema)
    assert rows["unlisted.zip"]["status"] == "loaded"
    assert all("no element found" in rows[n]["error_message"] for n in ("listed.zip", "all.zip", "contents.zip"))


def test_workbook_without_zip(spark, schema, tmp_path):
    path = put(tmp_path / "in", {"A very long name of a file_2023.v2, more.csv": ENROLL})
    assert ingest.load_workbook_files(spark, schema, path) == ingest.LoadReport(loaded=1, rows=4)
    row = facts(spark, schema).first()
    assert row["zip_name"] == "placeholder.zip"
    assert row["sheet_name"] == "A very long name of a file_2023.v2, more"[:31]
    assert spark.table(f"{schema}.{LEDGER}").count() == 0


def test_workbook_of_unknown_kind_is_an_error(spark, schema, tmp_path):
    path = put(tmp_path / "in", {"x.nope": "a"})
    with pytest.raises(ValueError, match="no reader for .nope files: x.nope"):
        ingest.load_workbook_files(spark, schema, path)


def test_facts_match_row_model(spark, schema, tmp_path):
    sheet = [["T"], ["Y", "A", "A"], ["h one"], ["1", "2", "3"], ["5"], ["h two"], ["2", "", "4"], ["BLANK", "1"]]
    body = "\n".join(",".join(r) for r in sheet)
    prefix = put(tmp_path / "in", {"m.zip": zip_bytes({"m.csv": "﻿" + body})})
    report = ingest.load_new_zips(spark, schema, prefix)
    columns = ["heading", "table_row_index", "table_key", "table_key_simple", "table_val", "first_col_key", "first_col_val"]
    found = sorted(tuple(r) for r in facts(spark, schema).select(columns).collect())
    assert found == sorted(facts_of(sheet))
    assert report.rows == len(found)


def test_unfinished_load_is_invisible(spark, schema, tmp_path):
    prefix = put(tmp_path / "in", {"a.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"})})
    ingest.load_new_zips(spark, schema, prefix)
    facts(spark, schema).withColumn("load_id", F.lit("lost")).write.insertInto(f"{schema}.{FACTS}")
    assert facts(spark, schema).count() == 2
    assert loaded_facts(spark, schema).count() == 1


def test_listing_reads_no_bodies(spark, tmp_path):
    prefix = put(tmp_path / "in", {"a.zip": b"1", "b.txt": b"22", "sub/c.zip": b"333"})
    files = listing.list_files(spark, prefix, "*.zip")
    assert sorted(r["length"] for r in files.collect()) == [1, 3]
    assert listing.list_files(spark, prefix, "*.zip", recursive=False).count() == 1
    plan = spark._jvm.PythonSQLUtils.explainString(files._jdf.queryExecution(), "simple")
    assert "content" not in plan
    bodies = listing.read_bodies(spark, [r["path"] for r in files.collect()])
    assert sorted(bytes(r["content"]) for r in bodies.collect()) == [b"1", b"333"]


def test_many_small_files_take_few_tasks(spark, tmp_path):
    prefix = put(tmp_path / "in", {f"{n}.zip": b"1" for n in range(200)})
    paths = [r["path"] for r in listing.list_files(spark, prefix).collect()]
    context = spark.sparkContext
    context.setJobGroup("lookup", "lookup")
    try:
        listing.read_bodies(spark, paths)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("lookup") for s in tracker.getJobInfo(job).stageIds]
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) <= listing.LOOKUP_TASKS
    with session_conf(spark, ingest.DECODE_CONF):
        bodies = listing.read_bodies(spark, paths)
        assert bodies.rdd.getNumPartitions() <= 8
        assert bodies.count() == 200


def test_long_listing_takes_few_tasks(spark, tmp_path):
    prefix = put(tmp_path / "in", {f"{n % 3}/{n}.zip": b"1" for n in range(1_000)})
    files = listing.list_files(spark, prefix, "*.zip")
    assert files.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert files.count() == files.select("path").distinct().count() == 1_000
    assert listing.list_files(spark, f"{prefix}/1", "*.txt").count() == 0


def test_texts_of_a_language_lie_in_several_folders(spark, tmp_path, monkeypatch):
    rows = [(n, "one" if n % 2 else "two", f"text {n}") for n in range(64)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    listed = []
    monkeypatch.setattr(queries, "list_files", lambda *given: listed.append(listing.list_files(*given)) or listed[0])
    found = {tuple(r) for r in queries.file_listing(spark, str(tmp_path)).collect()}
    assert found == {(f"doc {n}.txt", lang, len(text)) for n, lang, text in rows}
    assert len({r["path"].rpartition("/")[0] for r in listed[0].collect()}) > 8


def test_pending(spark):
    files = spark.createDataFrame(
        [("s3:/t/1.zip", 1), ("s3:/t/2.zip", 1), ("s3:/t/2.zip", 1), ("s3:/t/3%204.zip", 1), ("s3:/t/5.zip", 1)],
        "path string, length long",
    )
    done = spark.createDataFrame(
        [("s3:/t/1.zip", "loaded"), ("s3:/t/3 4.zip", "loaded"), ("s3:/t/5.zip", "failed")], "zip_uri string, status string"
    )
    assert sorted(r["zip_uri"] for r in pending_files(files, done).collect()) == ["s3:/t/2.zip", "s3:/t/5.zip"]


def test_paths_that_decode_to_one_are_both_loaded(spark, schema, tmp_path):
    listed = spark.createDataFrame([("s3:/t/e f.zip", 1), ("s3:/t/e%20f.zip", 1), ("s3:/t/g%20h.zip", 1)], "path string, length long")
    none = spark.createDataFrame([], "zip_uri string, status string")
    assert sorted(r["zip_uri"] for r in pending_files(listed, none).collect()) == ["s3:/t/e f.zip", "s3:/t/e%20f.zip", "s3:/t/g h.zip"]
    folder = put(tmp_path / "in", {n: zip_bytes({"a.csv": "Y,A\n1,x\n"}) for n in ("e f.zip", "e%20f.zip")})
    assert ingest.load_new_zips(spark, schema, folder).loaded == 2
    assert ingest.load_new_zips(spark, schema, folder).loaded == 0


def test_a_bad_workbook_leaves_no_facts_of_others(spark, schema, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "SLICE_FILES", 1)
    folder = put(tmp_path / "in", {"a.csv": "Y,A\n1,x\n", "b.csv": "Y,A\n1,x,over\n"})
    with pytest.raises(ValueError, match="cells"):
        ingest.load_workbook_files(spark, schema, folder)
    assert facts(spark, schema).count() == 0


def test_uri_functions(spark):
    df = spark.createDataFrame([("s3://b/a+b%20c.zip",), ("s3://b/x%zz",), ("s3://b/.hidden",)], "u string")
    rows = [tuple(r) for r in df.select(decoded_uri(F.col("u")), base_name(F.col("u")), extension(F.col("u"))).collect()]
    assert rows == [
        ("s3://b/a+b c.zip", "a+b%20c.zip", ".zip"),
        ("s3://b/x%zz", "x%zz", ""),
        ("s3://b/.hidden", ".hidden", ""),
    ]


def test_ids(spark):
    moments = [dt.datetime(2024, 1, 1, 0, 0, s, ms * 1000) for s in (0, 1, 59) for ms in (0, 1, 999)]
    letters = [ascending_letters(m) for m in moments]
    assert letters == sorted(letters) and len(set(letters)) == len(letters)
    assert re.fullmatch(r"\d{8}_\d{4}_[A-Z]{4}_[0-9a-f-]{36}", make_batch_id())
    ids = spark.range(2).select(load_id("20240101_0000_AAAA", "run", F.col("id").cast("string")).alias("i"))
    first, second = (r["i"] for r in ids.collect())
    assert first != second and [r["i"] for r in ids.collect()] == [first, second]


def test_stream_loads_arrivals(spark, schema, tmp_path):
    prefix = put(tmp_path / "in", {"a.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"}), "bad.zip": b"x"})
    checkpoint = str(tmp_path / "cp")

    def run(retry):
        load_arrivals(spark, schema, prefix, checkpoint, retry_failed=retry).awaitTermination()

    run(False)
    assert facts(spark, schema).count() == 1
    put(tmp_path / "in", {"b.zip": zip_bytes({"a.csv": "Y,A\n1,x\n2,y\n"}), "bad.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"})})
    run(False)
    run(True)
    run(True)
    assert sorted(r["zip_name"] for r in spark.table(f"{schema}.{LEDGER}").where("status = 'loaded'").collect()) == [
        "a.zip",
        "b.zip",
        "bad.zip",
    ]
    assert facts(spark, schema).count() == 4


def test_vanished_file_fails_alone(spark, schema, tmp_path):
    put(tmp_path / "in", {f"{name}.zip": zip_bytes({f"{name}.csv": ENROLL}) for name in ("good", "gone")})
    files = list_files(spark, str(tmp_path / "in"))
    listing = spark.createDataFrame(files.collect(), files.schema)
    (tmp_path / "in" / "gone.zip").unlink()
    report = ingest.load_listed(spark, schema, listing)
    assert (report.loaded, report.failed) == (1, 1)
    rows = {r["zip_name"]: r["status"] for r in spark.table(f"{schema}.open_cms_load_ledger").collect()}
    assert rows == {"good.zip": "loaded", "gone.zip": "failed"}


def test_failing_staging_is_raised(spark, schema, tmp_path, monkeypatch):
    put(tmp_path / "in", {f"f{k}.zip": zip_bytes({"a.csv": ENROLL}) for k in range(4)})
    tries = []

    def full(*args):
        tries.append(1)
        raise OSError("staging folder is full")

    monkeypatch.setattr(ingest, "decode_and_judge", full)
    with pytest.raises(OSError, match="full"):
        ingest.load_listed(spark, schema, list_files(spark, str(tmp_path / "in")))
    assert len(tries) == 1
    assert spark.table(f"{schema}.open_cms_load_ledger").count() == 0


def test_old_and_mended_files_come_with_the_next_arrival(spark, schema, tmp_path):
    folder = put(tmp_path / "in", {"bad.zip": b"broken", "first.zip": zip_bytes({"a.csv": ENROLL})})
    folder = tmp_path / "in"
    load_arrivals(spark, schema, str(folder), str(tmp_path / "check")).awaitTermination()
    put(folder, {"bad.zip": zip_bytes({"b.csv": ENROLL}), "old.zip": zip_bytes({"c.csv": ENROLL})})
    os.utime(folder / "old.zip", (1_000_000_000, 1_000_000_000))
    load_arrivals(spark, schema, str(folder), str(tmp_path / "check")).awaitTermination()
    done = spark.table(f"{schema}.open_cms_load_ledger").where("status = 'loaded'")
    assert sorted(r["zip_name"] for r in done.collect()) == ["bad.zip", "first.zip", "old.zip"]


def test_partitioned_folder_registers_with_its_rows(spark, tmp_path):
    name = f"reg_{uuid.uuid4().hex[:8]}"
    spark.range(10).selectExpr("id", "id % 3 AS part").write.partitionBy("part").parquet(f"{tmp_path}/{name}.db/t")
    assert register_folders(spark, name, str(tmp_path)) == ["t"]
    assert spark.table(f"{name}.t").count() == 10
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def listing_of(spark, folder):
    files = list_files(spark, str(folder))
    return spark.createDataFrame(files.collect(), files.schema)


def test_second_path_of_a_uri_is_loaded_once(spark, schema, tmp_path):
    folder = put(tmp_path / "in", {"e%20f.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"})})
    assert ingest.load_new_zips(spark, schema, folder).loaded == 1
    put(tmp_path / "in", {"e f.zip": zip_bytes({"a.csv": "Y,A\n2,y\n"})})
    assert [r["path"].rpartition("/")[2] for r in pending_files(list_files(spark, folder), spark.table(f"{schema}.{LEDGER}")).collect()] == ["e f.zip"]
    assert ingest.load_new_zips(spark, schema, folder).loaded == 1
    assert ingest.load_new_zips(spark, schema, folder) == ingest.LoadReport()
    assert sorted(r["first_col_val"] for r in facts(spark, schema).collect()) == ["1", "2"]


def test_ledger_rows_without_a_path_cover_their_uri(spark):
    listed = spark.createDataFrame([("a%20b", 1), ("c d", 1), ("c%20d", 2), ("x%zz%20", 3)], "path string, length long")
    old = spark.createDataFrame([("a b", "loaded"), ("c d", "loaded"), ("x%zz ", "failed")], "zip_uri string, status string")
    assert sorted(map(tuple, pending_files(listed, old).collect())) == [("c%20d", "c%20d", 2), ("x%zz ", "x%zz%20", 3)]


def test_lost_storage_is_an_error_and_no_ledger_row(spark, schema, tmp_path):
    put(tmp_path / "in", {f"{k}.zip": zip_bytes({"a.csv": ENROLL}) for k in range(5)})
    listing = listing_of(spark, tmp_path / "in")
    (tmp_path / "in").rename(tmp_path / "elsewhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest.load_listed(spark, schema, listing)
    assert spark.table(f"{schema}.{LEDGER}").count() == facts(spark, schema).count() == 0
    (tmp_path / "elsewhere").rename(tmp_path / "in")
    assert ingest.load_listed(spark, schema, listing).loaded == 5


def test_bodies_that_never_arrive_fail_without_halving(spark, schema, tmp_path, monkeypatch):
    put(tmp_path / "in", {f"{k}.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"}) for k in range(40)})
    listing = listing_of(spark, tmp_path / "in")
    jobs, read = [], ingest.read_bodies

    def unreadable(*args, **options):
        jobs.append(1)
        return read(*args, **options).where(~F.col("path").endswith("/7.zip"))

    monkeypatch.setattr(ingest, "read_bodies", unreadable)
    assert ingest.load_listed(spark, schema, listing) == ingest.LoadReport(loaded=39, failed=1, rows=39)
    assert len(jobs) == 1
    row = ledger(spark, schema)["7.zip"]
    assert (row["status"], row["error_message"]) == ("failed", ingest.NOT_DELIVERED) and row["source_path"].endswith("/7.zip")
    monkeypatch.setattr(ingest, "read_bodies", lambda *args, **options: read(*args, **options).where("false"))
    put(tmp_path / "in", {f"more{k}.zip": b"x" for k in range(2)})
    with pytest.raises(OSError, match="none of 3 listed files can be read"):
        ingest.load_listed(spark, schema, listing_of(spark, tmp_path / "in"))
    assert spark.table(f"{schema}.{LEDGER}").count() == 40


@pytest.mark.parametrize("bad", [{"3.zip"}, set()])
def test_crashing_bodies_are_cornered_and_a_crashing_cluster_is_not_booked(spark, schema, tmp_path, monkeypatch, bad):
    put(tmp_path / "in", {f"{k}.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"}) for k in range(9)})
    load = ingest._load_piece

    def crashing(spark, schema, files, zipped):
        if not bad or any(f["path"].rpartition("/")[2] in bad for f in files):
            raise RuntimeError("Python worker exited unexpectedly (crashed)")
        return load(spark, schema, files, zipped)

    monkeypatch.setattr(ingest, "_load_piece", crashing)
    if bad:
        assert ingest.load_listed(spark, schema, list_files(spark, str(tmp_path / "in"))) == ingest.LoadReport(loaded=8, failed=1, rows=8)
        assert "crashed" in ledger(spark, schema)["3.zip"]["error_message"]
    else:
        with pytest.raises(RuntimeError, match="crashed"):
            ingest.load_listed(spark, schema, list_files(spark, str(tmp_path / "in")))
        assert spark.table(f"{schema}.{LEDGER}").count() == 0


def test_a_load_lost_between_its_sinks_leaves_nothing(spark, schema, tmp_path, monkeypatch):
    folder = put(tmp_path / "in", {"a.zip": zip_bytes({"a.csv": "Y,A\n1,x\n2,y\n"})})
    append = ingest.append_by_name

    def killed(df, table):
        if table.endswith(LEDGER):
            raise KeyboardInterrupt
        append(df, table)

    monkeypatch.setattr(ingest, "append_by_name", killed)
    with pytest.raises(KeyboardInterrupt):
        ingest.load_new_zips(spark, schema, folder)
    monkeypatch.setattr(ingest, "append_by_name", append)
    ingest.load_workbook_files(spark, schema, put(tmp_path / "books", {"b.csv": "Y,A\n5,x\n"}))
    assert facts(spark, schema).count() == 3 and loaded_facts(spark, schema).count() == 0
    report = ingest.load_new_zips(spark, schema, folder)
    assert report == ingest.LoadReport(loaded=1, rows=2)
    assert sorted(r["first_col_val"] for r in facts(spark, schema).collect()) == ["1", "2", "5"]
    assert [tuple(r)[1] for r in ingest.file_totals(spark, schema, report).collect()] == [2]


def test_only_partitions_of_finished_loads_are_read(spark, schema, tmp_path):
    folder = put(tmp_path / "in", {f"{k}.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"}) for k in range(3)})
    ingest.load_new_zips(spark, schema, folder, slice_files=1)
    found = loaded_facts(spark, schema, since="2000")
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[.*load_stamp#\d+ >= 2000", plan) and "dynamicpruning" in plan
    assert found.count() == 3 and loaded_facts(spark, schema, since="9999").count() == 0


def test_quiet_and_mended_files_load_without_an_arrival(spark, schema, tmp_path):
    folder = tmp_path / "in"
    put(folder, {"bad.zip": b"broken", "a.zip": zip_bytes({"a.csv": "Y,A\n1,x\n"})})
    query = load_arrivals(spark, schema, str(folder), str(tmp_path / "check"), available_now=False, quiet_seconds=4, trigger="1 second")

    def wait_for(names):
        deadline = time.time() + 90
        while time.time() < deadline:
            spark.catalog.refreshTable(f"{schema}.{LEDGER}")
            rows = spark.table(f"{schema}.{LEDGER}").collect()
            if {r["zip_name"] for r in rows if r["status"] == "loaded"} == names:
                return rows
            time.sleep(1)
        raise AssertionError(f"still {rows}")

    try:
        wait_for({"a.zip"})
        put(folder, {"last.zip": zip_bytes({"a.csv": "Y,A\n2,x\n"})})
        wait_for({"a.zip", "last.zip"})
        put(folder, {"bad.zip": zip_bytes({"a.csv": "Y,A\n3,x\n"})})
        rows = wait_for({"a.zip", "last.zip", "bad.zip"})
    finally:
        query.stop()
    # A file that fails is not tried again at every tick.
    assert sum(r["zip_name"] == "bad.zip" for r in rows) <= 3


def test_folder_never_written_registers_with_known_columns(spark, tmp_path):
    name = f"reg_{uuid.uuid4().hex[:8]}"
    for table in (FACTS, LEDGER, "unknown"):
        (tmp_path / f"{name}.db" / table).mkdir(parents=True)
    assert register_folders(spark, name, str(tmp_path)) == sorted([FACTS, LEDGER])
    assert spark.table(f"{name}.{FACTS}").count() == spark.table(f"{name}.{LEDGER}").count() == 0
    spark.sql(f"DROP SCHEMA {name} CASCADE")
