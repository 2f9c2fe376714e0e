"""Queries by operator; :mod:`query_set.oracles` has the SQL under the same names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import text
from gridloom.functions.ids import load_id
from gridloom.functions.numfmt import shown_decimals
from gridloom.functions.rates import approx_mb_per_second, guarded_ratio
from gridloom.functions.uris import base_name, decoded_uri, extension
from gridloom.operators import batches, numbers, rollup
from gridloom.operators.contents import listed_sheets, select_sheets
from gridloom.operators.grid import compact, number_rows, overflow_message, sheet_status, wide_to_long
from gridloom.operators.latency import latency_summary
from gridloom.operators.pending import FAILED, LOADED, pending_files
from gridloom.plans.ingest import decode_and_judge, file_totals, grid_facts, load_bodies, load_listed, load_new_zips, load_workbook_files, with_load_id
from gridloom.plans.workloads import rows_sent
from gridloom.sources.listing import list_files
from gridloom.sources.sinks import append_by_name, insert_row, metric_rows, save_metric
from gridloom.sources.staging import make_folder, new_folder, staged
from gridloom.sources.tables import FACTS, LEDGER, METRICS, add_missing_columns, create_table, loaded_facts, register_folders, stamp_of
from gridloom.streaming.arrivals import load_arrivals
from query_set import tables as t

DOC = ["doc_id"]
PAIR = ["first_col_val", "table_key", "table_key_simple", "table_val"]


def grid_kvp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = number_rows(compact(t.document_grid(spark, sf_dir)), DOC, fitting=True)
    return wide_to_long(rows, ["doc_id", "heading", "table_row_index"])


def grid_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = number_rows(compact(t.document_grid(spark, sf_dir)), DOC)
    return rows.select("doc_id", F.col("row_idx").cast("long"), "heading", F.get("head", F.lit(0)).alias("first_header"))


def grid_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = number_rows(compact(t.document_grid(spark, sf_dir)), DOC)
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("data_rows"), F.max("table_row_index").alias("last_index"))


def grid_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = sheet_status(compact(t.document_grid(spark, sf_dir)), DOC)
    over = F.col("over")
    return (
        t.table(spark, sf_dir, "documents")
        .select("doc_id")
        .join(status, "doc_id", "left")
        .select(
            "doc_id",
            F.when(over.isNull(), LOADED).otherwise(FAILED).alias("status"),
            F.when(over.isNull(), F.coalesce("pairs", F.lit(0))).otherwise(0).alias("row_count"),
            overflow_message(over, F.col("head_width")).alias("error_message"),
        )
    )


def text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = compact(t.document_grid(spark, sf_dir))
    return rows.groupBy("doc_id").agg(
        F.sum(F.size("cells").cast("long")).alias("cells"),
        F.count_if(text.is_text_only(F.col("cells"))).alias("text_only_rows"),
        F.count_if(text.is_filler(F.col("cells"))).alias("filler_rows"),
    )


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [F.lit(c) for c in t.ORDER_COLUMNS]
    head = F.array(*names)
    rows = t.table(spark, sf_dir, "orders").select(
        F.array(*t.as_texts(t.ORDER_COLUMNS)).alias("cells"),
        head.alias("head"),
        F.array(*map(text.simple_key, names)).alias("head_keys"),
        F.lit(None).cast("array<int>").alias("twin"),
    )
    return wide_to_long(rows, []).select(*PAIR)


def key_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.concat(
        F.lit("Medicare\t Advantage "), "p_name", F.lit(" Total Enrollment/"), "p_type", F.lit("  Percentage Without Original "),
        "p_brand", F.lit(" medicare County YEAR"),
    )
    return t.table(spark, sf_dir, "part").select("p_partkey", text.simple_key(header).alias("key"))


def format_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(
        F.when(F.col("p_size") > 25, F.concat(F.lit('"'), "p_name", F.lit('.00" #,##0'))).otherwise(F.lit("[$.000]@")),
        F.when(F.col("p_retailprice") > 950, F.concat(F.lit("."), F.repeat(F.lit("0"), F.length("p_type") % 5))).otherwise(""),
        F.lit(";0.0000"),
    )
    return t.table(spark, sf_dir, "part").select("p_partkey", shown_decimals(code).cast("long").alias("decimals"))


def toc_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a workbook; if a user begins it, it has a contents sheet that lists each turn twice."""
    turns = t.table(spark, sf_dir, "conversations")
    books = turns.where(F.col("turn") == 0).select("conv_id", (F.col("role") == "user").alias("has_contents"))
    turns = turns.join(books, "conv_id")
    name = F.concat(F.lit("turn "), "turn")
    listed_twice = F.array(
        F.struct((1_000_000 - F.col("turn")).alias("row_idx"), F.array(name, F.col("role")).alias("cells")),
        F.struct((2_000_000 - F.col("turn")).alias("row_idx"), F.array(name, F.col("text")).alias("cells")),
    )
    title = F.array(F.struct(F.lit(0).cast("long").alias("row_idx"), F.array(F.lit("Table Name"), "text").alias("cells")))
    contents = turns.where("has_contents").select(
        "conv_id", F.inline(F.when(F.col("turn") == 0, title).otherwise(listed_twice))
    )
    # Short turns are listed, but their sheets are missing.
    sheets = turns.where((F.col("turn") > 0) & (F.length("text") >= 200)).select(
        "conv_id", name.alias("sheet_name"), F.col("turn").alias("sheet_pos"), "has_contents"
    )
    listed = listed_sheets(contents, ["conv_id"])
    chosen = select_sheets(sheets, listed, ["conv_id"], "has_contents")
    return chosen.select("conv_id", "sheet_name", "sheet_pos", "sheet_index", "description")


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listed paths of one URI for every third document, one of them loaded; rows of an older ledger know no path."""

    def uri(tail: str):
        return F.concat(F.lit("s3://in/"), "doc_id", F.lit(tail))

    docs = t.table(spark, sf_dir, "documents")
    twins = F.when(F.col("doc_id") % 3 == 0, F.array(uri("%20v+1%.zip"), uri(" v+1%.zip"))).otherwise(F.array(uri("%20v+1%.zip")))
    listing = docs.select(F.explode(twins).alias("path"), F.col("n_chars").alias("length"))
    new = F.col("doc_id") % 2 == 0
    ledger = t.table(spark, sf_dir, "labels").select(
        uri(" v+1%.zip").alias("zip_uri"),
        F.when(F.col("quality") == 1, LOADED).otherwise(FAILED).alias("status"),
        F.when(new, uri("%20v+1%.zip")).alias("source_path"),
    )
    return pending_files(listing, ledger)


def uri_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.split_part(F.col("url"), F.lit("?"), F.lit(1)), F.lit("/a%20b+"), "page_id", F.lit(".ZIP"))
    return t.table(spark, sf_dir, "pages").select(
        "page_id", decoded_uri(path).alias("uri"), base_name(decoded_uri(path)).alias("name"), extension(path).alias("extension")
    )


def sheet_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    dots = F.when(F.col("doc_id") % 3 == 0, F.lit("..csv")).when(F.col("doc_id") % 3 == 1, F.lit(".csv")).otherwise(F.lit(""))
    name = F.concat(F.lit("."), "source", F.lit("_"), "lang", F.lit(".claims_of_"), "n_chars", dots)
    return t.table(spark, sf_dir, "documents").select("doc_id", text.sheet_title(name).alias("title"))


def load_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a run, which a task that runs again gives anew; those of the plan differ between runs."""
    files = t.table(spark, sf_dir, "documents").select(F.concat(F.lit("s3://in/"), "doc_id").alias("zip_uri"), "source")
    fixed = files.select("zip_uri", "source", load_id("20240131_2359_ABCD", "run", F.col("zip_uri")).alias("load_id"))
    pattern = r"^\d{8}_\d{4}_[A-Z]{4}_[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    runs = [with_load_id(files).select("zip_uri", F.col("load_id").alias(f"id{k}")) for k in range(2)]
    both = fixed.join(runs[0], "zip_uri").join(runs[1], "zip_uri")
    fresh = (F.col("id0") != F.col("id1")) & F.col("id0").rlike(pattern) & F.col("id1").rlike(pattern)
    return both.select("zip_uri", "source", "load_id", stamp_of(F.col("load_id")).alias("stamp"), fresh.alias("fresh"))


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and sizes of the texts, each a file of its own in a folder of its language; other files are left out."""
    folder = f"{t.scratch(spark)}/by_lang"
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("text").cast("binary").alias("content"))
    # Tasks that make files in one folder wait for each other: each language has a folder in sixteen places.
    place = F.concat(F.pmod(F.hash("doc_id"), F.lit(16)), F.lit("/"), "lang", F.lit("/doc "), "doc_id")
    t.write_files(docs.select(F.concat(place, F.lit(".txt")).alias("name"), "content"), folder)
    t.write_files(docs.where("doc_id % 10 = 0").select(F.concat(place, F.lit(".TXT")).alias("name"), "content"), folder)
    files = list_files(spark, folder, "*.txt")
    return files.select(base_name(F.col("path")).alias("name"), F.regexp_extract("path", "/([^/]*)/[^/]*$", 1).alias("lang"), "length")


def zip_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid, sheets = decode_and_judge(t.part_zips(spark, sf_dir), new_folder(spark, "query"))
    facts = grid_facts(grid, sheets, base_name(F.col("zip_uri")))
    return facts.select("zip_name", "unzipped_name", "sheet_name", "sheet_index", "heading", "table_row_index", "first_col_key", *PAIR)


def xlsx_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid, sheets = decode_and_judge(t.order_books(spark, sf_dir), new_folder(spark, "query"))
    facts = grid_facts(grid, sheets, base_name(F.col("zip_uri")))
    return facts.select("sheet_name", "sheet_index", *PAIR)


def zip_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every zip is loaded, then what the ledger still misses is tried again."""
    schema = t.new_schema(spark)
    zips = t.part_zips(spark, sf_dir, F.col("p_size") == 50)
    load_bodies(zips, schema)
    left = pending_files(t.part_uris(spark, sf_dir), spark.table(f"{schema}.{LEDGER}")).select("zip_uri")
    load_bodies(zips.join(left, "zip_uri", "left_semi"), schema)
    facts = loaded_facts(spark, schema).groupBy("zip_name").agg(F.count(F.lit(1)).alias("facts"))
    ledger = spark.table(f"{schema}.{LEDGER}")
    per_zip = ledger.groupBy("zip_uri", "zip_name", "status", "error_message").agg(
        F.count(F.lit(1)).alias("attempts"), F.sum("sheet_count").alias("sheets"), F.sum("row_count").alias("row_count")
    )
    return per_zip.join(facts, "zip_name", "left")


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files on storage are loaded; a second load finds nothing to do."""
    schema, folder = t.new_schema(spark), t.part_csv_folder(spark, sf_dir)
    for _ in range(2):
        load_listed(spark, schema, list_files(spark, folder, "*.csv"), zipped=False)
    return spark.table(f"{schema}.{FACTS}").select("first_col_key", *PAIR)


def zip_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested zips on storage are listed and loaded; broken ones fail, are mended and load with the second run, a third finds nothing."""
    schema, folder = t.new_schema(spark), t.part_zip_folder(spark, sf_dir)
    reports = [load_new_zips(spark, schema, folder)]
    whole = t.part_zips(spark, sf_dir).withColumn("zip_name", F.concat(F.lit("part "), base_name(F.col("zip_uri"))))
    failed = spark.table(f"{schema}.{LEDGER}").where(F.col("status") == FAILED).select("zip_name", "zip_uri", "source_path")
    relative = F.replace(F.regexp_extract("source_path", "/zips/(.*)$", 1), F.lit(" "), F.lit("%20"))
    t.write_files(whole.drop("zip_uri").join(failed, "zip_name").select(relative.alias("name"), "content"), folder)
    reports += [load_new_zips(spark, schema, folder) for _ in range(2)]
    totals = file_totals(spark, schema, reports[0] + reports[1] + reports[2]).select(base_name(F.col("zip_uri")).alias("zip_name"), "row_count")
    attempts = spark.table(f"{schema}.{LEDGER}").groupBy("zip_name").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("status") == LOADED).alias("loads"), F.sum("sheet_count").alias("sheets")
    )
    facts = loaded_facts(spark, schema).select("zip_name", "unzipped_name", "sheet_name", "sheet_index", "table_row_index", "first_col_key", *PAIR)
    return facts.join(totals, "zip_name").join(attempts, "zip_name")


def book_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks that are in no zip: facts and no ledger row."""
    schema, folder = t.new_schema(spark), t.part_csv_folder(spark, sf_dir)
    load_workbook_files(spark, schema, folder, "no zip", "*.csv")
    facts = spark.table(f"{schema}.{FACTS}").select("zip_name", "load_stamp", "first_col_key", *PAIR)
    return facts.crossJoin(F.broadcast(spark.table(f"{schema}.{LEDGER}").agg(F.count(F.lit(1)).alias("ledger_rows"))))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the stream, started twice. Between the starts a broken file is mended, and a file comes that looks old."""
    schema, folder = t.new_schema(spark), t.part_csv_folder(spark, sf_dir)
    parts = t.table(spark, sf_dir, "part")
    late = F.concat_ws("\n", F.lit("late,value"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(",", "p_partkey", "p_size"))), "\n"))
    bodies = parts.groupBy((F.col("p_partkey") % 3).alias("file_no")).agg(late.cast("binary").alias("content"))
    named = F.concat(F.lit("late"), "file_no", F.lit(".csv")).alias("name")
    broken = F.concat(F.lit(b"\xff\xfe\xff"), "content").alias("content")
    t.write_files(bodies.where("file_no < 2").select(named, broken), folder)
    for mended in (False, True):
        if mended:
            t.write_files(bodies.select(named, "content"), folder)
        load_arrivals(spark, schema, folder, f"{folder}-checkpoint", name_glob="*.csv", zipped=False).awaitTermination()
    return loaded_facts(spark, schema).select("first_col_key", *PAIR)


def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table gets a column, rows by name and a literal row; a second schema registers its folder, a partitioned one and one never written."""
    suppliers = t.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    warehouse, name = t.scratch(spark), t.unique_name()
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{warehouse}/{name}.db'")
    create_table(spark, f"{name}.suppliers", suppliers.drop("s_acctbal").schema)
    append_by_name(suppliers.select("s_name", "s_suppkey"), f"{name}.suppliers")
    add_missing_columns(spark, f"{name}.suppliers", suppliers.schema)
    append_by_name(suppliers.select("s_acctbal", "s_name", "s_suppkey"), f"{name}.suppliers")
    insert_row(spark, f"{name}.suppliers", {"s_name": "it's \"one\"; -- `row`", "s_suppkey": -1})
    copy = staged(spark.table(f"{name}.suppliers"), "suppliers", f"{warehouse}/copy_{name}.db")
    staged(t.table(spark, sf_dir, "nation").select("n_name", "n_regionkey"), "nations", f"{warehouse}/copy_{name}.db", split_by="n_regionkey")
    make_folder(spark, f"{warehouse}/copy_{name}.db/{LEDGER}")
    register_folders(spark, f"copy_{name}", warehouse)
    nations = spark.table(f"copy_{name}.nations").select(
        F.col("n_regionkey").cast("long").alias("s_suppkey"), F.col("n_name").alias("s_name"), F.lit(None).cast("double").alias("s_acctbal")
    )
    empty = spark.table(f"copy_{name}.{LEDGER}").select(
        F.col("row_count").alias("s_suppkey"), F.col("zip_name").alias("s_name"), F.lit(None).cast("double").alias("s_acctbal")
    )
    return spark.table(f"copy_{name}.suppliers").select(copy.columns).unionByName(nations).unionByName(empty)


def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.latest_batch(t.table(spark, sf_dir, "events"), "user_id", "ts")


def batch_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = batches.batch_members(t.table(spark, sf_dir, "events"), "user_id", "ts")
    return members.select("user_id", "event_id", "event_type")


def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.latest_row(t.table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")


def metric_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.total_records(t.event_metrics(spark, sf_dir))


def metric_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.average_by_metric(t.event_metrics(spark, sf_dir))


def metric_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.metrics_detail(t.event_metrics(spark, sf_dir))


def metric_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.metrics_line(t.event_metrics(spark, sf_dir))


def metric_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup(t.event_metrics(spark, sf_dir), ["date_trunc_day"], list(rollup.MEASURES))


def metric_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders become metric rows, and their payload is read back."""
    orders = t.table(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_custkey").alias("total_seconds"), "o_orderstatus")
    metrics = metric_rows(orders, F.col("o_orderpriority"), "b1", F.struct("total_seconds", "o_orderstatus"))
    status = F.variant_get("payload", "$.o_orderstatus", "string")
    seconds = rollup.total_seconds()
    return metrics.groupBy("metric_name", "metric_batch_id", status.alias("status")).agg(
        F.count("id").alias("n"), F.sum(seconds).alias("total_seconds")
    )


def metric_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric row for each order priority, saved one by one as the workloads do, with the rows a sink was given; read from the table."""
    schema, orders = t.new_schema(spark), t.table(spark, sf_dir, "orders")
    totals = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("s")).orderBy("o_orderpriority")
    for row in totals.collect():  # there are five priorities
        sent, _ = rows_sent(orders.where(F.col("o_orderpriority") == row["o_orderpriority"]))
        rate = guarded_ratio(F.lit(row["n"]), F.lit(float(row["s"])))
        save_metric(spark, schema, row["o_orderpriority"], {"total_seconds": float(row["s"]), "rows_collected": sent, "rows_per_second": rate}, "b1")
    saved = spark.table(f"{schema}.{METRICS}")
    figures = [F.variant_get("payload", f"$.{c}", kind).alias(c) for c, kind in (("rows_collected", "long"), ("rows_per_second", "double"))]
    return saved.select("metric_name", "metric_batch_id", rollup.total_seconds().alias("total_seconds"), *figures)


def derived_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, seconds = F.col("l_quantity"), F.col("l_tax")
    return t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        guarded_ratio(rows, seconds).alias("rows_per_second"),
        approx_mb_per_second(rows, seconds).alias("approx_mb_per_second"),
        guarded_ratio(F.col("l_extendedprice"), rows).alias("udf_overhead_ratio"),
    )


def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.table(spark, sf_dir, "events").select("event_type", F.col("value").cast("decimal(18,2)").alias("seconds"))
    return latency_summary(events, ["event_type"], "seconds")


def range_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.total_of(t.table(spark, sf_dir, "lineitem"), F.col("l_linenumber"))


def mod_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.totals_by(t.table(spark, sf_dir, "orders"), F.col("o_custkey") % 1000, F.col("o_custkey"))


def square_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.total_of_squares(t.line_numbers(spark, sf_dir), "l_linenumber")


def square_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.total_of_squares(t.line_numbers(spark, sf_dir), "l_linenumber", numbers.times_itself_in_python)


def md5_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.with_digest(t.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "grid_kvp": grid_kvp,
    "grid_headings": grid_headings,
    "grid_row_index": grid_row_index,
    "grid_status": grid_status,
    "text_cells": text_cells,
    "wide_to_long": wide_orders,
    "key_normalise": key_normalise,
    "format_decimals": format_decimals,
    "toc_sheets": toc_sheets,
    "pending_files": pending,
    "uri_names": uri_names,
    "sheet_titles": sheet_titles,
    "load_ids": load_ids,
    "file_listing": file_listing,
    "zip_roundtrip": zip_facts,
    "xlsx_roundtrip": xlsx_facts,
    "zip_ledger": zip_ledger,
    "csv_ingest": csv_ingest,
    "zip_ingest": zip_ingest,
    "book_ingest": book_ingest,
    "stream_ingest": stream_ingest,
    "table_lifecycle": table_lifecycle,
    "latest_batch": latest_batch,
    "batch_members": batch_members,
    "latest_row": latest_row,
    "metric_count": metric_count,
    "metric_avg": metric_avg,
    "metric_detail": metric_detail,
    "metric_line": metric_line,
    "metric_days": metric_days,
    "metric_payload": metric_payload,
    "metric_saved": metric_saved,
    "derived_rates": derived_rates,
    "latency_summary": latency,
    "range_sum": range_sum,
    "mod_group": mod_group,
    "square_native": square_native,
    "square_udf": square_udf,
    "md5_payload": md5_payload,
}
