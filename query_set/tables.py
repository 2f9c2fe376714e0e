"""The driver's tables in the shapes the operators take."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from gridloom.sources.staging import new_folder
from gridloom.sources.tables import create_tables
from query_set.samples import Shared, shared_strings, xlsx_bytes, zip_bytes

PARTS_PER_FILE = 20
ORDERS_PER_FILE = 200

PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet per document: a line is a row, a comma ends a cell."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("row_idx", "line"))
    return lines.select("doc_id", "row_idx", F.split("line", ",").alias("cells"))


def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the metrics table: ``k`` of the JSON column is the number of seconds."""
    payload = F.parse_json(F.replace("props", F.lit('"k"'), F.lit('"total_seconds"')))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric_name"), payload.alias("payload"), F.col("ts").alias("last_updated")
    )


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column whose squares stay small at any size of the table."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("long"))


def as_texts(columns: list[str]) -> list[Column]:
    return [F.col(c).cast("string") for c in columns]


def part_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of the zips that :func:`part_zips` makes."""
    file_no = F.floor(F.col("p_partkey") / PARTS_PER_FILE)
    counts = table(spark, sf_dir, "part").groupBy(file_no.alias("file_no")).agg(F.count(F.lit(1)).alias("length"))
    return counts.select(F.concat(F.lit("mem:/in/"), "file_no", F.lit(".zip")).alias("path"), "length")


@F.pandas_udf(BinaryType())
def nested_csv(names: pd.Series, bodies: pd.Series) -> pd.Series:
    """A CSV in a zip in a zip."""
    return pd.Series([zip_bytes({"in.zip": zip_bytes({f"d/{n}.csv": b}), "readme.txt": ""}) for n, b in zip(names, bodies)])


def part_zips(spark: SparkSession, sf_dir: str, wide: Column | None = None) -> DataFrame:
    """Zips of CSV files, each with the parts of one key range. Where ``wide`` is true a row gets one cell too many."""
    line = F.concat_ws(",", *as_texts(PART_COLUMNS))
    if wide is not None:
        line = F.when(wide, F.concat(line, F.lit(",over"))).otherwise(line)
    lines = F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line"))))
    body = F.concat_ws("\n", F.lit("Parts"), F.lit(",".join(PART_COLUMNS)), F.array_join(F.transform("lines", lambda r: r["line"]), "\n"))
    files = (
        table(spark, sf_dir, "part")
        .groupBy(F.floor(F.col("p_partkey") / PARTS_PER_FILE).alias("file_no"))
        .agg(lines.alias("lines"))
    )
    name = F.col("file_no").cast("string")
    return files.select(F.concat(F.lit("mem:/in/"), name, F.lit(".zip")).alias("zip_uri"), nested_csv(name, body).alias("content"))


@F.pandas_udf(BinaryType())
def zipped_xlsx(orders: pd.Series) -> pd.Series:
    """A workbook with a contents sheet that leaves out its first sheet; repeated texts lie in its table of strings."""
    books = []
    for rows in orders:
        texts = sorted({r["o_orderpriority"] for r in rows} | {r["o_orderstatus"] for r in rows})
        at = {text: Shared(k) for k, text in enumerate(texts)}
        cells = [
            [int(r["o_orderkey"]), int(r["o_custkey"]), at[r["o_orderstatus"]], (float(r["o_totalprice"]), 1), None, (float(r["o_totalprice"]), 2),
             True, (int(r["day"]), 3), at[r["o_orderpriority"]]]
            for r in rows
        ]
        sheets = {
            "Left out": [["a", "b"], ["1", "2", "3"]],
            "Table of Contents": [["Contents"], ["Table Name", "Description"], ["Orders", "all of them"]],
            "Orders": [["Orders"], ["Key", "Customer", "Status", "Whole", "Exact", "Flag", "Day", "Order Total/Count"], *cells],
        }
        books.append(zip_bytes({"book.xlsx": xlsx_bytes(sheets, ["#,##0", "#,##0.00", "yyyy-mm-dd"], shared_strings(texts))}))
    return pd.Series(books)


def order_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zips of workbooks, each with the orders of one key range; days are numbers that a format shows as dates."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    row = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day.alias("day"), "o_orderpriority")
    books = (
        table(spark, sf_dir, "orders")
        .groupBy(F.floor(F.col("o_orderkey") / ORDERS_PER_FILE).alias("file_no"))
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
    )
    return books.select(F.concat(F.lit("mem:/x/"), "file_no", F.lit(".zip")).alias("zip_uri"), zipped_xlsx("rows").alias("content"))


def part_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """Parts written as CSV files with a header each."""
    folder = f"{scratch(spark)}/csv"
    parts = table(spark, sf_dir, "part").select(*PART_COLUMNS)
    parts.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", 1000).csv(folder)
    return folder


def write_files(files: DataFrame, folder: str) -> int:
    """Writes each row (``name``, ``content``) as a file of its own; a task that runs again writes the same. Their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = folder.removeprefix("file:") if folder.startswith("file:") else folder
        storage, root = fs.FileSystem.from_uri(place)
        made: set[str] = set()
        for batch in batches:
            for name, content in zip(*(batch.column(c) for c in ("name", "content")), strict=True):
                path = f"{root}/{name.as_py()}"
                parent = path.rpartition("/")[0]
                if parent not in made:
                    storage.create_dir(parent, recursive=True)
                    made.add(parent)
                with storage.open_output_stream(path) as out:
                    out.write(content.as_buffer())
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    return files.select("name", "content").mapInArrow(run, "files long").agg(F.sum("files")).first()[0] or 0


def part_zip_folder(spark: SparkSession, sf_dir: str) -> str:
    """The zips of :func:`part_zips` on storage, in two folders; every seventh is broken."""
    folder = f"{scratch(spark)}/zips"
    number = F.regexp_extract("zip_uri", r"(\d+)\.zip$", 1).cast("long")
    place = F.when(number % 2 == 0, F.lit("even/part%20")).otherwise(F.lit("odd/part%20"))
    zips = part_zips(spark, sf_dir).select(number.alias("file_no"), F.concat(place, number, F.lit(".zip")).alias("name"), "content")
    write_files(zips.withColumn("content", F.when(F.col("file_no") % 7 == 3, F.substring("content", 1, 40)).otherwise(F.col("content"))), folder)
    return folder


def scratch(spark: SparkSession) -> str:
    """A folder of its own, deleted when the driver ends."""
    return new_folder(spark, "queries")


def unique_name() -> str:
    return f"q_{uuid.uuid4().hex}"


def new_schema(spark: SparkSession) -> str:
    """A schema with the four tables, in a folder of its own."""
    name = unique_name()
    create_tables(spark, name, location=f"{scratch(spark)}/{name}.db")
    return name
