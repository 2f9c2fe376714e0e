"""Catalog tables: schemas, creation, added columns, registration of folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.sources.staging import child_folders, holds_data


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _LONG, _TIME = T.StringType(), T.LongType(), T.TimestampType()

# Table names and columns.
FACTS = "open_cms_data_kvp"
LEDGER = "open_cms_load_ledger"
METRICS = "metrics"
SCRATCH = "test_table"

# Own additions: the partition of a load's facts, and the listed path of a file.
STAMP = "load_stamp"
# Stamp of facts that no ledger row stands for.
UNLISTED = "unlisted"
STAMP_LENGTH = 18
PARTITIONS = {FACTS: STAMP}

SCHEMAS: dict[str, T.StructType] = {
    FACTS: _struct(
        load_id=_TEXT,
        zip_name=_TEXT,
        unzipped_name=_TEXT,
        sheet_name=_TEXT,
        sheet_index=_LONG,
        heading=_TEXT,
        table_row_index=_LONG,
        table_key=_TEXT,
        table_key_simple=_TEXT,
        table_val=_TEXT,
        created_at=_TIME,
        updated_at=_TIME,
        first_col_key=_TEXT,
        first_col_val=_TEXT,
        load_stamp=_TEXT,
    ),
    LEDGER: _struct(
        zip_uri=_TEXT,
        zip_name=_TEXT,
        load_id=_TEXT,
        status=_TEXT,
        sheet_count=_LONG,
        row_count=_LONG,
        error_message=_TEXT,
        created_at=_TIME,
        updated_at=_TIME,
        source_path=_TEXT,
    ),
    METRICS: _struct(
        id=_TEXT, metric_name=_TEXT, payload=T.VariantType(), last_updated=_TIME, metric_batch_id=_TEXT
    ),
    SCRATCH: _struct(int_id=_LONG, stuff=_TEXT),
}


def _columns(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def create_table(spark: SparkSession, table: str, schema: T.StructType, provider: str = "parquet", partition: str | None = None) -> None:
    cut = f" PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema.fields)}) USING {provider}{cut}")


def add_missing_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Adds the columns of ``schema`` that ``table`` lacks; returns their names."""
    present = {name.lower() for name in spark.table(table).columns}
    missing = [f for f in schema.fields if f.name.lower() not in present]
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(missing)})")
    return [f.name for f in missing]


def create_tables(spark: SparkSession, schema: str, provider: str = "parquet", location: str | None = None) -> None:
    """The schema and its four tables, brought up to date. Safe to repeat."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")
    for name, columns in SCHEMAS.items():
        create_table(spark, f"{schema}.{name}", columns, provider, PARTITIONS.get(name))
        add_missing_columns(spark, f"{schema}.{name}", columns)


def register_folders(
    spark: SparkSession, schema: str, warehouse: str, provider: str = "parquet", known: Mapping[str, T.StructType] = SCHEMAS
) -> list[str]:
    """Registers the table folders of a schema under a warehouse root, in place.

    The columns are those of the files; a folder that was never written is registered
    where ``known`` has its columns and left out otherwise, as nothing tells them.
    """
    name = schema.split(".")[-1]
    root = warehouse if name == "default" else f"{warehouse.rstrip('/')}/{name}.db"
    folders = {t: holds_data(spark, f"{root}/{t}") for t in child_folders(spark, root)}
    found = [t for t, written in folders.items() if written or t in known]
    if not found:
        raise FileNotFoundError(f"no table folders under {root}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for table in found:
        columns = "" if folders[table] else f" ({_columns(known[table].fields)})"
        cut = f" PARTITIONED BY (`{PARTITIONS[table]}`)" if columns and table in PARTITIONS else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.`{table}`{columns} USING {provider}{cut} LOCATION '{root}/{table}'")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{schema}.`{table}`")):
            spark.catalog.recoverPartitions(f"{schema}.`{table}`")
    return found


def stamp_of(load_id: Column) -> Column:
    """The part of a load id that all files of one slice share."""
    return F.substring(load_id, 1, STAMP_LENGTH)


def loaded_facts(spark: SparkSession, schema: str, since: str | None = None) -> DataFrame:
    """Facts of finished loads, of those from the stamp ``since`` on (such as ``20240131``) if given.

    The ledger is the record of what is finished: a job lost between its two appends leaves
    facts without a ledger row. Only the partitions of finished loads are read.
    """
    done = spark.table(f"{schema}.{LEDGER}").where("status = 'loaded'").select("load_id", stamp_of(F.col("load_id")).alias(STAMP))
    facts = spark.table(f"{schema}.{FACTS}")
    if since is not None:
        done, facts = (df.where(F.col(STAMP) >= since) for df in (done, facts))
    return facts.join(done, [STAMP, "load_id"], "left_semi").select(facts.columns)


def drop_unfinished(spark: SparkSession, schema: str) -> list[str]:
    """Drops the facts of loads that were lost before their ledger rows; returns their stamps.

    No other load of the schema may be running.
    """
    table = f"{schema}.{FACTS}"
    if not any(c.isPartition for c in spark.catalog.listColumns(table)):
        return []
    found = spark.sql(f"SHOW PARTITIONS {table}").select(F.regexp_extract("partition", f"^{STAMP}=(.*)$", 1).alias(STAMP))
    done = spark.table(f"{schema}.{LEDGER}").select(stamp_of(F.col("load_id")).alias(STAMP))
    # One partition a slice: few, and only those of lost jobs come to the driver.
    lost = [row[STAMP] for row in found.where(F.col(STAMP).rlike(r"^\d{8}_\d{4}_[A-Z]{4}$")).join(done, STAMP, "left_anti").collect()]
    for stamp in lost:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({STAMP} = '{stamp}')")
    return lost
