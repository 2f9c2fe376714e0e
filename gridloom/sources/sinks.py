"""Appends to catalog tables, by column name."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.tables import METRICS


def append_by_name(df: DataFrame, table: str) -> None:
    """Appends whatever the order of the columns; the table's other columns become null."""
    wanted = df.sparkSession.table(table).schema
    given = set(df.columns)
    unknown = given - set(wanted.names)
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")
    df.select(
        *(
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted.fields
        )
    ).write.insertInto(table)


def with_audit(df: DataFrame) -> DataFrame:
    return df.withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})


def insert_row(spark: SparkSession, table: str, values: Mapping[str, Any]) -> None:
    """One literal row with an explicit column list; the table's other columns become null.

    Values are bound as parameters, so no text is ever part of the statement.
    """
    names = [name.replace("`", "``") for name in values]
    bound = ", ".join(f":v{k} AS `{name}`" for k, name in enumerate(names))
    spark.sql(f"INSERT INTO {table} BY NAME SELECT {bound}", args={f"v{k}": v for k, v in enumerate(values.values())})


def metric_rows(df: DataFrame, metric_name: Column, batch_id: str, payload: Column | None = None) -> DataFrame:
    """Rows of the metrics table; the payload is a struct, by default of all columns.

    Built from columns, so no quoting is involved; JSON writes +infinity as the
    string "Infinity", which reads back as a double.
    """
    payload = F.struct("*") if payload is None else payload
    return df.select(
        F.uuid().alias("id"),
        metric_name.alias("metric_name"),
        F.parse_json(F.to_json(payload)).alias("payload"),
        F.current_timestamp().alias("last_updated"),
        F.lit(batch_id).alias("metric_batch_id"),
    )


def save_metric(spark: SparkSession, schema: str, metric_name: str, metric: Mapping[str, Any], batch_id: str) -> None:
    """One row; a value of ``metric`` is a figure or a column."""
    payload = F.struct(*((v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in metric.items()))
    append_by_name(metric_rows(spark.range(1), F.lit(metric_name), batch_id, payload), f"{schema}.{METRICS}")
