"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def list_columns(spark: SparkSession, database: str) -> DataFrame:
    """One row per column of every table of a database; reads metadata only."""
    rows = [
        (table.name, column.name, column.dataType)
        for table in spark.catalog.listTables(database)
        for column in spark.catalog.listColumns(f"{database}.{table.name}")
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def preview(df: DataFrame, order_by: list[str], rows: int = 10) -> DataFrame:
    """The first rows by a full order, so a preview is the same on each run. Spark
    plans this as a bounded top-k per task, not as a sort of the table."""
    return df.orderBy(*order_by).limit(rows)
