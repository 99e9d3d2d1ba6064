"""File scans: raw CSV and landed JSON Lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.config import RawDataset
from orderloom.functions.events import EVENT_SCHEMA


# The text of a line that does not fit its dataset.
REJECTED = "rejected_line"
AUDIT_COLUMNS = ("ingestion_timestamp", "source_file")


def _reader(spark: SparkSession, dataset: RawDataset) -> DataFrameReader:
    reader = spark.read.option("header", True).options(**dataset.options)
    return reader.option("multiLine", True) if dataset.multi_line else reader


def read_raw_csv(spark: SparkSession, raw_root: str, dataset: RawDataset) -> DataFrame:
    """CSV with a header. Line breaks inside quotes split a record unless the
    dataset asks for ``multi_line``, as is Spark's default. Fields that are missing or do
    not fit their type are NULL."""
    path, reader = f"{raw_root.rstrip('/')}/{dataset.file_name}", _reader(spark, dataset)
    if dataset.schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(dataset.schema).csv(path)


def read_raw_csv_with_rejects(spark: SparkSession, raw_root: str, dataset: RawDataset) -> DataFrame:
    """The same records with one more column, ``rejected_line``: the text of a record with too
    few or too many fields, or with one that does not fit its type, else NULL. Without a
    declared schema the types are inferred first, from all records."""
    path = f"{raw_root.rstrip('/')}/{dataset.file_name}"
    if dataset.schema is None:
        schema = read_raw_csv(spark, raw_root, dataset).schema
    else:
        schema = StructType.fromDDL(dataset.schema)
    reader = _reader(spark, dataset).options(mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED)
    return reader.schema(StructType([*schema, StructField(REJECTED, StringType())])).csv(path)


def with_audit_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": F.col("_metadata.file_path"),
        }
    )


def read_landing(spark: SparkSession, path: str, route: str = "high_value", schema: str = EVENT_SCHEMA) -> DataFrame:
    """Landed events as a table. The scan goes through the folder's root, so that
    files of an uncommitted batch are left out, and prunes to one route."""
    return (
        spark.read.schema(f"{schema}, route string").json(path).where(F.col("route") == route).drop("route")
    )
