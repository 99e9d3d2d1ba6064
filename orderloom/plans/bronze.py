"""Raw files to audited tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from orderloom.config import Layers, RawDataset
from orderloom.sinks.tables import create_database, refresh_table, refresh_with_rejects
from orderloom.sources.files import (
    AUDIT_COLUMNS,
    REJECTED,
    read_raw_csv,
    read_raw_csv_with_rejects,
    with_audit_columns,
)

CONCURRENT_LOADS = 4


def ingest(
    spark: SparkSession,
    raw_root: str,
    dataset: RawDataset,
    layers: Layers,
    table_format: str = "parquet",
) -> int:
    """Load one raw dataset into its table and return the number of rows."""
    raw = with_audit_columns(read_raw_csv(spark, raw_root, dataset))
    return refresh_table(raw, layers.bronze, dataset.table, table_format=table_format)


def ingest_with_rejects(spark: SparkSession, raw_root: str, dataset: RawDataset, layers: Layers) -> tuple[int, int]:
    """Load one raw dataset into its Parquet table, and the lines that do not fit it, as they
    came, into ``<table>_rejects``; the number of rows of both, which together are the
    records read. The file is read once, and both tables are written by the same tasks."""
    raw = with_audit_columns(read_raw_csv_with_rejects(spark, raw_root, dataset))
    return refresh_with_rejects(raw, layers.bronze, dataset.table, REJECTED, AUDIT_COLUMNS)


def ingest_all(
    spark: SparkSession,
    raw_root: str,
    datasets: tuple[RawDataset, ...],
    layers: Layers,
    table_format: str = "parquet",
    *,
    rejects: bool = False,
) -> dict[str, int]:
    """Load every dataset and return the row count of each table. Some are
    submitted at a time, so that small ones do not leave executors idle. With
    ``rejects`` there is a table of rejected lines beside each."""
    if rejects and table_format != "parquet":
        raise ValueError("rejected lines are split off on Parquet tables only")
    create_database(spark, layers.bronze, layers.database_path(layers.bronze))

    def load(dataset: RawDataset) -> dict[str, int]:
        if not rejects:
            return {dataset.table: ingest(spark, raw_root, dataset, layers, table_format)}
        kept, rejected = ingest_with_rejects(spark, raw_root, dataset, layers)
        return {dataset.table: kept, f"{dataset.table}_rejects": rejected}

    with ThreadPoolExecutor(CONCURRENT_LOADS) as pool:
        return {table: rows for loaded in pool.map(load, datasets) for table, rows in loaded.items()}


def counts_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")
