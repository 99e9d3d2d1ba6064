"""Catalog writes."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from orderloom.session import delete_path
from orderloom.sinks import versions
from orderloom.sinks.versions import COMPACT_BYTES, KEEP_OLD, MOST_PARTS, PART_BYTES, VersionedTable


def create_database(spark: SparkSession, database: str, path: str | None = None) -> None:
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{location}")


def compacted(df: DataFrame) -> DataFrame:
    """Even files of the size AQE aims at, however many tasks made the rows."""
    return df.hint("rebalance")


def refresh_table(
    df: DataFrame,
    database: str,
    table: str,
    *,
    table_format: str = "parquet",
    cluster_by: tuple[str, ...] = (),
    compact: bool = False,
    keep: timedelta = KEEP_OLD,
) -> int:
    """Replace a table with its schema and return the number of rows written.

    On Parquet readers see the old table until the new one is complete, and those that
    were planned before finish on the old files, which stay for ``keep``. Other formats
    commit in their own way and answer a count from their metadata.
    """
    if compact and not cluster_by:
        df = compacted(df)
    if table_format == "parquet":
        return versions.refresh(VersionedTable(df.sparkSession, database, table), df, cluster_by, keep)
    name = f"{database}.{table}"
    if cluster_by:
        df = versions.in_key_order(df, cluster_by).drop(versions.PART)
    writer = df.write.format(table_format).mode("overwrite")
    if table_format == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(name)
    return df.sparkSession.table(name).count()


def refresh_with_rejects(
    df: DataFrame, database: str, table: str, record: str, kept_with: tuple[str, ...], *, keep: timedelta = KEEP_OLD
) -> tuple[int, int]:
    """Refresh a Parquet table with the rows whose ``record`` is NULL, and ``<table>_rejects`` with
    that text of all others and the columns ``kept_with``, from one pass over the rows."""
    spark, others = df.sparkSession, f"{table}_rejects"
    return versions.refresh_split(
        VersionedTable(spark, database, table),
        VersionedTable(spark, database, others),
        df,
        df[record].isNull(),
        tuple(c for c in df.columns if c != record),
        (record, *kept_with),
        keep,
    )


def append_table(
    df: DataFrame, database: str, table: str, table_format: str = "parquet", *, most_parts: int = MOST_PARTS
) -> None:
    """Add rows to a table, or start it. On Parquet, small parts are put together once
    there are more than ``most_parts``."""
    if table_format == "parquet":
        versions.append(VersionedTable(df.sparkSession, database, table), df, most_parts)
    else:
        df.write.format(table_format).mode("append").saveAsTable(f"{database}.{table}")


def compact_table(
    spark: SparkSession, database: str, table: str, *, most_bytes: int = COMPACT_BYTES, keep: timedelta = KEEP_OLD
) -> int:
    """Put the small parts of a Parquet table together, in place; how many there were."""
    return versions.compact(VersionedTable(spark, database, table), most_bytes, keep)


def cluster_table(
    spark: SparkSession,
    database: str,
    table: str,
    *columns: str,
    part_bytes: int = PART_BYTES,
    keep: timedelta = KEEP_OLD,
) -> int:
    """Order a Parquet table by ``columns``, in place, rewriting only what overlaps or is
    small; how many parts were rewritten. Worth calling again and again on a table that grows."""
    return versions.cluster(VersionedTable(spark, database, table), columns, part_bytes, keep)


def remove_old_versions(spark: SparkSession, database: str, table: str, keep: timedelta = KEEP_OLD) -> None:
    """Delete files of a Parquet table that were replaced, or left behind, longer ago than ``keep``."""
    VersionedTable(spark, database, table).remove_old(keep)


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    """Drop a Parquet table together with all its files."""
    gone = VersionedTable(spark, database, table)
    spark.sql(f"DROP VIEW IF EXISTS {gone.name}")
    delete_path(spark, gone.path(gone.folder))
