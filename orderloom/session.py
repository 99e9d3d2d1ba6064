"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# AQE coalesces small shuffle partitions, splits skewed ones and switches to
# broadcast when a side turns out small. Columnar files hold more rows than their
# length tells, so a size estimate counts them several times before it is held
# against the broadcast limit. Merged shuffle partitions stay small, as a task's rows take
# many times their shuffled size in a hash table. UTC keeps dates the same on every host.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def build_session(app_name: str = "orderloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time settings on a session that someone else built."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's scratch data, below one that every executor reaches.

    The cluster names that folder in ``spark.checkpoint.dir``. Where the setting is
    missing, as in tests, it is the warehouse, which is shared as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/orderloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for scratch data."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}/{label}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Name and time of change, in seconds, of the folders in a folder; none where it is missing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    found = [f for f in files.listStatus(target) if f.isDirectory()]
    return sorted((f.getPath().getName(), f.getModificationTime() / 1000) for f in found)


def clear_scratch(spark: SparkSession) -> None:
    """Drop the databases and delete the files that this application keeps as
    scratch, once no result that reads them is needed."""
    mark = scratch_root(spark).rpartition("/")[2]
    for database in spark.catalog.listDatabases():
        if f"/{mark}/" in f"{database.locationUri}/":
            spark.sql(f"DROP DATABASE IF EXISTS {database.name} CASCADE")
    delete_path(spark, scratch_root(spark))
