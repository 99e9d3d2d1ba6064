"""Scratch tables, running totals and hot-key-safe helpers shared by the operators."""

from __future__ import annotations

import os
from contextlib import contextmanager
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.session import scratch_path


def show_package_to_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    On a cluster it is installed or sent along; this covers a session that was
    started from another folder of the same machine.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


class Scratch:
    """Tables in the folder that all executors share.

    A written table cuts lineage and outlives its executors. ``drop`` gives back
    the disk of a table whose readers are done.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        show_package_to_workers(spark)
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch = path
        return table

    def drop(self, *tables: DataFrame | str) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table if isinstance(table, str) else table._scratch)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (``__`` stands for a dot) for the length of a block."""
    keys = {name.replace("__", "."): value for name, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def located(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of a file scan, whose ``_metadata`` tells their place; others are written first."""
    try:
        docs.select("_metadata.row_index")
        return docs
    except AnalysisException:
        return scratch.write(docs, "located")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def running_total(
    df: DataFrame, keys: list[str], value: Column, bucket: Column, order: list[str], name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the same keys.

    Rows are ordered by ``bucket``, then by ``order``. Only the rows of one bucket
    meet in a task; before that, a group is reduced to one sum per bucket. Keys
    and bucket must not be null.
    """
    df = df.withColumn("_bucket", bucket).withColumn("_value", value.cast("long"))
    sums = df.groupBy(*keys, "_bucket").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return (
        placed.join(bases, [*keys, "_bucket"])
        .withColumn(name, F.col("_base") + F.col("_inside"))
        .drop("_bucket", "_value", "_base", "_inside")
    )


MOST_HOT = 1000


def join_counted(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key and says in
    ``count`` how many rows have it.

    Keys with more than a thousandth of the rows, and more than a thousand, number
    fewer than a thousand, so their part of the table is broadcast and their rows
    stay where they are. Only the other rows are shuffled.
    """
    total, most = table.agg(F.sum(count), F.max(count)).first()
    limit = max(MOST_HOT, (total or 0) / MOST_HOT)
    if (most or 0) <= limit:
        return rows.join(table, key)
    is_hot = F.col(count) > limit
    hot = F.broadcast(table.where(is_hot))
    others = rows.join(F.broadcast(table.where(is_hot).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(others.join(table.where(~is_hot), key))


def spread(*key: Column, buckets: int = 256) -> Column:
    """A bucket made of a row's own values, the same when a task runs again."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
