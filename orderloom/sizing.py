"""Spark's size estimates, and what is decided by them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# A shuffle partition is meant to hold about this much, by Spark's estimate, which
# counts columnar files several times. AQE merges what turns out smaller, so too
# many partitions cost little. Beyond the upper bound the driver's map of blocks,
# maps times reduces, would outgrow it; partitions then grow and spill.
PARTITION_BYTES = 512 << 20
MOST_PARTITIONS = 200_000

_SHUFFLES = "spark.sql.shuffle.partitions"
_BASE = "orderloom.shuffle.partitions.base"

# Spark gives this much, or a product of it, where it knows nothing.
_UNKNOWN = 1 << 60

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def parse_bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([bkmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def estimated_bytes(df: DataFrame) -> int | None:
    """Size of a frame as the optimizer sees it, None where that is unknown."""
    try:
        estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None
    return estimate if estimate < _UNKNOWN else None


def small_enough_to_broadcast(spark: SparkSession, df: DataFrame) -> bool:
    """Whether a frame is within Spark's broadcast limit; unknown counts as large."""
    estimate = estimated_bytes(df)
    limit = parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return estimate is not None and estimate <= limit


def size_shuffles(spark: SparkSession, *inputs: DataFrame) -> int:
    """Raise the number of shuffle partitions to fit the inputs, never lower it."""
    largest = max((estimated_bytes(df) or 0 for df in inputs), default=0)
    wanted = min(MOST_PARTITIONS, -(-largest // PARTITION_BYTES))
    current = int(spark.conf.get(_SHUFFLES))
    if wanted > current:
        if spark.conf.get(_BASE, None) is None:
            spark.conf.set(_BASE, str(current))
        spark.conf.set(_SHUFFLES, str(wanted))
    return max(wanted, current)


def restore_shuffles(spark: SparkSession) -> None:
    """Put back what ``size_shuffles`` has raised, so that the next work on the
    session is sized by its own inputs."""
    base = spark.conf.get(_BASE, None)
    if base is not None:
        spark.conf.set(_SHUFFLES, base)
        spark.conf.unset(_BASE)
