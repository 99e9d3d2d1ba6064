"""Batches of a stream that count once they are committed.

A batch writes each of its outputs to a folder of its own, ``<path>/<output>/batch=<name>``,
and then one marker to ``<path>/commits``. Readers join the outputs with the markers, so a
batch that died between its writes shows in none of them, and run again it shows in all,
once. The markers hold what the batch counted, so totals outlive the driver.

Compaction writes the lines of several batches to one folder per output, and a marker
that names the batches it replaces; with that one file, readers change over.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import delete_path, list_folder, path_bytes

MARKER_SCHEMA = (
    "batch string, run string, first long, last long, matched long, rejected long,"
    " replaced array<string>, committed timestamp"
)
KEEP_REPLACED = timedelta(days=1)
COMPACT_BYTES = 256 << 20


def _commits(path: str) -> str:
    return f"{path}/commits"


def output_path(path: str, output: str, batch: str) -> str:
    return f"{path}/{output}/batch={batch}"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The lasting name of the stream with this checkpoint: a new checkpoint, even in the
    old place, numbers its batches anew and so needs names of its own."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def batch_name(run: str, batch_id: int) -> str:
    return f"{run}-{batch_id:012d}"


def markers(spark: SparkSession, path: str) -> DataFrame:
    """All markers, those of replaced batches too."""
    if not list_folder(spark, _commits(path)):
        return spark.createDataFrame([], MARKER_SCHEMA)
    # One folder per marker, none of them a partition.
    return spark.read.schema(MARKER_SCHEMA).option("recursiveFileLookup", True).json(_commits(path))


def live_markers(spark: SparkSession, path: str) -> DataFrame:
    """The markers that count: no compaction has replaced their batch."""
    every = markers(spark, path)
    replaced = every.select(F.explode("replaced").alias("batch"))
    return every.join(replaced, "batch", "left_anti")


def is_committed(spark: SparkSession, path: str, run: str, batch_id: int) -> bool:
    reached = (F.col("first") <= batch_id) & (F.col("last") >= batch_id)
    return not markers(spark, path).where((F.col("run") == run) & reached).isEmpty()


def commit(
    spark: SparkSession,
    path: str,
    batch: str,
    run: str,
    first: int,
    last: int,
    matched: int,
    rejected: int,
    replaced: list[str] | None = None,
) -> None:
    """Make a batch count. Its marker is one file, which appears whole or not at all."""
    row = (batch, run, first, last, matched, rejected, replaced or [], datetime.now(timezone.utc))
    marker = spark.createDataFrame([row], MARKER_SCHEMA).coalesce(1)
    marker.write.mode("overwrite").json(f"{_commits(path)}/{batch}")


def read_committed(spark: SparkSession, path: str, output: str, schema: str, fmt: str = "json") -> DataFrame:
    """One output of all batches that count."""
    if not list_folder(spark, f"{path}/{output}"):
        return spark.createDataFrame([], schema)
    landed = spark.read.schema(f"{schema}, batch string").format(fmt).load(f"{path}/{output}")
    return landed.join(live_markers(spark, path).select("batch"), "batch", "left_semi").drop("batch")


@dataclass(frozen=True)
class Totals:
    batches: int
    matched: int
    rejected: int


def landed_totals(spark: SparkSession, path: str) -> Totals:
    """What all batches so far have counted, over restarts and compactions."""
    row = live_markers(spark, path).agg(
        F.coalesce(F.sum(F.col("last") - F.col("first") + 1), F.lit(0)),
        F.coalesce(F.sum("matched"), F.lit(0)),
        F.coalesce(F.sum("rejected"), F.lit(0)),
    ).first()
    return Totals(*row)


def _groups(spark: SparkSession, path: str, outputs: tuple[str, ...], most_bytes: int) -> list[list]:
    """Live batches of one stream, one after the other, that together stay within ``most_bytes``."""
    groups: list[list] = []
    size = 0
    for marker in live_markers(spark, path).orderBy("run", "first").collect():
        paths = [output_path(path, output, marker["batch"]) for output in outputs]
        here = sum(path_bytes(spark, p) for p in paths)
        if groups and groups[-1][0]["run"] == marker["run"] and size + here <= most_bytes:
            groups[-1].append(marker)
            size += here
        else:
            groups.append([marker])
            size = here
    return [g for g in groups if len(g) > 1]


def compact_batches(
    spark: SparkSession,
    path: str,
    outputs: tuple[str, ...],
    *,
    most_bytes: int = COMPACT_BYTES,
    keep: timedelta = KEEP_REPLACED,
) -> int:
    """Put the files of small batches together, in place; how many batches were replaced.

    Readers may go on, and so may the stream. Replaced files stay for ``keep``.
    """
    replaced = 0
    for group in _groups(spark, path, outputs, most_bytes):
        names = [m["batch"] for m in group]
        merged = f"{group[0]['run']}-{group[0]['first']:012d}-{uuid.uuid4().hex}"
        for output in outputs:
            paths = [output_path(path, output, name) for name in names]
            lines = spark.read.text(paths).select("value").hint("rebalance")
            lines.write.text(output_path(path, output, merged))
        counted = {name: sum(m[name] for m in group) for name in ("matched", "rejected")}
        commit(spark, path, merged, group[0]["run"], group[0]["first"], group[-1]["last"], **counted, replaced=names)
        replaced += len(names)
    remove_replaced(spark, path, outputs, keep)
    return replaced


def remove_replaced(spark: SparkSession, path: str, outputs: tuple[str, ...], keep: timedelta = KEEP_REPLACED) -> None:
    """Delete the files of batches that were replaced longer ago than ``keep``.

    A batch's own marker goes last, and those of older compactions before those of newer
    ones; a marker that names a batch outlives it.
    """
    limit = datetime.fromtimestamp(time.time() - keep.total_seconds(), timezone.utc)
    merges = markers(spark, path).where((F.size("replaced") > 0) & (F.col("committed") <= F.lit(limit)))
    for merge in merges.orderBy("committed").collect():
        for name in merge["replaced"]:
            for output in outputs:
                delete_path(spark, output_path(path, output, name))
            delete_path(spark, f"{_commits(path)}/{name}")
