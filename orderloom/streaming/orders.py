"""High-value orders out of an event stream.

The work per record has no state: parse, compare, route. ``land_orders`` writes
both routes through one file sink, whose commit log makes the output exactly
once. ``land_and_print`` also prints every match, as lines of text that the
executors write; its outputs are committed together, batch by batch (``commits``).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.config import HIGH_VALUE_THRESHOLD
from orderloom.functions.events import EVENT_SCHEMA, one_line, parse_event
from orderloom.streaming.commits import (
    COMPACT_BYTES,
    KEEP_REPLACED,
    batch_name,
    commit,
    compact_batches,
    is_committed,
    output_path,
    read_committed,
    run_of,
)

OUTPUTS = HIGH_VALUE, DEAD_LETTER, PRINTED = "high_value", "dead_letter", "printed"
PREFIX = "above threshold: "
_COUNTS = "order_events"


def route_events(values: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """``value`` text with its ``route`` and, for rejects, the ``reason``.

    Amounts strictly above the threshold are kept as they came, whatever other
    fields they carry. Text that is no JSON event, or has no amount, is a dead
    letter. All other records leave the stream here.
    """
    event = parse_event(F.col("value"))
    reason = (
        F.when(event["_broken"].isNotNull() | event.isNull(), "malformed")
        .when(event["order_amount"].isNull(), "no amount")
    )
    return (
        values.select("value", reason.alias("reason"), event["order_amount"].alias("amount"))
        .withColumn(
            "route",
            F.when(F.col("reason").isNotNull(), DEAD_LETTER).when(F.col("amount") > threshold, HIGH_VALUE),
        )
        .where(F.col("route").isNotNull())
        .select("value", "route", "reason")
    )


def _start(writer, continuous: bool, every: str) -> StreamingQuery:
    trigger = {"processingTime": every} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def land_orders(
    values: DataFrame,
    path: str,
    checkpoint: str,
    threshold: float = HIGH_VALUE_THRESHOLD,
    *,
    continuous: bool = False,
    every: str = "1 second",
) -> StreamingQuery:
    """Land both routes as JSON Lines, one folder per route. A dead letter is
    wrapped with its reason. ``drain`` reports how many took either route. A
    continuous query starts a batch, and so at least a file per route, ``every`` so
    often; ``compact_landing`` puts them together."""
    counted = route_events(values, threshold).observe(
        _COUNTS,
        F.count_if(F.col("route") == HIGH_VALUE).alias("matched"),
        F.count_if(F.col("route") == DEAD_LETTER).alias("rejected"),
    )
    lines = counted.select(
        F.when(F.col("route") == HIGH_VALUE, one_line(F.col("value")))
        .otherwise(F.to_json(F.struct("value", "reason")))
        .alias("value"),
        "route",
    )
    writer = (
        lines.writeStream.format("text")
        .partitionBy("route")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, continuous, every)


@dataclass
class StreamCounts:
    matched: int = 0
    rejected: int = 0


def land_and_print(
    values: DataFrame,
    path: str,
    checkpoint: str,
    threshold: float = HIGH_VALUE_THRESHOLD,
    *,
    counts: StreamCounts | None = None,
    preview: Callable[[str], None] | None = None,
    preview_rows: int = 20,
    continuous: bool = False,
    every: str = "1 second",
) -> StreamingQuery:
    """Land both routes per batch, and print every match to a second output.

    The batch is kept while its outputs are written, so the source is read once, and they
    count together once its marker is written. ``counts`` grows by what each batch has
    written; ``landed_totals`` gives the total over all runs. ``preview`` is no sink: it is
    called with the first ``preview_rows`` printed lines of a batch, which come to
    the driver.
    """
    counts = counts or StreamCounts()
    spark, run = values.sparkSession, None

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal run
        if run is None:
            run = run_of(spark, checkpoint)
            # Only the first batch after a start can have been committed before.
            if is_committed(spark, path, run, batch_id):
                return
        name, matched, rejected = batch_name(run, batch_id), Observation(), Observation()
        batch = batch.persist()
        try:
            matches = batch.where(F.col("route") == HIGH_VALUE).select(one_line(F.col("value")).alias("value"))
            matches.observe(matched, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").text(
                output_path(path, HIGH_VALUE, name)
            )
            dead = batch.where(F.col("route") == DEAD_LETTER).select("value", "reason")
            dead.observe(rejected, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(
                output_path(path, DEAD_LETTER, name)
            )
            printed = matches.select(F.concat(F.lit(PREFIX), "value").alias("value"))
            printed.write.mode("overwrite").text(output_path(path, PRINTED, name))
            found = matched.get["rows"], rejected.get["rows"]
            commit(spark, path, name, run, batch_id, batch_id, *found)
            if preview:
                for row in printed.take(preview_rows):
                    preview(row["value"])
        finally:
            batch.unpersist()
        counts.matched += found[0]
        counts.rejected += found[1]

    writer = (
        route_events(values, threshold)
        .writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, continuous, every)


def read_batches(spark: SparkSession, path: str, route: str = HIGH_VALUE) -> DataFrame:
    """What ``land_and_print`` has landed on one route, in committed batches."""
    schema = EVENT_SCHEMA if route == HIGH_VALUE else "value string, reason string"
    return read_committed(spark, path, route, schema)


def read_printed(spark: SparkSession, path: str) -> DataFrame:
    """The events, as JSON text, that ``land_and_print`` has printed in committed batches."""
    lines = read_committed(spark, path, PRINTED, "value string", "text")
    return lines.select(F.substring("value", len(PREFIX) + 1, 1 << 30).alias("value"))


def compact_printed_landing(
    spark: SparkSession, path: str, *, most_bytes: int = COMPACT_BYTES, keep: timedelta = KEEP_REPLACED
) -> int:
    """Put the files of ``land_and_print`` together, in place, under readers and the
    stream itself; how many batches were replaced."""
    return compact_batches(spark, path, OUTPUTS, most_bytes=most_bytes, keep=keep)


def compact_landing(spark: SparkSession, path: str, target: str) -> None:
    """Copy what ``land_orders`` has committed to ``path`` into few, even files."""
    landed = spark.read.schema("value string, route string").text(path)
    landed.hint("rebalance", "route").write.partitionBy("route").text(target)


def _is_busy(query: StreamingQuery) -> bool:
    """Starting up, or at work on a batch that has not reported yet."""
    status = query.status
    return status["isDataAvailable"] or status["message"].startswith("Initializing")


def drain(query: StreamingQuery, idle_seconds: float | None = None, poll_seconds: float = 1.0) -> StreamCounts:
    """Follow a query to its end and add up the counts it observed.

    A query over what is available ends by itself. For a continuous one give
    ``idle_seconds``: it is stopped once that long has passed without a new record.
    """
    counts, next_batch, last_input = StreamCounts(), 0, time.monotonic()

    def collect() -> None:
        nonlocal next_batch, last_input
        for progress in query.recentProgress:
            if progress.batchId < next_batch or progress.numInputRows == 0:
                continue
            next_batch, last_input = progress.batchId + 1, time.monotonic()
            observed = progress.observedMetrics.get(_COUNTS)
            if observed is not None:
                counts.matched += observed["matched"]
                counts.rejected += observed["rejected"]

    while not query.awaitTermination(poll_seconds):
        collect()
        if _is_busy(query):
            last_input = time.monotonic()
        elif idle_seconds is not None and time.monotonic() - last_input >= idle_seconds:
            query.stop()
    collect()
    return counts
