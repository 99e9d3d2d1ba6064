"""Order events as lines of JSON text, from a Kafka topic or from a folder.

The folder form replays the same records where no broker is at hand.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# What a micro-batch takes unless the topic says otherwise.
BATCH_RECORDS = 1_000_000
BATCH_FILES = 1000


@dataclass(frozen=True)
class Topic:
    """``transport`` is ``kafka`` (``name`` is the topic) or ``folder`` (``name``
    is a path). ``batch_limit`` bounds one micro-batch: records for Kafka (a million
    by default), files for a folder (a thousand). ``min_partitions`` lets several tasks share one hot Kafka
    partition."""

    name: str
    transport: str = "folder"
    bootstrap_servers: str | None = None
    batch_limit: int | None = None
    min_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.transport not in ("kafka", "folder"):
            raise ValueError(f"unknown transport {self.transport!r}")
        if self.transport == "kafka" and not self.bootstrap_servers:
            raise ValueError("a kafka topic needs bootstrap_servers")

    def read_options(self, streaming: bool) -> dict[str, str]:
        chosen: dict[str, str] = {}
        if self.transport == "kafka":
            chosen["kafka.bootstrap.servers"] = self.bootstrap_servers
            chosen["subscribe"] = self.name
            chosen["startingOffsets"] = "earliest"
            if self.min_partitions:
                chosen["minPartitions"] = str(self.min_partitions)
            if streaming:
                chosen["maxOffsetsPerTrigger"] = str(self.batch_limit or BATCH_RECORDS)
        elif streaming:
            chosen["maxFilesPerTrigger"] = str(self.batch_limit or BATCH_FILES)
        return {**chosen, **self.options}


def stream_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """Unbounded ``value`` column, from the earliest record. How far a query has
    read is kept in its own checkpoint."""
    reader = spark.readStream.options(**topic.read_options(streaming=True))
    if topic.transport == "kafka":
        return reader.format("kafka").load().select(F.col("value").cast("string").alias("value"))
    return reader.format("text").load(topic.name).select("value")


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """The same column for everything now in the topic, as a batch."""
    reader = spark.read.options(**topic.read_options(streaming=False))
    if topic.transport == "kafka":
        return reader.format("kafka").load().select(F.col("value").cast("string").alias("value"))
    return reader.format("text").load(topic.name).select("value")
