"""Publishing order events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderloom.sources.topic import Topic


def publish(values: DataFrame, topic: Topic) -> None:
    """Append a ``value`` column of JSON text to a topic, one record per row."""
    if topic.transport == "kafka":
        (
            values.select("value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", topic.bootstrap_servers)
            .option("topic", topic.name)
            .options(**topic.options)
            .save()
        )
    else:
        values.select("value").write.mode("append").text(topic.name)
