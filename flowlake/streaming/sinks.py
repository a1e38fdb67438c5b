"""Append sinks of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from flowlake.config import LakeConfig
from flowlake.operators.codec import alert_messages, encode


def append_files(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
                 trigger: str | None = "10 seconds",
                 partition_by: str | None = None, retention: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet layer, exactly once.

    ``trigger=None`` takes what is there now and stops. After ``retention`` the sink's log, and
    with it every reader, forgets a file.
    """
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if retention:
        writer = writer.option("retention", retention)
    return triggered(writer, trigger).start()


def publish_alerts(alerts: DataFrame, cfg: LakeConfig,
                   trigger: str | None = "10 seconds") -> StreamingQuery:
    """Send an alert stream to the alerts topic (needs the Kafka connector)."""
    writer = (
        alert_messages(alerts).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", cfg.brokers)
        .option("topic", cfg.alerts_topic)
        .option("checkpointLocation", cfg.checkpoint("alerts_topic"))
        .outputMode("append")
    )
    return triggered(writer, trigger).start()


def publish_rows(rows: DataFrame, cfg: LakeConfig, topic: str, key: str | None = None) -> None:
    """Send a batch of rows to a topic as JSON (needs the Kafka connector)."""
    (
        encode(rows, key).write.format("kafka")
        .option("kafka.bootstrap.servers", cfg.brokers)
        .option("topic", topic)
        .save()
    )


def triggered(writer, trigger: str | None):
    """The writer with its trigger; ``None`` takes what is there now and stops."""
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)
