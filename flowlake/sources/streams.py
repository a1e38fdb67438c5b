"""Streams of raw messages.

Whatever the kind, the frame has a ``value`` column holding the payload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlake.config import LakeConfig


def log_options(cfg: LakeConfig, topic: str | None = None) -> dict[str, str]:
    """Options of the message-log source."""
    limit = {"maxOffsetsPerTrigger": str(cfg.max_offsets)} if cfg.max_offsets else {}
    return limit | {
        "kafka.bootstrap.servers": cfg.brokers,
        "subscribe": topic or cfg.topic,
        "startingOffsets": cfg.starting_offsets,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }


def open_stream(spark: SparkSession, cfg: LakeConfig, kind: str = "kafka",
                path: str | None = None, max_files: int | None = None) -> DataFrame:
    """Stream of messages from the log, or from files with one message per line.

    The log needs Spark's Kafka connector on the class path.
    """
    if kind == "kafka":
        return spark.readStream.format("kafka").options(**log_options(cfg)).load()
    if kind == "text":
        max_files = max_files or cfg.max_files
        options = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
        return spark.readStream.options(**options).text(path).select(
            F.col("value"), F.col("_metadata.file_modification_time").alias("timestamp")
        )
    raise ValueError(f"unknown stream kind {kind!r}")


def follow_layer(spark: SparkSession, path: str, schema: StructType,
                 max_files: int | None = None) -> DataFrame:
    """Stream of the rows another stream commits to a layer."""
    options = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    return spark.readStream.schema(schema).options(**options).parquet(path)
