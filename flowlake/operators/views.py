"""Read-side views over flows and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.operators.rules import SYN_RATIO

# Columns of the enriched-flow listing, in order.
SILVER_LISTING = (
    "ts", "src_ip", "dst_ip", "src_subnet_24", "dst_subnet_24", "is_private_src",
    "is_private_dst", "dst_port", "dst_service", "proto", "bytes", "packets",
)

# How many peers make a gold row worth highlighting.
SUSPECT_SOURCES = 100
SUSPECT_DESTINATIONS = 50


def available(df: DataFrame, wanted: tuple[str, ...] = SILVER_LISTING) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*(name for name in wanted if name in df.columns))


def syn_ratio(profile: DataFrame) -> DataFrame:
    """Add the share of pure SYN flows among the TCP flows of a profile row."""
    return profile.withColumn("syn_ratio", F.expr(SYN_RATIO))


def flag_above(gold: DataFrame, measure: str, limit: int) -> DataFrame:
    """Add ``is_suspect``: the measure lies above ``limit``."""
    return gold.withColumn("is_suspect", F.col(measure) > limit)


def flag_destinations(gold: DataFrame) -> DataFrame:
    return flag_above(gold, "unique_sources", SUSPECT_SOURCES)


def flag_talkers(gold: DataFrame) -> DataFrame:
    return flag_above(gold, "unique_destinations", SUSPECT_DESTINATIONS)


def service_distribution(flows: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent destination services."""
    counts = flows.groupBy("dst_service").agg(F.count("*").alias("flow_count"))
    return counts.orderBy(F.desc("flow_count"), F.asc("dst_service")).limit(k)


def rows_per_date(silver: DataFrame) -> DataFrame:
    return silver.groupBy("date").agg(F.count("*").alias("flow_count"))


def ingest_stats(decoded: DataFrame, window: str = "1 minute",
                 watermark: str = "2 minutes") -> DataFrame:
    """Messages, payload bytes, malformed records and rate per arrival window.

    ``decoded`` holds ``raw``, the decoded ``ts`` and the log's ``timestamp``.
    """
    arrived = decoded.withWatermark("timestamp", watermark)
    stats = arrived.groupBy(F.window("timestamp", window)).agg(
        F.count("*").alias("messages"),
        F.coalesce(F.sum(F.octet_length("raw").cast("bigint")), F.lit(0).cast("bigint")).alias(
            "payload_bytes"
        ),
        F.count_if(F.col("ts").isNull()).alias("malformed"),
    )
    seconds = (
        F.col("window.end").cast("timestamp").cast("bigint")
        - F.col("window.start").cast("timestamp").cast("bigint")
    )
    return stats.withColumn("messages_per_second", F.col("messages") / seconds)
