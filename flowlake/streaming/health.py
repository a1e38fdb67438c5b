"""How the streams are doing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

PROGRESS = (
    "name string, batch_id bigint, trigger_time timestamp, input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, "
    "batch_duration_ms bigint, watermark timestamp, state_rows bigint, late_groups bigint"
)


def progress(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """The recent micro-batches of the given streams, one row each.

    Spark keeps a bounded number of progress reports per stream. ``late_groups``
    counts what the watermark dropped after map-side aggregation, not flows.
    """
    rows = []
    for query in queries:
        for report in query.recentProgress:
            states = report.stateOperators
            rows.append((
                query.name,
                report.batchId,
                report.timestamp,
                report.numInputRows,
                report.inputRowsPerSecond,
                report.processedRowsPerSecond,
                report.durationMs.get("triggerExecution"),
                report.eventTime.get("watermark"),
                sum(s.numRowsTotal for s in states),
                sum(s.numRowsDroppedByWatermark for s in states),
            ))
    as_text = PROGRESS.replace("trigger_time timestamp", "trigger_time string").replace(
        "watermark timestamp", "watermark string"
    )
    return spark.createDataFrame(rows, as_text).withColumns({
        "trigger_time": F.to_timestamp("trigger_time"),
        "watermark": F.to_timestamp("watermark"),
    })


def layer_health(layers: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows per layer, its newest time, and the seconds it is behind the first layer.

    ``layers`` gives the rows of each layer and the time to look at. A layer of
    windows may be ahead: its newest window ends after the flows in it.
    """
    rows = [
        df.agg(F.count("*").alias("row_count"), F.max(time).alias("newest"))
        .select(F.lit(name).alias("layer"), "row_count", "newest")
        for name, (df, time) in layers.items()
    ]
    first, time = next(iter(layers.values()))
    received = first.agg(F.unix_micros(F.max(time))).scalar()
    return reduce(DataFrame.unionByName, rows).withColumn(
        "lag_seconds", (received - F.unix_micros("newest")) / F.lit(1e6))


def alert_latency(alerts: DataFrame) -> DataFrame:
    """Seconds from the end of the event window to the alert, per alert type."""
    delay = F.unix_micros("detected_at") - F.unix_micros("window_end")
    return (
        alerts.withColumn("_delay", delay / F.lit(1_000_000))
        .groupBy("alert_type")
        .agg(
            F.count("*").alias("alerts"),
            F.min("_delay").alias("fastest_seconds"),
            F.percentile_approx("_delay", 0.5).alias("median_seconds"),
            F.percentile_approx("_delay", 0.99).alias("p99_seconds"),
        )
    )


def observed_ingest(decoded: DataFrame, name: str = "ingest") -> DataFrame:
    """Attach per-batch ingest counters to a stream of decoded messages.

    They appear under ``observedMetrics`` in the stream's progress.
    """
    return decoded.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.octet_length("raw").cast("bigint")).alias("payload_bytes"),
        F.count_if(F.col("ts").isNull()).alias("malformed"),
    )
