"""Baseline suppression on a stream of gold rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlake.config import LakeConfig
from flowlake.model import ALERT, GOLD, dated
from flowlake.operators.baseline import DEFAULT_LOOKBACK, judge, suppress
from flowlake.operators.rules import Rule, keep_matching
from flowlake.sources.layers import read_layer
from flowlake.sources.streams import follow_layer


def start_suppression(session, cfg: LakeConfig, rule: Rule, window_seconds: int, path: str,
                      trigger: str | None = None, lookback: int = DEFAULT_LOOKBACK,
                      **options) -> StreamingQuery:
    """Follow the stored destination profile and write the alerts that remain.

    Streams refuse ranking and range windows, so every micro-batch of new gold
    rows is judged as a batch against the stored history. Alerts are stored by
    the date of their window; those already there are left out, so neither a
    repeated batch nor a new checkpoint writes any twice or takes any away.
    """
    profile_path, schema = cfg.gold("destination_profile"), GOLD["destination_profile"]

    def judge_batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            # Only windows near this batch's can matter; the bounds reach the scans.
            first, last = rows.agg(
                F.min(F.unix_micros("window.start")), F.max(F.unix_micros("window.start"))
            ).first()
            if first is None:
                return
            span = lookback * window_seconds * 1_000_000
            earliest, latest = (F.timestamp_micros(F.lit(t)) for t in (first - span, last))
            stored = read_layer(rows.sparkSession, profile_path, dated(schema)).where(
                F.col("window.start").between(earliest, latest)
                & F.col("date").between(F.to_date(earliest), F.to_date(latest))
            ).drop("date")
            found = suppress(judge(rows, rule, window_seconds, lookback, history=stored, **options))
            known = read_layer(rows.sparkSession, path, dated(ALERT)).where(
                F.col("date") >= F.to_date(F.timestamp_micros(F.lit(first))))
            new = keep_matching(found, known, "window_start", "alert_type", "entity",
                                how="left_anti")
            new.withColumn("date", F.to_date("window_start")).write.mode("append").partitionBy(
                "date").parquet(path)
        finally:
            rows.unpersist()

    writer = (
        follow_layer(session, profile_path, dated(schema), cfg.max_files).drop("date")
        .writeStream.foreachBatch(judge_batch)
        .option("checkpointLocation", cfg.checkpoint(f"suppressed_{rule.alert_type.lower()}"))
    )
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_suppressed(spark: SparkSession, path: str) -> DataFrame:
    """The alerts all batches left."""
    return read_layer(spark, path, ALERT)
