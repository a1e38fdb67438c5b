"""What the streams did, kept in stored tables: batches, throughput, alert latency.

Spark keeps a bounded number of progress reports per stream and forgets them with the
application. ``BatchLog`` listens to the streams of a session and stores every report; latencies
are stored as one KLL sketch per batch and alert type, so quantiles over any span of batches come
from merging sketches, without the alerts.
"""

from __future__ import annotations

from datetime import datetime
from threading import Condition

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from flowlake.config import LakeConfig
from flowlake.model import ALERT, BATCHES, LATENCY, dated
from flowlake.sources.layers import read_layer
from flowlake.sources.streams import follow_layer
from flowlake.streaming.sinks import triggered

#: Name under which a sink's stream reports what it writes.
WRITTEN = "written"
#: Size of the latency sketches: quantiles are off by about 1.3 % of the ranks at most.
SKETCH_K = 200


def observed(rows: DataFrame, time: str | None) -> DataFrame:
    """Attach the counters of a sink's rows to each micro-batch's report."""
    at = F.col(time) if time else F.lit(None).cast("timestamp")
    return rows.observe(
        WRITTEN,
        F.count(F.lit(1)).alias("written_rows"),
        F.unix_micros(F.min(at)).alias("first_us"),
        F.unix_micros(F.max(at)).alias("last_us"),
    )


def _moment(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def _row(report) -> tuple:
    seen = report.observedMetrics.get(WRITTEN)
    states = report.stateOperators
    return (
        report.name, str(report.runId), report.batchId, _moment(report.timestamp),
        report.numInputRows, seen.written_rows if seen else None,
        seen.first_us if seen else None, seen.last_us if seen else None,
        report.durationMs.get("triggerExecution"), _moment(report.eventTime.get("watermark")),
        sum(s.numRowsTotal for s in states), sum(s.numRowsDroppedByWatermark for s in states),
        report.timestamp[:10],
    )


class BatchLog(StreamingQueryListener):
    """Stores a row per micro-batch of the session's named streams.

    Rows are written in groups of ``flush_every`` and when a stream ends, each group as one file,
    stored by date. A batch that is reported again after a restart is stored again; readers take
    the last report of a stream's batch. Reports that come between a group's last write and a
    crash of the driver are lost, ``flush_every - 1`` at most. Batches without input and output
    (idle triggers) are not stored.
    """

    def __init__(self, session: SparkSession, path: str, flush_every: int = 6):
        self.session, self.path, self.flush_every = session, path, flush_every
        self._waiting: list[tuple] = []
        self._changed = Condition()
        self._ended: set[str] = set()

    def __enter__(self) -> BatchLog:
        self.session.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.session.streams.removeListener(self)
        self._flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        self._flush()

    def onQueryProgress(self, event) -> None:
        report = event.progress
        seen = report.observedMetrics.get(WRITTEN)
        if report.name and (report.numInputRows or (seen and seen.written_rows)):
            self._waiting.append(_row(report))
        if len(self._waiting) >= self.flush_every:
            self._flush()

    def onQueryTerminated(self, event) -> None:
        self._flush()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def settle(self, queries: list[StreamingQuery], seconds: float = 60) -> None:
        """Wait until the reports of ended streams are stored; Spark delivers them later."""
        runs = {str(q.runId) for q in queries}
        with self._changed:
            if not self._changed.wait_for(lambda: runs <= self._ended, seconds):
                raise TimeoutError("streams have not reported their end")

    def _flush(self) -> None:
        with self._changed:
            rows, self._waiting = self._waiting, []
            if rows:
                frame = self.session.createDataFrame(rows, _RAW)
                frame.withColumns({
                    "first_time": F.timestamp_micros("first_us"),
                    "last_time": F.timestamp_micros("last_us"),
                    "date": F.to_date("date"),
                }).select(*dated(BATCHES).fieldNames()).coalesce(1).write.mode(
                    "append").partitionBy("date").parquet(self.path)


_RAW = (
    "stream string, run_id string, batch_id long, trigger_time timestamp, input_rows long, "
    "written_rows long, first_us long, last_us long, duration_ms long, watermark timestamp, "
    "state_rows long, late_groups long, date string"
)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """One row per stream and batch, as last reported."""
    stored = read_layer(spark, path, BATCHES)
    rest = [c for c in BATCHES.fieldNames() if c not in ("stream", "batch_id")]
    last = F.max_by(F.struct(*rest), "trigger_time")
    return stored.groupBy("stream", "batch_id").agg(last.alias("_last")).select(
        "stream", "batch_id", "_last.*")


def throughput(stored: DataFrame, *spans: Column) -> DataFrame:
    """Per stream (and span): rows, busy time, rows per second, quantiles of batch durations."""
    busy = F.sum("duration_ms") / F.lit(1000.0)
    return stored.groupBy("stream", *spans).agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("written_rows").alias("written_rows"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.sum("late_groups").alias("late_groups"),
        busy.alias("busy_seconds"),
        F.try_divide(F.sum("input_rows"), busy).alias("rows_per_second"),
        F.percentile_approx("duration_ms", 0.5).alias("median_ms"),
        F.percentile_approx("duration_ms", 0.99).alias("p99_ms"),
    )


def start_latency(session: SparkSession, cfg: LakeConfig, trigger: str | None = None,
                  ) -> StreamingQuery:
    """Follow the alerts and store a sketch of their latencies per batch and type.

    The latency is the time from the end of the event window to the detection, in seconds. A
    repeated batch replaces what it wrote before.
    """
    def sketch(rows: DataFrame, batch_id: int) -> None:
        seconds = (F.unix_micros("detected_at") - F.unix_micros("window_end")) / F.lit(1e6)
        (
            rows.groupBy("alert_type")
            .agg(F.kll_sketch_agg_double(seconds, F.lit(SKETCH_K)).alias("latencies"))
            .withColumn("batch", F.lit(batch_id))
            .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch").parquet(cfg.latency)
        )

    writer = (
        follow_layer(session, cfg.alerts, dated(ALERT), cfg.max_files).writeStream
        .queryName("alert_latency").foreachBatch(sketch)
        .option("checkpointLocation", cfg.checkpoint("alert_latency"))
    )
    return triggered(writer, trigger).start()


def latency_quantiles(spark: SparkSession, cfg: LakeConfig,
                      quantiles: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """Per alert type: number of alerts and the given quantiles, from the merged sketches."""
    merged = read_layer(spark, cfg.latency, LATENCY).groupBy("alert_type").agg(
        F.kll_merge_agg_double("latencies").alias("latencies"))
    return merged.select(
        "alert_type", F.kll_sketch_get_n_double("latencies").alias("alerts"),
        *(F.kll_sketch_get_quantile_double("latencies", F.lit(q)).alias(f"p{q * 100:g}_seconds")
          for q in quantiles))
