"""Read-side views over stored alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.severity import severity_label
from flowlake.operators.rules import keep_matching


def labelled(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("severity_label", severity_label())


def recent(alerts: DataFrame, within: str, time: str = "detected_at",
           now: Column | None = None) -> DataFrame:
    """Alerts whose ``time`` lies less than ``within`` (an interval) before ``now``.

    Newest first; other columns make the order total.
    """
    now = F.current_timestamp() if now is None else now
    ties = [F.desc(c) for c in ("detected_at", "window_end") if c in alerts.columns and c != time]
    return alerts.where(F.col(time) > now - F.expr(f"INTERVAL {within}")).orderBy(
        F.desc(time), *ties, F.asc("alert_type"), F.asc("entity"))


def latest(alerts: DataFrame, time: str = "window_end") -> Column:
    """The newest time among the alerts, as a scalar subquery."""
    return alerts.agg(F.max(time)).scalar()


def feed(alerts: DataFrame, time: str = "window_end") -> DataFrame:
    """Most severe first, then newest first."""
    return alerts.orderBy(
        F.desc("severity_score"), F.desc(time), F.asc("alert_type"), F.asc("entity")
    )


def counts_by_type(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_type").agg(F.count("*").alias("alerts"))


def mean_severity(alerts: DataFrame) -> DataFrame:
    """Mean severity to two decimals, summed as decimals so order cannot matter.

    Scores count to nine decimals.
    """
    return alerts.agg(
        F.round(F.avg(F.col("severity_score").cast("decimal(28,9)")), 2)
        .cast("double")
        .alias("mean_severity")
    )


def most_targeted(alerts: DataFrame, k: int = 5) -> DataFrame:
    per_entity = alerts.groupBy("entity").agg(F.count("*").alias("alerts"))
    return per_entity.orderBy(F.desc("alerts"), F.asc("entity")).limit(k)


def status(recent_alerts: DataFrame, time: str = "detected_at") -> DataFrame:
    """One row: ATTACK or NORMAL, and the newest alert if there is one."""
    summary = recent_alerts.agg(
        F.count("*").alias("recent_alerts"),
        F.max_by(
            F.struct("alert_type", "entity", "severity_score", "window_end"),
            F.struct(time, "severity_score", "alert_type", "entity"),
        ).alias("last"),
    )
    return summary.select(
        F.when(F.col("recent_alerts") > 0, "ATTACK").otherwise("NORMAL").alias("status"),
        "recent_alerts",
        "last.*",
        F.when(F.col("last").isNotNull(), severity_label("last.severity_score")).alias(
            "severity_label"
        ),
    )


def first_per_entity(alerts: DataFrame) -> DataFrame:
    """Notify once: the earliest alert of each type and entity, batch or by hand.

    One pre-aggregated pass; no group is ever sorted.
    """
    rest = [name for name in alerts.columns if name not in ("alert_type", "entity")]
    return (
        alerts.groupBy("alert_type", "entity")
        .agg(F.min(F.struct("window_start", *(c for c in rest if c != "window_start"))).alias("_a"))
        .select(*(F.col(c) if c in ("alert_type", "entity") else F.col(f"_a.{c}")
                  for c in alerts.columns))
    )


def not_yet_notified(alerts: DataFrame, notified: DataFrame) -> DataFrame:
    """Alerts whose window, type and entity were not sent before (batch)."""
    return keep_matching(
        alerts, notified, "window_start", "alert_type", "entity", how="left_anti"
    )


def distinct_windows_in_stream(alerts: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    """Drop repeats of a window, type and entity (stream), all columns kept."""
    return alerts.withWatermark("window_end", watermark).dropDuplicates(
        ["window_start", "window_end", "alert_type", "entity"]
    )


def distinct_in_stream(alerts: DataFrame, horizon: str) -> DataFrame:
    """Drop repeats of a type and entity within ``horizon`` of event time (stream)."""
    return alerts.withWatermark("window_end", horizon).dropDuplicatesWithinWatermark(
        ["alert_type", "entity"]
    )


def incidents(alerts: DataFrame, gap: str = "30 minutes", watermark: str = "2 minutes",
              ) -> DataFrame:
    """Alerts of one type and entity that follow each other within ``gap``, as one incident.

    Batch or stream. Windows belong to one incident while each starts at most ``gap`` after the
    one before; an alert that is delivered again counts once. On a stream an incident is opened
    by its first alert, extended by others in whatever batch they come, joined with a neighbour
    when one comes between them, and written when the watermark has passed its end. State is one
    row per open incident and one per recent alert.
    """
    once = alerts.withWatermark("window_start", watermark).dropDuplicates(
        ["window_start", "alert_type", "entity"])
    return (
        once.groupBy(F.session_window("window_start", gap), "alert_type", "entity")
        .agg(
            F.min("window_start").alias("incident_start"),
            F.max("window_end").alias("incident_end"),
            F.count(F.lit(1)).alias("windows"),
            F.max("severity_score").alias("peak_severity"),
            F.max("unique_sources").alias("peak_sources"),
            F.sum("total_packets").alias("total_packets"),
            F.sum("total_bytes").alias("total_bytes"),
        )
        .drop("session_window")
    )


def with_state(found: DataFrame, now: Column, gap: str = "30 minutes") -> DataFrame:
    """Incidents with ``is_open``: whether an alert at ``now`` could still extend them (batch)."""
    return found.withColumn("is_open", F.col("incident_end") + F.expr(f"INTERVAL {gap}") > now)
