"""Top-k, heavy hitters and newest-row views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Of a frequent-items sketch: its error is at most this share of the flows over
# the items it tracks.
ERROR = 3.5


def _descending(measure: str, *ties: str) -> list[Column]:
    return [F.desc(measure), *(F.asc(tie) for tie in ties)]


def top_k(gold: DataFrame, measure: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows with the largest measure; ``ties`` make the order total."""
    return gold.orderBy(*_descending(measure, *ties)).limit(k)


def top_k_per(df: DataFrame, groups: list[str], measure: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows with the largest measure per group, with their ``rank``.

    Spark keeps only ``k`` rows per group and map task before the shuffle, so a
    group of any size costs its final task ``k`` rows per input task. Batch
    only: streams refuse ranking windows.
    """
    order = Window.partitionBy(*groups).orderBy(*_descending(measure, *ties))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def newest(df: DataFrame, n: int, time: str = "ts") -> DataFrame:
    """The ``n`` latest rows by event time, ties broken by all other columns."""
    rest = [name for name in df.columns if name != time]
    return df.orderBy(F.desc(time), *(F.asc(name) for name in rest)).limit(n)


def newest_dated(silver: DataFrame, n: int) -> DataFrame:
    """As ``newest``, for a layer partitioned by ``date``.

    Only the latest dates that together hold ``n`` rows are scanned; the others
    are pruned. Finding them reads row counts, not rows.
    """
    per_date = silver.groupBy("date").agg(F.count("*").alias("_rows"))
    # One row per date, so the single ordered partition stays small.
    from_latest = Window.partitionBy(F.lit(0)).orderBy(F.desc("date"))
    newer = F.sum("_rows").over(from_latest.rowsBetween(Window.unboundedPreceding, -1))
    first_date = (
        per_date.withColumn("_newer", F.coalesce(newer, F.lit(0)))
        .where(F.col("_newer") < n)
        .agg(F.min("date"))
    )
    return newest(silver.where(F.col("date") >= first_date.scalar()), n)


def count_per_window(flows: DataFrame, columns: list[str], window: str,
                     watermark: str = "2 minutes") -> DataFrame:
    return (
        flows.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window), *columns)
        .agg(F.count("*").alias("flow_count"))
    )


def router_top_ports(flows: DataFrame, window: str = "1 minute", k: int = 5) -> DataFrame:
    """Most used destination ports per router and window."""
    per_port = count_per_window(flows, ["router_id", "dst_port"], window)
    return top_k_per(per_port, ["window", "router_id"], "flow_count", k, "dst_port")


def heavy_hitters(flows: DataFrame, entity: str = "dst_ip", window: str = "1 minute",
                  k: int = 10) -> DataFrame:
    """Entities with the most flows per window, exactly."""
    per_entity = count_per_window(flows, [entity], window)
    return top_k_per(per_entity, ["window"], "flow_count", k, entity)


def heavy_hitters_sketched(flows: DataFrame, entity: str = "dst_ip", window: str = "1 minute",
                           k: int = 10, tracked: int = 10_000, by: list[str] | None = None,
                           watermark: str = "2 minutes") -> DataFrame:
    """Frequent entities per window from a fixed-size sketch; also for streams.

    State is at most ``tracked`` items per group. Counts are exact while a group
    has fewer items; beyond that, entities with less than ``ERROR / tracked`` of
    a window's flows may be missing, so a flat window yields fewer than ``k``.
    """
    groups = by or []
    sketched = (
        flows.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window), *groups)
        .agg(F.expr(f"approx_top_k({entity}, {int(k)}, {int(tracked)})").alias("_top"))
    )
    ranked = sketched.select("window", *groups, F.posexplode("_top").alias("_place", "_item"))
    return ranked.select(
        "window", *groups,
        F.col("_item.item").alias(entity),
        F.col("_item.count").alias("flow_count"),
        (F.col("_place") + 1).alias("rank"),
    )


def heavy_hitters_approx(flows: DataFrame, entity: str = "dst_ip", window: str = "1 minute",
                         k: int = 10, tracked: int = 10_000) -> DataFrame:
    """The ``min(k, entities)`` entities with the most flows per window (batch).

    A sketch per window names candidates, and only their flows are counted exactly. Estimates are
    off by ``ERROR / tracked`` of a window's flows at most, so an entity that is no candidate has
    no more than the least candidate's estimate and that. Where the ``k``-th estimate does not
    clear it by twice the error, all flows of the window are counted. Flows without an entity
    don't count. The flows are read twice: for the sketches, and for the counts.
    """
    named = flows.where(F.col(entity).isNotNull()).withColumn("window", F.window("ts", window))
    wanted = min(4 * k, tracked)
    sketched = named.groupBy("window").agg(
        F.count("*").alias("_flows"),
        F.expr(f"approx_top_k({entity}, {wanted}, {int(tracked)})").alias("_top"),
    )
    error = F.ceil(F.col("_flows") * F.lit(ERROR / tracked))
    estimates = F.sort_array(F.transform("_top", lambda item: item["count"]), asc=False)
    least = F.when(F.size("_top") < wanted, F.lit(0)).otherwise(F.array_min(estimates))
    kth = F.coalesce(F.get(estimates, F.lit(k - 1)), F.lit(0))
    candidates = sketched.select(
        F.col("window").alias("_window"), (kth <= least + 2 * error).alias("_open"),
        F.transform("_top", lambda item: item["item"]).alias("_candidates"))
    counted = (
        named.join(candidates, F.col("window") == F.col("_window"))
        .where(F.col("_open") | F.array_contains("_candidates", F.col(entity)))
        .groupBy("window", entity).agg(F.count("*").alias("flow_count"))
    )
    return top_k_per(counted, ["window"], "flow_count", k, entity)
