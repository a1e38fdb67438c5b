"""Event-time windowed rollups of flows.

Every function takes a batch or a streaming frame and starts nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAFFIC = {
    "total_bytes": ("sum", "bytes"),
    "total_packets": ("sum", "packets"),
    "flow_count": ("count", None),
}

IS_TCP = "proto = 'TCP'"
IS_SYN_ONLY = "proto = 'TCP' AND tcp_flags = 'SYN'"


@dataclass(frozen=True)
class Rollup:
    """What to compute per window and ``key``.

    ``measures`` maps an output name to ``(kind, expression)``, where kind is
    ``sum`` of the SQL expression, ``count_if`` it holds, or ``count`` of rows.
    ``distinct`` maps an output name to the column whose values are counted.
    """

    key: str
    distinct: dict[str, str]
    measures: dict[str, tuple[str, str | None]] = field(default_factory=lambda: dict(TRAFFIC))


DESTINATIONS = Rollup("dst_ip", {"unique_sources": "src_ip"})
TALKERS = Rollup("src_ip", {"unique_destinations": "dst_ip", "distinct_ports": "dst_port"})
ROUTERS = Rollup("router_id", {"unique_sources": "src_ip", "unique_destinations": "dst_ip"})
DESTINATION_PROFILE = Rollup(
    "dst_ip",
    {"unique_sources": "src_ip"},
    {
        **TRAFFIC,
        "tcp_flows": ("count_if", IS_TCP),
        "syn_flows": ("count_if", IS_SYN_ONLY),
    },
)

GOLD_ROLLUPS = {
    "top_destinations": DESTINATIONS,
    "top_talkers": TALKERS,
    "router_summary": ROUTERS,
    "destination_profile": DESTINATION_PROFILE,
}


def rollup(
    flows: DataFrame,
    spec: Rollup,
    window: str = "1 minute",
    slide: str | None = None,
    watermark: str = "2 minutes",
    distinct: str = "approx",
    rsd: float = 0.05,
    salts: int = 1,
) -> DataFrame:
    """Aggregate ``flows`` per event-time window and key.

    ``distinct`` picks how different values are counted:

    - ``approx``: HyperLogLog++ with relative error ``rsd``; small state, one
      shuffle.
    - ``sketch``: a mergeable HLL sketch, one shuffle; near exact for small
      groups.
    - ``exact``: each value is first reduced to one row, spread over the cluster
      by (window, key, value), then counted. No set of values is ever held, and
      it also runs in a stream, where ``count(DISTINCT)`` is refused.

    With ``salts`` above 1 a key is first aggregated in that many groups, split
    by a hash of its counted values, so that a hot key's partial results (one
    sketch per input task) meet in several tasks rather than one. Values of
    different groups differ, so counts add up; sketches are merged. Estimates of
    ``approx`` can only be added, hence it takes one counted column. Exact
    counting is spread by value anyway and gains little from salts.
    """
    if distinct not in ("approx", "sketch", "exact"):
        raise ValueError(f"unknown distinct mode {distinct!r}")
    timed = flows.withWatermark("ts", watermark).withColumn(
        "window", F.window("ts", window, slide)
    )
    if distinct == "exact":
        return _exact(timed, spec, [spec.key], salts)
    if salts > 1:
        return _salted(timed, spec, distinct, rsd, salts)
    counted = {
        name: F.approx_count_distinct(column, rsd)
        if distinct == "approx"
        else F.hll_sketch_estimate(F.hll_sketch_agg(column))
        for name, column in spec.distinct.items()
    }
    return timed.groupBy("window", spec.key).agg(
        *_measures(spec), *(column.alias(name) for name, column in counted.items())
    )


def _measures(spec: Rollup) -> list[Column]:
    """The measures as aggregates over flows."""
    aggregates = {
        "sum": lambda expression: F.sum(F.expr(expression)),
        "count_if": lambda expression: F.count_if(F.expr(expression)),
        "count": lambda _: F.count(F.lit(1)),
    }
    return [
        aggregates[kind](expression).alias(name)
        for name, (kind, expression) in spec.measures.items()
    ]


def _exact(timed: DataFrame, spec: Rollup, keys: list[str], salts: int = 1) -> DataFrame:
    """Count different values by grouping on them first.

    Several counted columns become lanes of one long (lane, value) table. The
    measures ride on the first lane only.
    """
    columns = list(spec.distinct.values())
    if len(columns) == 1:
        per_value = (
            timed.withColumn("_value", F.col(columns[0]))
            .groupBy("window", *keys, "_value")
            .agg(*_measures(spec))
        )
        in_lane = {columns[0]: F.col("_value")}
    else:
        inputs = {
            name: F.expr(expression)
            for name, (_, expression) in spec.measures.items() if expression is not None
        }
        lanes = timed.select(
            "window", *keys,
            *(column.alias(name) for name, column in inputs.items()),
            *(F.col(column).cast("string").alias(f"_{column}") for column in columns),
        ).unpivot(["window", *keys, *inputs], [f"_{c}" for c in columns], "_lane", "_value")
        in_first = F.col("_lane") == f"_{columns[0]}"
        of_first = {
            "sum": lambda name: F.sum(F.when(in_first, F.col(name))),
            "count_if": lambda name: F.count_if(in_first & F.col(name)),
            "count": lambda _: F.count_if(in_first),
        }
        per_value = lanes.groupBy("window", *keys, "_lane", "_value").agg(
            *(of_first[kind](name).alias(name) for name, (kind, _) in spec.measures.items())
        )
        in_lane = {c: F.when(F.col("_lane") == f"_{c}", F.col("_value")) for c in columns}
    groups = ["window", *keys]
    if salts > 1:
        per_value = per_value.withColumn("_salt", F.pmod(F.xxhash64("_value"), F.lit(salts)))
        groups.append("_salt")
    counts = per_value.groupBy(*groups).agg(
        *(F.sum(name).alias(name) for name in spec.measures),
        *(F.count(in_lane[column]).alias(name) for name, column in spec.distinct.items()),
    )
    if salts > 1:
        counts = counts.groupBy("window", *keys).agg(
            *(F.sum(name).alias(name) for name in (*spec.measures, *spec.distinct))
        )
    return counts


def _salted(timed: DataFrame, spec: Rollup, distinct: str, rsd: float, salts: int) -> DataFrame:
    columns = list(spec.distinct.values())
    if distinct == "approx" and len(columns) > 1:
        raise ValueError("salted approx needs exactly one counted column; use sketch or exact")

    def count(column):
        if distinct == "approx":
            return F.approx_count_distinct(column, rsd)
        return F.hll_sketch_agg(column)

    def merge(partial):
        if distinct == "approx":
            return F.sum(partial)
        return F.hll_sketch_estimate(F.hll_union_agg(partial))

    split = timed.withColumn("_salt", F.pmod(F.xxhash64(columns[0]), F.lit(salts)))
    partial = split.groupBy("window", spec.key, "_salt").agg(
        *_measures(spec),
        *(count(column).alias(name) for name, column in spec.distinct.items()),
    )
    return partial.groupBy("window", spec.key).agg(
        *(F.sum(name).alias(name) for name in spec.measures),
        *(merge(name).alias(name) for name in spec.distinct),
    )


def rollup_widths(flows: DataFrame, spec: Rollup, widths: list[str]) -> DataFrame:
    """Exact rollups for several window widths from one scan, tagged by ``width``.

    Batch only: to compare widths on a stream, start one rollup per width.
    """
    timed = flows
    for position, width in enumerate(widths):
        timed = timed.withColumn(f"_w{position}", F.window("ts", width))
    tagged = timed.select(
        "*",
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(width).alias("width"), F.col(f"_w{i}").alias("window"))
                    for i, width in enumerate(widths)
                )
            )
        ),
    )
    return _exact(tagged, spec, ["width", spec.key])

