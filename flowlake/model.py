"""Table schemas of the flow lake.

Column names and types are a contract shared with every reader of the lake.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def of_types(**types: str) -> StructType:
    schema = StructType()
    for name, type_name in types.items():
        schema = schema.add(name, type_name)
    return schema


def _with(base: StructType, **types: str) -> StructType:
    return StructType(base.fields + of_types(**types).fields)


FLOW = of_types(
    ts="timestamp",
    router_id="string",
    src_ip="string",
    dst_ip="string",
    src_port="integer",
    dst_port="integer",
    proto="string",
    bytes="long",
    packets="integer",
    tcp_flags="string",
    sampling_rate="integer",
)

SILVER = _with(
    FLOW,
    src_subnet_24="string",
    dst_subnet_24="string",
    is_private_src="boolean",
    is_private_dst="boolean",
    dst_service="string",
    date="date",
)

MESSAGE = of_types(value="string", timestamp="timestamp")

QUARANTINE = of_types(raw="string")

WINDOW = of_types(start="timestamp", end="timestamp")


def _gold(key: str, *counts: str) -> StructType:
    return _with(
        StructType().add("window", WINDOW).add(key, "string"),
        total_bytes="long",
        total_packets="long",
        flow_count="long",
        **dict.fromkeys(counts, "long"),
    )


#: Sums every pane carries.
PANE_TRAFFIC = {"total_bytes": "long", "total_packets": "long", "flow_count": "long"}

GOLD = {
    "top_destinations": _gold("dst_ip", "unique_sources"),
    "top_talkers": _gold("src_ip", "unique_destinations", "distinct_ports"),
    "router_summary": _gold("router_id", "unique_sources", "unique_destinations"),
    "destination_profile": _gold("dst_ip", "tcp_flows", "syn_flows", "unique_sources"),
}

# Which addresses of a block occur, per window and destination.
SOURCE_BITS = of_types(window=WINDOW, dst_ip="string", block="long", other="string", bits="long")

# For scan alerts ``unique_sources`` carries the number of distinct
# destinations; the column name is part of the contract.
ALERT = of_types(
    window_start="timestamp",
    window_end="timestamp",
    alert_type="string",
    entity="string",
    severity_score="double",
    unique_sources="long",
    total_packets="long",
    total_bytes="long",
    detected_at="timestamp",
)

# A message as received: its text, and the flow fields decoded from it.
RECEIVED = StructType(QUARANTINE.fields + FLOW.fields)

# What a micro-batch of a stream did.
BATCHES = of_types(
    stream="string",
    run_id="string",
    batch_id="long",
    trigger_time="timestamp",
    input_rows="long",
    written_rows="long",
    first_time="timestamp",
    last_time="timestamp",
    duration_ms="long",
    watermark="timestamp",
    state_rows="long",
    late_groups="long",
)

# Sketches of the seconds from event window to alert, one per batch and type.
LATENCY = of_types(alert_type="string", latencies="binary")

# The newest event time up to a batch, in microseconds.
FRONTIER = of_types(newest="long")

# Alerts with the decayed past they were held against.
DECAYED = _with(
    ALERT, syn_ratio="double", history_sum="double", history_weight="double", suppressed="boolean")

# Which version of a date is current, and which files of the layer it holds.
VERSION = of_types(version="integer")
MANIFEST = of_types(date="date", version="integer", file="string")


def dated(schema: StructType) -> StructType:
    """The schema of a layer stored by ``date``."""
    return _with(StructType([f for f in schema.fields if f.name != "date"]), date="date")


def batched(schema: StructType) -> StructType:
    """The schema of a table that keeps the rows of each micro-batch apart."""
    return _with(schema, batch="integer")
