"""Flows and wire messages projected from an ``events`` table.

A deterministic stand-in for router exports: errors play a flood, signups a
scan, purchases a flash crowd, clicks and views ordinary traffic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.operators.codec import wire_json

# Ports and flags of ordinary traffic, by position.
BASELINE_PORTS = (80, 443, 22, 53, 21, 25, 3306, 5432, 6379, 8080)
BASELINE_FLAGS = ("SYN", "SYN-ACK", "ACK", "FIN", "RST")
FLOOD_TARGET = "172.16.4.100"
SCANNER = "10.0.0.99"


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _nth(choices: tuple, position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, choices)), (position + 1).cast("int"))


def flows_of_events(events: DataFrame, *keep: str) -> DataFrame:
    """The 11 flow columns for every event, after the event columns in ``keep``."""
    e, u, value = F.col("event_id"), F.col("user_id"), F.col("value")
    kind = F.col("event_type")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    flood, scan, crowd = kind == "error", kind == "signup", kind == "purchase"
    bot = e * 7919 % 1000
    host = e % 254 + 1
    anyone = (
        F.when(e % 10 < 7, _text("10.", e * 31 % 256, ".", u % 256, ".", host))
        .when(e % 10 < 9, _text("192.168.", u % 256, ".", host))
        .otherwise(_text("8.8.", u % 256, ".", host))
    )
    flags = F.when(e % 3 == 0, _nth(BASELINE_FLAGS, e % 5)).otherwise("")

    def by_kind(flood_is, scan_is, crowd_is, baseline_is) -> Column:
        return (
            F.when(flood, flood_is).when(scan, scan_is).when(crowd, crowd_is)
            .otherwise(baseline_is)
        )

    columns = {
        "ts": F.col("ts"),
        "router_id": _text("router-", e % 3 + 1),
        "src_ip": by_kind(
            _text("10.0.", F.floor(bot / 256).cast("int"), ".", bot % 256),
            F.lit(SCANNER), anyone, anyone,
        ),
        "dst_ip": by_kind(
            F.lit(FLOOD_TARGET),
            _text("10.", e * 17 % 256, ".", e * 13 % 256, ".", host),
            _text("172.16.1.", (e % 3 + 1) * 10),
            _text("10.", e * 17 % 256, ".", e * 13 % 256, ".", host),
        ),
        "src_port": (1024 + e * 7919 % 64511).cast("int"),
        "dst_port": by_kind(
            F.lit(80), 20 + k, F.lit(443), _nth(BASELINE_PORTS, k % 10)
        ).cast("int"),
        "proto": F.when(flood | scan | crowd, "TCP").otherwise(
            _nth(("TCP", "UDP", "ICMP"), e % 3)
        ),
        "bytes": by_kind(
            10000 + F.floor(value * 100), 40 + F.floor(value),
            100 + F.floor(value * 20), 100 + F.floor(value * 20),
        ).cast("bigint"),
        "packets": by_kind(50 + k, F.lit(1), 5 + k % 20, 1 + k % 50).cast("int"),
        "tcp_flags": by_kind(F.lit("SYN"), F.lit("SYN"), F.lit("ACK"), flags),
        "sampling_rate": F.lit(1),
    }
    return events.select(*keep, *(column.alias(name) for name, column in columns.items()))


def messages_of_events(events: DataFrame) -> DataFrame:
    """Log messages for every event: ``value, timestamp``.

    Each event sends its flow as JSON. Each flood event also sends one record
    without a usable time, each crowd event one that is odd but acceptable.
    """
    flow = flows_of_events(events, "event_id", "event_type")
    zoned = F.col("ts").cast("timestamp")
    fields = [c for c in flow.columns if c not in ("event_id", "event_type", "ts")]
    wire = wire_json(zoned.alias("ts"), *fields)
    time = F.date_format(zoned, "yyyy-MM-dd'T'HH:mm:ss")
    e = F.col("event_id")
    damaged = (
        F.when(e % 5 == 0, _text("not json ", e))
        .when(e % 5 == 1, _text('{"ts":"bad","router_id":"router-', e, '"}'))
        .when(e % 5 == 2, _text('[{"ts":"', time, 'Z","router_id":"router-', e, '"}]'))
        .when(e % 5 == 3, F.lit(""))
    )
    odd = (
        F.when(e % 5 == 0, _text('{"ts":"', time, 'Z","router_id":"r', e, '","bytes":"abc"}'))
        .when(e % 5 == 1, _text('{"ts":"', time, 'Z","router_id":"r', e, '","dst_port":99999999999}'))
        .when(e % 5 == 2, _text('{"ts":"', time, 'Z","router_id":"r', e, '","bytes":5,"extra":1}'))
        .when(e % 5 == 3, _text('{"ts":"', time, '.123456789+02:00","router_id":"r', e, '"}'))
        .otherwise(_text('{"ts":', zoned.cast("bigint"), ',"router_id":"r', e, '"}'))
    )
    sent = (
        F.when(F.col("event_type") == "error", F.array(wire, damaged))
        .when(F.col("event_type") == "purchase", F.array(wire, odd))
        .otherwise(F.array(wire))
    )
    return flow.select(F.explode(sent).alias("value"), F.col("ts").alias("timestamp"))
