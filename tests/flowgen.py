"""Flow records for tests, built by counting: every sum and distinct count is known."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

NOON = datetime(2026, 1, 29, 12, tzinfo=timezone.utc)

CROWD_TARGETS = ("172.16.1.10", "172.16.1.20", "172.16.1.30")


def record(ts, src_ip, dst_ip, dst_port=443, proto="TCP", size=100, packets=1, tcp_flags="ACK",
           router_id="router-1"):
    return {
        "ts": ts.isoformat().replace("+00:00", "Z"), "router_id": router_id,
        "src_ip": src_ip, "dst_ip": dst_ip, "src_port": 40000, "dst_port": dst_port,
        "proto": proto, "bytes": size, "packets": packets, "tcp_flags": tcp_flags,
        "sampling_rate": 1,
    }


def address(block, number):
    """A different address per number, in a block for documentation or tests."""
    return f"{block}.{number // 250 % 250}.{number % 250 + 1}"


def flood(i, count, **_):
    """Up to 1000 sources send 100 packets of 300 bytes each to one target."""
    return {"src_ip": address("198.18", i % 1000), "dst_ip": "172.16.4.100", "dst_port": 80,
            "size": 30_000, "packets": 100, "tcp_flags": "SYN"}


def scan(i, count, ports=None):
    """One source sends one packet to each of many targets, ports in turn."""
    ports = ports or range(20, 32)
    return {"src_ip": "10.0.0.99", "dst_ip": address("203.0", i), "dst_port": ports[i % len(ports)],
            "size": 60, "packets": 1, "tcp_flags": "SYN"}


def crowd(i, count, **_):
    """A source of its own for each flow to one of three targets, 15 packets each."""
    return {"src_ip": address("10.7", i), "dst_ip": CROWD_TARGETS[i % 3], "dst_port": 443,
            "size": 3000, "packets": 15}


def quiet(i, count, **_):
    """No two flows share a source or a target."""
    return {"src_ip": address("10.9", i), "dst_ip": address("192.0", i), "dst_port": 1000 + i % 8,
            "proto": ("TCP", "UDP", "ICMP")[i % 3], "size": 5000, "packets": 20, "tcp_flags": ""}


SCENARIOS = {"ddos_fan_in": flood, "scan_fan_out": scan, "flash_crowd": crowd, "baseline": quiet}


def scenario(name, minute, count, ports=None):
    """``count`` flows of one scenario, spread evenly over one minute after noon."""
    for i in range(count):
        ts = NOON + timedelta(minutes=minute, seconds=60 * i / count)
        yield record(ts, **SCENARIOS[name](i, count, ports=ports))


def lines(records):
    return [json.dumps(r) for r in records]


def messages(spark, records):
    return spark.createDataFrame([(text,) for text in lines(records)], "value string")
