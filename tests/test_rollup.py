"""Rollups against a plain Python count, in every distinct mode."""

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlake.functions.timing import flatten_window
from flowlake.model import FLOW, GOLD
from flowlake.operators import ranking
from flowlake.operators.codec import parse_flows
from flowlake.operators.rollup import GOLD_ROLLUPS, ROUTERS, TALKERS, Rollup, rollup, rollup_widths
from flowlake.operators.rules import detect_all
from flowlake.operators.views import syn_ratio
from tests import flowgen

START = datetime(2026, 1, 29, 12)

FLOWS = st.lists(
    st.tuples(
        st.integers(0, 200),                             # seconds
        st.sampled_from(["r1", "r2", None]),
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from(["x", "y", "z", None]),
        st.sampled_from([80, 443, 22, None]),
        st.sampled_from(["TCP", "UDP", None]),
        st.sampled_from([None, 0, 5, 2**40]),
        st.sampled_from([None, 1, 7]),
        st.sampled_from(["SYN", "ACK", "", None]),
    ),
    max_size=40,
)


def frame(spark, flows):
    rows = [(START + timedelta(seconds=s), router, src, dst, 1, port, proto, size, packets, flags, 1)
            for s, router, src, dst, port, proto, size, packets, flags in flows]
    return spark.createDataFrame(rows, FLOW)


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def counted(flows, table, width=60):
    """What the gold table must hold, by plain counting."""
    spec = GOLD_ROLLUPS[table]
    position = {"router_id": 1, "src_ip": 2, "dst_ip": 3, "dst_port": 4}
    groups = defaultdict(list)
    for flow in flows:
        groups[flow[0] // width, flow[position[spec.key]]].append(flow)
    out = set()
    for (window, key), rows in groups.items():
        measures = [total(r[6] for r in rows), total(r[7] for r in rows), len(rows)]
        if "tcp_flows" in spec.measures:
            measures += [sum(r[5] == "TCP" for r in rows),
                         sum(r[5] == "TCP" and r[8] == "SYN" for r in rows)]
        distincts = [len({r[position[c]] for r in rows} - {None}) for c in spec.distinct.values()]
        out.add((START + timedelta(seconds=window * width), key, *measures, *distincts))
    return out


def held(gold):
    return {tuple(r) for r in flatten_window(gold).drop("window_end").collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(flows=FLOWS)
@pytest.mark.parametrize("table", sorted(GOLD))
def test_exact_and_small_sketches_count_right(spark, table, flows):
    df, spec = frame(spark, flows), GOLD_ROLLUPS[table]
    want = counted(flows, table)
    assert held(rollup(df, spec, distinct="exact")) == want
    # So few values collide in no sketch.
    assert held(rollup(df, spec, distinct="sketch")) == want
    assert held(rollup(df, spec, distinct="exact", salts=4)) == want
    assert held(rollup(df, spec, distinct="sketch", salts=4)) == want


@pytest.mark.parametrize("table", sorted(GOLD))
@pytest.mark.parametrize("mode", ["approx", "sketch", "exact"])
def test_gold_columns(spark, table, mode):
    gold = rollup(frame(spark, []), GOLD_ROLLUPS[table], distinct=mode)
    assert [(f.name, f.dataType) for f in gold.schema] == [
        (f.name, f.dataType) for f in GOLD[table]]


def flood(spark, sources):
    rows = [(i % 60, "r", f"10.{i % sources // 256}.{i % sources % 256}.1", "x", 80, "TCP", 1, 1, "SYN")
            for i in range(sources * 3)]
    return frame(spark, rows)


@pytest.mark.parametrize("sources", [20, 101, 501, 3000])
def test_estimates_are_close(spark, sources):
    df, spec = flood(spark, sources), GOLD_ROLLUPS["top_destinations"]

    def estimate(**options):
        (row,) = rollup(df, spec, **options).collect()
        assert (row.flow_count, row.total_bytes) == (sources * 3, sources * 3)
        return row.unique_sources

    assert estimate(distinct="exact") == sources
    assert abs(estimate() - sources) <= 3 * 0.05 * sources
    assert abs(estimate(rsd=0.01) - sources) <= 3 * 0.01 * sources
    assert abs(estimate(salts=8) - sources) <= 3 * 0.05 * sources
    for salts in (1, 8):
        assert abs(estimate(distinct="sketch", salts=salts) - sources) <= 0.05 * sources


def test_a_hot_key_next_to_many_small_ones(spark):
    rows = [(i % 60, "r", f"s{i % 997}", "hot" if i % 3 == 0 else f"d{i}", 80, "TCP", 1, 1, "SYN")
            for i in range(6000)]
    gold = rollup(frame(spark, rows), GOLD_ROLLUPS["top_destinations"], distinct="exact", salts=8)
    assert held(gold) == counted(rows, "top_destinations")


def test_own_measures_and_lanes(spark):
    spec = Rollup(
        "router_id", {"ports": "dst_port", "flags": "tcp_flags"},
        {"big": ("count_if", "bytes > 3"), "volume": ("sum", "bytes * packets"), "n": ("count", None)})
    flows = [(0, "r", "a", "x", port, "TCP", size, 2, flag)
             for port, size, flag in ((80, 5, "SYN"), (80, 1, "ACK"), (443, None, None))]
    for mode in ("exact", "sketch"):
        for salts in (1, 4):
            gold = rollup(frame(spark, flows), spec, distinct=mode, salts=salts)
            assert held(gold) == {(START, "r", 1, 12, 3, 2, 2)}


def test_refused_modes(spark):
    # The estimates of two counted columns cannot both be added.
    with pytest.raises(ValueError):
        rollup(frame(spark, []), TALKERS, distinct="approx", salts=4)
    with pytest.raises(ValueError):
        rollup(frame(spark, []), TALKERS, distinct="guess")


def test_window_borders_and_slides(spark):
    flows = [(s, "r", "a", "x", 80, "TCP", 1, 1, "") for s in (0, 59, 60, 119, 120)]
    gold = rollup(frame(spark, flows), ROUTERS, "1 minute", distinct="exact")
    assert {(r.window.start.minute, r.flow_count) for r in gold.collect()} == {(0, 2), (1, 2), (2, 1)}
    sliding = rollup(frame(spark, flows), ROUTERS, "2 minutes", "1 minute", distinct="exact")
    assert {(r.window.start.minute, r.flow_count) for r in sliding.collect()} == {
        (59, 2), (0, 4), (1, 3), (2, 1)}


def test_several_widths_from_one_scan(spark):
    flows = [(s, "r", f"s{s % 3}", f"d{s % 2}", 80, "TCP", s, 1, "") for s in range(200)]
    spec = GOLD_ROLLUPS["top_destinations"]
    wide = rollup_widths(frame(spark, flows), spec, ["10 seconds", "60 seconds"])
    for width, seconds in (("10 seconds", 10), ("60 seconds", 60)):
        part = wide.where(F.col("width") == width).drop("width")
        assert held(part) == counted(flows, "top_destinations", seconds)


def test_syn_ratio_without_tcp_is_null(spark):
    flows = [(0, "r", "a", "x", 80, "UDP", 1, 1, ""), (0, "r", "a", "y", 80, "TCP", 1, 1, "SYN"),
             (0, "r", "a", "y", 80, "TCP", 1, 1, "ACK")]
    gold = syn_ratio(rollup(frame(spark, flows), GOLD_ROLLUPS["destination_profile"]))
    assert {r.dst_ip: r.syn_ratio for r in gold.collect()} == {"x": None, "y": 0.5}


def test_rankings(spark):
    flows = [(w * 60 + i, "r", "s", f"d{d}", 80 + d, "TCP", 1, 1, "")
             for w in range(2) for d in range(6) for i in range(6 - d)]
    df = frame(spark, flows)
    want = {(w, f"d{d}", 6 - d) for w in range(2) for d in range(3)}
    exact = ranking.heavy_hitters(df, k=3).collect()
    assert {(r.window.start.minute, r.dst_ip, r.flow_count) for r in exact} == want
    assert {(r.dst_ip, r["rank"]) for r in exact} == {("d0", 1), ("d1", 2), ("d2", 3)}
    approx = ranking.heavy_hitters_approx(df, k=3).collect()
    assert {(r.window.start.minute, r.dst_ip, r.flow_count) for r in approx} == want
    ports = ranking.router_top_ports(df, k=2).collect()
    assert {(r.window.start.minute, r.dst_port, r["rank"]) for r in ports} == {
        (0, 80, 1), (0, 81, 2), (1, 80, 1), (1, 81, 2)}
    per_router = ranking.heavy_hitters_sketched(df, "dst_port", k=2, by=["router_id"]).collect()
    assert {(r.router_id, r.dst_port, r.flow_count) for r in per_router} == {("r", 80, 6), ("r", 81, 5)}


@pytest.mark.parametrize("entities,tracked", [(60, 20), (2000, 100), (5, 1000)])
def test_sketched_heavy_hitters_are_the_exact_ones(spark, entities, tracked):
    # Flat windows, in which no entity stands out, and one with ten heavy ones.
    flows = [(i % 60, "r", "s", f"d{i % entities}", 80, "TCP", 1, 1, "") for i in range(4000)]
    flows += [(60 + i % 60, "r", "s", f"d{i % 10 if i % 2 else i % entities}", 80, "TCP", 1, 1, "")
              for i in range(4000)]
    df = frame(spark, flows)
    got = ranking.heavy_hitters_approx(df, k=10, tracked=tracked)
    want = ranking.heavy_hitters(df, k=10)
    columns = ["window", "dst_ip", "flow_count", "rank"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(
        map(str, want.select(columns).collect()))
    assert got.count() >= 2 * min(10, entities)


def test_newest_rows(spark):
    rows = [(START - timedelta(days=d), d, i) for d in range(4) for i in range(5)]
    df = spark.createDataFrame(rows, "ts timestamp, d int, i int").withColumn("date", F.to_date("ts"))
    for n in (1, 5, 6, 12, 100):
        want = [(d, i) for d in range(4) for i in range(5)][:n]
        assert [(r.d, r.i) for r in ranking.newest(df, n).collect()] == want
        assert [(r.d, r.i) for r in ranking.newest_dated(df, n).collect()] == want


SCENARIOS = {
    "baseline": set(),
    "ddos_fan_in": {("FAN_IN_DDOS", "172.16.4.100", 1.0)},
    "scan_fan_out": set(),
    "flash_crowd": {("FAN_IN_DDOS", ip, 1.0) for ip in flowgen.CROWD_TARGETS},
}


def detected(spark, records):
    flows = parse_flows(flowgen.messages(spark, records))
    gold = {t: rollup(flows, GOLD_ROLLUPS[t], distinct="exact") for t in GOLD}
    return {(r.alert_type, r.entity, r.severity_score) for r in detect_all(gold).collect()}


@pytest.mark.parametrize("name", sorted(SCENARIOS))
def test_scenarios(spark, name):
    assert detected(spark, flowgen.scenario(name, 0, 6000)) == SCENARIOS[name]


def test_a_scan_over_more_ports_is_found(spark):
    scan = flowgen.scenario("scan_fan_out", 0, 3000, ports=range(1, 26))
    assert detected(spark, scan) == {("FAN_OUT_SCAN", "10.0.0.99", 1.0)}
