"""Column functions and the codec on their edge values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flowlake.functions.address import is_private, subnet_24
from flowlake.functions.services import join_service, service_name
from flowlake.functions.severity import banded, severity_label
from flowlake.model import FLOW, SILVER
from flowlake.operators.codec import alert_messages, decode, encode, parse_flows, quarantined
from flowlake.operators.enrich import enrich, with_date

ADDRESSES = [
    ("10.1.2.3", "10.1.2", True),
    ("10.1.2", "", True),
    ("999.1.1.1", "999.1.1", False),
    ("::1", "", False),
    ("", "", False),
    ("172.15.0.1", "172.15.0", False),
    ("172.32.0.1", "172.32.0", False),
    ("172.16.0.1", "172.16.0", True),
    ("172.31.9.9", "172.31.9", True),
    ("172.160.0.1", "172.160.0", False),
    ("100.1.1.1", "100.1.1", False),
    ("192.169.0.1", "192.169.0", False),
    ("192.168.0.1", "192.168.0", True),
    ("1.2.3.4.5", "", False),
    (" 10.1.2.3", "", False),
    (None, None, None),
]


def test_addresses(spark):
    df = spark.createDataFrame([(ip,) for ip, _, _ in ADDRESSES], "ip string")
    got = {r.ip: (r.s, r.p) for r in
           df.select("ip", subnet_24("ip").alias("s"), is_private("ip").alias("p")).collect()}
    assert got == {ip: (subnet, private) for ip, subnet, private in ADDRESSES}


def test_services(spark):
    ports = {80: "HTTP", 443: "HTTPS", 22: "SSH", 53: "DNS", 21: "FTP", 25: "SMTP", 3306: "MySQL",
             5432: "PostgreSQL", 6379: "Redis", 8080: "HTTP-ALT", 81: "OTHER", -1: "OTHER",
             None: "OTHER"}
    df = spark.createDataFrame([(p,) for p in ports], "port int")
    assert {r.port: r.s for r in df.select("port", service_name("port").alias("s")).collect()} == ports


def test_service_dimension_replaces_the_list_and_keeps_rows(spark):
    flows = spark.createDataFrame([(80,), (9999,), (None,), (80,), (70000,)], "dst_port int").select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in FLOW.fields if f.name != "dst_port"),
        "dst_port",
    )
    services = spark.createDataFrame(
        [(80, "web"), (80, "web"), (70000, "own"), (9999, "game"), (None, "x"), (81, None)],
        "port int, service string")
    assert join_service(flows, services).count() == enrich(flows, services).count() == 5
    rows = join_service(flows, services).collect()
    assert sorted((str(r.dst_port), r.dst_service) for r in rows) == [
        ("70000", "own"), ("80", "web"), ("80", "web"), ("9999", "game"), ("None", "OTHER")]
    twice = spark.createDataFrame([(80, "web"), (80, "www")], "port int, service string")
    with pytest.raises(Exception, match="two services for port 80"):
        join_service(flows, twice).collect()


def test_severity(spark):
    df = spark.createDataFrame([(100,), (101,), (200,), (201,), (None,)], "n int")
    scores = [r[0] for r in df.select(banded("n", ((100, 0.7), (200, 1.0)), 0.4)).collect()]
    assert scores == [0.4, 0.7, 0.7, 1.0, 0.4]
    df = spark.createDataFrame([(0.4,), (0.6,), (0.7,), (0.8,), (1.0,)], "severity_score double")
    assert [r[0] for r in df.select(severity_label()).collect()] == [
        "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]


DECODED = [
    ('{"ts":"2026-01-29T12:00:00.123456789Z","router_id":"r","bytes":5}',
     {"ts": datetime(2026, 1, 29, 12, 0, 0, 123456), "router_id": "r", "bytes": 5}),
    ('{"ts":"2026-01-29T12:00:00.123456789+02:00","router_id":"r"}',
     {"ts": datetime(2026, 1, 29, 10, 0, 0, 123456), "router_id": "r"}),
    ('{"ts":"2026-01-29T12:00:00Z","bytes":"abc","router_id":"r"}',
     {"ts": datetime(2026, 1, 29, 12), "router_id": "r"}),
    ('{"ts":"2026-01-29T12:00:00Z","dst_port":99999999999}', {"ts": datetime(2026, 1, 29, 12)}),
    ('{"ts":1769688000,"router_id":"r"}', {"ts": datetime(2026, 1, 29, 12), "router_id": "r"}),
    ('{"ts":"2026-01-29T12:00:00Z","extra":1}', {"ts": datetime(2026, 1, 29, 12)}),
    # The first object counts.
    ('{"ts":"2026-01-29T12:00:00Z"} {', {"ts": datetime(2026, 1, 29, 12)}),
]
DROPPED = ['{"ts":"bad","router_id":"r"}', "not json", "", None, '[{"ts":"2026-01-29T12:00:00Z"}]',
           '{"ts":"2026-01-29T12', "{}", "null",
           '{"ts":"2026-01-29T12:00:00Z","bytes":}', '{"ts":"2026-01-29T12:00:00Z","bytes":5',
           '{"ts":null,"bytes":5}']


@pytest.mark.parametrize("text,expected", DECODED)
def test_accepted_messages(spark, text, expected):
    # As the message log delivers it: binary.
    messages = spark.createDataFrame([(bytearray(text, "utf8"),)], "value binary")
    (row,) = parse_flows(messages).select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), *FLOW.fieldNames()[1:]).collect()
    assert row.asDict() == {**dict.fromkeys(FLOW.fieldNames()), **expected}


def test_refused_messages_are_quarantined_whole(spark):
    texts = DROPPED + [text for text, _ in DECODED]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    refused = sorted(str(r.raw) for r in quarantined(messages).collect())
    # What the full decode refuses and what the quarantine takes is the same.
    assert refused == sorted(str(r.raw) for r in decode(messages).where("ts IS NULL").collect())
    assert refused == sorted(map(str, DROPPED))
    assert parse_flows(messages).count() == len(DECODED)


def test_encode_then_decode_is_identity(spark):
    flows = spark.createDataFrame(
        [(datetime(2026, 1, 29, 12, 0, 0, 123456), "r", 'quo"te', "ü", 1, 2, "TCP", 2**60, 3, "", 1),
         (datetime(1999, 12, 31, 23, 59, 59), None, None, None, None, None, None, None, None, None,
          None)], FLOW)
    back = parse_flows(encode(flows, key="router_id").select("value"))
    assert back.exceptAll(flows).isEmpty() and flows.exceptAll(back).isEmpty()


def test_alert_messages_are_keyed_by_entity(spark):
    alerts = spark.createDataFrame([("FAN_IN_DDOS", "1.2.3.4", 0.7)],
                                   "alert_type string, entity string, severity_score double")
    (row,) = alert_messages(alerts).collect()
    assert row.key == "1.2.3.4"
    assert row.value == '{"alert_type":"FAN_IN_DDOS","entity":"1.2.3.4","severity_score":0.7}'


def test_enriched_flows_have_the_silver_columns(spark):
    flows = spark.createDataFrame(
        [(datetime(2026, 1, 29, 23, 59, 59), "r", "10.1.2.3", "8.8.8.8", 1, 53, "UDP", 1, 1, "", 1)],
        FLOW)
    silver = with_date(enrich(flows))
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]
    (row,) = silver.collect()
    assert row.date == date(2026, 1, 29)
    assert (row.src_subnet_24, row.is_private_src, row.is_private_dst, row.dst_service) == (
        "10.1.2", True, False, "DNS")
