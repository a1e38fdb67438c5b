"""Rules at the edge of every threshold, suppression, and alert views."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowlake.model import ALERT, GOLD
from flowlake.operators import alerts as views
from flowlake.operators import baseline, rules, screening
from flowlake.operators.codec import parse_flows
from flowlake.operators.rollup import GOLD_ROLLUPS, rollup
from tests import flowgen

START = datetime(2026, 1, 29, 12)


def destination(sources, packets, size, window=0, ip="1.1.1.1"):
    begin = START + timedelta(minutes=window)
    return ((begin, begin + timedelta(minutes=1)), ip, size, packets, 1, sources)


def talker(destinations, ports):
    return ((START, START + timedelta(minutes=1)), "1.1.1.1", 0, 0, 1, destinations, ports)


FAN_IN = [
    (100, 99999, 0, None),
    (101, 10000, 10_000_000, None),
    (101, 10001, 0, 0.4),
    (101, 0, 10_000_001, 0.4),
    (101, None, 10_000_001, 0.4),
    (101, 10001, None, 0.4),
    (101, None, None, None),
    (None, 10001, 10_000_001, None),
    (200, 10001, 0, 0.4),
    (201, 10001, 0, 0.7),
    (500, 10001, 0, 0.7),
    (501, 10001, 0, 1.0),
]


@pytest.mark.parametrize("sources,packets,size,severity", FAN_IN)
def test_fan_in(spark, sources, packets, size, severity):
    gold = spark.createDataFrame([destination(sources, packets, size)], GOLD["top_destinations"])
    found = rules.detect(gold, rules.FAN_IN).collect()
    assert [r.severity_score for r in found] == ([] if severity is None else [severity])


FAN_OUT = [(50, 21, None), (51, 20, None), (51, 21, 0.4), (100, 21, 0.4), (101, 21, 0.7),
           (200, 21, 0.7), (201, 21, 1.0), (None, 21, None), (51, None, None)]


@pytest.mark.parametrize("destinations,ports,severity", FAN_OUT)
def test_fan_out(spark, destinations, ports, severity):
    gold = spark.createDataFrame([talker(destinations, ports)], GOLD["top_talkers"])
    found = rules.detect(gold, rules.FAN_OUT).collect()
    assert [r.severity_score for r in found] == ([] if severity is None else [severity])
    assert [r.unique_sources for r in found] == ([] if severity is None else [destinations])


def profile(spark, rows):
    """Rows of (window number, entity, sources, tcp flows, syn flows)."""
    return spark.createDataFrame(
        [((START + timedelta(minutes=w), START + timedelta(minutes=w + 1)), ip, 0, 20_000, 1,
          tcp, syn, sources) for w, ip, sources, tcp, syn in rows],
        GOLD["destination_profile"])


@pytest.mark.parametrize("tcp,syn,severity", [
    (50, 40, None), (50, 41, 0.4), (49, 49, None), (100, 90, 0.4), (100, 91, 0.7), (100, 95, 0.7),
    (100, 96, 1.0), (0, 0, None)])
def test_syn_burst(spark, tcp, syn, severity):
    found = rules.detect(profile(spark, [(0, "a", 5, tcp, syn)]), rules.SYN_BURST).collect()
    assert [r.severity_score for r in found] == ([] if severity is None else [severity])


def test_alert_columns(spark):
    gold = {
        "top_destinations": spark.createDataFrame([destination(501, 10001, 7)],
                                                  GOLD["top_destinations"]),
        "top_talkers": spark.createDataFrame([talker(60, 30)], GOLD["top_talkers"]),
    }
    alerts = rules.detect_all(gold)
    assert [(f.name, f.dataType) for f in alerts.schema] == [(f.name, f.dataType) for f in ALERT]
    assert {r.alert_type for r in alerts.collect()} == {"FAN_IN_DDOS", "FAN_OUT_SCAN"}


RULE = rules.Rule("FAN_IN_DDOS", "destination_profile", "dst_ip", "unique_sources",
                  every=(rules.Above("unique_sources", 100),))


def judged(spark, rows, **options):
    out = baseline.judge(profile(spark, rows), RULE, 60, lookback=5, **options)
    return {(r.entity, (r.window_start - START).seconds // 60): r.suppressed for r in out.collect()}


def test_crowds_are_suppressed_once_there_is_history(spark):
    crowd = [(w, "crowd", 300, 100, 0) for w in range(6)]
    flood = [(w, "flood", 300, 100, 100) for w in range(6)]
    got = judged(spark, crowd + flood)
    assert [got["crowd", w] for w in range(6)] == [False, False, False, True, True, True]
    assert not any(got["flood", w] for w in range(6))


def test_a_jump_above_the_baseline_stays(spark):
    rows = [(w, "a", 120, 10, 0) for w in range(4)]
    # Twice the mean is still normal, one more is not.
    assert judged(spark, rows + [(4, "a", 240, 10, 0)])["a", 4] is True
    assert judged(spark, rows + [(4, "a", 241, 10, 0)])["a", 4] is False


def test_quiet_windows_count_as_history_and_old_ones_do_not(spark):
    quiet = [(w, "a", 10, 10, 0) for w in range(3)]
    assert judged(spark, quiet + [(3, "a", 300, 10, 0)]) == {("a", 3): False}
    old = [(w, "a", 300, 10, 0) for w in (0, 1, 2)]
    assert judged(spark, old + [(8, "a", 300, 10, 0)])["a", 8] is False


def test_entities_without_a_name_have_a_history_too(spark):
    rows = [(w, None, 300, 100, 0) for w in range(5)]
    got = judged(spark, rows)
    assert [got[None, w] for w in range(5)] == [False, False, False, True, True]
    whole = profile(spark, rows)
    last = whole.where(F.col("window.start") >= START + timedelta(minutes=4))
    assert baseline.judge(last, RULE, 60, lookback=5, history=whole).count() == 1


def test_separate_history_gives_the_same_verdicts(spark):
    rows = [(w, "crowd", 300, 100, 0) for w in range(6)]
    whole = profile(spark, rows)
    last = whole.where(F.col("window.start") >= START + timedelta(minutes=4))
    got = baseline.judge(last, RULE, 60, lookback=5, history=whole).collect()
    assert [(r.window_start.minute, r.suppressed) for r in sorted(got)] == [(4, True), (5, True)]


def test_no_tcp_traffic_means_no_flood(spark):
    rows = [(w, "udp", 300, 0, 0) for w in range(4)]
    assert judged(spark, rows)["udp", 3] is True


def alert(minute, kind="FAN_IN_DDOS", entity="a", severity=0.7):
    begin = START + timedelta(minutes=minute)
    end = begin + timedelta(minutes=1)
    return (begin, end, kind, entity, severity, 1, 1, 1, end + timedelta(minutes=2, seconds=minute))


@pytest.fixture(scope="module")
def alerts(spark):
    return spark.createDataFrame(
        [alert(0), alert(1, severity=1.0), alert(1, "FAN_OUT_SCAN", "b", 0.4), alert(9, entity="c")],
        ALERT)


def test_recent_and_status(spark, alerts):
    now = F.lit(START + timedelta(minutes=10))
    newest = views.recent(alerts, "5 MINUTES", "window_end", now)
    assert [r.entity for r in newest.collect()] == ["c"]
    (row,) = views.status(alerts, "window_end").collect()
    assert (row.status, row.recent_alerts, row.entity, row.severity_label) == ("ATTACK", 4, "c", "HIGH")
    (row,) = views.status(alerts.where("false")).collect()
    assert (row.status, row.recent_alerts, row.entity, row.severity_label) == ("NORMAL", 0, None, None)
    # The bound is open: an alert exactly that old is no longer recent.
    edge = views.recent(alerts, "9 MINUTES", "window_end", now)
    assert sorted(r.window_start.minute for r in edge.collect()) == [1, 1, 9]
    assert [r.entity for r in views.recent(alerts, "8 MINUTES", "window_end", now).collect()] == ["c"]


def test_default_clock_is_now(spark, alerts):
    assert views.recent(alerts, "5 MINUTES").isEmpty()
    fresh = alerts.withColumn("detected_at", F.current_timestamp())
    assert views.recent(fresh, "5 MINUTES").count() == 4


def test_reports(spark, alerts):
    assert [r.window_start.minute for r in views.feed(alerts).collect()] == [1, 9, 0, 1]
    assert {r.alert_type: r.alerts for r in views.counts_by_type(alerts).collect()} == {
        "FAN_IN_DDOS": 3, "FAN_OUT_SCAN": 1}
    assert views.mean_severity(alerts).first()[0] == 0.7
    other = alerts.limit(2).withColumn("severity_score", F.lit(0.44))
    assert views.mean_severity(other).first()[0] == 0.44
    assert views.mean_severity(other.withColumn("severity_score", F.lit(120.0))).first()[0] == 120
    newest = views.recent(alerts, "10 YEARS", "window_start", F.lit("2027-01-01").cast("timestamp"))
    minutes = [r.window_start for r in newest.collect()]
    assert len(minutes) == 4 and minutes == sorted(minutes, reverse=True)
    assert [(r.entity, r.alerts) for r in views.most_targeted(alerts, 2).collect()] == [
        ("a", 2), ("b", 1)]


def test_notify_once(spark, alerts):
    first = views.first_per_entity(alerts)
    assert first.columns == alerts.columns
    assert sorted((r.entity, r.window_start.minute, r.severity_score) for r in first.collect()) == [
        ("a", 0, 0.7), ("b", 1, 0.4), ("c", 9, 0.7)]
    unnamed = alerts.withColumn("entity", F.lit(None).cast("string"))
    assert views.not_yet_notified(unnamed, unnamed).isEmpty()
    left = views.not_yet_notified(alerts, first)
    assert [(r.entity, r.window_start.minute) for r in left.collect()] == [("a", 1)]


@pytest.mark.parametrize("rule", [*rules.STANDARD_RULES, rules.SYN_BURST], ids=lambda r: r.alert_type)
def test_screening_finds_what_the_full_rollup_finds(spark, rule):
    records = [r for m in range(2) for name, count in
               (("baseline", 400), ("ddos_fan_in", 1500), ("flash_crowd", 900))
               for r in flowgen.scenario(name, m, count)]
    records += flowgen.scenario("scan_fan_out", 1, 500, ports=range(1, 30))
    # Records whose addresses were lost form a group of their own.
    for name in ("ddos_fan_in", "scan_fan_out"):
        records += [{**r, rule.entity: None}
                    for r in flowgen.scenario(name, 0, 1000, ports=range(1, 30))]
    flows = parse_flows(flowgen.messages(spark, records))
    table = GOLD_ROLLUPS[rule.table]
    want = rules.detect(rollup(flows, table, distinct="exact"), rule).drop("detected_at")
    got = screening.detect_in_flows(flows, rule, "1 minute").drop("detected_at")
    assert want.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.where("entity IS NULL").count() > 0
    # A pass that kept every key would be of no use.
    kept = screening.candidates(flows, rule, "1 minute").count()
    assert want.count() <= kept < 20
