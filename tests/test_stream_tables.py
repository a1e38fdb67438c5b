"""What the streams keep beside the layers: reports, corrections, incidents, states, compaction."""

import time
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import run_streams
from flowlake.config import LakeConfig, seconds_of, streaming_session
from flowlake.functions.timing import flatten_window
from flowlake.model import ALERT, DECAYED, FLOW, GOLD, SILVER, SOURCE_BITS, dated
from flowlake.operators import mergeable, rules
from flowlake.operators.alerts import incidents, with_state
from flowlake.operators.codec import parse_flows
from flowlake.operators.rollup import DESTINATIONS, rollup
from flowlake.sources.layers import read_layer
from flowlake.sources.streams import follow_layer, open_stream
from flowlake.streaming import compaction, metrics
from flowlake.streaming.late import read_corrected, read_late, start_corrections
from flowlake.streaming.decayed import start_decayed
from flowlake.streaming.medallion import Medallion
from flowlake.streaming.sinks import append_files
from tests import flowgen
from tests.test_streams import TRAFFIC, inbox, minute, same, text_lake  # noqa: F401


def test_reports_outlive_streams_and_sessions(spark, inbox, tmp_path, drop_file):  # noqa: F811
    drop_file(inbox, "1.txt", flowgen.lines(minute(0) + minute(1)))
    for number in (2, 3):
        lake = text_lake(spark, inbox, tmp_path)
        with metrics.BatchLog(lake.session, lake.cfg.batches, flush_every=2) as log:
            log.settle(lake.run_available())
        drop_file(inbox, f"{number}.txt", flowgen.lines(minute(20 * number)))
    stored = metrics.batches(spark, lake.cfg.batches)
    per = {r.stream: r for r in metrics.throughput(stored).collect()}
    assert (per["bronze"].input_rows, per["bronze"].written_rows) == (15, 15)
    assert per["silver"].written_rows == 15 and "quarantine" not in per  # nothing to do
    assert per["bronze"].last_time - per["bronze"].first_time == timedelta(minutes=40, seconds=4)
    assert per["gold_top_destinations"].written_rows == 2
    # No batch is counted twice, and each has its time.
    assert stored.count() == stored.select("stream", "batch_id").distinct().count()
    assert stored.where("duration_ms is null or duration_ms <= 0 or input_rows is null").isEmpty()
    silver = stored.where("stream = 'gold_top_destinations'")
    assert silver.agg(F.max("watermark")).first()[0] is not None


def test_a_report_sent_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "batches")
    row = {"stream": "s", "run_id": "r", "batch_id": 4, "input_rows": 10, "written_rows": 3}
    for hour, rows in ((1, 10), (2, 12)):
        spark.createDataFrame([row | {"input_rows": rows}]).withColumns({
            "trigger_time": F.timestamp_seconds(F.lit(hour * 3600)), "date": F.lit("2024-01-01"),
            "duration_ms": F.lit(5).cast("long"), "late_groups": F.lit(0).cast("long"),
        }).write.mode("append").partitionBy("date").parquet(path)
    (got,) = metrics.batches(spark, path).collect()
    assert got.input_rows == 12


def test_latency_sketches_merge_over_batches(spark, tmp_path):
    cfg = LakeConfig.under(str(tmp_path / "lake"), max_files=1)
    session = streaming_session(spark, cfg)
    for part in range(4):
        spark.range(part, 4000, 4).select(
            F.timestamp_seconds("id").alias("window_start"),
            F.timestamp_seconds("id").alias("window_end"),
            F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("alert_type"),
            F.lit("e").alias("entity"), F.lit(1.0).alias("severity_score"),
            *(F.lit(1).cast("long").alias(c)
              for c in ("unique_sources", "total_packets", "total_bytes")),
            F.timestamp_seconds(F.col("id") * 2).alias("detected_at"),
        ).withColumn("date", F.to_date("window_start")).coalesce(1).write.mode(
            "append").partitionBy("date").parquet(cfg.alerts)
    for _ in range(2):  # A second run finds nothing new.
        metrics.start_latency(session, cfg).awaitTermination()
    got = {r.alert_type: r for r in metrics.latency_quantiles(spark, cfg, (0.5, 0.99)).collect()}
    assert (got["A"].alerts, got["B"].alerts) == (1334, 2666)
    for row in got.values():
        assert abs(row.p50_seconds - 2000) < 0.02 * 4000
        assert abs(row.p99_seconds - 3960) < 0.02 * 4000


def corrected(spark, lake):
    rows = flatten_window(read_corrected(spark, lake.cfg, "top_destinations")).collect()
    return sorted((r.window_start.minute, r.dst_ip, r.flow_count) for r in rows)


def test_late_flows_correct_closed_windows(spark, inbox, tmp_path, drop_file):  # noqa: F811
    def run():
        lake = text_lake(spark, inbox, tmp_path)
        lake.run_available()
        start_corrections(lake).awaitTermination()
        return lake

    drop_file(inbox, "1.txt", flowgen.lines([r for m in range(4) for r in minute(m)] + minute(20)))
    lake = run()
    before = corrected(spark, lake)
    assert [c for _, _, c in before] == [5] * 4 and read_late(spark, lake.cfg).isEmpty()
    # Late rows for a known window and key, for a new key, and for a window nobody has seen.
    late = minute(1, 3) + minute(2, 2, "9.9.9.9") + minute(9, 1)
    drop_file(inbox, "2.txt", flowgen.lines(late))
    lake = run()
    assert read_late(spark, lake.cfg).count() == len(late)
    want = [(0, "172.16.1.10", 5), (1, "172.16.1.10", 8), (2, "172.16.1.10", 5),
            (2, "9.9.9.9", 2), (3, "172.16.1.10", 5), (9, "172.16.1.10", 1)]
    assert corrected(spark, lake) == want
    # Gold itself is as it was, and a later correction replaces an earlier one.
    assert read_layer(spark, lake.cfg.gold("top_destinations"), GOLD["top_destinations"]).count() == 4
    drop_file(inbox, "3.txt", flowgen.lines(minute(1, 4) + minute(40)))
    lake = run()
    want[1] = (1, "172.16.1.10", 12)
    assert corrected(spark, lake) == want + [(20, "172.16.1.10", 5)]
    # The lost checkpoint of the corrections: all batches come again, nothing counts twice.
    again = replace(lake.cfg, checkpoint_root=str(tmp_path / "fresh"))
    lake = Medallion(spark, again, open_messages=lake.open_messages, tables=lake.tables,
                     rules=lake.rules)
    start_corrections(lake).awaitTermination()
    assert corrected(spark, lake) == want + [(20, "172.16.1.10", 5)]
    flows = read_layer(spark, again.silver, SILVER).where(F.minute("ts") < 40)
    assert same(read_corrected(spark, again, "top_destinations"),
                rollup(flows, DESTINATIONS, distinct="exact"))


def alert(number, entity="a", kind="FAN_IN_DDOS", severity=0.4, size=10):
    start = flowgen.NOON + timedelta(minutes=number)
    return (start, start + timedelta(minutes=1), kind, entity, severity, 7, size, size, start)


def test_incidents_open_extend_join_and_close_over_batches(spark, tmp_path):
    cfg = LakeConfig.under(str(tmp_path / "lake"))

    def send(*rows):
        spark.createDataFrame(rows, ALERT).coalesce(1).write.mode("append").parquet(cfg.alerts)

    def run():
        session = streaming_session(spark, cfg)
        found = incidents(follow_layer(session, cfg.alerts, ALERT), "5 minutes", "30 minutes")
        append_files(found, cfg.gold("incidents"), cfg.checkpoint("incidents"),
                     trigger=None).awaitTermination()
        stored = spark.read.schema(found.schema).parquet(cfg.gold("incidents")).collect()
        return sorted(((r.incident_start.minute, r.incident_end.minute), r.entity, r.windows,
                       r.peak_severity, r.total_packets) for r in stored)

    send(alert(0), alert(1), alert(0))                 # opened; one alert twice
    assert run() == []
    send(alert(8, severity=1.0), alert(1), alert(3, "b"))  # another one, a repeat, another entity
    assert run() == []
    send(alert(5))                                     # joins the two
    assert run() == []
    send(alert(50, "c"))                               # the watermark closes what is before
    assert run() == [((0, 9), "a", 4, 1.0, 40), ((3, 4), "b", 1, 0.4, 10)]
    stored = spark.read.schema(ALERT).parquet(cfg.alerts)
    batch = incidents(stored, "5 minutes")
    now = F.lit(flowgen.NOON + timedelta(minutes=52))
    state = {r.entity: r.is_open for r in with_state(batch, now, "5 minutes").collect()}
    assert state == {"a": False, "b": False, "c": True}


def test_alerts_of_a_batch_make_one_file_per_date(spark, tmp_path):
    cfg = LakeConfig.under(str(tmp_path / "lake"), window="1 day")
    rows = spark.range(240).select(
        F.timestamp_seconds(F.lit(86_400) * (F.col("id") % 3)).alias("start"),
        F.concat(F.lit("10.0.0."), F.col("id")).alias("dst_ip"))
    gold = rows.select(
        F.struct("start", (F.col("start") + F.expr("INTERVAL 1 DAY")).alias("end")).alias("window"),
        "dst_ip", *(F.lit(100_000).cast("long").alias(c)
                    for c in GOLD["destination_profile"].fieldNames()[2:]))
    gold.withColumn("date", F.to_date("window.start")).repartition(40).write.partitionBy(
        "date").parquet(cfg.gold("destination_profile"))
    rule = replace(rules.FAN_IN, table="destination_profile")
    lake = Medallion(spark, cfg, open_flows=lambda _: None, rules=(rule,), tables=())
    [start_alerts] = list(lake._stages())[-1]
    start_alerts(None).awaitTermination()
    stored = spark.read.parquet(cfg.alerts)
    assert stored.count() == stored.select("entity").distinct().count() == 240
    assert len(stored.inputFiles()) == stored.select("date").distinct().count() == 3


def test_states_of_a_stream_merge_like_the_flows(spark, inbox, tmp_path, drop_file):  # noqa: F811
    drop_file(inbox, "1.txt", flowgen.lines(TRAFFIC))
    drop_file(inbox, "2.txt", flowgen.lines(minute(90, 1)))
    lake = text_lake(spark, inbox, tmp_path, gold_files=1)
    lake.tables, lake.rules = ("destination_panes", "router_panes", "source_bits"), ()
    lake.run_available()
    flows = parse_flows(flowgen.messages(spark, TRAFFIC))
    exact = rollup(flows, DESTINATIONS, "1 hour", distinct="exact")
    stored = read_layer(spark, lake.cfg.gold("destination_panes"),
                        mergeable.DESTINATION_PANES.schema())
    hour = mergeable.estimates(
        mergeable.merged(stored, mergeable.DESTINATION_PANES, "1 hour"),
        mergeable.DESTINATION_PANES, source_set="unique_sources").drop("sources")
    assert same(hour.withColumn("unique_sources", F.col("unique_sources").cast("long")), exact)
    bits = read_layer(spark, lake.cfg.gold("source_bits"), SOURCE_BITS)
    counted = mergeable.counted_bits(
        mergeable.merged_bits(bits, "dst_ip", "1 hour"), "dst_ip", "unique_sources")
    assert same(counted, exact.select("window", "dst_ip", "unique_sources"))
    ports = mergeable.frequent(
        mergeable.merged(read_layer(spark, lake.cfg.gold("router_panes"),
                                    mergeable.ROUTER_PANES.schema()),
                         mergeable.ROUTER_PANES, "1 hour"), mergeable.ROUTER_PANES, "ports", 2)
    top = flows.groupBy("dst_port").count().orderBy(F.desc("count"), "dst_port").limit(2).collect()
    assert [(r.dst_port, r.item_count, r.rank) for r in ports.orderBy("rank").collect()] == [
        (t.dst_port, t["count"], i + 1) for i, t in enumerate(top)]


def test_compaction_between_batches_keeps_every_row_once(spark, inbox, tmp_path, drop_file):  # noqa: F811
    schema, sent = dated(FLOW), []

    def run(number):
        rows = minute(number) + minute(24 * 60 + number, 2)
        sent.extend(rows)
        drop_file(inbox, f"{number}.txt", flowgen.lines(rows))
        lake = text_lake(spark, inbox, tmp_path, max_files=1)
        lake.run_available("bronze")
        return lake.cfg.bronze

    def check():
        want = parse_flows(flowgen.messages(spark, sent))
        assert same(compaction.read_compacted(spark, path, schema).drop("date"), want)

    for number in range(3):
        path = run(number)
    check()
    assert compaction.compact(spark, path, schema, "2026-01-30") == 1
    check()
    # Nothing new: nothing is written.
    assert compaction.compact(spark, path, schema, "2026-01-30") == 1
    run(3)
    run(4)
    check()
    files = {str(r.date): r.files for r in
             compaction.files_per_date(spark, path, schema).collect()}
    assert files == {"2026-01-29": 3, "2026-01-30": 5}
    # A compaction that failed before its commit leaves readers where they were.
    compaction.read_compacted(spark, path, schema).limit(3).write.partitionBy("date").parquet(
        f"{path}_compacted/data/version=2")
    check()
    assert compaction.compact(spark, path, schema, "2026-01-31") == 2
    check()
    gone = compaction.drop_superseded(spark, path)
    assert any("data/version=1" in g for g in gone)
    check()
    run(5)
    check()
    files = {str(r.date): r.files for r in
             compaction.files_per_date(spark, path, schema).collect()}
    assert files == {"2026-01-29": 2, "2026-01-30": 2}


def test_decayed_past_does_not_depend_on_batches(spark, tmp_path):
    rule = replace(rules.FAN_IN, table="destination_profile", some=(),
                   every=(rules.Above("unique_sources", 0),))
    rows = [(m, e, 10 * (m + 1)) for m in (0, 1, 2, 4, 7) for e in ("a", None)]

    def run(name, parts):
        cfg = LakeConfig.under(str(tmp_path / name), max_files=1)
        for part in parts:
            spark.createDataFrame(
                [((flowgen.NOON + timedelta(minutes=m), flowgen.NOON + timedelta(minutes=m + 1)),
                  e, 1, 1, 1, 2, 0, n) for m, e, n in part], GOLD["destination_profile"],
            ).withColumn("date", F.to_date("window.start")).coalesce(1).write.mode(
                "append").partitionBy("date").parquet(cfg.gold("destination_profile"))
            start_decayed(streaming_session(spark, cfg), cfg, rule, 60).awaitTermination()
        found = read_layer(spark, cfg.judged, DECAYED).collect()
        return sorted((str(r.entity), r.window_start.minute, r.history_sum, r.history_weight,
                       r.suppressed) for r in found)

    want, total, weight, last = [], 0.0, 0.0, 0
    for m in (0, 1, 2, 4, 7):
        total, weight, last = total * 0.5 ** (m - last), weight * 0.5 ** (m - last), m
        n = 10 * (m + 1)
        want.append((m, total, weight, weight >= 0.8 and n * weight <= 2 * total))
        total, weight = total + n, weight + 1
    expected = sorted((e, *w) for e in ("a", "None") for w in want)
    assert run("one", [rows]) == expected
    assert run("many", [rows[i:i + 2] for i in range(0, len(rows), 2)]) == expected


def test_everything_starts_from_the_launcher(spark, inbox, tmp_path, drop_file):  # noqa: F811
    drop_file(inbox, "1.txt", flowgen.lines(TRAFFIC))
    drop_file(inbox, "2.txt", flowgen.lines(minute(90, 1)))
    root = LakeConfig.under(str(tmp_path / "lake"))
    cfg = LakeConfig.from_env(
        {"SUPPRESS": "true", "TRIGGER": "1 second"}, distinct="exact", bronze=root.bronze,
        silver=root.silver, gold_root=root.gold_root, checkpoint_root=root.checkpoint_root)
    assert cfg.suppress and seconds_of(spark, cfg.window) == 60
    lake = run_streams.start(
        spark, cfg, lambda session: open_stream(session, cfg, "text", str(inbox)))
    try:
        deadline = time.time() + 120
        while time.time() < deadline:
            assert not [q.exception() for q in lake.session.streams.active if q.exception()]
            judged = read_layer(spark, cfg.judged, DECAYED)
            if judged.count() and metrics.latency_quantiles(spark, cfg).count():
                break
            time.sleep(1)
    finally:
        names = {q.name for q in lake.session.streams.active}
        for query in lake.session.streams.active:
            query.stop()
    assert {"judged_alerts", "corrections", "alert_latency", "gold_destination_profile"} <= names
    assert judged.count() and metrics.latency_quantiles(spark, cfg).count()


@pytest.mark.parametrize("text,number", [
    ("0.0.0.0", 0), ("255.255.255.255", 2 ** 32 - 1), ("10.0.0.1", 167772161), ("010.0.0.1", None),
    ("1.2.3", None), ("1.2.3.4.5", None), ("256.1.1.1", None), ("::1", None), ("", None), (None, None)])
def test_ip_numbers(spark, text, number):
    from flowlake.functions.address import ip_number
    df = spark.createDataFrame([(text,)], "ip string")
    assert df.select(ip_number("ip")).first()[0] == number


def test_bitmaps_count_odd_addresses_too(spark):
    ips = ["10.0.0.1", "10.0.0.1", "10.9.9.9", "::1", "::2", "010.0.0.1", None, "0.0.0.0"]
    rows = [flowgen.record(flowgen.NOON + timedelta(seconds=i), ip, "t")
            for i, ip in enumerate(ips)] + [flowgen.record(flowgen.NOON, None, "only-null")]
    flows = parse_flows(flowgen.messages(spark, rows))
    got = mergeable.counted_bits(
        mergeable.address_bits(flows, "dst_ip", "src_ip", "1 minute"), "dst_ip", "n").collect()
    assert {r.dst_ip: r.n for r in got} == {"t": 6, "only-null": 0}


def test_a_pane_that_crosses_a_window_is_an_error(spark):
    flows = parse_flows(flowgen.messages(spark, minute(0)))
    hours = mergeable.panes(flows, mergeable.DESTINATION_PANES, "1 hour")
    with pytest.raises(Exception, match="crosses"):
        mergeable.merged(hours, mergeable.DESTINATION_PANES, "25 minutes").collect()
