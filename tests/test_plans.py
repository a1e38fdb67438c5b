"""Plans keep the shape they need at scale."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowlake.plans.queries import REGISTRY
from flowlake.functions.address import is_private
from flowlake.model import FLOW, SILVER
from flowlake.operators import ranking
from flowlake.operators.codec import parse_flows
from flowlake.operators.enrich import enrich, with_date
from flowlake.operators.rollup import DESTINATIONS, GOLD_ROLLUPS, TALKERS, rollup
from flowlake.sources.layers import between, read_layer, write_layer

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "AggregateInPandas", "PythonUDF")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "silver")
    rows = [(datetime(2026, 1, day, 12, i), "r", "10.0.0.1", "8.8.8.8", 1, 80, "TCP", 1, 1, "", 1)
            for day in (1, 2, 3) for i in range(4)]
    write_layer(with_date(enrich(spark.createDataFrame(rows, FLOW))), path, "date")
    return read_layer(spark, path, SILVER)


BATCH = [name for name in REGISTRY if not name.startswith("streaming_")]
# Views of the stored layers build these on their first call.
STORED = {
    "alerts_to_messages", "silver_daily_partitions", "latest_flows", "gold_flattened",
    "router_listing", "layer_counts", "topk_destinations", "topk_talkers", "topk_per_window",
    "flag_suspect_destinations", "flag_suspect_talkers", "baseline_verdicts",
    "baseline_suppressed_alerts", "alert_severity_labels", "recent_alerts", "attack_status",
    "alert_feed", "alert_type_counts", "alert_severity_mean", "most_targeted", "deduped_alerts",
    "alert_incidents", "entity_flows", "gold_sketch_rollup", "gold_total_rollup", "shared_sources",
    "gold_top_ports", "gold_heavy_hitters", "bitmap_unique_sources", "sliding_destinations",
}


@pytest.mark.parametrize("name", sorted(set(BATCH) - STORED))
def test_flow_queries_start_no_job_and_scan_the_events(spark, name):
    context = spark.sparkContext
    context.setJobGroup(f"call-{name}", name)
    df = entry.queries()[name](spark, SF)
    physical(df)
    # Reading the table's schema is the only job.
    assert len(context.statusTracker().getJobIdsForGroup(f"call-{name}")) <= 1
    assert {f.replace("file://", "") for f in df.inputFiles()} == {f"{SF}/events.parquet"}


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    plan = physical(entry.queries()[name](spark, SF))
    assert not [node for node in PYTHON_NODES if node in plan]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_columns_are_pruned(silver):
    plan = physical(rollup(silver, DESTINATIONS, distinct="exact"))
    (schema,) = re.findall(r"ReadSchema: (struct<.*?>)(?:\n|$)", plan)
    assert schema == "struct<ts:timestamp,src_ip:string,dst_ip:string,bytes:bigint,packets:int>"
    plan = physical(rollup(silver, DESTINATIONS).select("unique_sources"))
    assert "ReadSchema: struct<ts:timestamp,src_ip:string,dst_ip:string>" in plan


def test_time_bounds_prune_dates_and_reach_the_scan(silver):
    since, until = F.lit("2026-01-02 12:01:00").cast("timestamp"), F.lit("2026-01-03").cast("timestamp")
    part = between(silver, since, until, {"dst_ip": "8.8.8.8"})
    plan = physical(part)
    assert re.search(r"PartitionFilters: \[.*date.*>= 2026-01-02.*<= 2026-01-03", plan)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2026-01-02.12:01", plan)
    assert "EqualTo(dst_ip,8.8.8.8)" in plan
    assert part.count() == 3


def test_key_filter_above_a_rollup_reaches_the_scan(silver):
    for mode in ("approx", "exact"):
        plan = physical(rollup(silver, TALKERS, distinct=mode).where("src_ip = '10.0.0.1'"))
        assert "EqualTo(src_ip,10.0.0.1)" in plan


def test_private_filter_reaches_the_scan(silver):
    assert "StringStartsWith(src_ip,172.31.)" in physical(silver.where(is_private("src_ip")))


def test_timestamps_are_stored_with_statistics(spark, silver):
    import pyarrow.parquet as pq

    metadata = pq.ParquetFile(silver.inputFiles()[0].replace("file://", "")).metadata
    column = metadata.row_group(0).column(0)
    assert column.path_in_schema == "ts" and column.statistics.has_min_max


def test_newest_rows_read_the_last_date_only(silver):
    plan = physical(ranking.newest_dated(silver, 3))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*date[^\]]*>= Subquery", plan)


def test_text_is_parsed_once(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    plan = parse_flows(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_enrichment_does_not_shuffle(silver):
    assert "Exchange" not in physical(enrich(silver.select(*FLOW.fieldNames())))


@pytest.mark.parametrize("mode,exchanges", [("approx", 1), ("sketch", 1), ("exact", 2)])
@pytest.mark.parametrize("table", sorted(GOLD_ROLLUPS))
def test_rollups_combine_before_each_shuffle(silver, table, mode, exchanges):
    plan = physical(rollup(silver, GOLD_ROLLUPS[table], distinct=mode))
    assert plan.count("Exchange hashpartitioning") == exchanges
    below = re.findall(r"Exchange hashpartitioning.*\n\s*\+- (\w+)\((.*)", plan)
    assert len(below) == exchanges
    assert all(node.endswith("Aggregate") for node, _ in below)
    # Exact counting holds no sets: it spreads a key over the cluster by value.
    assert "collect_set" not in plan
    if mode == "exact":
        assert re.findall(r"Exchange hashpartitioning\((.*?), 8\)", plan)[-1].count("_value") == 1


def test_ranking_keeps_k_rows_before_the_shuffle(silver):
    plan = physical(ranking.router_top_ports(silver, k=3))
    assert re.search(r"WindowGroupLimit.*Partial", plan)
    assert plan.index("Final") < plan.index("Partial")


def test_missing_layer_is_empty(spark, tmp_path):
    missing = read_layer(spark, str(tmp_path / "nothing"), SILVER)
    assert missing.schema == SILVER and missing.isEmpty()
