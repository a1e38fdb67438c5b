"""Plans of the queries over gold that merges, and what lookups of an address read."""

import pytest
from pyspark.sql import functions as F

from flowlake.operators import mergeable
from flowlake.operators.enrich import enrich, with_date
from flowlake.plans.queries import REGISTRY, _flows, event_lake
from flowlake.sources.layers import entity_history, write_clustered, write_layer

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
STATES = ("destination_panes", "router_panes", "source_bits")


@pytest.mark.parametrize("name", ["shared_sources", "gold_top_ports", "bitmap_unique_sources",
                                  "gold_total_rollup", "sliding_destinations"])
def test_wider_windows_read_gold_and_no_flows(spark, name):
    files = REGISTRY[name](spark, SMALL).inputFiles()
    assert files and all(any(f"gold/{state}" in f for state in STATES) for f in files)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sliding_windows_copy_panes_and_not_flows(spark):
    panes = mergeable.panes(_flows(spark, SMALL), mergeable.DESTINATION_PANES, "1 hour")
    slides = mergeable.merged(panes, mergeable.DESTINATION_PANES, "6 hours", "1 hour")
    lines = plan_of(slides).splitlines()
    copies = [i for i, line in enumerate(lines) if "Expand" in line or "Generate" in line]
    first = [i for i, line in enumerate(lines) if "hll_sketch_agg" in line]
    # Read from the bottom: flows are aggregated to panes before anything is copied.
    assert copies and first and max(copies) < min(first)
    hours = panes.count()
    assert hours == panes.select("window", "dst_ip").distinct().count()
    assert slides.agg(F.sum("flow_count")).first()[0] == 6 * 1000


def rows_read(df):
    """Rows that the scans of a plan without exchanges hand on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value()
               for i in range(leaves.size()))


def test_lookups_of_an_address_skip_row_groups(spark, tmp_path):
    silver = with_date(enrich(_flows(spark, LARGER))).where("date < '2024-01-05'")
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "16384")
    try:
        write_clustered(silver, str(tmp_path / "near"), "date")
        write_layer(silver, str(tmp_path / "plain"), "date")
    finally:
        hadoop.unset("parquet.block.size")
    busy = [r[0] for r in silver.groupBy("dst_ip").count().orderBy(F.desc("count")).limit(4)
            .collect()]
    quiet = silver.where(~F.col("dst_ip").isin(busy)).orderBy("ts").first()["dst_ip"]
    total = silver.count()
    for address in (*busy[1:], quiet):
        near, plain = (entity_history(spark.read.parquet(str(tmp_path / layout)), address)
                       for layout in ("near", "plain"))
        assert sorted(map(str, near.select(*sorted(near.columns)).collect())) == sorted(
            map(str, plain.select(*sorted(near.columns)).collect()))
        assert rows_read(near) < 0.5 * 2 * total
        assert rows_read(near) < rows_read(plain)


def test_lookups_reach_the_scan(spark):
    layer = event_lake(spark, SMALL).clustered()
    since = F.lit("2024-01-10 00:00:00").cast("timestamp")
    plan = entity_history(layer, "172.16.1.20", since)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "EqualTo(dst_ip,172.16.1.20)" in text and "EqualTo(src_ip,172.16.1.20)" in text
    assert "PartitionFilters: [isnotnull(date" in text


def operators_of(df):
    """The physical plan's operators, one per line, before stages are run."""
    return df._jdf.queryExecution().sparkPlan().toString()


def test_bitmaps_merge_in_hash_tables(spark):
    # A wide bitmap has no place in a hash table: all its copies would be sorted.
    flows = _flows(spark, SMALL)
    bits = mergeable.address_bits(flows, "dst_ip", "src_ip", "1 hour")
    slides = mergeable.merged_bits(bits, "dst_ip", "6 hours", "1 hour")
    plan = operators_of(mergeable.counted_bits(slides, "dst_ip", "unique_sources"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_copies_for_sliding_windows_are_not_shuffled(spark):
    flows = _flows(spark, SMALL)
    panes = mergeable.panes(flows, mergeable.DESTINATION_PANES, "1 hour")
    bits = mergeable.address_bits(flows, "dst_ip", "src_ip", "1 hour")
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for slides in (mergeable.merged(panes, mergeable.DESTINATION_PANES, "6 hours", "1 hour"),
                   mergeable.merged_bits(bits, "dst_ip", "6 hours", "1 hour")):
        lines = slides._jdf.queryExecution().executedPlan().toString().splitlines()
        copied = next(i for i, line in enumerate(lines) if "Generate" in line)
        assert not any("Exchange" in line for line in lines[:copied])
        below = next(line for line in lines[copied:] if "Exchange" in line)
        assert f", {6 * shuffles})" in below


@pytest.mark.parametrize("width,slide", [(6, 1), (6, 4), (3, 3), (2, 5)])
def test_sliding_windows_hold_what_brute_force_finds(spark, width, slide):
    hour = 3600
    rows = [(10 * hour + 60, "a", "10.0.0.1"), (10 * hour + 70, "a", "10.0.0.1"),
            (11 * hour, "a", "10.0.0.63"), (14 * hour, "a", "10.0.0.64"), (14 * hour, "a", "::1"),
            (15 * hour, "a", "10.0.0.1"), (15 * hour, "a", "::1"), (15 * hour, "a", None),
            (40 * hour, None, "255.255.255.255"), (41 * hour, None, "0.0.0.63")]
    flows = spark.createDataFrame(rows, "at long, dst_ip string, src_ip string").select(
        F.timestamp_seconds("at").alias("ts"), "dst_ip", "src_ip", F.lit(5).alias("bytes"),
        F.lit(2).alias("packets"))
    expected = {}
    for at, target, source in rows:
        for start in range(0, 50):
            if start % slide == 0 and start * hour <= at < (start + width) * hour:
                expected.setdefault((start * hour, target), []).append(source)
    span, step = f"{width} hours", f"{slide} hours"
    bits = mergeable.address_bits(flows, "dst_ip", "src_ip", "1 hour")
    counted = mergeable.counted_bits(
        mergeable.merged_bits(bits, "dst_ip", span, step), "dst_ip", "sources")
    got = {(int(r.start), r.dst_ip): r.sources for r in counted.select(
        F.unix_seconds("window.start").alias("start"), "dst_ip", "sources").collect()}
    assert got == {k: len(set(v) - {None}) for k, v in expected.items()}
    panes = mergeable.panes(flows, mergeable.DESTINATION_PANES, "1 hour")
    sums = mergeable.merged(panes, mergeable.DESTINATION_PANES, span, step).select(
        F.unix_seconds("window.start").alias("start"),
        (F.unix_seconds("window.end") - F.unix_seconds("window.start")).alias("length"),
        "dst_ip", "flow_count", "total_bytes").collect()
    assert {((r.start, r.dst_ip), r.length, r.flow_count, r.total_bytes) for r in sums} == {
        (k, width * hour, len(v), 5 * len(v)) for k, v in expected.items()}


def test_sliding_sums_and_sources_are_not_broadcast(spark):
    assert "Broadcast" not in operators_of(REGISTRY["sliding_destinations"](spark, SMALL))
