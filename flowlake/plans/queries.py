"""The registered queries, each a function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.config import LakeConfig, pinned, shared_folder
from flowlake.functions.timing import flatten_window, zoneless
from flowlake.model import ALERT, DECAYED, FLOW, GOLD, QUARANTINE, SILVER, SOURCE_BITS, dated
from flowlake.operators import alerts as alert_views
from flowlake.operators import baseline, codec, mergeable, ranking, rules, screening, views
from flowlake.operators.enrich import enrich, with_date
from flowlake.operators.rollup import (
    DESTINATION_PROFILE,
    DESTINATIONS,
    ROUTERS,
    TALKERS,
    Rollup,
    rollup,
    rollup_widths,
)
from flowlake.plans.lake import EventLake, lake_of, state_of
from flowlake.sources.events import FLOOD_TARGET, flows_of_events, messages_of_events
from flowlake.sources.layers import entity_history, inventory, read_layer
from flowlake.sources.streams import follow_layer
from flowlake.streaming import metrics
from flowlake.streaming.compaction import (
    compact, drop_superseded, files_per_date, read_compacted,
)
from flowlake.streaming.decayed import start_decayed
from flowlake.streaming.health import layer_health
from flowlake.streaming.late import read_corrected, start_corrections
from flowlake.streaming.medallion import STANDARD_TABLES, Medallion
from flowlake.streaming.sinks import append_files
from flowlake.streaming.suppression import read_suppressed, start_suppression

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

ALERT_WINDOW = "10 days"
PROFILE_WINDOW = "1 day"
ROLLUP_WINDOW = "1 hour"
INCIDENT_GAP = "36 hours"

# A fan-in rule sensitive enough for one-day windows of small tables, so that
# the crowd targets trip it and the baseline has something to judge.
SENSITIVE_FAN_IN = rules.Rule(
    alert_type="FAN_IN_DDOS",
    table="destination_profile",
    entity="dst_ip",
    evidence="unique_sources",
    every=(rules.Above("unique_sources", 5), rules.Above("total_packets", 50)),
    bands=((500, 1.0), (200, 0.7)),
)


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def _events_path(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pinned(spark).read.parquet(_events_path(sf_dir))


def _exactly(path: str) -> str:
    """A pattern that only ``path`` itself meets; a stream's path must be one to be a file."""
    return f"{path[:-1]}[{path[-1]}]"


def event_lake(spark: SparkSession, sf_dir: str) -> EventLake:
    return lake_of(pinned(spark), _events_path(sf_dir))


def _flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flows as the bronze layer stores them, straight from the events."""
    flows = flows_of_events(_events(spark, sf_dir))
    return flows.withColumn("ts", F.col("ts").cast("timestamp"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the message log would hold."""
    messages = messages_of_events(_events(spark, sf_dir))
    return messages.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _flat(gold: DataFrame) -> DataFrame:
    """Result columns: window bounds instead of the struct, without a zone."""
    return zoneless(flatten_window(gold))


def _exact(spark: SparkSession, sf_dir: str, spec: Rollup, window: str = ROLLUP_WINDOW,
           **options) -> DataFrame:
    return _flat(rollup(_flows(spark, sf_dir), spec, window, distinct="exact", **options))


def _detected(spark: SparkSession, sf_dir: str, rule: rules.Rule, window: str) -> DataFrame:
    found = screening.detect_in_flows(_flows(spark, sf_dir), rule, window)
    return zoneless(found.drop("detected_at"))


def _stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_lake(spark, sf_dir).alerts(ALERT_WINDOW).drop("detected_at")


# --- decode, quarantine, encode -------------------------------------------------


@register
def parse_flows(spark, sf_dir):
    return zoneless(codec.parse_flows(_messages(spark, sf_dir)))


@register
def malformed_quarantine(spark, sf_dir):
    return codec.quarantined(_messages(spark, sf_dir))


@register
def flows_to_json_roundtrip(spark, sf_dir):
    """Every flow's wire text, and the flow decoded from it."""
    flows = _flows(spark, sf_dir)
    sent = codec.encode(flows).select("value")
    return zoneless(codec.decode(sent).where(F.col("ts").isNotNull()))


@register
def alerts_to_messages(spark, sf_dir):
    """Alerts as messages for the alerts topic, keyed by entity."""
    return codec.alert_messages(event_lake(spark, sf_dir).alerts(ALERT_WINDOW).drop("detected_at"))


@register
def ingest_stats(spark, sf_dir):
    decoded = codec.decode(_messages(spark, sf_dir), "timestamp")
    return _flat(views.ingest_stats(decoded, ROLLUP_WINDOW))


# --- enrichment and layer scans -------------------------------------------------


@register
def enrich_flows(spark, sf_dir):
    return zoneless(enrich(_flows(spark, sf_dir)))


@register
def silver_view(spark, sf_dir):
    return zoneless(views.available(with_date(enrich(_flows(spark, sf_dir)))))


@register
def silver_daily_partitions(spark, sf_dir):
    return views.rows_per_date(event_lake(spark, sf_dir).silver())


@register
def latest_flows(spark, sf_dir):
    latest = ranking.newest_dated(event_lake(spark, sf_dir).silver(), 1000)
    return zoneless(latest.select(*FLOW.fieldNames()))


@register
def entity_flows(spark, sf_dir):
    """What one address sent and received in three days, from the clustered layer."""
    since, until = (F.lit(f"2024-01-{day} 06:00:00").cast("timestamp") for day in (10, 13))
    found = entity_history(event_lake(spark, sf_dir).clustered(), "172.16.1.20", since, until)
    return zoneless(found.select("role", *FLOW.fieldNames()))


@register
def gold_flattened(spark, sf_dir):
    return _flat(event_lake(spark, sf_dir).gold("top_destinations", ALERT_WINDOW))


@register
def router_listing(spark, sf_dir):
    return _flat(event_lake(spark, sf_dir).gold("router_summary", ALERT_WINDOW))


@register
def service_distribution(spark, sf_dir):
    return views.service_distribution(enrich(_flows(spark, sf_dir)))


@register
def layer_counts(spark, sf_dir):
    """Rows per layer, and whether the files counted are those that the storage lists."""
    lake = event_lake(spark, sf_dir)
    layers = {
        "bronze": lake.bronze(),
        "silver": lake.silver(),
        **{table: lake.gold(table, ALERT_WINDOW) for table in STANDARD_TABLES},
        "alerts": lake.alerts(ALERT_WINDOW),
    }
    paths = {"bronze": lake.cfg.bronze, "silver": lake.cfg.silver, **{
        table: lake.cfg.gold(f"{table}_{ALERT_WINDOW.replace(' ', '_')}")
        for table in (*STANDARD_TABLES, "alerts")}}
    listed = {layer: sum(name.endswith(".parquet") for name, _, _ in state_of(lake.spark, path))
              for layer, path in paths.items()}
    stored = F.create_map(*(F.lit(x) for pair in listed.items() for x in pair))
    return inventory(layers).select(
        "layer", "row_count", (F.col("files") > 0).alias("has_files"),
        (F.col("files") == stored[F.col("layer")]).alias("files_agree"))


# --- rollups --------------------------------------------------------------------


@register
def top_destinations(spark, sf_dir):
    return _exact(spark, sf_dir, DESTINATIONS)


@register
def top_talkers(spark, sf_dir):
    return _exact(spark, sf_dir, TALKERS)


@register
def router_summary(spark, sf_dir):
    return _exact(spark, sf_dir, ROUTERS)


@register
def salted_top_destinations(spark, sf_dir):
    return _exact(spark, sf_dir, DESTINATIONS, salts=16)


@register
def exact_unique_sources(spark, sf_dir):
    return _exact(spark, sf_dir, DESTINATIONS, PROFILE_WINDOW).select(
        "window_start", "window_end", "dst_ip", "unique_sources"
    )


def _within_bound(spark, sf_dir, spec: Rollup, **options) -> DataFrame:
    """The approximate rollup, its estimates replaced by whether they are close.

    Both sides come out of their aggregations partitioned by window and key. A
    missing address is a key like any other.
    """
    flows = _flows(spark, sf_dir)
    estimate = rollup(flows, spec, ROLLUP_WINDOW, **options)
    exact = rollup(flows, spec, ROLLUP_WINDOW, distinct="exact").select(
        F.col("window").alias("_window"), F.col(spec.key).alias("_key"),
        *(F.col(name).alias(f"exact_{name}") for name in spec.distinct)
    )
    close = F.lit(True)
    for name in spec.distinct:
        truth = F.col(f"exact_{name}")
        bound = F.greatest(F.lit(1), F.ceil(truth * F.lit(0.15)))
        close = close & (F.abs(F.col(name) - truth) <= bound)
    joined = estimate.join(
        exact, F.col("window").eqNullSafe(F.col("_window"))
        & F.col(spec.key).eqNullSafe(F.col("_key")))
    return _flat(
        joined.select("window", spec.key, *spec.measures, close.alias("within_bound"))
    )


@register
def top_destinations_approx(spark, sf_dir):
    return _within_bound(spark, sf_dir, DESTINATIONS)


@register
def top_talkers_approx(spark, sf_dir):
    return _within_bound(spark, sf_dir, TALKERS)


@register
def router_summary_approx(spark, sf_dir):
    return _within_bound(spark, sf_dir, ROUTERS)


@register
def top_destinations_sketch(spark, sf_dir):
    return _within_bound(spark, sf_dir, DESTINATIONS, distinct="sketch", salts=16)


@register
def destinations_multi_window(spark, sf_dir):
    return _flat(
        rollup_widths(_flows(spark, sf_dir), DESTINATIONS, ["10 minutes", "1 hour", "1 day"])
    )


@register
def router_top_ports(spark, sf_dir):
    return _flat(ranking.router_top_ports(_flows(spark, sf_dir), PROFILE_WINDOW, 5))


@register
def heavy_hitters(spark, sf_dir):
    return _flat(ranking.heavy_hitters(_flows(spark, sf_dir), "dst_ip", PROFILE_WINDOW, 10))


@register
def heavy_hitters_approx(spark, sf_dir):
    """Heavy hitters found through a sketch and counted exactly."""
    return _flat(ranking.heavy_hitters_approx(_flows(spark, sf_dir), "dst_ip", PROFILE_WINDOW, 10))


@register
def syn_ratio(spark, sf_dir):
    profile = _exact(spark, sf_dir, DESTINATION_PROFILE, PROFILE_WINDOW)
    return views.syn_ratio(profile).select(
        "window_start", "window_end", "dst_ip", "tcp_flows", "syn_flows", "syn_ratio"
    )


# --- gold that merges ------------------------------------------------------------

WATCHED = [FLOOD_TARGET, *(f"172.16.1.{host}" for host in (10, 20, 30))]


def _destination_panes(spark, sf_dir) -> DataFrame:
    return event_lake(spark, sf_dir).panes("destination_panes", ROLLUP_WINDOW)


def _close(estimate: str, truth: str, share: float = 0.15) -> Column:
    """Whether an estimate is within a share of the truth, or one off."""
    return F.abs(F.col(estimate) - F.col(truth)) <= F.greatest(
        F.lit(1), F.ceil(F.col(truth) * F.lit(share)))


@register
def gold_sketch_rollup(spark, sf_dir):
    """Days from hourly panes: sums, and sources by union of sketches, against the exact ones."""
    days = mergeable.estimates(
        mergeable.merged(_destination_panes(spark, sf_dir), mergeable.DESTINATION_PANES, "1 day"),
        mergeable.DESTINATION_PANES, sources="by_hll", source_set="by_theta")
    exact = event_lake(spark, sf_dir).gold("top_destinations", PROFILE_WINDOW).select(
        F.col("window").alias("_window"), F.col("dst_ip").alias("_key"), "unique_sources")
    both = days.join(exact, F.col("window").eqNullSafe(F.col("_window"))
                     & F.col("dst_ip").eqNullSafe(F.col("_key")))
    return _flat(both.select(
        "window", "dst_ip", "total_bytes", "total_packets", "flow_count",
        (_close("by_hll", "unique_sources") & _close("by_theta", "unique_sources")).alias(
            "within_bound")))


@register
def gold_total_rollup(spark, sf_dir):
    """The panes without their key: traffic and sources of all targets together, per day."""
    spec = mergeable.DESTINATION_PANES
    days = mergeable.estimates(
        mergeable.merged(_destination_panes(spark, sf_dir), spec, "1 day", keys=()),
        spec, sources="by_hll", source_set="by_theta")
    bits = event_lake(spark, sf_dir).source_bits(ROLLUP_WINDOW).withColumn("dst_ip", F.lit("all"))
    exact = mergeable.counted_bits(mergeable.merged_bits(bits, "dst_ip", "1 day"), "dst_ip",
                                   "unique_sources").select("window", "unique_sources")
    return _flat(days.join(exact, "window").select(
        "window", "total_bytes", "total_packets", "flow_count", "unique_sources",
        (_close("by_hll", "unique_sources") & _close("by_theta", "unique_sources")).alias(
            "within_bound")))


@register
def shared_sources(spark, sf_dir):
    """Sources that each two watched targets share per day, by intersecting sketches."""
    days = mergeable.merged(_destination_panes(spark, sf_dir), mergeable.DESTINATION_PANES, "1 day")
    shared = mergeable.shared_values(days, "source_set", "dst_ip", WATCHED)
    return _flat(shared.withColumn("shared", F.col("shared").cast("long")))


@register
def gold_top_ports(spark, sf_dir):
    """Most used ports per router and day, from hourly states."""
    days = mergeable.merged(event_lake(spark, sf_dir).panes("router_panes", ROLLUP_WINDOW),
                            mergeable.ROUTER_PANES, PROFILE_WINDOW)
    return _top_ports(days)


def _top_ports(days: DataFrame) -> DataFrame:
    top = mergeable.frequent(days, mergeable.ROUTER_PANES, "ports", 5)
    return _flat(top.select("window", "router_id", "dst_port",
                            F.col("item_count").alias("flow_count"), "rank"))


@register
def gold_heavy_hitters(spark, sf_dir):
    """Targets of most flows per day over all routers, and whether counts keep to their bound."""
    lake = event_lake(spark, sf_dir)
    days = mergeable.merged(lake.panes("router_panes", ROLLUP_WINDOW), mergeable.ROUTER_PANES,
                            PROFILE_WINDOW, keys=())
    top = mergeable.frequent(days, mergeable.ROUTER_PANES, "targets", 4)
    exact = lake.gold("top_destinations", PROFILE_WINDOW).select("window", "dst_ip", "flow_count")
    return _flat(top.join(exact, ["window", "dst_ip"]).select(
        "window", "dst_ip", "flow_count", "rank",
        (F.abs(F.col("item_count") - F.col("flow_count")) <= F.col("count_error")).alias(
            "within_bound")))


@register
def bitmap_unique_sources(spark, sf_dir):
    """Sources per target and day, exactly, from the bitmaps of hours."""
    bits = event_lake(spark, sf_dir).source_bits(ROLLUP_WINDOW)
    days = mergeable.merged_bits(bits, "dst_ip", PROFILE_WINDOW)
    return _flat(mergeable.counted_bits(days, "dst_ip", "unique_sources"))


@register
def sliding_destinations(spark, sf_dir):
    """Six hours, every hour, from hourly panes: sums, and sources by the panes' bitmaps."""
    spec = mergeable.DESTINATION_PANES
    sums = mergeable.merged(_destination_panes(spark, sf_dir), spec, "6 hours", "1 hour").drop(
        *spec.states)
    bits = event_lake(spark, sf_dir).source_bits(ROLLUP_WINDOW)
    sources = mergeable.counted_bits(
        mergeable.merged_bits(bits, "dst_ip", "6 hours", "1 hour"), "dst_ip", "unique_sources")
    sources = sources.withColumnsRenamed({"window": "_window", "dst_ip": "_key"})
    # Either side has a row per window and key; its size, guessed from the panes, is too low.
    return _flat(sums.join(sources.hint("merge"), F.col("window").eqNullSafe(F.col("_window"))
                           & F.col("dst_ip").eqNullSafe(F.col("_key"))).drop("_window", "_key"))


# --- rankings and flags over gold -----------------------------------------------


def _gold_slice(spark, sf_dir, table):
    return flatten_window(event_lake(spark, sf_dir).gold(table, PROFILE_WINDOW))


@register
def topk_destinations(spark, sf_dir):
    gold = _gold_slice(spark, sf_dir, "top_destinations")
    return zoneless(ranking.top_k(gold, "total_bytes", 20, "dst_ip", "window_start"))


@register
def topk_talkers(spark, sf_dir):
    gold = _gold_slice(spark, sf_dir, "top_talkers")
    return zoneless(ranking.top_k(gold, "total_bytes", 20, "src_ip", "window_start"))


@register
def topk_per_window(spark, sf_dir):
    gold = _gold_slice(spark, sf_dir, "top_destinations")
    return zoneless(
        ranking.top_k_per(gold, ["window_start", "window_end"], "total_bytes", 5, "dst_ip")
    )


@register
def flag_suspect_destinations(spark, sf_dir):
    gold = event_lake(spark, sf_dir).gold("top_destinations", ALERT_WINDOW)
    return _flat(views.flag_destinations(gold))


@register
def flag_suspect_talkers(spark, sf_dir):
    gold = event_lake(spark, sf_dir).gold("top_talkers", ALERT_WINDOW)
    return _flat(views.flag_talkers(gold))


# --- detection ------------------------------------------------------------------


@register
def fan_in_alerts(spark, sf_dir):
    return _detected(spark, sf_dir, rules.FAN_IN, ALERT_WINDOW)


@register
def fan_out_alerts(spark, sf_dir):
    return _detected(spark, sf_dir, rules.FAN_OUT, PROFILE_WINDOW)


@register
def syn_burst_alerts(spark, sf_dir):
    return _detected(spark, sf_dir, rules.SYN_BURST, PROFILE_WINDOW)


@register
def alerts(spark, sf_dir):
    """The flagship: all standard rules, straight from the flows."""
    flows = _flows(spark, sf_dir)
    found = screening.detect_all_in_flows(flows, rules.STANDARD_RULES, ALERT_WINDOW)
    return zoneless(found.drop("detected_at"))


def _judged(spark, sf_dir):
    profile = event_lake(spark, sf_dir).gold("destination_profile", PROFILE_WINDOW)
    return baseline.judge(profile, SENSITIVE_FAN_IN, window_seconds=86_400)


@register
def baseline_verdicts(spark, sf_dir):
    return zoneless(_judged(spark, sf_dir).drop("detected_at"))


@register
def baseline_suppressed_alerts(spark, sf_dir):
    return zoneless(baseline.suppress(_judged(spark, sf_dir)).drop("detected_at"))


# --- alert views ----------------------------------------------------------------


@register
def alert_severity_labels(spark, sf_dir):
    return zoneless(alert_views.labelled(_stored_alerts(spark, sf_dir)))


def _recent(spark, sf_dir):
    stored = _stored_alerts(spark, sf_dir)
    clock = alert_views.latest(stored, "window_end")
    return alert_views.recent(stored, "15 DAYS", "window_end", clock)


@register
def recent_alerts(spark, sf_dir):
    return zoneless(_recent(spark, sf_dir))


@register
def attack_status(spark, sf_dir):
    return zoneless(alert_views.status(_recent(spark, sf_dir), "window_end"))


@register
def alert_feed(spark, sf_dir):
    return zoneless(alert_views.feed(_stored_alerts(spark, sf_dir)))


@register
def alert_type_counts(spark, sf_dir):
    return alert_views.counts_by_type(_stored_alerts(spark, sf_dir))


@register
def alert_severity_mean(spark, sf_dir):
    return alert_views.mean_severity(_stored_alerts(spark, sf_dir))


@register
def most_targeted(spark, sf_dir):
    return alert_views.most_targeted(_stored_alerts(spark, sf_dir))


@register
def deduped_alerts(spark, sf_dir):
    return zoneless(alert_views.first_per_entity(_stored_alerts(spark, sf_dir)))


def _outage(alerts: DataFrame) -> DataFrame:
    """Alerts with gaps and repeats: none of every fifth day, those of even days sent twice."""
    day = F.dayofmonth("window_start")
    heard = alerts.where(day % 5 != 0)
    return heard.unionByName(heard.where(day % 2 == 0))


@register
def alert_incidents(spark, sf_dir):
    """Alerts of days that follow each other as one incident, and whether it is still open."""
    profile = event_lake(spark, sf_dir).gold("destination_profile", PROFILE_WINDOW)
    sent = _outage(rules.detect(profile, SENSITIVE_FAN_IN))
    found = alert_views.incidents(sent, INCIDENT_GAP)
    return zoneless(alert_views.with_state(
        found, alert_views.latest(sent, "window_end"), INCIDENT_GAP))


# --- streams --------------------------------------------------------------------


def _flow_stream(spark, sf_dir, cfg: LakeConfig):
    """The flows as a stream, and one late-coming row that closes all windows."""
    batch = _events(spark, sf_dir)
    closing = f"{cfg.checkpoint_root}/closing"
    flows_of_events(batch.agg(
        F.lit(0).cast("bigint").alias("event_id"),
        (F.max("ts") + F.expr("INTERVAL 1 YEAR")).alias("ts"),
        F.lit(0).cast("bigint").alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(0.0).alias("value"),
        F.lit('{"k": 0}').alias("props"),
    )).write.parquet(closing)

    def open_flows(session):
        events = session.readStream.schema(batch.schema).parquet(_exactly(_events_path(sf_dir)))
        flows = flows_of_events(events)
        last = session.readStream.schema(flows.schema).parquet(closing)
        both = flows.unionByName(last)
        return both.withColumn("ts", F.col("ts").cast("timestamp"))

    return open_flows


def _medallion(spark, sf_dir, window, rules_=rules.STANDARD_RULES, tables=()) -> Medallion:
    spark = pinned(spark)
    cfg = LakeConfig.under(shared_folder(spark, "streams"), window=window, distinct="exact")
    return Medallion(
        spark, cfg, open_flows=_flow_stream(spark, sf_dir, cfg), rules=rules_, tables=tables
    )


@register
def streaming_top_destinations(spark, sf_dir):
    """Bronze, silver and a gold table by chained streams; read back from the lake."""
    lake = _medallion(spark, sf_dir, ROLLUP_WINDOW, (), ("top_destinations",))
    lake.run_available()
    path = lake.cfg.gold("top_destinations")
    return _flat(read_layer(pinned(spark), path, GOLD["top_destinations"]))


@register
def streaming_alerts(spark, sf_dir):
    """The whole chain of streams down to the alerts table."""
    lake = _medallion(spark, sf_dir, ALERT_WINDOW)
    lake.run_available()
    return zoneless(read_layer(pinned(spark), lake.cfg.alerts, ALERT)).drop("detected_at")


@register
def streaming_deduped_alerts(spark, sf_dir):
    """A stream of alerts, each sent twice, without repeats of a window, type and entity."""
    lake = _medallion(spark, sf_dir, ALERT_WINDOW)
    lake.run_available()
    cfg = lake.cfg
    sent = lake.follow(cfg.alerts, ALERT)
    once = alert_views.distinct_windows_in_stream(sent.unionByName(sent))
    append_files(
        once, cfg.gold("notified"), cfg.checkpoint("notified"), trigger=None
    ).awaitTermination()
    return zoneless(read_layer(pinned(spark), cfg.gold("notified"), ALERT)).drop("detected_at")


@register
def streaming_incidents(spark, sf_dir):
    """Incidents closed by a stream that takes one file of alerts after the other.

    Files hold alerts in any order, so the watermark keeps incidents open for two months. The
    stream is started again when an alert of a year later is there, which closes them all.
    """
    lake = _medallion(spark, sf_dir, PROFILE_WINDOW, (SENSITIVE_FAN_IN,), ("destination_profile",))
    lake.run_available()
    cfg = lake.cfg
    end = f"{cfg.checkpoint_root}/end"
    stored = read_layer(lake.session, cfg.alerts, ALERT)
    later = stored.agg(F.max("window_start") + F.expr("INTERVAL 1 YEAR")).scalar()
    last = stored.limit(1).withColumns({"window_start": later, "alert_type": F.lit("END")})
    for arrived in (last.limit(0), last):
        arrived.write.mode("append").parquet(end)
        sent = _outage(follow_layer(lake.session, cfg.alerts, dated(ALERT), 8).drop("date"))
        sent = sent.unionByName(follow_layer(lake.session, end, ALERT))
        closed = alert_views.incidents(sent, INCIDENT_GAP, "60 days")
        append_files(closed, cfg.gold("incidents"), cfg.checkpoint("incidents"),
                     trigger=None).awaitTermination()
    return zoneless(read_layer(pinned(spark), cfg.gold("incidents"), closed.schema))


@register
def streaming_suppressed_alerts(spark, sf_dir):
    """Baseline suppression in a stream over the stored destination profile."""
    lake = _medallion(spark, sf_dir, PROFILE_WINDOW, (), ("destination_profile",))
    lake.run_available()
    path = lake.cfg.gold("suppressed")
    start_suppression(lake.session, lake.cfg, SENSITIVE_FAN_IN, 86_400, path).awaitTermination()
    return zoneless(read_suppressed(pinned(spark), path)).drop("detected_at")


@register
def streaming_decayed_verdicts(spark, sf_dir):
    """Alerts of a stream, held against decayed sums that it keeps as state."""
    lake = _medallion(spark, sf_dir, PROFILE_WINDOW, (), ("destination_profile",))
    lake.run_available()
    start_decayed(lake.session, lake.cfg, SENSITIVE_FAN_IN, 86_400).awaitTermination()
    judged = read_layer(pinned(spark), lake.cfg.judged, DECAYED)
    return zoneless(judged).drop("detected_at")


@register
def streaming_compacted(spark, sf_dir):
    """Flows per date of a layer that a stream filled in many batches and that was compacted.

    The second half of the flows comes after a compaction and reaches back into its dates.
    """
    events = _events(spark, sf_dir)
    cfg = LakeConfig.under(shared_folder(spark, "streams"))
    inbox, closed = f"{cfg.checkpoint_root}/inbox", "2024-01-25"

    def open_flows(session):
        rows = session.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
        return flows_of_events(rows.parquet(inbox)).withColumn("ts", F.col("ts").cast("timestamp"))

    session, schema = pinned(spark), dated(FLOW)
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).repartition(2, "event_id").write.mode(
            "append").parquet(inbox)
        Medallion(session, cfg, open_flows=open_flows, rules=(), tables=()).run_available("bronze")
        compact(session, cfg.bronze, schema, closed)
    drop_superseded(session, cfg.bronze)
    counted = read_compacted(session, cfg.bronze, schema).groupBy("date").agg(
        F.count("*").alias("flow_count"))
    return counted.join(files_per_date(session, cfg.bronze, schema), "date").select(
        "date", "flow_count", (F.col("files") <= 2).alias("is_compact"))


@register
def streaming_quarantine(spark, sf_dir):
    """The texts a message stream sets aside because they cannot be decoded."""
    spark = pinned(spark)
    cfg = LakeConfig.under(shared_folder(spark, "streams"))
    schema = _events(spark, sf_dir).schema

    def open_messages(session):
        events = session.readStream.schema(schema).parquet(_exactly(_events_path(sf_dir)))
        return messages_of_events(events)

    lake = Medallion(spark, cfg, open_messages=open_messages, rules=(), tables=())
    lake.run_available("quarantine")
    return read_layer(spark, cfg.quarantine, QUARANTINE)


@register
def streaming_health(spark, sf_dir):
    """Rows of the layers that the streams stored, and how far each is behind the first."""
    lake = _medallion(spark, sf_dir, ALERT_WINDOW, tables=STANDARD_TABLES)
    lake.run_available()
    session, cfg = pinned(spark), lake.cfg
    return zoneless(layer_health({
        "bronze": (read_layer(session, cfg.bronze, FLOW), F.col("ts")),
        "silver": (read_layer(session, cfg.silver, SILVER), F.col("ts")),
        **{table: (read_layer(session, cfg.gold(table), GOLD[table]), F.col("window.end"))
           for table in ("top_destinations", "top_talkers", "router_summary")},
        "alerts": (read_layer(session, cfg.alerts, ALERT), F.col("window_end")),
    }))


@register
def streaming_metrics(spark, sf_dir):
    """What each stream of the chain read and wrote, from the stored reports of its batches.

    The rules' filter reaches the scan of gold, so the rows it reads are left out.
    """
    lake = _medallion(spark, sf_dir, ALERT_WINDOW, tables=STANDARD_TABLES)
    with metrics.BatchLog(lake.session, lake.cfg.batches) as log:
        log.settle(lake.run_available())
    streams = metrics.throughput(metrics.batches(pinned(spark), lake.cfg.batches))
    return zoneless(streams.select(
        "stream", F.when(F.col("stream") != "gold_alerts", F.col("input_rows")).alias("input_rows"),
        "written_rows", "first_time", "last_time", "late_groups",
        ((F.col("busy_seconds") > 0) & (F.col("rows_per_second") > 0)
         & (F.col("median_ms") <= F.col("p99_ms"))).alias("is_timed")))


@register
def streaming_alert_latency(spark, sf_dir):
    """Alerts per type and whether the stored sketches' quantiles of latency are near enough."""
    lake = _medallion(spark, sf_dir, PROFILE_WINDOW, (SENSITIVE_FAN_IN,), ("destination_profile",))
    lake.run_available()
    session, cfg = pinned(spark), lake.cfg
    metrics.start_latency(lake.session, replace(cfg, max_files=8)).awaitTermination()
    sketched = metrics.latency_quantiles(session, cfg)
    seconds = (F.unix_micros("detected_at") - F.unix_micros("window_end")) / F.lit(1e6)
    alerts = read_layer(session, cfg.alerts, ALERT).select("alert_type", seconds.alias("seconds"))

    def near(quantile: float, column: str) -> Column:
        # As many alerts lie below and up to the estimate as the sketch's rank error allows.
        below = F.count_if(F.col("seconds") < F.col(column))
        up_to = F.count_if(F.col("seconds") <= F.col(column))
        slack = F.count("*") * F.lit(0.02) + F.lit(1)
        target = F.count("*") * F.lit(quantile)
        return (below <= target + slack) & (up_to >= target - slack)

    return alerts.join(F.broadcast(sketched), "alert_type").groupBy("alert_type", "alerts").agg(
        near(0.5, "p50_seconds").alias("p50_within"), near(0.99, "p99_seconds").alias("p99_within"))


@register
def streaming_late_corrected(spark, sf_dir):
    """Gold of a stream to which every twentieth flow came too late, with its corrections."""
    events = _events(spark, sf_dir)
    cfg = LakeConfig.under(shared_folder(spark, "streams"), window=ROLLUP_WINDOW, distinct="exact")
    inbox = f"{cfg.checkpoint_root}/inbox"
    is_late = F.col("event_id") % 20 == 0
    closing = events.agg(
        *(F.max(c).alias(c) if c != "ts" else (F.max(c) + F.expr("INTERVAL 1 YEAR")).alias(c)
          for c in events.columns))

    def open_flows(session):
        flows = flows_of_events(session.readStream.schema(events.schema).parquet(inbox))
        return flows.withColumn("ts", F.col("ts").cast("timestamp"))

    for part in (events.where(~is_late).unionByName(closing), events.where(is_late)):
        part.write.mode("append").parquet(inbox)
        lake = Medallion(pinned(spark), cfg, open_flows=open_flows, rules=(),
                         tables=("top_destinations",))
        lake.run_available()
        start_corrections(lake).awaitTermination()
    return _flat(read_corrected(pinned(spark), cfg, "top_destinations"))


@register
def streaming_top_ports(spark, sf_dir):
    """Most used ports per router and day, from hourly states that a stream stored."""
    lake = _medallion(spark, sf_dir, ROLLUP_WINDOW, (), ("router_panes",))
    lake.run_available()
    stored = read_layer(pinned(spark), lake.cfg.gold("router_panes"),
                        mergeable.ROUTER_PANES.schema())
    return _top_ports(mergeable.merged(stored, mergeable.ROUTER_PANES, PROFILE_WINDOW))


@register
def streaming_bitmap_sources(spark, sf_dir):
    """Sources per target and day, exactly, from the hourly bitmaps that a stream stored."""
    lake = _medallion(spark, sf_dir, ROLLUP_WINDOW, (), ("source_bits",))
    lake.run_available()
    stored = read_layer(pinned(spark), lake.cfg.gold("source_bits"), SOURCE_BITS)
    days = mergeable.merged_bits(stored, "dst_ip", PROFILE_WINDOW)
    return _flat(mergeable.counted_bits(days, "dst_ip", "unique_sources"))
