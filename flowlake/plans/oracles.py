"""The registered queries as SQL over the same tables, for cross-checking."""

from __future__ import annotations

FLOWS = """
k AS (
  SELECT event_id AS e, user_id AS u, ts, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events
),
flows_e AS (
  SELECT e, event_type, ts,
    'router-' || CAST(e % 3 + 1 AS VARCHAR) AS router_id,
    CASE
      WHEN event_type = 'error' THEN '10.0.'
        || CAST(CAST(floor((e * 7919 % 1000) / 256) AS INTEGER) AS VARCHAR) || '.'
        || CAST((e * 7919 % 1000) % 256 AS VARCHAR)
      WHEN event_type = 'signup' THEN '10.0.0.99'
      WHEN e % 10 < 7 THEN '10.' || CAST(e * 31 % 256 AS VARCHAR) || '.'
        || CAST(u % 256 AS VARCHAR) || '.' || CAST(e % 254 + 1 AS VARCHAR)
      WHEN e % 10 < 9 THEN '192.168.' || CAST(u % 256 AS VARCHAR) || '.'
        || CAST(e % 254 + 1 AS VARCHAR)
      ELSE '8.8.' || CAST(u % 256 AS VARCHAR) || '.' || CAST(e % 254 + 1 AS VARCHAR)
    END AS src_ip,
    CASE
      WHEN event_type = 'error' THEN '172.16.4.100'
      WHEN event_type = 'purchase' THEN '172.16.1.' || CAST((e % 3 + 1) * 10 AS VARCHAR)
      ELSE '10.' || CAST(e * 17 % 256 AS VARCHAR) || '.' || CAST(e * 13 % 256 AS VARCHAR)
        || '.' || CAST(e % 254 + 1 AS VARCHAR)
    END AS dst_ip,
    CAST(1024 + e * 7919 % 64511 AS INTEGER) AS src_port,
    CAST(CASE event_type
      WHEN 'error' THEN 80 WHEN 'signup' THEN 20 + k WHEN 'purchase' THEN 443
      ELSE CASE k % 10 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 22 WHEN 3 THEN 53
        WHEN 4 THEN 21 WHEN 5 THEN 25 WHEN 6 THEN 3306 WHEN 7 THEN 5432
        WHEN 8 THEN 6379 ELSE 8080 END
    END AS INTEGER) AS dst_port,
    CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 'TCP'
      WHEN e % 3 = 0 THEN 'TCP' WHEN e % 3 = 1 THEN 'UDP' ELSE 'ICMP' END AS proto,
    CASE event_type
      WHEN 'error' THEN 10000 + CAST(floor(value * 100) AS BIGINT)
      WHEN 'signup' THEN 40 + CAST(floor(value) AS BIGINT)
      ELSE 100 + CAST(floor(value * 20) AS BIGINT)
    END AS bytes,
    CAST(CASE event_type
      WHEN 'error' THEN 50 + k WHEN 'signup' THEN 1 WHEN 'purchase' THEN 5 + k % 20
      ELSE 1 + k % 50 END AS INTEGER) AS packets,
    CASE WHEN event_type IN ('error', 'signup') THEN 'SYN'
      WHEN event_type = 'purchase' THEN 'ACK'
      WHEN e % 3 <> 0 THEN ''
      ELSE CASE e % 5 WHEN 0 THEN 'SYN' WHEN 1 THEN 'SYN-ACK' WHEN 2 THEN 'ACK'
        WHEN 3 THEN 'FIN' ELSE 'RST' END
    END AS tcp_flags,
    1 AS sampling_rate
  FROM k
),
flows AS (SELECT * EXCLUDE (e, event_type) FROM flows_e)"""

FLOW_COLUMNS = (
    "ts, router_id, src_ip, dst_ip, src_port, dst_port, proto, bytes, packets, "
    "tcp_flags, sampling_rate"
)

WIRE_TEXT = """
    '{"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","router_id":"' || router_id
    || '","src_ip":"' || src_ip || '","dst_ip":"' || dst_ip
    || '","src_port":' || CAST(src_port AS VARCHAR) || ',"dst_port":' || CAST(dst_port AS VARCHAR)
    || ',"proto":"' || proto || '","bytes":' || CAST(bytes AS VARCHAR)
    || ',"packets":' || CAST(packets AS VARCHAR) || ',"tcp_flags":"' || tcp_flags
    || '","sampling_rate":1}'"""

SECOND_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"

DAMAGED_TEXT = f"""
    CASE e % 5 WHEN 0 THEN 'not json ' || CAST(e AS VARCHAR)
      WHEN 1 THEN '{{"ts":"bad","router_id":"router-' || CAST(e AS VARCHAR) || '"}}'
      WHEN 2 THEN '[{{"ts":"' || {SECOND_TEXT} || 'Z","router_id":"router-' || CAST(e AS VARCHAR) || '"}}]'
      WHEN 3 THEN '' END"""

ODD_TEXT = f"""
    CASE e % 5
      WHEN 0 THEN '{{"ts":"' || {SECOND_TEXT} || 'Z","router_id":"r' || CAST(e AS VARCHAR) || '","bytes":"abc"}}'
      WHEN 1 THEN '{{"ts":"' || {SECOND_TEXT} || 'Z","router_id":"r' || CAST(e AS VARCHAR) || '","dst_port":99999999999}}'
      WHEN 2 THEN '{{"ts":"' || {SECOND_TEXT} || 'Z","router_id":"r' || CAST(e AS VARCHAR) || '","bytes":5,"extra":1}}'
      WHEN 3 THEN '{{"ts":"' || {SECOND_TEXT} || '.123456789+02:00","router_id":"r' || CAST(e AS VARCHAR) || '"}}'
      ELSE '{{"ts":' || CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) || ',"router_id":"r' || CAST(e AS VARCHAR) || '"}}'
    END"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([FLOWS.strip(), *ctes]) + "\n" + body


def _bucket(width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', ts, TIMESTAMP '1970-01-01')"


def _rollup(key: str, width: str, extra: str, traffic: bool = True, source: str = "flows") -> str:
    sums = (
        "CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(sum(packets) AS BIGINT) AS total_packets, "
        "count(*) AS flow_count, " if traffic else ""
    )
    return (
        f"SELECT {_bucket(width)} AS window_start, {_bucket(width)} + INTERVAL '{width}' AS window_end, "
        f"{key}, {sums}{extra} FROM {source} GROUP BY 1, 2, {key}"
    )


SOURCES = "count(DISTINCT src_ip) AS unique_sources"
TARGETS = "count(DISTINCT dst_ip) AS unique_destinations"
PORTS = "count(DISTINCT dst_port) AS distinct_ports"
SYN = (
    "count(*) FILTER (WHERE proto = 'TCP') AS tcp_flows, "
    "count(*) FILTER (WHERE proto = 'TCP' AND tcp_flags = 'SYN') AS syn_flows"
)
RATIO = "CASE WHEN tcp_flows > 0 THEN CAST(syn_flows AS DOUBLE) / tcp_flows END"


def _fan_in(width: str) -> str:
    return f"""
  SELECT window_start, window_end, 'FAN_IN_DDOS' AS alert_type, dst_ip AS entity,
    CAST(CASE WHEN unique_sources > 500 THEN 1.0 WHEN unique_sources > 200 THEN 0.7 ELSE 0.4 END AS DOUBLE)
      AS severity_score,
    unique_sources, total_packets, total_bytes
  FROM ({_rollup("dst_ip", width, SOURCES)})
  WHERE unique_sources > 100 AND (total_packets > 10000 OR total_bytes > 10000000)"""


def _fan_out(width: str) -> str:
    return f"""
  SELECT window_start, window_end, 'FAN_OUT_SCAN' AS alert_type, src_ip AS entity,
    CAST(CASE WHEN unique_destinations > 200 THEN 1.0 WHEN unique_destinations > 100 THEN 0.7 ELSE 0.4 END
      AS DOUBLE) AS severity_score,
    unique_destinations AS unique_sources, total_packets, total_bytes
  FROM ({_rollup("src_ip", width, f"{TARGETS}, {PORTS}")})
  WHERE unique_destinations > 50 AND distinct_ports > 20"""


ALERTS = f"alerts AS ({_fan_in('10 days')} UNION ALL {_fan_out('10 days')})"
# The bands of the severity labels.
LABEL = (
    "CASE WHEN severity_score >= 0.8 THEN 'CRITICAL' WHEN severity_score >= 0.6 THEN 'HIGH' "
    "ELSE 'MEDIUM' END"
)
RECENT = (
    "recent AS (SELECT * FROM alerts WHERE window_end > "
    "(SELECT max(window_end) FROM alerts) - INTERVAL 15 DAYS)"
)

# Private address ranges, names of well-known ports. The limits and
# scores of the rules above and below are those of ``operators/rules.py``.
PRIVATE = "regexp_matches({0}, '^(10[.]|192[.]168[.]|172[.](1[6-9]|2[0-9]|3[01])[.])')"
SUBNET = "regexp_extract({0}, '^([0-9]+[.][0-9]+[.][0-9]+)[.][0-9]+$', 1)"
SERVICE = (
    "CASE dst_port WHEN 80 THEN 'HTTP' WHEN 443 THEN 'HTTPS' WHEN 22 THEN 'SSH' WHEN 53 THEN 'DNS' "
    "WHEN 21 THEN 'FTP' WHEN 25 THEN 'SMTP' WHEN 3306 THEN 'MySQL' WHEN 5432 THEN 'PostgreSQL' "
    "WHEN 6379 THEN 'Redis' WHEN 8080 THEN 'HTTP-ALT' ELSE 'OTHER' END"
)
ENRICHED = (
    f"enriched AS (SELECT *, {SUBNET.format('src_ip')} AS src_subnet_24, "
    f"{SUBNET.format('dst_ip')} AS dst_subnet_24, {PRIVATE.format('src_ip')} AS is_private_src, "
    f"{PRIVATE.format('dst_ip')} AS is_private_dst, {SERVICE} AS dst_service FROM flows)"
)

MESSAGES = f"""messages AS (
  SELECT ts, {WIRE_TEXT} AS raw, FALSE AS bad FROM flows_e
  UNION ALL SELECT ts, {DAMAGED_TEXT}, TRUE FROM flows_e WHERE event_type = 'error'
  UNION ALL SELECT ts, {ODD_TEXT}, FALSE FROM flows_e WHERE event_type = 'purchase'
)"""

JUDGED = f"""trails AS (
  SELECT *, {RATIO} AS syn_ratio,
    count(*) OVER trail AS history_windows,
    CAST(coalesce(sum(unique_sources) OVER trail, 0) AS BIGINT) AS history_sum
  FROM ({_rollup("dst_ip", "1 day", f"{SYN}, {SOURCES}")})
  WINDOW trail AS (PARTITION BY dst_ip ORDER BY window_start
    RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 SECOND PRECEDING)
),
judged AS (
  SELECT window_start, window_end, 'FAN_IN_DDOS' AS alert_type, dst_ip AS entity,
    CAST(CASE WHEN unique_sources > 500 THEN 1.0 WHEN unique_sources > 200 THEN 0.7 ELSE 0.4 END AS DOUBLE)
      AS severity_score,
    unique_sources, total_packets, total_bytes, syn_ratio, history_windows, history_sum,
    history_windows >= 3 AND unique_sources * history_windows <= 2 * history_sum
      AND coalesce(syn_ratio <= 0.8, TRUE) AS suppressed
  FROM trails WHERE unique_sources > 5 AND total_packets > 50
)"""


def _top_per(inner: str, groups: str, measure: str, ties: str, k: int) -> str:
    return f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY {groups} ORDER BY {measure} DESC, {ties}) AS INTEGER) AS rank
  FROM ({inner})) WHERE rank <= {k}"""


def _bounded(key: str) -> str:
    return _with(_rollup(key, "1 hour", "TRUE AS within_bound"))


_DESTINATIONS_HOURLY = _rollup("dst_ip", "1 hour", SOURCES)
_LAYERS = {
    "bronze": "flows",
    "silver": "flows",
    "top_destinations": f"({_rollup('dst_ip', '10 days', SOURCES)})",
    "top_talkers": f"({_rollup('src_ip', '10 days', TARGETS)})",
    "router_summary": f"({_rollup('router_id', '10 days', SOURCES)})",
    "alerts": "alerts",
}

ORACLES: dict[str, str] = {
    "parse_flows": _with(f"""
SELECT {FLOW_COLUMNS} FROM flows
UNION ALL
SELECT CASE e % 5 WHEN 3 THEN date_trunc('second', ts) + INTERVAL 123456 MICROSECONDS - INTERVAL 2 HOURS
         ELSE date_trunc('second', ts) END,
  'r' || CAST(e AS VARCHAR), NULL, NULL, NULL, NULL, NULL,
  CASE WHEN e % 5 = 2 THEN 5 END, NULL, NULL, NULL
FROM flows_e WHERE event_type = 'purchase'"""),
    "malformed_quarantine": _with("SELECT raw FROM messages WHERE bad", MESSAGES),
    "flows_to_json_roundtrip": _with(f"SELECT {WIRE_TEXT} AS raw, {FLOW_COLUMNS} FROM flows"),
    "alerts_to_messages": _with("""
SELECT entity AS key,
  '{"window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S.%f')
  || 'Z","window_end":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%S.%f')
  || 'Z","alert_type":"' || alert_type || '","entity":"' || entity
  || '","severity_score":' || CAST(severity_score AS VARCHAR)
  || ',"unique_sources":' || CAST(unique_sources AS VARCHAR)
  || ',"total_packets":' || CAST(total_packets AS VARCHAR)
  || ',"total_bytes":' || CAST(total_bytes AS VARCHAR) || '}' AS value
FROM alerts""", ALERTS),
    "ingest_stats": _with(f"""
SELECT {_bucket("1 hour")} AS window_start, {_bucket("1 hour")} + INTERVAL '1 hour' AS window_end,
  count(*) AS messages, CAST(coalesce(sum(strlen(raw)), 0) AS BIGINT) AS payload_bytes,
  count(*) FILTER (WHERE bad) AS malformed, count(*) / CAST(3600 AS DOUBLE) AS messages_per_second
FROM messages GROUP BY 1, 2""", MESSAGES),
    "enrich_flows": _with("SELECT * FROM enriched", ENRICHED),
    "silver_view": _with(
        "SELECT ts, src_ip, dst_ip, src_subnet_24, dst_subnet_24, is_private_src, is_private_dst, "
        "dst_port, dst_service, proto, bytes, packets FROM enriched", ENRICHED),
    "silver_daily_partitions": _with(
        "SELECT CAST(ts AS DATE) AS date, count(*) AS flow_count FROM flows GROUP BY 1"),
    "latest_flows": _with(
        f"SELECT {FLOW_COLUMNS} FROM flows ORDER BY ts DESC, {FLOW_COLUMNS[4:]} LIMIT 1000"),
    "gold_flattened": _with(_rollup("dst_ip", "10 days", SOURCES)),
    "router_listing": _with(_rollup("router_id", "10 days", f"{SOURCES}, {TARGETS}")),
    "service_distribution": _with(
        "SELECT dst_service, count(*) AS flow_count FROM enriched GROUP BY 1 "
        "ORDER BY flow_count DESC, dst_service LIMIT 10", ENRICHED),
    "layer_counts": _with(
        "\nUNION ALL ".join(
            f"SELECT '{layer}' AS layer, count(*) AS row_count, TRUE AS has_files, "
            f"TRUE AS files_agree FROM {table}"
            for layer, table in _LAYERS.items()), ALERTS),
    "top_destinations": _with(_DESTINATIONS_HOURLY),
    "top_talkers": _with(_rollup("src_ip", "1 hour", f"{TARGETS}, {PORTS}")),
    "router_summary": _with(_rollup("router_id", "1 hour", f"{SOURCES}, {TARGETS}")),
    "salted_top_destinations": _with(_DESTINATIONS_HOURLY),
    "streaming_top_destinations": _with(_DESTINATIONS_HOURLY),
    "exact_unique_sources": _with(_rollup("dst_ip", "1 day", SOURCES, traffic=False)),
    "top_destinations_approx": _bounded("dst_ip"),
    "top_destinations_sketch": _bounded("dst_ip"),
    "top_talkers_approx": _bounded("src_ip"),
    "router_summary_approx": _bounded("router_id"),
    "destinations_multi_window": _with("\nUNION ALL ".join(
        f"SELECT '{width}' AS width, * FROM ({_rollup('dst_ip', width, SOURCES)})"
        for width in ("10 minutes", "1 hour", "1 day"))),
    "router_top_ports": _with(_top_per(
        _rollup("router_id, dst_port", "1 day", "count(*) AS flow_count", traffic=False),
        "window_start, router_id", "flow_count", "dst_port", 5)),
    "heavy_hitters": _with(_top_per(
        _rollup("dst_ip", "1 day", "count(*) AS flow_count", traffic=False),
        "window_start", "flow_count", "dst_ip", 10)),
    "syn_ratio": _with(
        f"SELECT *, {RATIO} AS syn_ratio FROM ({_rollup('dst_ip', '1 day', SYN, traffic=False)})"),
    "topk_destinations": _with(
        f"SELECT * FROM ({_rollup('dst_ip', '1 day', SOURCES)}) "
        "ORDER BY total_bytes DESC, dst_ip, window_start LIMIT 20"),
    "topk_talkers": _with(
        f"SELECT * FROM ({_rollup('src_ip', '1 day', f'{TARGETS}, {PORTS}')}) "
        "ORDER BY total_bytes DESC, src_ip, window_start LIMIT 20"),
    "topk_per_window": _with(_top_per(
        _rollup("dst_ip", "1 day", SOURCES), "window_start", "total_bytes", "dst_ip", 5)),
    "flag_suspect_destinations": _with(
        f"SELECT *, unique_sources > 100 AS is_suspect FROM ({_rollup('dst_ip', '10 days', SOURCES)})"),
    "flag_suspect_talkers": _with(
        "SELECT *, unique_destinations > 50 AS is_suspect "
        f"FROM ({_rollup('src_ip', '10 days', f'{TARGETS}, {PORTS}')})"),
    "fan_in_alerts": _with(_fan_in("10 days")),
    "fan_out_alerts": _with(_fan_out("1 day")),
    "syn_burst_alerts": _with(f"""
SELECT window_start, window_end, 'SYN_BURST' AS alert_type, dst_ip AS entity,
  CAST(CASE WHEN {RATIO} > 0.95 THEN 1.0 WHEN {RATIO} > 0.9 THEN 0.7 ELSE 0.4 END AS DOUBLE)
    AS severity_score,
  unique_sources, total_packets, total_bytes
FROM ({_rollup("dst_ip", "1 day", f"{SYN}, {SOURCES}")})
WHERE {RATIO} > 0.8 AND tcp_flows > 49"""),
    "alerts": _with("SELECT * FROM alerts", ALERTS),
    "streaming_alerts": _with("SELECT * FROM alerts", ALERTS),
    "baseline_verdicts": _with("SELECT * FROM judged", JUDGED),
    "baseline_suppressed_alerts": _with(
        "SELECT * EXCLUDE (syn_ratio, history_windows, history_sum, suppressed) "
        "FROM judged WHERE NOT suppressed", JUDGED),
    "alert_severity_labels": _with(f"SELECT *, {LABEL} AS severity_label FROM alerts", ALERTS),
    "recent_alerts": _with("SELECT * FROM recent", ALERTS, RECENT),
    "attack_status": _with(f"""
SELECT CASE WHEN n > 0 THEN 'ATTACK' ELSE 'NORMAL' END AS status, n AS recent_alerts,
  alert_type, entity, severity_score, window_end,
  CASE WHEN alert_type IS NOT NULL THEN {LABEL} END AS severity_label
FROM (SELECT count(*) AS n FROM recent) LEFT JOIN (
  SELECT * FROM recent
  ORDER BY window_end DESC, severity_score DESC, alert_type DESC, entity DESC LIMIT 1) ON TRUE""",
        ALERTS, RECENT),
    "alert_feed": _with(
        "SELECT * FROM alerts ORDER BY severity_score DESC, window_end DESC, alert_type, entity",
        ALERTS),
    "alert_type_counts": _with(
        "SELECT alert_type, count(*) AS alerts FROM alerts GROUP BY 1", ALERTS),
    "alert_severity_mean": _with(
        "SELECT round(CAST(sum(CAST(severity_score AS DECIMAL(28, 9))) AS DOUBLE) / count(*), 2) "
        "AS mean_severity FROM alerts", ALERTS),
    "most_targeted": _with(
        "SELECT entity, count(*) AS alerts FROM alerts GROUP BY 1 ORDER BY alerts DESC, entity LIMIT 5",
        ALERTS),
    "deduped_alerts": _with(
        "SELECT * FROM alerts QUALIFY row_number() OVER "
        "(PARTITION BY alert_type, entity ORDER BY window_start) = 1", ALERTS),
}
ORACLES |= {
    "heavy_hitters_approx": ORACLES["heavy_hitters"],
    "streaming_deduped_alerts": ORACLES["streaming_alerts"],
    "streaming_suppressed_alerts": ORACLES["baseline_suppressed_alerts"],
    "streaming_quarantine": ORACLES["malformed_quarantine"],
}

# The streams' layers of flows also hold the flow, a year later, that closes all windows.
_YEAR_LATER = "(SELECT max(ts) + INTERVAL 1 YEAR FROM flows)"
ORACLES["streaming_health"] = _with(
    f"SELECT *, (epoch_us({_YEAR_LATER}) - epoch_us(newest)) / 1e6 AS lag_seconds FROM ("
    + "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, count(*) + 1 AS row_count, max(ts) + INTERVAL 1 YEAR AS newest "
        f"FROM {table}" if table == "flows" else
        f"SELECT '{layer}' AS layer, count(*) AS row_count, max(window_end) AS newest FROM {table}"
        for layer, table in _LAYERS.items()) + ")", ALERTS)


def _stream(name: str, read: str, table: str, time: str) -> str:
    return (
        f"SELECT '{name}' AS stream, CAST(({read}) AS BIGINT) AS input_rows, "
        f"count(*) AS written_rows, min({time}) AS first_time, max({time}) AS last_time FROM {table}"
    )


_SENT = "(SELECT ts FROM flows UNION ALL SELECT max(ts) + INTERVAL 1 YEAR FROM flows)"
_ALL_FLOWS = "SELECT count(*) + 1 FROM flows"
ORACLES["streaming_metrics"] = _with(
    "SELECT *, CAST(0 AS BIGINT) AS late_groups, TRUE AS is_timed FROM ("
    + "\nUNION ALL ".join([
        _stream("bronze", _ALL_FLOWS, _SENT, "ts"),
        _stream("silver", _ALL_FLOWS, _SENT, "ts"),
        *(_stream(f"gold_{table}", _ALL_FLOWS, _LAYERS[table], "window_start")
          for table in ("top_destinations", "top_talkers", "router_summary")),
        _stream("gold_alerts", "NULL", "alerts", "window_start"),
    ]) + ")", ALERTS)

_SENSITIVE = f"""sensitive AS (
  SELECT window_start, window_end, 'FAN_IN_DDOS' AS alert_type, dst_ip AS entity,
    CAST(CASE WHEN unique_sources > 500 THEN 1.0 WHEN unique_sources > 200 THEN 0.7 ELSE 0.4 END AS DOUBLE)
      AS severity_score, unique_sources, total_packets, total_bytes
  FROM ({_rollup("dst_ip", "1 day", SOURCES)})
  WHERE unique_sources > 5 AND total_packets > 50
)"""
# Gaps and islands: an incident begins where the alert before is more than the gap away.
_ISLANDS = """heard AS (SELECT * FROM sensitive WHERE day(window_start) % 5 <> 0),
begun AS (
  SELECT *, CASE WHEN lag(window_start) OVER run >= window_start - INTERVAL 36 HOURS THEN 0 ELSE 1 END
    AS is_first
  FROM heard WINDOW run AS (PARTITION BY alert_type, entity ORDER BY window_start)
),
numbered AS (
  SELECT *, sum(is_first) OVER (PARTITION BY alert_type, entity ORDER BY window_start) AS island
  FROM begun
),
incidents AS (
  SELECT alert_type, entity, min(window_start) AS incident_start, max(window_end) AS incident_end,
    count(*) AS windows, max(severity_score) AS peak_severity, max(unique_sources) AS peak_sources,
    CAST(sum(total_packets) AS BIGINT) AS total_packets, CAST(sum(total_bytes) AS BIGINT) AS total_bytes
  FROM numbered GROUP BY alert_type, entity, island
)"""
ORACLES |= {
    "alert_incidents": _with(
        "SELECT *, incident_end + INTERVAL 36 HOURS > (SELECT max(window_end) FROM heard) AS is_open "
        "FROM incidents", _SENSITIVE, _ISLANDS),
    "streaming_incidents": _with("SELECT * FROM incidents", _SENSITIVE, _ISLANDS),
    "streaming_alert_latency": _with(
        "SELECT alert_type, count(*) AS alerts, TRUE AS p50_within, TRUE AS p99_within "
        "FROM sensitive GROUP BY alert_type", _SENSITIVE),
    "streaming_late_corrected": ORACLES["top_destinations"],
    "streaming_top_ports": ORACLES["router_top_ports"],
    "streaming_bitmap_sources": ORACLES["exact_unique_sources"],
    "gold_top_ports": ORACLES["router_top_ports"],
    "bitmap_unique_sources": ORACLES["exact_unique_sources"],
    "gold_sketch_rollup": _with(_rollup("dst_ip", "1 day", "TRUE AS within_bound")),
    "gold_total_rollup": _with(
        "SELECT * EXCLUDE (everything) FROM (" + _rollup(
            "everything", "1 day", f"{SOURCES}, TRUE AS within_bound",
            source="(SELECT *, 'all' AS everything FROM flows)") + ")"),
    "shared_sources": _with("""
SELECT a.day AS window_start, a.day + INTERVAL 1 DAY AS window_end, a.dst_ip AS dst_ip_a,
  b.dst_ip AS dst_ip_b, count(*) FILTER (WHERE a.src_ip = b.src_ip) AS shared
FROM watched a JOIN watched b ON a.day = b.day AND a.dst_ip < b.dst_ip
GROUP BY 1, 2, 3, 4""", """watched AS (
  SELECT DISTINCT date_trunc('day', ts) AS day, dst_ip, src_ip FROM flows
  WHERE dst_ip IN ('172.16.4.100', '172.16.1.10', '172.16.1.20', '172.16.1.30'))"""),
    "gold_heavy_hitters": _with(_top_per(
        _rollup("dst_ip", "1 day", "count(*) AS flow_count, TRUE AS within_bound", traffic=False),
        "window_start", "flow_count", "dst_ip", 4)),
    "sliding_destinations": _with(f"""
SELECT window_start, window_start + INTERVAL 6 HOURS AS window_end, dst_ip,
  CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(sum(packets) AS BIGINT) AS total_packets,
  count(*) AS flow_count, {SOURCES}
FROM (SELECT *, {_bucket("1 hour")} - INTERVAL 1 HOUR * unnest(range(6)) AS window_start FROM flows)
GROUP BY window_start, dst_ip"""),
}

_DECAYED = f"""profile AS ({_rollup("dst_ip", "1 day", f"{SYN}, {SOURCES}")}),
past AS (
  SELECT a.window_start, a.dst_ip,
    sum(b.unique_sources * power(0.5, date_diff('day', b.window_start, a.window_start))) AS sums,
    sum(power(0.5, date_diff('day', b.window_start, a.window_start))) AS weights
  FROM profile a JOIN profile b ON a.dst_ip = b.dst_ip AND b.window_start < a.window_start
  GROUP BY 1, 2
),
held AS (
  SELECT p.*, {RATIO} AS syn_ratio, coalesce(sums, 0.0) AS history_sum,
    coalesce(weights, 0.0) AS history_weight
  FROM profile p LEFT JOIN past USING (window_start, dst_ip)
)"""
ORACLES |= {
    "streaming_decayed_verdicts": _with("""
SELECT window_start, window_end, 'FAN_IN_DDOS' AS alert_type, dst_ip AS entity,
  CAST(CASE WHEN unique_sources > 500 THEN 1.0 WHEN unique_sources > 200 THEN 0.7 ELSE 0.4 END AS DOUBLE)
    AS severity_score, unique_sources, total_packets, total_bytes, syn_ratio,
  history_sum, history_weight,
  history_weight >= 0.8 AND unique_sources * history_weight <= 2 * history_sum
    AND coalesce(syn_ratio <= 0.8, TRUE) AS suppressed
FROM held WHERE unique_sources > 5 AND total_packets > 50""", _DECAYED),
    "streaming_compacted": _with(
        "SELECT CAST(ts AS DATE) AS date, count(*) AS flow_count, "
        "CAST(ts AS DATE) < DATE '2024-01-25' AS is_compact FROM flows GROUP BY 1, 3"),
}
ORACLES["entity_flows"] = _with(f"""
SELECT CASE WHEN src_ip = '172.16.1.20' THEN 'sent' ELSE 'received' END AS role, {FLOW_COLUMNS}
FROM flows WHERE '172.16.1.20' IN (src_ip, dst_ip)
  AND ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-13 06:00:00'""")
