"""Column names, types and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

SESSION = "session_id"
CAPTURE = "capture_id"

# A flow key: the two endpoints in canonical order, inside one capture of one session.
FLOW_KEY = [SESSION, CAPTURE, "protocol", "a_ip", "a_port", "b_ip", "b_port"]

PACKET_FLAGS = ["syn", "ack", "rst", "fin", "psh"]

PACKETS = T.StructType(
    [
        T.StructField(SESSION, T.StringType()),
        T.StructField(CAPTURE, T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("packet_length", T.IntegerType()),
        *[T.StructField(flag, T.IntegerType()) for flag in PACKET_FLAGS],
        T.StructField("icmp_type", T.IntegerType()),
    ]
)

# The fields of one dissected packet line, in file order.
PACKET_LINE_FIELDS = [
    "frame_time_epoch",
    "ip_src",
    "ip_dst",
    "tcp_srcport",
    "udp_srcport",
    "tcp_dstport",
    "udp_dstport",
    "ip_proto",
    "frame_len",
    "tcp_flags_syn",
    "tcp_flags_ack",
    "tcp_flags_reset",
    "tcp_flags_fin",
    "tcp_flags_push",
    "icmp_type",
]

# Model inputs in contract order with their types.
FEATURES: dict[str, str] = {
    "protocol": "string",
    "src_port": "int64",
    "dst_port": "int64",
    "duration_ms": "float64",
    "packet_count_total": "int64",
    "packet_count_fwd": "int64",
    "packet_count_bwd": "int64",
    "byte_count_total": "int64",
    "byte_count_fwd": "int64",
    "byte_count_bwd": "int64",
    "pkt_len_min": "int64",
    "pkt_len_max": "int64",
    "pkt_len_mean": "float64",
    "pkt_len_std": "float64",
    "iat_min_ms": "float64",
    "iat_max_ms": "float64",
    "iat_mean_ms": "float64",
    "iat_std_ms": "float64",
    "syn_count": "int64",
    "ack_count": "int64",
    "rst_count": "int64",
    "fin_count": "int64",
    "psh_count": "int64",
    "icmp_echo_req_count": "int64",
    "icmp_echo_reply_count": "int64",
    "connections_per_1s": "int64",
    "connections_per_5s": "int64",
    "distinct_dst_ports_per_5s": "int64",
    "distinct_dst_ips_per_5s": "int64",
    "icmp_packets_per_1s": "int64",
    "failed_connection_ratio": "float64",
}

# Columns that must never be model inputs.
EXCLUDED_COLUMNS = [
    "capture_id",
    "dst_ip",
    "end_time",
    "end_ts",
    "flow_id",
    "label_family",
    "scenario_family",
    "scenario_id",
    "session_id",
    "severity",
    "src_ip",
    "start_time",
    "start_ts",
]

TARGET = "label_binary"
POSITIVE_LABEL = "suspect"
NEGATIVE_LABEL = "normal"

# Columns of manifests and summaries, statuses, splits and modes.
MANIFEST_COLUMNS = [
    "campaign_id",
    "run_index",
    "scenario_id",
    "scenario_family",
    "label_binary",
    "source_host",
    "target_host",
    "pcap_name",
    "started_at_utc",
    "packet_count",
    "status",
    "notes",
]

CAPTURE_SUMMARY_COLUMNS = [
    "campaign_id",
    "capture_id",
    "pcap_name",
    "scenario_id",
    "scenario_family",
    "label_binary",
    "packet_count",
    "flow_count",
    "status",
    "source_host",
    "target_host",
    "started_at_utc",
    "notes",
]

# Scenario -> (family, severity).
SCENARIOS: dict[str, tuple[str, str | None]] = {
    "N01": ("normal_icmp", None),
    "N02": ("normal_http", None),
    "N03": ("normal_http", None),
    "N06": ("normal_dns", None),
    "N07": ("normal_bulk_tcp", None),
    "N11": ("normal_wget", None),
    "N20": ("normal_http_short", None),
    "N21": ("normal_http_short", None),
    "N22": ("normal_dns_burst", None),
    "N23": ("normal_ssh_short", None),
    "N24": ("normal_wget_burst", None),
    "N25": ("normal_bulk_tcp", None),
    "N30": ("normal_https_short", None),
    "N31": ("normal_https_download", None),
    "N35": ("normal_scp", None),
    "N36": ("normal_admin_mixed", None),
    "S01": ("scan_syn", "medium"),
    "S02": ("scan_connect", "medium"),
    "S03": ("scan_udp", "medium"),
    "S05": ("syn_burst", "high"),
    "S06": ("icmp_burst", "high"),
    "S20": ("scan_syn_large", "medium"),
    "S21": ("scan_connect_large", "medium"),
    "S22": ("scan_udp_large", "medium"),
    "S23": ("syn_burst_multiport", "high"),
    "S24": ("failed_connection_burst", "medium"),
    "S25": ("scan_syn_slow", "medium"),
    "S30": ("ssh_bruteforce_light", "medium"),
    "S31": ("web_probe_https", "medium"),
}

# Flows kept per training capture, by scenario (first and second plan).
CAPS_BY_SCENARIO_V1: dict[str, int] = {
    "N20": 150,
    "N21": 150,
    "N22": 250,
    "N23": 120,
    "N24": 100,
    "N30": 160,
    "S20": 400,
    "S21": 600,
    "S22": 300,
    "S24": 180,
    "S25": 180,
}
CAPS_BY_SCENARIO_V2: dict[str, int] = {
    "N20": 120,
    "N21": 120,
    "N22": 180,
    "N23": 120,
    "N24": 100,
    "N30": 140,
    "N31": 80,
    "N35": 20,
    "N36": 50,
    "S20": 350,
    "S21": 500,
    "S22": 250,
    "S23": 180,
    "S24": 160,
    "S25": 160,
    "S30": 60,
    "S31": 60,
}

EXCLUDED_STATUSES = ["scenario_error"]
IGNORED_CAMPAIGN_PREFIX = "smoke_"
SPLITS = ["train", "validation", "test"]
BLOCKING_MODES = ["dry_run", "system_stub", "enforce"]
