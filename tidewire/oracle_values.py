"""What the SQL counterparts expect, spelled out apart from the package they check."""

from __future__ import annotations

# Labels and texts of the contract.
SCENARIOS = {
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
FEATURES = {
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
CAPS = {
    "N01": 3,
    "N02": 5,
    "N07": 2,
    "N11": 4,
    "S16": 6,
    "S20": 3,
    "S23": 1,
    "S27": 8,
}
REASON_NOT_SUSPECT = "no blocking action for non-suspect classification"
REASON_BELOW = "suspect classification below block confidence threshold"
REASON_SUSPECT = "post-flow-classification suspect decision"
REASON_NOT_ENFORCED = "Firewall enforcement is recorded only; no command is executed."
RECOMMENDATION = ("Review the source host, preserve flow evidence and keep prevention in dry_run unless the lab "
 "scenario explicitly requires enforcement.")
RUNTIME_STATUS = {
    "running": "RUNNING",
    "stopped": "STOPPED",
    "stopping": "STOPPING",
    "error": "ERROR",
}
LABEL = {
    "normal": "Normal",
    "suspect": "Suspect",
}
SEVERITY = {
    "critical": "Critique",
    "high": "Elevee",
    "medium": "Moyenne",
    "low": "Faible",
    "normal": "Normale",
    "info": "Info",
    "warning": "Avertissement",
}
ACTION = {
    "allow": "Autoriser",
    "alert_only": "Alerte",
    "block_dry_run": "Blocage",
    "block_system_stub": "Blocage",
    "block_enforce": "Blocage",
    "block": "Blocage",
    "observe": "Observation",
}
EVENT_STATUS = {
    "open": "Ouverte",
    "closed": "Fermee",
    "blocked": "Bloquee",
    "executed": "Executee",
    "simulated": "Simulee",
    "alert_only": "Alerte",
    "escalated": "Escaladee",
}
MISSING = {
    "runtime_status": "INCONNU",
    "label": "Inconnu",
    "severity": "Inconnue",
    "action": "-",
    "event_status": "-",
    "protocol": "-",
}
