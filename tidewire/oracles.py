"""The same results as :mod:`tidewire.queries`, as SQL for DuckDB over the driver tables."""

from __future__ import annotations

from tidewire import oracle_values as V

ORACLES: dict[str, str] = {}


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


def _values(rows: list[tuple]) -> str:
    def text(value):
        return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)

    return "VALUES " + ", ".join("(" + ", ".join(map(text, row)) + ")" for row in rows)


def _packets(capture: str = "'CAP-EVT'") -> str:
    return f"""
ev AS (
  SELECT event_id AS seq, (epoch_us(ts) - 1704067200000000) // 4000 AS ts_us,
    CASE event_type WHEN 'signup' THEN 'UDP' WHEN 'error' THEN 'ICMP' ELSE 'TCP' END AS protocol,
    user_id AS u, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value
  FROM events),
ev2 AS (
  SELECT *, seq % 3 = 0 AS rev, '10.0.0.' || (u % 6) AS client, '10.0.1.' || (k % 3) AS server,
    CASE WHEN protocol = 'ICMP' THEN 0 ELSE 40000 + u % 2 END AS cport,
    CASE WHEN protocol = 'ICMP' THEN 0 ELSE [22, 53, 80, 443][CAST(k % 4 AS INT) + 1] END AS sport
  FROM ev),
packets AS (
  SELECT 'EVT' AS session_id, {capture} AS capture_id, seq, ts_us,
    CASE WHEN rev THEN server ELSE client END AS src_ip,
    CASE WHEN rev THEN client ELSE server END AS dst_ip,
    CASE WHEN rev THEN sport ELSE cport END AS src_port,
    CASE WHEN rev THEN cport ELSE sport END AS dst_port,
    protocol, CAST(least(1500, 40 + floor(value * 4)) AS BIGINT) AS packet_length,
    CASE WHEN protocol = 'TCP' AND seq % 7 = 0 THEN 1 ELSE 0 END AS syn,
    CASE WHEN protocol = 'TCP' AND seq % 3 <> 1 THEN 1 ELSE 0 END AS ack,
    CASE WHEN protocol = 'TCP' AND seq % 29 = 0 THEN 1 ELSE 0 END AS rst,
    CASE WHEN protocol = 'TCP' AND seq % 23 = 0 THEN 1 ELSE 0 END AS fin,
    CASE WHEN protocol = 'TCP' AND seq % 5 = 0 THEN 1 ELSE 0 END AS psh,
    CASE WHEN protocol <> 'ICMP' THEN -1 WHEN rev THEN 0 ELSE 8 END AS icmp_type,
    u
  FROM ev2)"""


_KEYED = """
ends AS (
  SELECT *, src_ip < dst_ip OR (src_ip = dst_ip AND src_port <= dst_port) AS from_a FROM packets),
keyed AS (
  SELECT *, CASE WHEN from_a THEN src_ip ELSE dst_ip END AS a_ip,
    CASE WHEN from_a THEN src_port ELSE dst_port END AS a_port,
    CASE WHEN from_a THEN dst_ip ELSE src_ip END AS b_ip,
    CASE WHEN from_a THEN dst_port ELSE src_port END AS b_port
  FROM ends),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY capture_id, protocol, a_ip, a_port, b_ip, b_port) AS kid,
    CASE protocol WHEN 'TCP' THEN 30000000 WHEN 'ICMP' THEN 5000000 ELSE 15000000 END AS idle
  FROM keyed),
steps AS (
  SELECT *, row_number() OVER (PARTITION BY kid ORDER BY ts_us, seq) AS rn FROM numbered)"""

# One packet of every key per round: the state of the open flow travels along.
_WALK = """
walk AS (
  SELECT kid, rn, seq, ts_us, ts_us AS start_us, seq AS start_seq, 1 AS n,
    psh > 0 OR fin > 0 OR rst > 0 AS loud,
    protocol = 'TCP' AND (fin > 0 OR rst > 0) AS done, CAST(NULL AS BIGINT) AS gap_us
  FROM steps WHERE rn = 1
  UNION ALL
  SELECT s.kid, s.rn, s.seq, s.ts_us,
    CASE WHEN s.fresh THEN s.ts_us ELSE s.start_us END,
    CASE WHEN s.fresh THEN s.seq ELSE s.start_seq END,
    CASE WHEN s.fresh THEN 1 ELSE s.n + 1 END,
    CASE WHEN s.fresh THEN s.noisy ELSE s.loud OR s.noisy END,
    (s.protocol = 'TCP' AND (s.fin > 0 OR s.rst > 0))
      OR (NOT s.fresh AND s.ts_us - s.start_us >= 60000000),
    CASE WHEN s.fresh THEN NULL ELSE s.ts_us - s.before_us END
  FROM (
    SELECT k.kid, k.rn, k.seq, k.ts_us, k.protocol, k.fin, k.rst, w.start_us, w.start_seq, w.n,
      w.loud, w.ts_us AS before_us, k.psh > 0 OR k.fin > 0 OR k.rst > 0 AS noisy,
      w.done OR k.ts_us - w.start_us > 60000000 OR k.ts_us - w.ts_us >
        CASE WHEN k.protocol = 'TCP' AND w.n <= 3 AND NOT w.loud THEN 3000000 ELSE k.idle END
        AS fresh
    FROM walk w JOIN steps k ON k.kid = w.kid AND k.rn = w.rn + 1) s),
members AS (
  SELECT s.*, w.start_us, w.start_seq, w.gap_us
  FROM walk w JOIN steps s ON s.kid = w.kid AND s.rn = w.rn)"""

def _rounded(part: str, whole: str, digits: int) -> str:
    """Half up on whole numbers."""
    scale = 10**digits
    return f"(({part}) * {2 * scale} + {whole}) // (({whole}) * 2) / {scale}"


_FLOWS = f"""
sums AS (
  SELECT capture_id, kid, protocol, start_us, start_seq, max(ts_us) AS end_us,
    arg_max(seq, rn) AS last_seq,
    arg_min(src_ip, rn) AS src_ip, arg_min(dst_ip, rn) AS dst_ip,
    arg_min(src_port, rn) AS src_port, arg_min(dst_port, rn) AS dst_port,
    count(*) AS n, CAST(sum(packet_length) AS BIGINT) AS bytes,
    min(packet_length) AS len_min, max(packet_length) AS len_max,
    CAST(sum(packet_length * packet_length) AS BIGINT) AS len_sq,
    count(*) FILTER (gap_us > 0) AS gaps, min(gap_us) FILTER (gap_us > 0) AS gap_min,
    max(gap_us) FILTER (gap_us > 0) AS gap_max,
    CAST(sum(gap_us) FILTER (gap_us > 0) AS BIGINT) AS gap_sum,
    CAST(sum(gap_us * gap_us) FILTER (gap_us > 0) AS BIGINT) AS gap_sq,
    CAST(sum(syn) AS BIGINT) AS syn_count, CAST(sum(ack) AS BIGINT) AS ack_count,
    CAST(sum(rst) AS BIGINT) AS rst_count, CAST(sum(fin) AS BIGINT) AS fin_count,
    CAST(sum(psh) AS BIGINT) AS psh_count,
    count(*) FILTER (icmp_type = 8) AS icmp_echo_req_count,
    count(*) FILTER (icmp_type = 0) AS icmp_echo_reply_count
  FROM members GROUP BY ALL),
forward AS (
  SELECT m.kid, m.start_seq, count(*) AS packets_fwd,
    CAST(sum(m.packet_length) AS BIGINT) AS bytes_fwd
  FROM members m JOIN sums f ON m.kid = f.kid AND m.start_seq = f.start_seq
    AND m.src_ip = f.src_ip AND m.src_port = f.src_port
    AND m.dst_ip = f.dst_ip AND m.dst_port = f.dst_port
  GROUP BY ALL),
flows AS (
  SELECT s.*, packets_fwd, bytes_fwd,
    CAST(bytes AS DOUBLE) / n AS len_mean, CAST(len_sq AS DOUBLE) / n AS len_mean_sq,
    CAST(gap_sum AS DOUBLE) / nullif(gaps, 0) AS gap_mean,
    CAST(gap_sq AS DOUBLE) / nullif(gaps, 0) AS gap_mean_sq
  FROM sums s JOIN forward USING (kid, start_seq)),
described AS (
  SELECT *, round((end_us - start_us) / 1000, 3) AS duration_ms,
    {_rounded('bytes', 'n', 6)} AS pkt_len_mean,
    round(sqrt(greatest(0.0::DOUBLE, len_mean_sq - len_mean * len_mean)), 6) AS pkt_len_std,
    round(coalesce(gap_min / 1000, 0), 6) AS iat_min_ms,
    round(coalesce(gap_max / 1000, 0), 6) AS iat_max_ms,
    coalesce({_rounded('gap_sum', 'nullif(gaps, 0) * 1000', 6)}, 0) AS iat_mean_ms,
    round(coalesce(sqrt(greatest(0.0::DOUBLE, gap_mean_sq - gap_mean * gap_mean)) / 1000, 0), 6)
      AS iat_std_ms,
    round(CASE WHEN protocol <> 'TCP' THEN 0 WHEN syn_count > 0 AND ack_count = 0 THEN 1
      ELSE least(1.0::DOUBLE, rst_count / greatest(syn_count, 1)) END, 6)
      AS failed_connection_ratio
  FROM flows)"""

_TRIGGERS = """
closing AS (
  SELECT *, (protocol = 'TCP' AND (fin_count > 0 OR rst_count > 0))
      OR end_us - start_us >= 60000000 AS own,
    least(start_us + 60000000, end_us + CASE
      WHEN protocol = 'TCP' AND n <= 3 AND psh_count + fin_count + rst_count = 0 THEN 3000000
      WHEN protocol = 'TCP' THEN 30000000 WHEN protocol = 'ICMP' THEN 5000000
      ELSE 15000000 END) AS deadline_us
  FROM described),
arrivals AS (
  SELECT capture_id, ts_us, min(seq) AS seq FROM packets GROUP BY ALL),
nexts AS (
  SELECT c.kid, c.start_seq, min(a.ts_us) AS next_us FROM closing c
  JOIN arrivals a ON a.capture_id = c.capture_id AND a.ts_us > c.deadline_us GROUP BY ALL),
triggered AS (
  SELECT c.*, CASE WHEN own THEN end_us ELSE a.ts_us END AS trigger_us,
    CASE WHEN own THEN last_seq ELSE a.seq END AS trigger_seq, CAST(own AS INT) AS trigger_phase
  FROM closing c LEFT JOIN nexts x USING (kid, start_seq)
  LEFT JOIN arrivals a ON a.capture_id = c.capture_id AND a.ts_us = x.next_us)"""

_IDS = """
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY trigger_us NULLS LAST,
    trigger_seq, trigger_phase, start_us, start_seq) - 1 AS flow_index
  FROM triggered),
ids AS (
  SELECT *, printf('%s__%06d', capture_id, flow_index) AS flow_id FROM ordered)"""

_BEHAVIOUR = """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY capture_id, src_ip ORDER BY start_us, flow_index) AS at
  FROM ids),
seen AS (
  SELECT a.flow_id,
    count(*) FILTER (a.start_us - b.start_us <= 1000000) AS connections_per_1s,
    count(*) AS connections_per_5s,
    count(DISTINCT b.dst_port) AS distinct_dst_ports_per_5s,
    count(DISTINCT b.dst_ip) AS distinct_dst_ips_per_5s,
    CAST(coalesce(sum(b.n) FILTER (b.protocol = 'ICMP' AND a.start_us - b.start_us <= 1000000), 0)
      AS BIGINT) AS icmp_packets_per_1s
  FROM placed a JOIN placed b ON a.capture_id = b.capture_id AND a.src_ip = b.src_ip
    AND b.at <= a.at AND a.start_us - b.start_us <= 5000000
  GROUP BY a.flow_id),
features AS (
  SELECT i.*, connections_per_1s, connections_per_5s, distinct_dst_ports_per_5s,
    distinct_dst_ips_per_5s, icmp_packets_per_1s
  FROM ids i JOIN seen USING (flow_id))"""

_FEATURE_LIST = """protocol, CAST(src_port AS BIGINT) AS src_port,
  CAST(dst_port AS BIGINT) AS dst_port, duration_ms, n AS packet_count_total,
  packets_fwd AS packet_count_fwd, n - packets_fwd AS packet_count_bwd,
  bytes AS byte_count_total, bytes_fwd AS byte_count_fwd, bytes - bytes_fwd AS byte_count_bwd,
  len_min AS pkt_len_min, len_max AS pkt_len_max, pkt_len_mean, pkt_len_std,
  iat_min_ms, iat_max_ms, iat_mean_ms, iat_std_ms,
  syn_count, ack_count, rst_count, fin_count, psh_count, icmp_echo_req_count,
  icmp_echo_reply_count, connections_per_1s, connections_per_5s, distinct_dst_ports_per_5s,
  distinct_dst_ips_per_5s, icmp_packets_per_1s, failed_connection_ratio"""

_WITH_PACKETS = _with(_packets())
_WITH_KEYS = _with(_packets(), _KEYED)
_WITH_MEMBERS = _with(_packets(), _KEYED, _WALK, recursive=True)
_WITH_FLOWS = _with(_packets(), _KEYED, _WALK, _FLOWS, recursive=True)
_WITH_TRIGGERS = _with(_packets(), _KEYED, _WALK, _FLOWS, _TRIGGERS, recursive=True)
_WITH_IDS = _with(_packets(), _KEYED, _WALK, _FLOWS, _TRIGGERS, _IDS, recursive=True)
_WITH_FEATURES = _with(
    _packets(), _KEYED, _WALK, _FLOWS, _TRIGGERS, _IDS, _BEHAVIOUR, recursive=True
)

_CAPTURES = """
captures AS (
  SELECT c_custkey, 'cap_' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS capture_id,
    CASE WHEN c_custkey % 50 = 0 THEN 'smoke_' ELSE 'camp_' END || (c_nationkey % 5)
      AS campaign_id,
    CASE WHEN c_custkey % 29 < 16 THEN 'N' ELSE 'S' END
      || lpad(CAST(c_custkey % 29 AS VARCHAR), 2, '0') AS scenario_id,
    CASE WHEN c_custkey % 29 < 16 THEN 'normal' ELSE 'suspect' END AS label_binary,
    'fam_' || ((c_custkey % 29) % 11) AS scenario_family,
    CASE WHEN c_acctbal < -900 THEN 'scenario_error' ELSE 'ok' END AS status
  FROM customer),
usable AS (
  SELECT * FROM captures
  WHERE status <> 'scenario_error' AND NOT starts_with(campaign_id, 'smoke_'))"""

_CAPTURE_FLOWS = """
capture_flows AS (
  SELECT 'cap_' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS capture_id,
    'cap_' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') || '__'
      || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS flow_id,
    epoch_us(o_orderdate) AS start_us,
    epoch_us(o_orderdate) + (o_orderkey % 97) * 1000 AS end_us,
    CAST(round(o_totalprice * 100) AS BIGINT) % 1001 AS p_milli,
    CASE o_orderstatus WHEN 'F' THEN 'TCP' WHEN 'O' THEN 'UDP' ELSE 'ICMP' END AS protocol,
    o_orderkey, o_custkey
  FROM orders),
labeled AS (
  SELECT f.*, c.* EXCLUDE (capture_id) FROM capture_flows f JOIN captures c USING (capture_id))"""


def _plan(source: str, group: str, order: str) -> str:
    return f"""
dealt AS (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS r,
    count(*) OVER (PARTITION BY {group}) AS total FROM {source}),
sizes AS (
  SELECT *, greatest(1, CAST(round_even(total * 0.15::DOUBLE, 0) AS BIGINT)) AS n_val FROM dealt),
sizes2 AS (
  SELECT *, greatest(1, total - CAST(round_even(total * 0.7::DOUBLE, 0) AS BIGINT) - n_val)
    AS n_test FROM sizes),
plan AS (
  SELECT * EXCLUDE (r, total, n_val, n_test), CASE
    WHEN total >= 3 AND r <= total - n_val - n_test THEN 'train'
    WHEN total >= 3 AND r <= total - n_test THEN 'validation'
    WHEN total >= 3 THEN 'test' WHEN r = 1 THEN 'train' ELSE 'test' END AS split
  FROM sizes2)"""


_PLAN = _plan("usable", "scenario_id", "campaign_id, capture_id")
_WITH_CAPTURES = _with(_CAPTURES)
_WITH_LABELED = _with(_CAPTURES, _CAPTURE_FLOWS)
_WITH_PLAN = _with(_CAPTURES, _CAPTURE_FLOWS, _PLAN)

_MANIFEST = """
manifest AS (
  SELECT capture_id, campaign_id, scenario_id, label_binary,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE scenario_family END AS scenario_family,
    CASE WHEN c_custkey % 9 = 0 THEN 'low' ELSE '' END AS severity,
    '172.30.1.' || (20 + c_custkey % 4) AS source_host, status
  FROM captures WHERE c_custkey % 17 <> 0)"""

_SCENARIOS = f"""
scenarios(scenario_id, family, level) AS (
  {_values([(s, f, v) for s, (f, v) in V.SCENARIOS.items()])})"""

_CAPTURE_PACKETS = """
capture_packets AS (
  SELECT seq, ts_us, 'cap_' || lpad(CAST(u % 1000 AS VARCHAR), 7, '0') AS capture_id,
    CASE WHEN seq % 5 = 0 THEN '172.30.1.' || (20 + (u % 1000) % 4) ELSE src_ip END AS src_ip,
    CASE WHEN seq % 5 < 2 THEN '172.30.1.20' ELSE dst_ip END AS dst_ip,
    src_port, dst_port, protocol
  FROM packets),
kept_packets AS (
  SELECT p.* FROM capture_packets p LEFT JOIN manifest m USING (capture_id)
  WHERE NOT coalesce(m.label_binary = 'normal' AND m.source_host <> '172.30.1.20'
    AND ((p.src_ip = m.source_host AND p.dst_ip = '172.30.1.20')
      OR (p.dst_ip = m.source_host AND p.src_ip = '172.30.1.20'))
    AND p.protocol = 'TCP' AND 22 IN (p.src_port, p.dst_port), FALSE))"""

_COUNTS = """
capture_counts AS (
  SELECT c.*, count(o_orderkey) AS flow_count,
    CAST(coalesce(sum(o_orderkey % 9 + 1), 0) AS BIGINT) AS packet_count
  FROM captures c LEFT JOIN capture_flows f USING (capture_id) GROUP BY ALL)"""

_CAPS = f"""
caps(scenario_id, cap) AS ({_values(list(V.CAPS.items()))}),
train AS (
  SELECT l.* FROM labeled l WHERE l.capture_id IN (SELECT capture_id FROM plan WHERE split = 'train'))"""


def _capped(source: str) -> str:
    return f"""
capped AS (
  SELECT * EXCLUDE (r, cap) FROM (
    SELECT l.*, cap, row_number() OVER (PARTITION BY capture_id ORDER BY start_us, end_us, flow_id)
      AS r
    FROM {source} l LEFT JOIN caps USING (scenario_id))
  WHERE cap IS NULL OR r <= cap),
balanced AS (
  SELECT * EXCLUDE (r, quota) FROM (
    SELECT c.*, row_number() OVER (PARTITION BY label_binary ORDER BY md5(flow_id), flow_id) AS r,
      (SELECT min(n) FROM (SELECT count(*) AS n FROM capped GROUP BY label_binary)) AS quota
    FROM capped c)
  WHERE r <= quota)"""


_SCORED = """
scored AS (
  SELECT flow_id, capture_id, campaign_id, scenario_id, label_binary,
    CASE WHEN o_orderkey % 6 = 0 THEN scenario_family END AS scenario_family,
    CASE WHEN o_orderkey % 10 = 3 THEN 'lf_known' ELSE '' END AS label_family,
    CASE WHEN o_orderkey % 17 = 0 THEN 'medium' END AS severity,
    p_milli, CASE WHEN p_milli >= 500 THEN 'suspect' ELSE 'normal' END AS raw_label,
    p_milli / 1000 AS p,
    CASE WHEN o_orderkey % 13 <> 0 THEN '10.1.' || (o_custkey % 7) || '.' || (o_orderkey % 11) END
      AS src_ip,
    CASE WHEN o_orderkey % 39 <> 0 THEN '10.2.0.' || (o_orderkey % 5) END AS dst_ip,
    40000 + o_orderkey % 100 AS src_port,
    CAST([22, 53, 80, 443][CAST(o_custkey % 4 AS INT) + 1] AS BIGINT) AS dst_port, protocol,
    1 + o_orderkey % 9 AS packet_count_total,
    60 * (1 + o_orderkey % 9) + o_custkey % 50 AS byte_count_total,
    (end_us - start_us) / 1000 AS duration_ms,
    CASE WHEN protocol = 'TCP' THEN o_orderkey % 2 ELSE 0 END AS syn_count,
    CASE WHEN protocol = 'TCP' THEN o_orderkey % 3 ELSE 0 END AS ack_count,
    CASE WHEN protocol = 'TCP' THEN (o_orderkey // 7) % 2 ELSE 0 END AS rst_count,
    CASE WHEN protocol = 'TCP' AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS fin_count,
    CASE WHEN protocol = 'TCP' AND o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS psh_count,
    start_us, end_us,
    CASE WHEN o_orderkey % 19 <> 0 THEN end_us + 500000 END AS finalized_us,
    o_orderkey, o_custkey
  FROM labeled)"""

_DETECTED = f"""
preview AS (
  SELECT *, CASE WHEN src_ip IS NOT NULL THEN 'iptables -I INPUT 1 -s ' || src_ip || ' -j DROP'
    WHEN dst_ip IS NOT NULL THEN 'iptables -I OUTPUT 1 -d ' || dst_ip || ' -p ' || lower(protocol)
      || ' --dport ' || dst_port || ' -j DROP'
    ELSE 'iptables -I INPUT 1 -p ' || lower(protocol) || ' --dport ' || dst_port || ' -j DROP'
    END AS rule_text
  FROM scored),
detected AS (
  SELECT *, CASE WHEN raw_label = 'suspect' AND p < 0.95::DOUBLE THEN 'normal' ELSE raw_label END
      AS predicted_label,
    CASE WHEN raw_label = 'suspect' THEN p ELSE 1::DOUBLE - p END AS confidence,
    raw_label = 'suspect' AND p >= 0.95::DOUBLE AS alert_triggered,
    raw_label = 'suspect' AND p >= 0.99::DOUBLE AS triggered,
    end_us + 750000 AS event_us
  FROM preview),
records AS (
  SELECT *,
    coalesce(severity, CASE WHEN NOT alert_triggered THEN 'normal'
      WHEN triggered OR confidence >= 0.99::DOUBLE THEN 'critical'
      WHEN confidence >= 0.95::DOUBLE THEN 'high'
      WHEN confidence >= 0.80::DOUBLE THEN 'medium' ELSE 'low' END) AS level,
    CASE WHEN predicted_label <> 'suspect' THEN 'benign_' || lower(protocol)
      WHEN protocol = 'TCP' AND syn_count > 0 AND rst_count > 0 THEN 'syn_burst'
      WHEN protocol = 'ICMP' THEN 'icmp_anomaly' WHEN protocol = 'UDP' THEN 'udp_anomaly'
      ELSE 'suspect_flow' END AS derived_type,
    CASE WHEN triggered THEN 'block_dry_run' WHEN alert_triggered THEN 'alert_only'
      ELSE 'allow' END AS action_taken,
    CASE WHEN triggered THEN 'blocked' WHEN alert_triggered THEN 'open' ELSE 'closed' END
      AS state,
    nullif(concat_ws(',', CASE WHEN syn_count > 0 THEN 'SYN' END,
      CASE WHEN ack_count > 0 THEN 'ACK' END, CASE WHEN fin_count > 0 THEN 'FIN' END,
      CASE WHEN rst_count > 0 THEN 'RST' END, CASE WHEN psh_count > 0 THEN 'PSH' END), '')
      AS flag_text,
    CASE WHEN raw_label <> 'suspect' OR NOT alert_triggered THEN '{V.REASON_NOT_SUSPECT}'
      WHEN NOT triggered THEN '{V.REASON_BELOW}' ELSE '{V.REASON_SUSPECT}' END AS reason
  FROM detected),
evts AS (
  SELECT flow_id AS event_id, event_us, coalesce(src_ip, 'unknown') AS src_ip,
    coalesce(dst_ip, 'unknown') AS dst_ip, src_port, dst_port, protocol,
    packet_count_total AS packet_count, byte_count_total AS byte_count, duration_ms,
    flag_text AS tcp_flags, predicted_label AS prediction_label,
    raw_label AS raw_prediction_label, confidence AS risk_score, level AS severity,
    coalesce(nullif(scenario_family, ''), nullif(label_family, ''), derived_type) AS attack_type,
    action_taken, state AS status, triggered AS blocked, flow_id, alert_triggered,
    start_us, end_us, finalized_us
  FROM records),
alerts AS (
  SELECT 'alt-' || md5(event_id) AS alert_id, event_us, attack_type, severity, src_ip, dst_ip,
    'Suspect flow detected from ' || src_ip || ' to ' || dst_ip || ' over ' || protocol || '.'
      AS description,
    '{V.RECOMMENDATION}' AS recommendation, action_taken,
    CASE WHEN blocked THEN 'escalated' ELSE 'open' END AS status, risk_score,
    start_us AS flow_started_us, end_us AS flow_ended_us, finalized_us AS flow_finalized_us,
    event_us AS prediction_done_us, event_us + 1250 AS alert_created_us,
    round((event_us + 1250 - end_us) / 1000, 3) AS latency_from_flow_end_ms,
    round((event_us + 1250 - finalized_us) / 1000, 3) AS latency_from_finalization_ms
  FROM evts WHERE alert_triggered),
blocks AS (
  SELECT 'blk-' || md5(flow_id) AS block_id, event_us, coalesce(src_ip, 'unknown') AS src_ip,
    coalesce(dst_ip, 'unknown') AS dst_ip, src_port, dst_port, protocol, predicted_label,
    confidence, reason, 'dry_run' AS mode, triggered,
    CASE WHEN alert_triggered THEN rule_text END AS command_preview,
    CASE WHEN triggered THEN 'simulated' ELSE 'alert_only' END AS status
  FROM records WHERE raw_label = 'suspect'),
logs AS (
  SELECT event_us, 'WARNING' AS level, 'detection_service' AS component,
    'Suspect flow detected from ' || src_ip || ' to ' || dst_ip || ' (' || attack_type || ').'
      AS message, 'detection' AS category
  FROM evts WHERE alert_triggered
  UNION ALL
  SELECT event_us, 'WARNING', 'blocking_service',
    'Blocking decision triggered for ' || src_ip || ' to ' || dst_ip || ' in dry_run mode.',
    'blocking'
  FROM blocks WHERE triggered)"""


def _named(names: dict[str, str], value: str, missing: str, otherwise: str) -> str:
    cases = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in names.items())
    return (
        f"CASE WHEN {value} IS NULL THEN '{missing}' ELSE "
        f"CASE lower(trim({value})) {cases} ELSE {otherwise} END END"
    )


def _label(value: str) -> str:
    return _named(V.LABEL, value, V.MISSING["label"], value)


def _severity(value: str) -> str:
    return _named(V.SEVERITY, value, V.MISSING["severity"], value)


def _action(value: str) -> str:
    return _named(V.ACTION, value, "-", value)


def _status(value: str) -> str:
    return _named(V.EVENT_STATUS, value, "-", value)


_TIME = "strftime(make_timestamp(event_us), '%H:%M:%S')"

_VIEWS = f"""
events_view AS (
  SELECT event_id, event_us, {_TIME} AS time, {_label('prediction_label')} AS label,
    printf('%.2f', risk_score) AS score, upper(protocol) AS protocol, src_ip AS source,
    dst_ip AS destination, src_port, dst_port, {_action('action_taken')} AS action,
    {_status('status')} AS status
  FROM evts),
alerts_view AS (
  SELECT alert_id, event_us, {_TIME} AS time, {_severity('severity')} AS severity,
    attack_type AS type, src_ip AS source, dst_ip AS destination,
    {_action('action_taken')} AS action, {_status('status')} AS status,
    printf('%.2f', risk_score) AS score
  FROM alerts),
journal AS (
  SELECT event_us, level, 'Detection' AS type, message FROM logs WHERE category = 'detection'
  UNION ALL
  SELECT event_us, level, 'Blocking', message FROM logs WHERE category = 'blocking'
  UNION ALL
  SELECT event_us, CASE WHEN prediction_label = 'normal' THEN 'NORMAL' ELSE 'SUSPECT' END,
    'Prediction', {_label('prediction_label')} || ' ' || upper(protocol) || ' ' || src_ip
      || ' -> ' || dst_ip
  FROM evts
  UNION ALL
  SELECT event_us, 'ALERTE', 'Detection', description FROM alerts
  UNION ALL
  SELECT event_us, CASE WHEN triggered THEN 'BLOCAGE' ELSE 'ACTION' END, 'Action', reason
  FROM blocks)"""

_WITH_SCORED = _with(_CAPTURES, _CAPTURE_FLOWS, _SCORED)
_WITH_RECORDS = _with(_CAPTURES, _CAPTURE_FLOWS, _SCORED, _DETECTED)
_WITH_VIEWS = _with(_CAPTURES, _CAPTURE_FLOWS, _SCORED, _DETECTED, _VIEWS)

# Lines are spelled and then split again, so that the oracle really parses.
_LINES = """
lines AS (
  SELECT seq, CASE WHEN seq % 97 = 0 THEN ['1.0', '10.0.0.1'] WHEN seq % 73 = 0 THEN [''] WHEN seq % 67 = 0 THEN ['   '] ELSE [
    CASE WHEN seq % 83 = 0 THEN '-1.5' WHEN seq % 79 = 0 THEN 'n/a' WHEN seq % 101 = 0 THEN 'nan'
      WHEN seq % 103 = 0 THEN 'Infinity' WHEN seq % 107 = 0 THEN '1e300'
      ELSE (ts_us // 1000000) || '.' || lpad(CAST(ts_us % 1000000 AS VARCHAR), 6, '0') END,
    CASE WHEN seq % 89 = 0 THEN ' ' ELSE src_ip END, dst_ip,
    CASE WHEN protocol = 'TCP' THEN CAST(src_port AS VARCHAR) ELSE '' END,
    CASE WHEN protocol = 'UDP' THEN CAST(src_port AS VARCHAR) ELSE '' END,
    CASE WHEN protocol = 'TCP' THEN CAST(dst_port AS VARCHAR) ELSE '' END,
    CASE WHEN protocol = 'UDP' THEN CAST(dst_port AS VARCHAR) ELSE '' END,
    CASE WHEN seq % 71 = 0 THEN '47' WHEN protocol = 'ICMP' THEN '1'
      WHEN protocol = 'TCP' THEN '6' ELSE '17' END,
    CASE WHEN seq % 61 = 0 THEN '60.9' ELSE CAST(packet_length AS VARCHAR) END,
    CASE WHEN seq % 2 = 0 AND syn = 1 THEN 'True' WHEN seq % 2 = 0 THEN 'False'
      ELSE CAST(syn AS VARCHAR) END,
    CAST(ack AS VARCHAR), CAST(rst AS VARCHAR),
    CASE WHEN seq % 59 = 0 THEN 'x' ELSE CAST(fin AS VARCHAR) END, CAST(psh AS VARCHAR),
    CASE WHEN icmp_type < 0 THEN '' ELSE CAST(icmp_type AS VARCHAR) END] END AS f
  FROM packets),
parsed AS (
  SELECT seq, f, coalesce(try_cast(f[1] AS DOUBLE), -1) AS seconds,
    CASE f[8] WHEN '1' THEN 'ICMP' WHEN '6' THEN 'TCP' WHEN '17' THEN 'UDP'
      ELSE 'IP_' || f[8] END AS protocol,
    CASE WHEN len(f) < 15 THEN 'short_line'
      WHEN NOT coalesce(try_cast(f[1] AS DOUBLE), -1) BETWEEN 0 AND 9e12 THEN 'bad_time'
      WHEN trim(f[2]) = '' OR trim(f[3]) = '' THEN 'blank_address' END AS reason
  FROM lines)"""


def _int(position: int, default: int) -> str:
    return (
        f"CAST(coalesce(trunc(try_cast(nullif(trim(f[{position}]), '') AS DOUBLE)), {default})"
        " AS INT)"
    )


def _flag(position: int) -> str:
    return f"CASE WHEN lower(f[{position}]) = 'true' THEN 1 ELSE {_int(position, 0)} END"


ORACLES["packets_parsed"] = (
    _with(_packets(), _LINES)
    + f"""SELECT seq, try_cast(round(seconds * 1000000) AS BIGINT) AS ts_us, trim(f[2]) AS src_ip,
  trim(f[3]) AS dst_ip,
  CASE protocol WHEN 'TCP' THEN {_int(4, 0)} WHEN 'UDP' THEN {_int(5, 0)} ELSE 0 END AS src_port,
  CASE protocol WHEN 'TCP' THEN {_int(6, 0)} WHEN 'UDP' THEN {_int(7, 0)} ELSE 0 END AS dst_port,
  protocol, {_int(9, 0)} AS packet_length, {_flag(10)} AS syn, {_flag(11)} AS ack,
  {_flag(12)} AS rst, {_flag(13)} AS fin, {_flag(14)} AS psh, {_int(15, -1)} AS icmp_type
FROM parsed WHERE reason IS NULL"""
)
ORACLES["packet_rejects"] = (
    _with(_packets(), _LINES)
    + "SELECT reason AS reject_reason, count(*) AS line_count FROM parsed"
    " WHERE reason IS NOT NULL GROUP BY reason"
)
ORACLES["manifest_dedup"] = (
    _WITH_CAPTURES
    + """SELECT * EXCLUDE (r) FROM (
  SELECT c_custkey AS position,
    'run_' || lpad(CAST(c_custkey - c_custkey % 3 AS VARCHAR), 7, '0') || '.pcap' AS pcap_name,
    campaign_id, scenario_id, label_binary, '172.30.1.' || (20 + c_custkey % 4) AS source_host,
    status, row_number() OVER (PARTITION BY c_custkey - c_custkey % 3 ORDER BY c_custkey DESC) AS r
  FROM captures) WHERE r = 1"""
)
ORACLES["split_scan"] = (
    _WITH_PLAN
    + """SELECT split, flow_id, capture_id, label_binary, start_us, end_us, protocol
FROM labeled JOIN (SELECT capture_id, split FROM plan) USING (capture_id) WHERE split <> 'train'"""
)
ORACLES["campaign_union"] = (
    _WITH_CAPTURES
    + """SELECT capture_id, campaign_id, scenario_id, label_binary,
  CASE WHEN campaign_id <> 'camp_0' THEN scenario_family END AS scenario_family,
  CASE WHEN campaign_id <> 'camp_0' THEN c_custkey END AS run_index
FROM captures"""
)
ORACLES["wide_manifest"] = (
    _WITH_CAPTURES
    + """SELECT * EXCLUDE (r) FROM (
  SELECT 'run_' || lpad(CAST(c_custkey - c_custkey % 3 AS VARCHAR), 7, '0') || '.pcap' AS pcap_name,
    campaign_id, scenario_id, label_binary, '172.30.1.' || (20 + c_custkey % 4) AS source_host,
    c_custkey AS run_index, status,
    row_number() OVER (PARTITION BY c_custkey - c_custkey % 3 ORDER BY c_custkey DESC) AS r
  FROM captures) WHERE r = 1"""
)
ORACLES["csv_records"] = (
    _WITH_CAPTURES
    + """SELECT 'run_' || lpad(CAST(c_custkey - c_custkey % 3 AS VARCHAR), 7, '0') || '.pcap' AS pcap_name,
  'two' || chr(10) || 'lines, "' || c_custkey || '"' || chr(10) || ',' AS notes, '"59",' AS extra_59, status,
  CAST(NULL AS VARCHAR) AS absent
FROM captures"""
)
ORACLES["campaign_flows"] = (
    _WITH_LABELED
    + """SELECT flow_id, capture_id, campaign_id, start_us,
  CAST(CASE WHEN o_custkey % 3 <> 1 OR p_milli % 7 <> 0 THEN p_milli END AS DOUBLE) AS p_milli,
  CASE WHEN o_custkey % 3 <> 1 THEN protocol END AS protocol,
  CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey
FROM labeled"""
)
_RAW = """
raw AS (
  SELECT CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'A' THEN 'TCP' ELSE 'UDP' END
      AS protocol,
    CAST(40000 + l_partkey % 100 AS VARCHAR) AS src_port,
    CASE WHEN l_partkey % 31 = 0 THEN 'https' ELSE CAST(l_suppkey % 500 AS VARCHAR) END
      AS dst_port,
    CASE WHEN l_orderkey % 41 = 0 THEN 'n/a' ELSE CAST(l_discount AS VARCHAR) END AS duration_ms,
    CASE WHEN l_orderkey % 43 <> 0 THEN CAST(l_linenumber AS VARCHAR) END AS packet_count_total,
    CAST(l_quantity AS VARCHAR) AS pkt_len_mean
  FROM lineitem)"""
_RAW_COLUMNS = {
    "protocol",
    "src_port",
    "dst_port",
    "duration_ms",
    "packet_count_total",
    "pkt_len_mean",
}
_DUCK_TYPES = {"int64": "BIGINT", "float64": "DOUBLE", "string": "VARCHAR"}


def _violation(name: str, dtype: str) -> str:
    if name not in _RAW_COLUMNS:
        return (
            f"SELECT '{name}' AS column_name, '{dtype}' AS expected_type, FALSE AS present, "
            "CAST(0 AS BIGINT) AS null_count, CAST(0 AS BIGINT) AS misfit_count"
        )
    return (
        f"SELECT '{name}' AS column_name, '{dtype}' AS expected_type, TRUE AS present, "
        f"count(*) FILTER ({name} IS NULL) AS null_count, count(*) FILTER ({name} IS NOT NULL AND "
        f"try_cast({name} AS {_DUCK_TYPES[dtype]}) IS NULL) AS misfit_count FROM raw"
    )


ORACLES["contract_violations"] = _with(_RAW) + " UNION ALL ".join(
    _violation(name, dtype) for name, dtype in V.FEATURES.items()
)
ORACLES["replay_summary"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _PLAN)
    + """SELECT split, replay_limit, count(*) AS processed_events,
  count(*) FILTER (p_milli < 500) AS normal_count,
  count(*) FILTER (p_milli >= 500) AS suspect_count,
  count(*) FILTER (p_milli >= 500) AS block_decisions_count
FROM (SELECT split, p_milli, row_number() OVER (PARTITION BY split
    ORDER BY start_us, end_us, flow_id) AS place
  FROM labeled JOIN (SELECT capture_id, split FROM plan) USING (capture_id)
  WHERE split IN ('validation', 'test'))
JOIN (VALUES (NULL::INT), (100)) AS limits (replay_limit)
  ON replay_limit IS NULL OR place <= replay_limit
GROUP BY ALL"""
)
ORACLES["protocol_name"] = """SELECT protocol_number, CASE protocol_number WHEN 1 THEN 'ICMP'
  WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' ELSE 'IP_' || protocol_number END AS protocol,
  count(*) AS packet_count
FROM (SELECT CAST(l_quantity AS INT) % 21 AS protocol_number FROM lineitem) GROUP BY ALL"""
ORACLES["packet_filter"] = (
    _WITH_PACKETS
    + """SELECT seq, src_ip, dst_ip, protocol,
  CASE WHEN seq % 3 = 0 AND protocol = 'UDP' THEN 68 ELSE src_port END AS src_port,
  CASE WHEN seq % 3 = 0 AND protocol = 'UDP' THEN 67 ELSE dst_port END AS dst_port
FROM packets WHERE seq % 37 <> 0 AND NOT (seq % 3 = 0 AND protocol = 'UDP')"""
)
ORACLES["flow_key"] = (
    _WITH_KEYS + "SELECT seq, protocol, a_ip, a_port, b_ip, b_port, from_a FROM keyed"
)
ORACLES["control_plane_filter"] = (
    _with(_packets(), _CAPTURES, _MANIFEST, _CAPTURE_PACKETS) + "SELECT * FROM kept_packets"
)
ORACLES["capture_clean"] = (
    _WITH_CAPTURES + "SELECT capture_id, campaign_id, scenario_id, status FROM usable"
)
ORACLES["feature_projection"] = (
    _WITH_FEATURES + f"SELECT flow_id, {_FEATURE_LIST} FROM features"
)
ORACLES["training_frame"] = (
    _WITH_FEATURES
    + f"""SELECT {_FEATURE_LIST}, capture_id,
  CASE WHEN dst_port = 22 THEN 'suspect' ELSE 'normal' END AS label_binary FROM features"""
)
ORACLES["flow_features"] = (
    _WITH_FEATURES
    + f"SELECT flow_id, src_ip, dst_ip, start_us, {_FEATURE_LIST} FROM features"
)
ORACLES["label_flows"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _MANIFEST, _SCENARIOS)
    + """SELECT f.capture_id, flow_id, start_us, end_us, p_milli, protocol,
  coalesce(m.scenario_id, 'UNKNOWN') AS scenario_id,
  coalesce(nullif(m.scenario_family, ''), s.family, 'unknown') AS scenario_family,
  coalesce(m.label_binary, 'unknown') AS label_binary,
  coalesce(nullif(m.scenario_family, ''), s.family, 'unknown') AS label_family,
  coalesce(nullif(m.severity, ''), s.level) AS severity
FROM capture_flows f LEFT JOIN manifest m USING (capture_id)
LEFT JOIN scenarios s ON s.scenario_id = m.scenario_id"""
)
ORACLES["split_flows"] = (
    _WITH_PLAN
    + "SELECT flow_id, l.capture_id, l.label_binary, split FROM labeled l JOIN plan USING (capture_id)"
)
ORACLES["campaign_semi"] = (
    _WITH_LABELED
    + """SELECT flow_id, campaign_id FROM labeled
WHERE campaign_id IN (SELECT campaign_id FROM usable WHERE campaign_id <> 'camp_4')"""
)
ORACLES["excluded_captures"] = (
    _WITH_CAPTURES
    + """SELECT capture_id, campaign_id, status FROM captures
WHERE capture_id NOT IN (SELECT capture_id FROM usable)"""
)
ORACLES["flow_expiry_trigger"] = (
    _WITH_TRIGGERS
    + """SELECT start_seq AS flow_start_seq, last_seq AS flow_last_seq, deadline_us, trigger_seq,
  trigger_phase FROM triggered"""
)
ORACLES["split_label_flows"] = (
    _WITH_PLAN
    + """SELECT split, l.label_binary, count(*) AS flow_count
FROM labeled l JOIN plan USING (capture_id) GROUP BY ALL"""
)
ORACLES["split_family_flows"] = (
    _WITH_PLAN
    + """SELECT split, l.label_binary, l.scenario_family, count(*) AS flow_count
FROM labeled l JOIN plan USING (capture_id) GROUP BY ALL"""
)


def _iso(micros: str) -> str:
    stamp = f"make_timestamp({micros})"
    return (
        f"CASE WHEN {micros} % 1000000 = 0 THEN strftime({stamp}, '%Y-%m-%dT%H:%M:%S')"
        f" ELSE strftime({stamp}, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00'"
    )


ORACLES["flow_table"] = (
    _WITH_FLOWS
    + f"""SELECT start_seq AS flow_start_seq, last_seq AS flow_last_seq, protocol, src_ip, dst_ip,
  CAST(src_port AS BIGINT) AS src_port, CAST(dst_port AS BIGINT) AS dst_port,
  {_iso('start_us')} AS start_time, {_iso('end_us')} AS end_time, duration_ms,
  n AS packet_count_total, packets_fwd AS packet_count_fwd, n - packets_fwd AS packet_count_bwd,
  bytes AS byte_count_total, bytes_fwd AS byte_count_fwd, bytes - bytes_fwd AS byte_count_bwd
FROM described"""
)
ORACLES["flow_len_stats"] = (
    _WITH_FLOWS
    + """SELECT start_seq AS flow_start_seq, len_min AS pkt_len_min, len_max AS pkt_len_max,
  pkt_len_mean, pkt_len_std FROM described"""
)
ORACLES["flow_iat_stats"] = (
    _WITH_FLOWS
    + """SELECT start_seq AS flow_start_seq, iat_min_ms, iat_max_ms, iat_mean_ms, iat_std_ms
FROM described"""
)
ORACLES["flow_flag_counts"] = (
    _WITH_FLOWS
    + """SELECT start_seq AS flow_start_seq, syn_count, ack_count, rst_count, fin_count, psh_count,
  icmp_echo_req_count, icmp_echo_reply_count FROM described"""
)
ORACLES["capture_summary"] = (
    _with(_packets(), _CAPTURES, _CAPTURE_FLOWS, _MANIFEST, _SCENARIOS, _CAPTURE_PACKETS)
    + """SELECT m.campaign_id, c.capture_id, coalesce(m.scenario_id, 'UNKNOWN') AS scenario_id,
  coalesce(nullif(m.scenario_family, ''), s.family, 'unknown') AS scenario_family,
  coalesce(m.label_binary, 'unknown') AS label_binary,
  (SELECT count(*) FROM kept_packets k WHERE k.capture_id = c.capture_id) AS packet_count,
  (SELECT count(*) FROM capture_flows f WHERE f.capture_id = c.capture_id) AS flow_count,
  coalesce(m.status, 'unknown') AS status, m.source_host
FROM captures c LEFT JOIN manifest m USING (capture_id)
LEFT JOIN scenarios s ON s.scenario_id = m.scenario_id"""
)
ORACLES["campaign_stats"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _COUNTS)
    + """SELECT campaign_id, CAST(sum(n) AS BIGINT) AS capture_count,
  CAST(sum(f) AS BIGINT) AS flow_count,
  '{' || string_agg('"' || label_binary || '":' || n, ',' ORDER BY label_binary) || '}'
    AS label_counts
FROM (SELECT campaign_id, label_binary, count(*) AS n, sum(flow_count) AS f
  FROM capture_counts GROUP BY ALL) GROUP BY campaign_id"""
)
ORACLES["split_summary"] = (
    _WITH_PLAN + "SELECT split, label_binary, count(*) AS capture_count FROM plan GROUP BY ALL"
)
ORACLES["split_family_presence"] = (
    _WITH_PLAN + "SELECT split, scenario_family, count(*) AS capture_count FROM plan GROUP BY ALL"
)


def _distribution(by: str, total: bool) -> str:
    share = f"{_rounded('n * 100', 'CAST(sum(n) OVER () AS BIGINT)', 2)} AS pct_total," if total else ""
    within = "CAST(sum(n) OVER (PARTITION BY label_binary) AS BIGINT)"
    return (
        _WITH_LABELED
        + f"""SELECT label_binary, {by}, n AS flow_count, {share}
  {_rounded('n * 100', within, 2)} AS pct_within_label
FROM (SELECT label_binary, {by}, count(*) AS n FROM labeled GROUP BY ALL)"""
    )


ORACLES["scenario_distribution"] = _distribution("scenario_id, scenario_family", False)
ORACLES["family_distribution"] = _distribution("scenario_family", False)
ORACLES["scenario_flow_distribution"] = _distribution("scenario_id, scenario_family", True)
ORACLES["family_flow_distribution"] = _distribution("scenario_family", True)


def _capture_distribution(by: str) -> str:
    within = "CAST(sum(n) OVER (PARTITION BY label_binary) AS BIGINT)"
    return (
        _with(_CAPTURES, _CAPTURE_FLOWS, _COUNTS)
        + f"""SELECT label_binary, {by}, n AS capture_count, f AS flow_count, p AS packet_count,
  {_rounded('f', 'n', 2)} AS avg_flows_per_capture,
  {_rounded('n * 100', within, 2)} AS pct_captures_within_label
FROM (SELECT label_binary, {by}, count(*) AS n, CAST(sum(flow_count) AS BIGINT) AS f,
    CAST(sum(packet_count) AS BIGINT) AS p FROM capture_counts GROUP BY ALL)"""
    )


ORACLES["family_capture_distribution"] = _capture_distribution("scenario_family")
ORACLES["scenario_capture_distribution"] = _capture_distribution("scenario_id, scenario_family")
ORACLES["top3_label_share"] = (
    _WITH_LABELED
    + f"""SELECT label_binary,
  {_rounded('CAST(sum(n) FILTER (r <= 3) AS BIGINT) * 100', 'CAST(sum(n) AS BIGINT)', 2)}
    AS top3_share_pct
FROM (SELECT *, row_number() OVER (PARTITION BY label_binary ORDER BY n DESC, scenario_id) AS r
  FROM (SELECT label_binary, scenario_id, count(*) AS n FROM labeled GROUP BY ALL))
GROUP BY label_binary"""
)
ORACLES["view_summary"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _PLAN, _CAPS, _capped("train"))
    + """SELECT stage, count(*) AS row_count, count(DISTINCT capture_id) AS capture_count,
  count(DISTINCT campaign_id) AS campaign_count,
  count(*) FILTER (label_binary = 'normal') AS normal_count,
  count(*) FILTER (label_binary = 'suspect') AS suspect_count
FROM (SELECT 'all' AS stage, capture_id, campaign_id, label_binary FROM labeled
  UNION ALL SELECT 'train_source', capture_id, campaign_id, label_binary FROM train
  UNION ALL SELECT 'train_capped', capture_id, campaign_id, label_binary FROM capped
  UNION ALL SELECT 'train_balanced', capture_id, campaign_id, label_binary FROM balanced)
GROUP BY stage"""
)
_PROFILE_COLUMNS = [
    "flow_id",
    "capture_id",
    "campaign_id",
    "scenario_id",
    "label_binary",
    "scenario_family",
    "label_family",
    "severity",
    "p_milli",
    "raw_label",
    "src_ip",
    "dst_ip",
    "src_port",
    "dst_port",
    "protocol",
    "packet_count_total",
    "byte_count_total",
    "duration_ms",
    "syn_count",
    "ack_count",
    "rst_count",
    "fin_count",
    "psh_count",
    "start_us",
    "end_us",
    "finalized_us",
]
_SPLIT_TYPES = {
    **dict.fromkeys(["p_milli", "src_port", "dst_port", "packet_count_total", "byte_count_total"], "bigint"),
    **dict.fromkeys(["syn_count", "ack_count", "rst_count", "start_us", "end_us", "finalized_us"], "bigint"),
    **dict.fromkeys(["fin_count", "psh_count"], "int"),
    "duration_ms": "double",
}
ORACLES["split_profile"] = _with(_CAPTURES, _CAPTURE_FLOWS, _PLAN, _SCORED) + " UNION ALL ".join(
    f"SELECT split, count(*) AS row_count, {len(_PROFILE_COLUMNS)} AS column_count, "
    f"'{c}' AS column_name, '{_SPLIT_TYPES.get(c, 'string')}' AS dtype, "
    f"count(*) FILTER ({c} IS NULL) AS null_count FROM scored"
    " JOIN (SELECT capture_id, split FROM plan) USING (capture_id) GROUP BY split"
    for c in _PROFILE_COLUMNS
)
ORACLES["schema_drift"] = (
    """WITH raw AS (
  SELECT 'camp_' || (l_orderkey % 5) AS campaign_id,
    CAST(40000 + l_partkey % 100 AS VARCHAR) AS src_port,
    CASE WHEN l_partkey % 31 = 0 THEN 'https' ELSE CAST(l_suppkey % 500 AS VARCHAR) END
      AS dst_port,
    CASE WHEN l_orderkey % 41 = 0 THEN 'n/a' ELSE CAST(l_discount AS VARCHAR) END AS duration_ms,
    CASE WHEN l_orderkey % 43 <> 0 THEN CAST(l_linenumber AS VARCHAR) END AS packet_count_total
  FROM lineitem)
"""
    + " UNION ALL ".join(
        f"SELECT campaign_id, count(*) AS row_count, '{c}' AS column_name, '{t}' AS expected_type, "
        f"count(*) FILTER ({c} IS NULL) AS null_count, "
        f"count(*) FILTER ({c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL) AS misfit_count "
        "FROM raw GROUP BY campaign_id"
        for c, t in (
            ("src_port", "bigint"),
            ("dst_port", "bigint"),
            ("duration_ms", "double"),
            ("packet_count_total", "bigint"),
        )
    )
)
ORACLES["safe_casts"] = """SELECT coalesce(CASE WHEN l_partkey % 31 <> 0 THEN l_suppkey % 500 END, -1)
    AS dst_port,
  CASE WHEN l_orderkey % 41 = 0 THEN -1 ELSE CAST(l_discount AS DOUBLE) END AS duration_ms,
  count(*) AS row_count
FROM lineitem GROUP BY ALL"""
_SIGNED = [
    "capture_id",
    "flow_id",
    "start_us",
    "end_us",
    "p_milli",
    "protocol",
    "o_orderkey",
    "o_custkey",
    "c_custkey",
    "campaign_id",
    "scenario_id",
    "label_binary",
    "scenario_family",
    "status",
]
ORACLES["table_signature"] = (
    _WITH_LABELED
    + "SELECT count(*) AS row_count, CAST(coalesce(sum(CAST('0x' || substr(md5("
    + " || '|' || ".join(f"coalesce('=' || {c}, '-')" for c in _SIGNED)
    + "), 1, 15) AS BIGINT)), 0) AS VARCHAR) AS content_sum FROM labeled"
)
ORACLES["label_distribution"] = (
    _WITH_SCORED
    + "SELECT coalesce(severity, 'nan') AS severity, count(*) AS row_count FROM scored GROUP BY 1"
)
ORACLES["feature_profile"] = _WITH_SCORED + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature_name, count({c}) AS non_null_count,
  count(*) - count({c}) AS null_count, round((count(*) - count({c})) / count(*), 6) AS null_rate,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
  round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM scored"""
    for c in (
        "p_milli",
        "src_port",
        "dst_port",
        "packet_count_total",
        "byte_count_total",
        "duration_ms",
        "rst_count",
    )
)
_FEATURE_ROWS = f"WITH f AS MATERIALIZED ({ORACLES['flow_features']}) "
ORACLES["feature_profile_all"] = _FEATURE_ROWS + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature_name, count({c}) AS non_null_count,
  count(*) - count({c}) AS null_count, round((count(*) - count({c})) / count(*), 6) AS null_rate,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
  round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM f"""
    for c, kind in V.FEATURES.items()
    if kind != "string"
)
ORACLES["encoded_features"] = (
    _FEATURE_ROWS
    + "SELECT flow_id, "
    + " || '|' || ".join(
        [
            *[f"printf('%.6f', CASE WHEN protocol = '{p}' THEN 1.0 ELSE 0.0 END)" for p in ("ICMP", "TCP", "UDP")],
            *[f"printf('%.6f', CAST({c} AS DOUBLE))" for c, kind in V.FEATURES.items() if kind != "string"],
        ]
    )
    + " AS features FROM f"
)
ORACLES["model_check"] = """SELECT split, CAST(0 AS BIGINT) AS walk_mismatches, CAST(0 AS BIGINT) AS reload_mismatches,
  TRUE AS mostly_right FROM (VALUES ('train'), ('validation'), ('test')) AS splits (split)"""
ORACLES["categorical_top5"] = (
    _WITH_SCORED
    + """SELECT feature_name, CAST(sum(n) - sum(gaps) AS BIGINT) AS non_null_count,
  CAST(sum(gaps) AS BIGINT) AS null_count, round(sum(gaps) / sum(n), 6) AS null_rate,
  '{' || string_agg('"' || coalesce(value, 'None') || '":' || n, ',' ORDER BY r)
    FILTER (r <= 5) || '}' AS top_values
FROM (SELECT *, CASE WHEN value IS NULL THEN n ELSE coalesce(hidden, 0) END AS gaps,
  row_number() OVER (PARTITION BY feature_name ORDER BY n DESC, coalesce(value, 'None')) AS r FROM (
  SELECT 'protocol' AS feature_name, protocol AS value, count(*) AS n FROM scored GROUP BY ALL
  UNION ALL SELECT 'src_ip', src_ip, count(*) FROM scored GROUP BY ALL
  UNION ALL SELECT 'scenario_id', scenario_id, count(*) FROM scored GROUP BY ALL
  UNION ALL SELECT 'scenario_family', 'None', count(*) FROM scored
    WHERE p_milli % 4 = 0 OR scenario_family IS NULL
  UNION ALL SELECT 'scenario_family', scenario_family, count(*) FROM scored
    WHERE p_milli % 4 <> 0 AND scenario_family IS NOT NULL GROUP BY ALL)
  LEFT JOIN (SELECT 'scenario_family' AS feature_name, 'None' AS value,
    count(*) FILTER (p_milli % 4 <> 0 AND scenario_family IS NULL) AS hidden FROM scored)
    USING (feature_name, value))
GROUP BY feature_name"""
)
ORACLES["protocol_histogram"] = (
    _WITH_PACKETS + "SELECT protocol, count(*) AS row_count FROM packets GROUP BY ALL"
)
ORACLES["top_dst_ports"] = (
    _WITH_PACKETS
    + """SELECT CAST(dst_port AS INT) AS dst_port, count(*) AS row_count FROM packets GROUP BY ALL
ORDER BY row_count DESC, dst_port LIMIT 10"""
)

_EVALUATED = """
evaluated AS (
  SELECT capture_id, scenario_id, scenario_family, label_binary AS y_true,
    CASE WHEN p_milli >= 500 THEN 'suspect' ELSE 'normal' END AS y_pred, p_milli / 1000 AS score,
    p_milli
  FROM labeled)"""
_WITH_EVALUATED = _with(_CAPTURES, _CAPTURE_FLOWS, _EVALUATED)

ORACLES["confusion_matrix"] = (
    _WITH_EVALUATED
    + """SELECT t.l AS y_true, p.l AS y_pred, (SELECT count(*) FROM evaluated e
  WHERE e.y_true = t.l AND e.y_pred = p.l) AS row_count
FROM (VALUES ('normal'), ('suspect')) t(l), (VALUES ('normal'), ('suspect')) p(l)"""
)


def _quality(source: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
cells AS (
  SELECT {lead}count(*) AS n, count(*) FILTER (y_true = 'suspect' AND y_pred = 'suspect') AS tp,
    count(*) FILTER (y_true <> 'suspect' AND y_pred = 'suspect') AS fp,
    count(*) FILTER (y_true = 'suspect' AND y_pred <> 'suspect') AS fn,
    count(*) FILTER (y_true <> 'suspect' AND y_pred <> 'suspect') AS tn,
    round(avg(score), 6) AS mean_probability_suspect
  FROM {source} {group}),
quality AS (
  SELECT *, n AS rows, round((tp + tn) / n, 6) AS accuracy,
    round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision_suspect,
    round(tp / (tp + fn), 6) AS recall_suspect,
    round(2 * tp / (2 * tp + fp + fn), 6) AS f1_suspect,
    round(fp / (fp + tn), 6) AS false_positive_rate
  FROM cells)"""


def _auc(source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
ranks AS (
  SELECT {lead}y_true, rank() OVER ({part}ORDER BY score)
    + (count(*) OVER (PARTITION BY {lead}score) - 1) / 2 AS r FROM {source}),
auc AS (
  SELECT {lead}round((sum(r) FILTER (y_true = 'suspect')
    - count(*) FILTER (y_true = 'suspect') * (count(*) FILTER (y_true = 'suspect') + 1) / 2)
    / count(*) FILTER (y_true = 'suspect') / count(*) FILTER (y_true <> 'suspect'), 6)
    AS roc_auc_suspect FROM ranks {group})"""


_QUALITY_COLUMNS = (
    "rows, accuracy, balanced_accuracy, precision_suspect, recall_suspect, f1_suspect,"
    " false_positive_rate"
)
ORACLES["classification_metrics"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _EVALUATED, _quality("evaluated"))
    + f"SELECT {_QUALITY_COLUMNS}, tn, fp, fn, tp, mean_probability_suspect FROM quality"
)
ORACLES["classification_report"] = (
    _with(
        _CAPTURES,
        _CAPTURE_FLOWS,
        _EVALUATED,
        """
per_class AS (
  SELECT l AS label, h / p AS pr, h / s AS re, 2 * h / (s + p) AS f1, s FROM (
    SELECT l, count(*) FILTER (y_true = l) AS s, count(*) FILTER (y_pred = l) AS p,
      count(*) FILTER (y_true = l AND y_pred = l) AS h
    FROM evaluated, (VALUES ('normal'), ('suspect')) c(l) GROUP BY l))""",
    )
    + """SELECT label, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1_score,
  s AS support FROM per_class
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6),
  CAST(sum(s) AS BIGINT) FROM per_class
UNION ALL SELECT 'weighted avg', round(sum(pr * s) / sum(s), 6), round(sum(re * s) / sum(s), 6),
  round(sum(f1 * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM per_class"""
)
ORACLES["roc_auc"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _EVALUATED, _auc("evaluated"))
    + "SELECT roc_auc_suspect FROM auc"
)
ORACLES["scenario_breakdown"] = (
    _WITH_EVALUATED
    + """SELECT scenario_id, scenario_family, count(*) AS rows,
  round(count(*) FILTER (y_true = y_pred) / count(*), 9) AS accuracy,
  round(count(*) FILTER (y_pred = 'suspect') / count(*), 9) AS predicted_suspect_rate,
  round(count(*) FILTER (y_true = 'suspect') / count(*), 9) AS true_suspect_rate
FROM evaluated GROUP BY ALL"""
)
ORACLES["model_comparison"] = (
    _with(
        _CAPTURES,
        _CAPTURE_FLOWS,
        _PLAN,
        _EVALUATED,
        """
both_models AS (
  SELECT 'candidate' AS model, split, y_true, y_pred, score
  FROM evaluated JOIN plan USING (capture_id)
  UNION ALL
  SELECT 'baseline', split, y_true, CASE WHEN p_milli >= 800 THEN 'suspect' ELSE 'normal' END,
    CAST(p_milli - p_milli % 100 AS DOUBLE)
  FROM evaluated JOIN plan USING (capture_id))""",
        _quality("both_models", "model, split"),
        _auc("both_models", "model, split"),
    )
    + f"""SELECT model, split, {_QUALITY_COLUMNS}, roc_auc_suspect
FROM quality JOIN auc USING (model, split)"""
)
_STATUS = """
status_row AS (
  SELECT (SELECT count(*) FROM evts) AS finalized_flows, (SELECT count(*) FROM evts) AS predictions,
    (SELECT count(*) FROM evts WHERE alert_triggered) AS alerts,
    (SELECT count(*) FROM evts WHERE blocked) AS block_decisions,
    (SELECT prediction_label FROM evts ORDER BY event_us DESC, event_id DESC LIMIT 1)
      AS last_predicted_label,
    (SELECT risk_score FROM evts ORDER BY event_us DESC, event_id DESC LIMIT 1)
      AS last_confidence,
    (SELECT max(event_us) FROM evts) AS last_event_us,
    (SELECT max(event_us) FROM alerts) AS last_alert_us,
    (SELECT round((max(event_us) - min(event_us)) / 1000000, 3) FROM evts) AS uptime_seconds,
    (SELECT count(*) FROM parsed WHERE reason IS NULL) AS packets_captured,
    (SELECT count(*) FROM parsed WHERE reason IS NOT NULL) AS packets_ignored)"""
_WITH_STATUS = _with(
    _packets(), _LINES, _CAPTURES, _CAPTURE_FLOWS, _SCORED, _DETECTED, _STATUS
)
ORACLES["runtime_status"] = _WITH_STATUS + "SELECT * FROM status_row"
ORACLES["overview_kpis"] = (
    _WITH_STATUS
    + """SELECT replace(format('{:,}', finalized_flows), ',', ' ') AS finalized_flows,
  replace(format('{:,}', alerts), ',', ' ') AS alerts,
  replace(format('{:,}', block_decisions), ',', ' ') AS blocking,
  replace(printf('%.1f', alerts / predictions * 100), '.', ',') || ' %' AS suspect_rate
FROM status_row"""
)
ORACLES["alert_kpis"] = (
    _WITH_RECORDS
    + """SELECT count(*) FILTER (severity = 'critical') AS critical_count,
  count(*) FILTER (severity = 'high') AS high_count,
  count(*) FILTER (severity = 'medium') AS medium_count,
  count(DISTINCT src_ip) AS unique_sources,
  (SELECT alert_id FROM alerts ORDER BY event_us DESC, alert_id DESC LIMIT 1) AS recent_alert_id
FROM alerts"""
)
ORACLES["severity_histogram"] = (
    _WITH_VIEWS + "SELECT severity, count(*) AS alert_count FROM alerts_view GROUP BY ALL"
)
ORACLES["event_kpis"] = (
    _WITH_VIEWS
    + """SELECT count(*) FILTER (label = 'Normal') AS normal_count,
  count(*) FILTER (label = 'Suspect') AS suspect_count,
  coalesce(printf('%.2f', CAST(sum(CAST(score AS DECIMAL(10,2))) FILTER (label = 'Suspect')
    AS DOUBLE) / count(*) FILTER (label = 'Suspect')), '0.00') AS mean_suspect_score,
  count(DISTINCT protocol) AS protocol_count
FROM events_view"""
)
ORACLES["journal_kpis"] = (
    _WITH_VIEWS
    + """SELECT count(*) AS line_count, count(*) FILTER (level = 'INFO') AS info_count,
  count(*) FILTER (level IN ('ALERTE', 'SUSPECT')) AS alert_count,
  count(*) FILTER (level = 'BLOCAGE') AS blocking_count FROM journal"""
)
ORACLES["level_histogram"] = (
    _WITH_VIEWS + "SELECT level, count(*) AS line_count FROM journal GROUP BY ALL"
)
ORACLES["flow_segments"] = (
    _WITH_MEMBERS
    + """SELECT seq, start_seq AS flow_start_seq, start_us AS flow_start_us, gap_us,
  row_number() OVER (PARTITION BY kid, start_seq ORDER BY rn DESC) = 1 AS is_last FROM members"""
)
ORACLES["flow_segments_by_capture"] = (
    _with(_packets("'CAP-' || (u % 4)"), _KEYED, _WALK, recursive=True)
    + "SELECT capture_id, seq, start_seq AS flow_start_seq FROM members"
)
ORACLES["flow_ids"] = (
    _WITH_IDS + "SELECT flow_id, flow_index, start_seq AS flow_start_seq FROM ids"
)
ORACLES["conn_rate"] = (
    _WITH_FEATURES + "SELECT flow_id, connections_per_1s, connections_per_5s FROM features"
)
ORACLES["distinct_ports_5s"] = (
    _WITH_FEATURES + "SELECT flow_id, distinct_dst_ports_per_5s FROM features"
)
ORACLES["distinct_ips_5s"] = (
    _WITH_FEATURES + "SELECT flow_id, distinct_dst_ips_per_5s FROM features"
)
ORACLES["icmp_rate"] = _WITH_FEATURES + "SELECT flow_id, icmp_packets_per_1s FROM features"
ORACLES["capture_cap"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _PLAN, _CAPS, _capped("labeled"))
    + "SELECT flow_id, capture_id, scenario_id FROM capped"
)
ORACLES["capture_cap_audit"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _PLAN, _CAPS)
    + """SELECT capture_id, scenario_id, scenario_family, label_binary,
  count(*) AS original_flow_count, least(count(*), cap) AS capped_flow_count, cap AS cap_applied
FROM labeled LEFT JOIN caps USING (scenario_id)
GROUP BY capture_id, scenario_id, scenario_family, label_binary, cap"""
)
ORACLES["balance_labels"] = (
    _with(_CAPTURES, _CAPTURE_FLOWS, _PLAN, _CAPS, _capped("labeled"))
    + "SELECT flow_id, label_binary FROM balanced"
)
ORACLES["split_plan_by_label"] = (
    _with(_CAPTURES, _plan("captures", "label_binary", "campaign_id, scenario_id, capture_id"))
    + "SELECT capture_id, label_binary, split FROM plan"
)
ORACLES["split_plan_by_scenario"] = (
    _WITH_PLAN + "SELECT capture_id, scenario_id, split FROM plan"
)
ORACLES["flow_order"] = (
    _WITH_LABELED
    + "SELECT flow_id, start_us, end_us FROM labeled ORDER BY start_us, end_us, flow_id"
)
ORACLES["latest_alerts"] = (
    _WITH_RECORDS
    + """SELECT alert_id, event_us, severity, count(*) OVER () AS total_available
FROM alerts ORDER BY event_us DESC, alert_id LIMIT 100"""
)
ORACLES["overview_feed"] = (
    _WITH_VIEWS + "SELECT * FROM events_view ORDER BY event_us DESC, event_id LIMIT 6"
)
ORACLES["journal"] = _WITH_VIEWS + "SELECT * FROM journal ORDER BY event_us DESC"
ORACLES["journal_filtered"] = _WITH_VIEWS + "SELECT * FROM journal WHERE level = 'ALERTE'"
ORACLES["runtime_log_feed"] = (
    _WITH_RECORDS
    + f"""SELECT event_us, {_TIME} AS time, level, component AS type, message FROM logs
WHERE category = 'blocking' ORDER BY event_us DESC, message LIMIT 12"""
)
ORACLES["blocking_feed"] = (
    _WITH_RECORDS
    + f"""SELECT block_id, event_us, {_TIME} AS time, src_ip AS source, dst_ip AS destination,
  upper(protocol) AS protocol, printf('%.2f', confidence) AS confidence,
  CASE WHEN triggered THEN 'Blocage' ELSE 'Alerte' END AS action,
  {_status('status')} AS status FROM blocks"""
)
ORACLES["events_filtered"] = (
    _WITH_VIEWS
    + """SELECT * FROM events_view
WHERE label = 'Normal' AND protocol = 'TCP' AND CAST(score AS DOUBLE) >= 0.9::DOUBLE"""
)
ORACLES["alerts_filtered"] = (
    _WITH_VIEWS + "SELECT * FROM alerts_view WHERE severity = 'Critique'"
)
ORACLES["alert_pulse"] = (
    _WITH_RECORDS
    + """SELECT count(*) AS total_available,
  count(*) FILTER (alert_created_us > epoch_us(TIMESTAMP '1999-01-01')) AS new_alert_count,
  (SELECT alert_id FROM alerts ORDER BY event_us DESC, alert_id DESC LIMIT 1) AS latest_alert_id
FROM alerts"""
)
ORACLES["blocking_history"] = (
    _WITH_RECORDS
    + "SELECT flow_id, raw_label, predicted_label FROM records WHERE raw_label = 'suspect'"
)
ORACLES["failed_ratio"] = (
    _WITH_FLOWS + "SELECT start_seq AS flow_start_seq, failed_connection_ratio FROM described"
)
ORACLES["scenario_defaults"] = (
    _with(_CAPTURES, _SCENARIOS)
    + """SELECT capture_id, scenario_id, coalesce(family, 'unknown') AS family, level AS severity
FROM captures LEFT JOIN scenarios USING (scenario_id)"""
)
ORACLES["event_severity"] = _WITH_RECORDS + "SELECT event_id, severity FROM evts"
ORACLES["attack_type"] = (
    _WITH_RECORDS
    + """SELECT event_id, attack_type, derived_type
FROM evts JOIN records ON evts.event_id = records.flow_id"""
)
ORACLES["tcp_flags"] = _WITH_RECORDS + "SELECT event_id, tcp_flags FROM evts"
ORACLES["event_status"] = (
    _WITH_RECORDS + "SELECT event_id, action_taken, status, blocked FROM evts"
)
ORACLES["rule_preview"] = (
    _WITH_RECORDS + "SELECT flow_id, rule_text AS command_preview FROM records"
)
ORACLES["alert_latency"] = (
    _WITH_RECORDS
    + "SELECT alert_id, latency_from_flow_end_ms, latency_from_finalization_ms FROM alerts"
)
ORACLES["format_metrics"] = (
    _WITH_SCORED
    + """SELECT flow_id, replace(format('{:,}', byte_count_total * 1000), ',', ' ') AS bytes,
  CASE WHEN packet_count_total - 1 > 0 THEN
    replace(printf('%.1f', p_milli / (packet_count_total - 1) * 100), '.', ',') ELSE '0,0' END
    || ' %' AS share,
  printf('%.2f', p_milli / 1000) AS score, strftime(make_timestamp(end_us), '%H:%M:%S') AS time,
  printf('%02d:%02d:%02d', byte_count_total * 7 // 3600, byte_count_total * 7 % 3600 // 60,
    byte_count_total * 7 % 60) AS duration
FROM scored"""
)
ORACLES["display_labels"] = (
    _WITH_RECORDS
    + f"""SELECT event_id, {_label('prediction_label')} AS label, {_severity('severity')} AS severity,
  {_action('action_taken')} AS action, {_status("' ' || upper(status)")} AS status,
  CASE WHEN protocol = 'UDP' THEN '-' ELSE protocol END AS protocol,
  {_named(V.RUNTIME_STATUS, 'status', 'INCONNU', 'upper(status)')} AS runtime
FROM evts"""
)
ORACLES["alert_threshold"] = (
    _WITH_RECORDS
    + "SELECT flow_id, raw_label, predicted_label, confidence, alert_triggered FROM records"
)
ORACLES["block_decision"] = (
    _WITH_RECORDS
    + """SELECT flow_id, triggered AS block_threshold_met, 'blk-' || md5(flow_id) AS block_id,
  triggered, 'dry_run' AS mode, predicted_label, confidence, 'live_runtime' AS threshold_source,
  reason, src_ip AS source_ip, dst_ip AS destination_ip, src_port AS source_port,
  dst_port AS destination_port, protocol, event_us AS created_us,
  CASE WHEN alert_triggered THEN rule_text END AS command_preview
FROM records"""
)
ORACLES["event_records"] = _WITH_RECORDS + "SELECT * FROM evts"
ORACLES["alert_records"] = _WITH_RECORDS + "SELECT * FROM alerts"
ORACLES["blocking_records"] = _WITH_RECORDS + "SELECT * FROM blocks"
ORACLES["log_records"] = _WITH_RECORDS + "SELECT * FROM logs"
ORACLES["impute_features"] = (
    _with(
        _CAPTURES,
        _CAPTURE_FLOWS,
        _SCORED,
        """
holes AS (
  SELECT flow_id, CASE WHEN p_milli % 7 <> 0 THEN p_milli END AS p_milli, finalized_us, src_ip
  FROM scored)""",
    )
    + """SELECT flow_id,
  CAST(coalesce(p_milli, (SELECT median(p_milli) FROM holes)) AS DOUBLE) AS p_milli,
  CAST(coalesce(finalized_us, (SELECT median(finalized_us) FROM holes)) AS DOUBLE)
    AS finalized_us,
  coalesce(src_ip, (SELECT src_ip FROM holes WHERE src_ip IS NOT NULL GROUP BY src_ip
    ORDER BY count(*) DESC, src_ip LIMIT 1)) AS src_ip
FROM holes"""
)
ORACLES["blocking_evaluation"] = (
    _WITH_RECORDS
    + f"""SELECT flow_id, raw_label = 'suspect' AS triggered,
  CASE WHEN raw_label = 'suspect' THEN 'dry_run' ELSE 'enforce' END AS mode,
  CASE WHEN p_milli % 2 = 0 THEN 0.5::DOUBLE WHEN raw_label = 'suspect' THEN p
    ELSE 1::DOUBLE - p END AS confidence,
  CASE WHEN raw_label = 'suspect' THEN '{V.REASON_NOT_ENFORCED}' ELSE '{V.REASON_NOT_SUSPECT}' END
    AS reason,
  CASE WHEN raw_label = 'suspect' THEN rule_text END AS command_preview
FROM records"""
)
ORACLES["stream_packets"] = (
    _with(_packets(), _LINES)
    + "SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS line_count FROM parsed GROUP BY 1"
)
ORACLES["stream_flows"] = ORACLES["flow_table"]
ORACLES["flow_segments_sliced"] = ORACLES["flow_table"]
ORACLES["flow_features_sliced"] = ORACLES["flow_features"]
ORACLES["written_tables"] = (
    _WITH_CAPTURES
    + """SELECT sink, scenario_id, capture_count
FROM (SELECT scenario_id, count(*) AS capture_count FROM captures GROUP BY scenario_id),
  (VALUES ('csv'), ('json'), ('history'), ('history')) AS sinks (sink)"""
)
ORACLES["stream_quiet"] = ORACLES["flow_table"]
# Packets are late by buckets of a quarter of a second.
ORACLES["stream_late_packets"] = (
    _WITH_PACKETS
    + """SELECT seq, ts_us, (SELECT count(*) + count(*) FILTER (seq % 50 = 0) FROM packets) AS packets_in_all
FROM packets
WHERE seq % 50 = 0 AND ts_us // 250000 < (SELECT (max(ts_us) // 1000 - 5000) * 1000 // 250000 FROM packets)"""
)
ORACLES["stream_windows"] = (
    _WITH_PACKETS
    + """, probes AS (SELECT * FROM packets WHERE protocol = 'TCP')
SELECT a.seq, a.ts_us AS start_us, a.src_ip,
  count(*) FILTER (a.ts_us - b.ts_us <= 1000000) AS connections_per_1s, count(*) AS connections_per_5s,
  count(DISTINCT b.dst_port) AS distinct_dst_ports_per_5s, count(DISTINCT b.dst_ip) AS distinct_dst_ips_per_5s,
  CAST(0 AS BIGINT) AS icmp_packets_per_1s, CAST(1.0 AS DOUBLE) AS failed_connection_ratio
FROM probes a JOIN probes b ON a.src_ip = b.src_ip AND a.ts_us - b.ts_us BETWEEN 0 AND 5000000
  AND (b.ts_us < a.ts_us OR b.seq <= a.seq)
GROUP BY a.seq, a.ts_us, a.src_ip"""
)
ORACLES["stream_history"] = (
    _WITH_FLOWS
    + """SELECT count(*) AS finalized_flows, count(*) AS predictions, count(*) FILTER (m >= 950) AS alerts,
  count(*) FILTER (m >= 990) AS block_decisions, CAST(0 AS BIGINT) AS late_packets,
  CAST(5 AS BIGINT) AS newest, count(*) AS total_available, count(*) AS events, TRUE AS few_folders
FROM (SELECT bytes % 1001 AS m FROM described)"""
)
ORACLES["stream_detection"] = (
    _WITH_FLOWS
    + """SELECT count(*) AS predictions, count(*) FILTER (m >= 950) AS alerts,
  count(*) FILTER (m >= 990) AS block_decisions, count(*) FILTER (m >= 950) AS alert_records,
  count(*) FILTER (m >= 500) AS block_records, count(*) AS total_flows,
  count(*) FILTER (m >= 950) AS total_alerts
FROM (SELECT bytes % 1001 AS m FROM described)"""
)
ORACLES["stream_replay"] = (
    _WITH_LABELED
    + """SELECT CASE WHEN p_milli >= 500 THEN 'suspect' ELSE 'normal' END AS prediction_label,
  CASE WHEN p_milli >= 500 THEN 'blocked' ELSE 'closed' END AS status, count(*) AS event_count
FROM labeled GROUP BY ALL"""
)
