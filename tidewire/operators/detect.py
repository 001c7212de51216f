"""Scored flows to decisions, and decisions to event, alert and blocking records.

Input rows need ``raw_label`` and ``probability`` (map of label to probability), as
:func:`tidewire.operators.model.score` produces them. All steps are projections and
filters: no shuffle, and the same code runs on a batch and on a stream. Record ids are
hashes of the flow id, so that a retried task or a replayed micro-batch writes the
same ids again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import decisions as D
from tidewire.functions import display
from tidewire.functions.network import rule_preview, tcp_flags
from tidewire.operators.sampling import FLOW_ORDER
from tidewire.schemas import BLOCKING_MODES, POSITIVE_LABEL

# Texts of records and logs.
ALERT_TEXT = "Suspect flow detected from %s to %s over %s."
DETECTION_TEXT = "Suspect flow detected from %s to %s (%s)."
BLOCKING_TEXT = "Blocking decision triggered for %s to %s in %s mode."

# Record columns a flow may lack, with the type its null gets.
_OPTIONAL = {
    "src_ip": "string",
    "dst_ip": "string",
    "src_port": "long",
    "dst_port": "long",
    "protocol": "string",
    "scenario_family": "string",
    "label_family": "string",
    "severity": "string",
    "packet_count_total": "long",
    "byte_count_total": "long",
    "duration_ms": "double",
    "syn_count": "long",
    "ack_count": "long",
    "rst_count": "long",
    "fin_count": "long",
    "psh_count": "long",
    "urg_count": "long",
    "start_us": "long",
    "end_us": "long",
    "finalized_us": "long",
}


def _complete(df: DataFrame) -> DataFrame:
    missing = {c: F.lit(None).cast(t) for c, t in _OPTIONAL.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def detect(
    scored: DataFrame,
    *,
    alert_threshold: float | None = None,
    block_threshold: float | None = None,
    mode: str = "dry_run",
    threshold_source: str | None = None,
    decided_us: Column | None = None,
) -> DataFrame:
    """Add the final label, the alert flag and the blocking decision (a struct)."""
    if mode not in BLOCKING_MODES:
        raise ValueError(f"unknown blocking mode: {mode}")
    decided = F.unix_micros(F.current_timestamp()) if decided_us is None else decided_us
    raw, probability = F.col("raw_label"), F.col("probability")
    rows = _complete(scored).select(
        "*",
        D.apply_alert_threshold(raw, probability, alert_threshold).alias("predicted_label"),
        D.confidence(probability, raw).alias("confidence"),
        decided.alias("decided_us"),
    )
    label = F.col("predicted_label")
    rows = rows.select(
        "*",
        F.coalesce(label == POSITIVE_LABEL, F.lit(False)).alias("alert_triggered"),
        D.meets_block_threshold(label, probability, block_threshold).alias("block_threshold_met"),
    )
    return rows.withColumn("blocking", _blocking_decision(mode, threshold_source))


def _blocking_decision(mode: str, threshold_source: str | None) -> Column:
    """The decision struct, from the flow's label, alert flag and threshold result."""
    suspect, met = F.col("alert_triggered"), F.col("block_threshold_met")
    # Enforcing is never carried out, so a would-be enforced block is a dry run.
    effective_mode = F.lit(mode)
    if mode == "enforce":
        effective_mode = F.when(suspect & met, "dry_run").otherwise(mode)
    preview = rule_preview(
        F.col("src_ip"), F.col("dst_ip"), F.col("protocol"), F.col("src_port"), F.col("dst_port")
    )
    return F.struct(
        F.concat(F.lit("blk-"), F.md5(F.col("flow_id"))).alias("block_id"),
        (suspect & met).alias("triggered"),
        effective_mode.alias("mode"),
        F.col("predicted_label").alias("predicted_label"),
        F.col("confidence").alias("confidence"),
        F.lit(threshold_source).cast("string").alias("threshold_source"),
        D.block_reason(suspect, met, mode).alias("reason"),
        F.col("src_ip").alias("source_ip"),
        F.col("dst_ip").alias("destination_ip"),
        F.col("src_port").cast("long").alias("source_port"),
        F.col("dst_port").cast("long").alias("destination_port"),
        F.col("protocol").alias("protocol"),
        F.col("decided_us").alias("created_us"),
        F.when(suspect, preview).alias("command_preview"),
    )


def evaluate_blocking(
    requests: DataFrame, *, mode: str = "dry_run", decided_us: Column | None = None
) -> DataFrame:
    """Blocking decisions for labels that were decided elsewhere.

    A missing confidence is looked up in the request's probabilities; no threshold
    applies.
    """
    if mode not in BLOCKING_MODES:
        raise ValueError(f"unknown blocking mode: {mode}")
    decided = F.unix_micros(F.current_timestamp()) if decided_us is None else decided_us
    label = F.col("predicted_label")
    known = F.coalesce("confidence", D.confidence(F.col("probability"), label))
    rows = _complete(requests).withColumns(
        {
            "confidence": known,
            "decided_us": decided,
            "alert_triggered": F.coalesce(label == POSITIVE_LABEL, F.lit(False)),
            "block_threshold_met": F.lit(True),
        }
    )
    return rows.withColumn("blocking", _blocking_decision(mode, None))


def _attack_type(family_hint: bool) -> Column:
    nothing = F.lit(None).cast("string")
    return D.attack_type(
        F.col("scenario_family") if family_hint else nothing,
        F.col("label_family") if family_hint else nothing,
        F.col("protocol"),
        F.col("predicted_label"),
        F.col("syn_count"),
        F.col("rst_count"),
    )


def attack_types(detected: DataFrame) -> DataFrame:
    """The attack type of every flow, with and without what its families say."""
    return _complete(detected).select(
        F.col("flow_id").alias("event_id"),
        _attack_type(True).alias("attack_type"),
        _attack_type(False).alias("derived_type"),
    )


def event_records(detected: DataFrame, family_hint: bool = True) -> DataFrame:
    """One flat record per decided flow.

    ``family_hint`` lets a known scenario or label family name the attack type. A live
    stream, whose flows all carry the family ``live``, switches it off to get the
    derived type.
    """
    df = _complete(detected)
    triggered, alert = F.col("blocking.triggered"), F.col("alert_triggered")
    flags = {n: F.col(f"{n.lower()}_count") for n in ("SYN", "ACK", "FIN", "RST", "PSH", "URG")}
    return df.select(
        F.col("flow_id").alias("event_id"),
        F.col("decided_us").alias("event_us"),
        D.safe_text(F.col("src_ip"), "unknown").alias("src_ip"),
        D.safe_text(F.col("dst_ip"), "unknown").alias("dst_ip"),
        "src_port",
        "dst_port",
        D.safe_text(F.col("protocol"), "IP").alias("protocol"),
        F.coalesce("packet_count_total", F.lit(0)).alias("packet_count"),
        F.coalesce("byte_count_total", F.lit(0)).alias("byte_count"),
        F.coalesce("duration_ms", F.lit(0.0)).alias("duration_ms"),
        tcp_flags(flags).alias("tcp_flags"),
        F.col("predicted_label").alias("prediction_label"),
        F.col("raw_label").alias("raw_prediction_label"),
        F.col("confidence").alias("risk_score"),
        D.severity(F.col("severity"), F.col("confidence"), alert, triggered).alias("severity"),
        _attack_type(family_hint).alias("attack_type"),
        D.action_taken(triggered, alert, F.col("blocking.mode")).alias("action_taken"),
        D.event_status(triggered, alert).alias("status"),
        triggered.alias("blocked"),
        F.col("flow_id"),
        alert.alias("alert_triggered"),
        "start_us",
        "end_us",
        "finalized_us",
    )


def alert_records(events: DataFrame, created_us: Column | None = None) -> DataFrame:
    """One record per alerting event, with its latencies."""
    created = F.unix_micros(F.current_timestamp()) if created_us is None else created_us
    alerts = events.where("alert_triggered").withColumn("alert_created_us", created)
    return alerts.select(
        F.concat(F.lit("alt-"), F.md5(F.col("event_id"))).alias("alert_id"),
        "event_us",
        "attack_type",
        "severity",
        "src_ip",
        "dst_ip",
        F.format_string(ALERT_TEXT, "src_ip", "dst_ip", "protocol").alias("description"),
        F.lit(D.RECOMMENDATION).alias("recommendation"),
        "action_taken",
        F.when(F.col("blocked"), "escalated").otherwise("open").alias("status"),
        "risk_score",
        F.col("start_us").alias("flow_started_us"),
        F.col("end_us").alias("flow_ended_us"),
        F.col("finalized_us").alias("flow_finalized_us"),
        F.col("event_us").alias("prediction_done_us"),
        "alert_created_us",
        D.latency_ms(F.col("end_us"), F.col("alert_created_us")).alias("latency_from_flow_end_ms"),
        D.latency_ms(F.col("finalized_us"), F.col("alert_created_us")).alias(
            "latency_from_finalization_ms"
        ),
    )


def in_blocking_history() -> Column:
    return (
        (F.col("raw_label") == POSITIVE_LABEL)
        | F.col("alert_triggered")
        | F.col("blocking.triggered")
    )


def blocking_records(detected: DataFrame) -> DataFrame:
    """Blocking decisions of every flow the model or the threshold found suspect."""
    df = _complete(detected).where(in_blocking_history())
    return df.select(
        F.col("blocking.block_id").alias("block_id"),
        F.col("blocking.created_us").alias("event_us"),
        D.safe_text(F.col("src_ip"), "unknown").alias("src_ip"),
        D.safe_text(F.col("dst_ip"), "unknown").alias("dst_ip"),
        F.col("blocking.source_port").alias("src_port"),
        F.col("blocking.destination_port").alias("dst_port"),
        D.safe_text(F.col("protocol"), "IP").alias("protocol"),
        "predicted_label",
        "confidence",
        F.col("blocking.reason").alias("reason"),
        F.col("blocking.mode").alias("mode"),
        F.col("blocking.triggered").alias("triggered"),
        F.col("blocking.command_preview").alias("command_preview"),
        D.blocking_status(F.col("blocking.triggered"), F.col("blocking.mode")).alias("status"),
    )


def log_records(detected: DataFrame, events: DataFrame) -> DataFrame:
    """Log lines of alerts and triggered blocks."""
    shape = ["event_us", "level", "component", "message", "category"]
    alerts = events.where("alert_triggered").select(
        "event_us",
        F.lit("WARNING").alias("level"),
        F.lit("detection_service").alias("component"),
        F.format_string(DETECTION_TEXT, "src_ip", "dst_ip", "attack_type").alias("message"),
        F.lit("detection").alias("category"),
    )
    blocks = blocking_records(detected).where("triggered").select(
        "event_us",
        F.lit("WARNING").alias("level"),
        F.lit("blocking_service").alias("component"),
        F.format_string(BLOCKING_TEXT, "src_ip", "dst_ip", "mode").alias("message"),
        F.lit("blocking").alias("category"),
    )
    return alerts.select(*shape).unionByName(blocks.select(*shape))


def journal_lines(detected: DataFrame) -> DataFrame:
    """The journal of decided flows in one pass: up to five lines per flow.

    The same lines as :func:`tidewire.operators.views.journal` makes of stored records.
    """
    df = _complete(detected)
    alert, block = F.col("alert_triggered"), F.col("blocking.triggered")
    src, dst = D.safe_text(F.col("src_ip"), "unknown"), D.safe_text(F.col("dst_ip"), "unknown")
    protocol = D.safe_text(F.col("protocol"), "IP")
    decided, blocked = F.col("decided_us"), F.col("blocking.created_us")
    label = display.label(F.col("predicted_label"))

    def line(at: Column, level: str | Column, kind: str, message: Column) -> Column:
        shown = F.lit(level) if isinstance(level, str) else level
        return F.struct(at.alias("event_us"), shown.alias("level"), F.lit(kind).alias("type"), message.alias("message"))

    def text(form: str, *parts: Column) -> Column:
        return F.format_string(form, *parts)

    lines = F.array(
        line(
            decided,
            F.when(label == "Normal", "NORMAL").otherwise("SUSPECT"),
            "Prediction",
            text("%s %s %s -> %s", label, display.protocol(protocol), src, dst),
        ),
        F.when(alert, line(decided, "WARNING", "Detection", text(DETECTION_TEXT, src, dst, _attack_type(True)))),
        F.when(alert, line(decided, "ALERTE", "Detection", text(ALERT_TEXT, src, dst, protocol))),
        F.when(
            in_blocking_history(),
            line(blocked, F.when(block, "BLOCAGE").otherwise("ACTION"), "Action", F.coalesce("blocking.reason", F.lit("-"))),
        ),
        F.when(
            in_blocking_history() & block,
            line(blocked, "WARNING", "Blocking", text(BLOCKING_TEXT, src, dst, F.col("blocking.mode"))),
        ),
    )
    return df.select(F.inline(F.filter(lines, lambda x: x.isNotNull())))


def replay_rows(flows: DataFrame, limit: int | None = None) -> DataFrame:
    """Flows of a split in replay order; with ``limit``, the first so many of them."""
    ordered = flows.orderBy(*FLOW_ORDER)
    return ordered if limit is None else ordered.limit(limit)


def replay_summary(detected: DataFrame) -> DataFrame:
    """Counters of a replayed split."""
    return detected.agg(
        F.count(F.lit(1)).alias("processed_events"),
        F.count_if(~F.col("alert_triggered")).alias("normal_count"),
        F.count_if("alert_triggered").alias("suspect_count"),
        F.count_if(F.col("blocking.triggered")).alias("block_decisions_count"),
    )
