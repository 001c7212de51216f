"""From a class probability to a decision, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.schemas import NEGATIVE_LABEL, POSITIVE_LABEL

# Reason texts.
REASON_NOT_SUSPECT = "no blocking action for non-suspect classification"
REASON_BELOW = "suspect classification below block confidence threshold"
REASON_SUSPECT = "post-flow-classification suspect decision"
REASON_NOT_ENFORCED = "Firewall enforcement is recorded only; no command is executed."
RECOMMENDATION = (
    "Review the source host, preserve flow evidence and keep prevention "
    "in dry_run unless the lab scenario explicitly requires enforcement."
)


def confidence(probability: Column, label: Column) -> Column:
    """Probability of the label; null without probabilities."""
    return F.try_element_at(probability, label)


def best_other_label(probability: Column) -> Column:
    """Most probable label that is not the positive one; ``normal`` when there is none.

    Equal probabilities go to the label the map lists first, hence ``reduce`` with a
    strict comparison instead of a sort.
    """
    others = F.filter(F.map_entries(probability), lambda e: e["key"] != POSITIVE_LABEL)
    none = F.lit(None).cast("struct<key:string,value:double>")
    best = F.reduce(
        others,
        none,
        lambda kept, e: F.when(kept.isNull() | (e["value"] > kept["value"]), e).otherwise(kept),
    )
    return F.coalesce(best["key"], F.lit(NEGATIVE_LABEL))


def _positive_probability(probability: Column) -> Column:
    return F.coalesce(F.try_element_at(probability, F.lit(POSITIVE_LABEL)), F.lit(0.0))


def apply_alert_threshold(raw_label: Column, probability: Column, threshold: float | None) -> Column:
    """A suspect below the threshold falls back to its best other label."""
    if threshold is None:
        return raw_label
    weak = (
        (raw_label == POSITIVE_LABEL)
        & probability.isNotNull()
        & (_positive_probability(probability) < threshold)
    )
    return F.when(weak, best_other_label(probability)).otherwise(raw_label)


def meets_block_threshold(label: Column, probability: Column, threshold: float | None) -> Column:
    suspect = F.coalesce(label == POSITIVE_LABEL, F.lit(False))
    if threshold is None:
        return suspect
    return suspect & (probability.isNull() | (_positive_probability(probability) >= threshold))


def block_reason(suspect: Column, threshold_met: Column, mode: str) -> Column:
    enforced = REASON_NOT_ENFORCED if mode == "enforce" else REASON_SUSPECT
    return (
        F.when(~suspect, REASON_NOT_SUSPECT)
        .when(~threshold_met, REASON_BELOW)
        .otherwise(enforced)
    )


def severity(own: Column, conf: Column, alert: Column, triggered: Column) -> Column:
    """The record's own severity, else one by confidence."""
    level = F.coalesce(conf, F.lit(0.0))
    derived = (
        F.when(~alert, "normal")
        .when(triggered | (level >= 0.99), "critical")
        .when(level >= 0.95, "high")
        .when(level >= 0.80, "medium")
        .otherwise("low")
    )
    return F.coalesce(F.nullif(own, F.lit("")), derived)


def attack_type(
    scenario_family: Column,
    label_family: Column,
    protocol: Column,
    label: Column,
    syn: Column,
    rst: Column,
) -> Column:
    """Known family first, else what protocol and flags suggest."""
    proto = F.lower(F.coalesce(F.nullif(protocol, F.lit("")), F.lit("ip")))
    handshake = (F.coalesce(syn, F.lit(0)) > 0) & (F.coalesce(rst, F.lit(0)) > 0)
    derived = (
        F.when(label != POSITIVE_LABEL, F.concat(F.lit("benign_"), proto))
        .when((proto == "tcp") & handshake, "syn_burst")
        .when(proto == "icmp", "icmp_anomaly")
        .when(proto == "udp", "udp_anomaly")
        .otherwise("suspect_flow")
    )
    empty = F.lit("")
    return F.coalesce(F.nullif(scenario_family, empty), F.nullif(label_family, empty), derived)


def action_taken(triggered: Column, alert: Column, mode: Column) -> Column:
    return (
        F.when(triggered, F.concat(F.lit("block_"), mode))
        .when(alert, "alert_only")
        .otherwise("allow")
    )


def event_status(triggered: Column, alert: Column) -> Column:
    return F.when(triggered, "blocked").when(alert, "open").otherwise("closed")


def blocking_status(triggered: Column, mode: Column) -> Column:
    return (
        F.when(triggered & (mode == "enforce"), "executed")
        .when(triggered, "simulated")
        .otherwise("alert_only")
    )


def latency_ms(start_us: Column, end_us: Column) -> Column:
    """Null when either end is missing."""
    return F.round((end_us - start_us) / 1000, 3)


def safe_int(value: Column, default: int = 0) -> Column:
    """Whole number of a text or number, cut towards zero; the default for anything else."""
    number = F.trim(value.cast("string")).try_cast("double").try_cast("long")
    return F.coalesce(number, F.lit(default).cast("long"))


def safe_float(value: Column, default: float = 0.0) -> Column:
    """Finite or infinite number of a text or number; the default for anything else."""
    number = F.trim(value.cast("string")).try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(default))


def safe_text(value: Column, default: str | None = None) -> Column:
    text = F.nullif(F.trim(value.cast("string")), F.lit(""))
    return text if default is None else F.coalesce(text, F.lit(default))
