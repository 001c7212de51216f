"""Capture labels: manifest lookup, scenario defaults, capture and campaign summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.schemas import (
    CAPTURE_SUMMARY_COLUMNS,
    EXCLUDED_STATUSES,
    IGNORED_CAMPAIGN_PREFIX,
    SCENARIOS,
)


def last_per_key(rows: DataFrame, key: str, position: list[str]) -> DataFrame:
    """One row per key: the last by position. Aggregates map-side, unlike a ranking."""
    rest = [c for c in rows.columns if c != key]
    latest = rows.groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct(*position)).alias("_last")
    )
    return latest.select(*[F.col(c) if c == key else F.col(f"_last.{c}") for c in rows.columns])


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def default_family(scenario: Column) -> Column:
    families = F.create_map(*[F.lit(v) for s, (f, _) in SCENARIOS.items() for v in (s, f)])
    return F.coalesce(F.try_element_at(families, scenario), F.lit("unknown"))


def default_severity(scenario: Column) -> Column:
    severities = F.create_map(
        *[F.lit(v) for s, (_, level) in SCENARIOS.items() if level for v in (s, level)]
    )
    return F.try_element_at(severities, scenario)


def scenario_labels(has_severity: bool) -> dict[str, Column]:
    """Label columns of a row that was left-joined to its manifest entry."""
    scenario = F.coalesce("scenario_id", F.lit("UNKNOWN"))
    severity = default_severity(scenario)
    if has_severity:
        severity = F.coalesce(blank_to_null(F.col("severity")), severity)
    family = F.coalesce(blank_to_null(F.col("scenario_family")), default_family(scenario))
    return {
        "scenario_id": scenario,
        "scenario_family": family,
        "label_binary": F.coalesce("label_binary", F.lit("unknown")),
        "label_family": family,
        "severity": severity,
    }


def label_flows(flows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Left-join flows to the manifest of their capture and fill the label columns.

    No broadcast hint: the manifest grows with the number of captures, so the join
    strategy is left to the measured size.
    """
    has_severity = "severity" in manifest.columns
    wanted = ["scenario_id", "scenario_family", "label_binary"]
    if has_severity:
        wanted.append("severity")
    plain = flows.drop("scenario_id", "scenario_family", "label_binary", "label_family", "severity")
    joined = plain.join(manifest.select("capture_id", *wanted), "capture_id", "left")
    return joined.select(
        *plain.columns,
        *[c.alias(name) for name, c in scenario_labels(has_severity).items()],
    )


def capture_summary(captures: DataFrame, packets: DataFrame, flows: DataFrame) -> DataFrame:
    """Packets kept and flows per capture; captures without any stay, with zero.

    ``captures`` is one row per capture left-joined to the manifest already.
    """
    packet_counts = packets.groupBy("capture_id").agg(
        F.count(F.lit(1)).alias("_packets")
    )
    flow_counts = flows.groupBy("capture_id").agg(F.count(F.lit(1)).alias("_flows"))
    joined = captures.join(packet_counts, "capture_id", "left").join(
        flow_counts, "capture_id", "left"
    )
    labels = scenario_labels(has_severity=False)
    filled = {
        "packet_count": F.coalesce("_packets", F.lit(0)),
        "flow_count": F.coalesce("_flows", F.lit(0)),
        "status": F.coalesce("status", F.lit("unknown")),
        **{k: labels[k] for k in ("scenario_id", "scenario_family", "label_binary")},
    }
    return joined.select(
        *[
            filled[c].alias(c) if c in filled else F.col(c)
            for c in CAPTURE_SUMMARY_COLUMNS
            if c in filled or c in joined.columns
        ]
    )


def campaign_stats(captures: DataFrame) -> DataFrame:
    """Captures, flows and captures per label of each campaign."""
    per_label = captures.groupBy("campaign_id", "label_binary").agg(
        F.count(F.lit(1)).alias("_captures"), F.sum("flow_count").alias("_flows")
    )
    labels = F.sort_array(F.collect_list(F.struct("label_binary", "_captures")))
    return per_label.groupBy("campaign_id").agg(
        F.sum("_captures").alias("capture_count"),
        F.sum("_flows").alias("flow_count"),
        F.map_from_entries(labels).alias("label_counts"),
    )


def usable_captures(captures: DataFrame) -> DataFrame:
    """Without failed captures and throw-away campaigns; a missing status is no failure."""
    empty = F.lit("")
    return captures.where(
        ~F.coalesce("status", empty).isin(*EXCLUDED_STATUSES)
        & ~F.coalesce("campaign_id", empty).startswith(IGNORED_CAMPAIGN_PREFIX)
    )


def excluded_captures(captures: DataFrame) -> DataFrame:
    """The complement of :func:`usable_captures`, as an anti join on the capture."""
    return captures.join(usable_captures(captures).select("capture_id"), "capture_id", "left_anti")


def flows_of_campaigns(flows: DataFrame, captures: DataFrame) -> DataFrame:
    """Flows whose campaign still has a usable capture."""
    allowed = usable_captures(captures).select("campaign_id").distinct()
    return flows.join(allowed, "campaign_id", "left_semi")
