"""Feeds, filters and key figures over the record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import display

JOURNAL_COLUMNS = ["event_us", "level", "type", "message"]


def latest(records: DataFrame, n: int, at: str = "event_us", *ties: str) -> DataFrame:
    """Newest ``n`` records: each task keeps its own top n, one merges them."""
    return records.orderBy(F.desc_nulls_last(at), *ties).limit(n)


def latest_with_total(records: DataFrame, n: int, *ties: str) -> DataFrame:
    """Newest ``n`` records, with the number of all records."""
    total = records.agg(F.count(F.lit(1))).scalar()
    return latest(records, n, "event_us", *ties).withColumn("total_available", total)


def events_view(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "event_us",
        display.clock(F.col("event_us")).alias("time"),
        display.label(F.col("prediction_label")).alias("label"),
        display.score(F.col("risk_score")).alias("score"),
        display.protocol(F.col("protocol")).alias("protocol"),
        F.col("src_ip").alias("source"),
        F.col("dst_ip").alias("destination"),
        "src_port",
        "dst_port",
        display.action(F.col("action_taken")).alias("action"),
        display.event_status(F.col("status")).alias("status"),
    )


def alerts_view(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "alert_id",
        "event_us",
        display.clock(F.col("event_us")).alias("time"),
        display.severity(F.col("severity")).alias("severity"),
        F.coalesce("attack_type", F.lit("-")).alias("type"),
        F.col("src_ip").alias("source"),
        F.col("dst_ip").alias("destination"),
        display.action(F.col("action_taken")).alias("action"),
        display.event_status(F.col("status")).alias("status"),
        display.score(F.col("risk_score")).alias("score"),
    )


def blocking_view(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        "block_id",
        "event_us",
        display.clock(F.col("event_us")).alias("time"),
        F.col("src_ip").alias("source"),
        F.col("dst_ip").alias("destination"),
        display.protocol(F.col("protocol")).alias("protocol"),
        display.score(F.col("confidence")).alias("confidence"),
        F.when(F.col("triggered"), "Blocage").otherwise("Alerte").alias("action"),
        display.event_status(F.col("status")).alias("status"),
    )


def logs_view(logs: DataFrame, categories: list[str] | None = None) -> DataFrame:
    kept = logs
    if categories is not None:
        kept = logs.where(F.lower("category").isin(*categories))
    return kept.select(
        "event_us",
        display.clock(F.col("event_us")).alias("time"),
        F.upper(F.coalesce("level", F.lit("INFO"))).alias("level"),
        F.coalesce("component", F.lit("-")).alias("type"),
        F.coalesce("message", F.lit("-")).alias("message"),
    )


def filter_events(
    view: DataFrame,
    label: str | None = None,
    protocol: str | None = None,
    minimum_score: float = 0.0,
) -> DataFrame:
    """Events by label, protocol and score; a score that is not a number counts as zero."""
    number = F.coalesce(F.col("score").try_cast("double"), F.lit(0.0))
    kept = view.where(number >= minimum_score)
    if label is not None:
        kept = kept.where(F.col("label") == label)
    if protocol is not None:
        kept = kept.where(F.col("protocol") == protocol)
    return kept


def filter_alerts(view: DataFrame, severity: str | None = None) -> DataFrame:
    return view if severity is None else view.where(F.col("severity") == severity)


def filter_journal(journal: DataFrame, level: str | None = None) -> DataFrame:
    return journal if level is None else journal.where(F.col("level") == level)


def journal(
    events: DataFrame, alerts: DataFrame, blocks: DataFrame, logs: DataFrame
) -> DataFrame:
    """Logs, predictions, alerts and block decisions as one list of lines."""
    label = display.label(F.col("prediction_label"))
    dash = F.lit("-")
    parts = [
        logs.select(
            "event_us",
            F.upper(F.coalesce("level", F.lit("INFO"))).alias("level"),
            F.initcap(F.coalesce("category", F.lit("runtime"))).alias("type"),
            F.coalesce("message", dash).alias("message"),
        ),
        events.select(
            "event_us",
            F.when(label == "Normal", "NORMAL").otherwise("SUSPECT").alias("level"),
            F.lit("Prediction").alias("type"),
            F.format_string(
                "%s %s %s -> %s",
                label,
                display.protocol(F.col("protocol")),
                F.coalesce("src_ip", dash),
                F.coalesce("dst_ip", dash),
            ).alias("message"),
        ),
        alerts.select(
            "event_us",
            F.lit("ALERTE").alias("level"),
            F.lit("Detection").alias("type"),
            F.coalesce("description", dash).alias("message"),
        ),
        blocks.select(
            "event_us",
            F.when(F.col("triggered"), "BLOCAGE").otherwise("ACTION").alias("level"),
            F.lit("Action").alias("type"),
            F.coalesce("reason", dash).alias("message"),
        ),
    ]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return lines


def journal_kpis(lines: DataFrame) -> DataFrame:
    return lines.agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col("level") == "INFO").alias("info_count"),
        F.count_if(F.col("level").isin("ALERTE", "SUSPECT")).alias("alert_count"),
        F.count_if(F.col("level") == "BLOCAGE").alias("blocking_count"),
    )


def level_histogram(lines: DataFrame) -> DataFrame:
    return lines.groupBy("level").agg(F.count(F.lit(1)).alias("line_count"))


def severity_histogram(view: DataFrame) -> DataFrame:
    return view.groupBy("severity").agg(F.count(F.lit(1)).alias("alert_count"))


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """Counts by severity, distinct sources and the newest alert."""
    newest = F.struct("event_us", "alert_id")

    def count(level: str) -> Column:
        return F.count_if(F.lower(F.trim("severity")) == level)

    return alerts.agg(
        count("critical").alias("critical_count"),
        count("high").alias("high_count"),
        count("medium").alias("medium_count"),
        F.countDistinct("src_ip").alias("unique_sources"),
        F.max_by("alert_id", newest).alias("recent_alert_id"),
    )


def event_kpis(view: DataFrame) -> DataFrame:
    """Counts by label, mean of the displayed suspect scores, protocols seen."""
    number = F.col("score").try_cast("decimal(10,2)")
    suspect_score = F.when(F.col("label") == "Suspect", number)
    total, n = F.sum(suspect_score), F.count(suspect_score)
    mean = total.cast("double") / F.nullif(n, F.lit(0))
    return view.agg(
        F.count_if(F.col("label") == "Normal").alias("normal_count"),
        F.count_if(F.col("label") == "Suspect").alias("suspect_count"),
        F.coalesce(display.score(mean), F.lit("0.00")).alias("_mean"),
        F.countDistinct("protocol").alias("protocol_count"),
    ).select(
        "normal_count",
        "suspect_count",
        F.when(F.col("_mean") == "-", "0.00").otherwise(F.col("_mean")).alias("mean_suspect_score"),
        "protocol_count",
    )


def runtime_status(
    events: DataFrame, parsed_lines: DataFrame, running: bool = False, now_us: Column | None = None
) -> DataFrame:
    """Counters of a run and its latest label, confidence and times: one row.

    The run is up from its first event to its last, or to ``now_us`` while it is running.

    One pass over the events and one over the parsed lines; the two one-row results
    are stacked and folded into one row.
    """
    newest = F.struct("event_us", "event_id")
    decided = events.agg(
        F.count(F.lit(1)).alias("finalized_flows"),
        F.count(F.lit(1)).alias("predictions"),
        F.count_if("alert_triggered").alias("alerts"),
        F.count_if("blocked").alias("block_decisions"),
        F.max_by("prediction_label", newest).alias("last_predicted_label"),
        F.max_by("risk_score", newest).alias("last_confidence"),
        F.max("event_us").alias("last_event_us"),
        F.max(F.when(F.col("alert_triggered"), F.col("event_us"))).alias("last_alert_us"),
        uptime_seconds(
            F.min("event_us"),
            F.max("event_us"),
            F.lit(running),
            F.unix_micros(F.current_timestamp()) if now_us is None else now_us,
        ).alias("uptime_seconds"),
    )
    usable = F.col("reject_reason").isNull()
    lines = parsed_lines.agg(
        F.count_if(usable).alias("packets_captured"),
        F.count_if(~usable).alias("packets_ignored"),
    )
    both = decided.unionByName(lines, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def overview_kpis(status: DataFrame) -> DataFrame:
    return status.select(
        display.compact_number(F.col("finalized_flows")).alias("finalized_flows"),
        display.compact_number(F.col("alerts")).alias("alerts"),
        display.compact_number(F.col("block_decisions")).alias("blocking"),
        display.percent(F.col("alerts"), F.col("predictions")).alias("suspect_rate"),
    )


def uptime_seconds(
    started_us: Column, stopped_us: Column, running: Column, now_us: Column
) -> Column:
    end = F.when(running, now_us).otherwise(stopped_us)
    return F.coalesce(F.round((end - started_us) / 1_000_000, 3), F.lit(0.0))


def alert_pulse(alerts: DataFrame, since: str | None = None) -> DataFrame:
    """How many alerts are newer than a cursor, and the newest one.

    Without a cursor the answer is one when there is any alert. A cursor that is not a
    timestamp matches nothing.
    """
    newest = F.struct("event_us", "alert_id")
    at = F.coalesce("alert_created_us", "event_us")
    if since is None:
        fresh = F.least(F.count(F.lit(1)), F.lit(1))
    else:
        cursor = F.unix_micros(F.try_to_timestamp(F.lit(since)))
        fresh = F.count_if(at > cursor)
    return alerts.agg(
        F.count(F.lit(1)).alias("total_available"),
        fresh.alias("new_alert_count"),
        F.max_by("alert_id", newest).alias("latest_alert_id"),
    )
