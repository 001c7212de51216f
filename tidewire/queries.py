"""Every operator as a query over the driver tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import fixtures as fx
from tidewire.functions import decisions, display
from tidewire.functions import network as N
from tidewire.operators import (
    behaviour,
    detect,
    flows,
    labeling,
    metrics,
    model,
    numbering,
    packets,
    profile,
    sampling,
    segments,
    splits,
    views,
)
from tidewire.plans.durable import durable, scratch_folder
from tidewire.schemas import FEATURES, FLOW_KEY, SPLITS, TARGET
from tidewire.settings import Settings
from tidewire.sources import contract, tables
from tidewire.sources import packets as packet_source
from tidewire.streaming import flows as stream_flows_
from tidewire.streaming import live
from tidewire.streaming.windows import with_stream_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FLOW_TABLE_COLUMNS = [
    "flow_start_seq",
    "flow_last_seq",
    "protocol",
    "src_ip",
    "dst_ip",
    "src_port",
    "dst_port",
    "start_time",
    "end_time",
    "duration_ms",
    "packet_count_total",
    "packet_count_fwd",
    "packet_count_bwd",
    "byte_count_total",
    "byte_count_fwd",
    "byte_count_bwd",
]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _flows(spark: SparkSession, folder: str) -> DataFrame:
    return flows.flow_table(fx.packets(spark, folder), Settings.from_session(spark))


def _triggered(spark: SparkSession, folder: str) -> DataFrame:
    source, settings = fx.packets(spark, folder), Settings.from_session(spark)
    wanted = flows.flow_table(source, settings).select(*numbering.INPUTS)
    return numbering.with_expiry_trigger(wanted, source, settings)


def _numbered(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """Numbered flows, with all columns or with those named besides the ones that number them."""
    source, settings = fx.packets(spark, folder), Settings.from_session(spark)
    table = flows.flow_table(source, settings)
    if columns is not None:
        table = table.select(*numbering.INPUTS, *columns)
    return numbering.number_flows(table, source, settings)


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return behaviour.with_behaviour(_numbered(spark, folder))


def _window(spark: SparkSession, folder: str, *features: str) -> DataFrame:
    numbered = _numbered(spark, folder, ["src_ip", "dst_ip", "dst_port"])
    return behaviour.with_window_features(numbered, features).select("flow_id", *features)


def _small_limits(spark: SparkSession) -> Settings:
    """Limits under which nearly every group of the driver tables takes the plan for huge ones."""
    return replace(Settings.from_session(spark), max_group_rows=100, max_fold_rows=20)


# --- sources ---------------------------------------------------------------------------


@query
def packets_parsed(spark: SparkSession, folder: str) -> DataFrame:
    return packet_source.accepted(packet_source.parse_packet_lines(fx.packet_lines(spark, folder)))


@query
def packet_rejects(spark: SparkSession, folder: str) -> DataFrame:
    parsed = packet_source.parse_packet_lines(fx.packet_lines(spark, folder))
    return packet_source.rejected(parsed).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("line_count")
    )


@query
def manifest_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return labeling.last_per_key(fx.manifest_rows(spark, folder), "pcap_name", ["position"])


@query
def split_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All splits written, then two of them read back, each from its own folder."""
    where = scratch_folder(spark, "splits")
    rows = fx.labeled_flows(spark, folder).join(_plan(spark, folder).select("capture_id", "split"), "capture_id")
    tables.write_splits(rows, where)
    wanted = ["flow_id", "capture_id", "label_binary", "start_us", "end_us", "protocol"]
    parts = [
        tables.read_split(spark, where, name).select(F.lit(name).alias("split"), *wanted)
        for name in ("validation", "test")
    ]
    return parts[0].unionByName(parts[1])


@query
def campaign_union(spark: SparkSession, folder: str) -> DataFrame:
    """Campaign tables as CSV files of different columns, found and aligned by one scan.

    The oldest campaign has no family column, the others a run index. Which campaigns
    there are is for the data to say.
    """
    where = scratch_folder(spark, "campaigns")
    rows = fx.captures(spark, folder).select(
        "capture_id", "campaign_id", "scenario_id", "label_binary", "scenario_family", "c_custkey"
    )
    oldest = F.col("campaign_id") == "camp_0"
    first = rows.where(oldest).drop("scenario_family", "c_custkey")
    others = rows.where(~oldest).withColumnRenamed("c_custkey", "run_index")
    for part in (first, others):
        files = part.withColumn("campaign", F.col("campaign_id"))
        files.write.mode("append").partitionBy("campaign").csv(where, header=True)
    wanted = ["capture_id", "campaign_id", "scenario_id", "label_binary", "scenario_family", "run_index"]
    found = tables.read_csv_by_header(spark, f"{where}/*/*.csv", wanted)
    return found.select(*wanted[:-1], F.col("run_index").try_cast("long").alias("run_index"))


@query
def wide_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest of thirty columns through its reader; those it knows stand last."""
    where = scratch_folder(spark, "manifest")
    rows = fx.manifest_rows(spark, folder).select(
        *[F.concat(F.lit("a, \""), F.col("position").cast("string")).alias(f"extra_{n}") for n in range(22)],
        F.col("status"),
        F.lit("x").alias("severity"),
        "campaign_id",
        "scenario_id",
        "label_binary",
        "source_host",
        F.col("position").alias("run_index"),
        "pcap_name",
    )
    # Sorted over several files; a later line, in file order, wins.
    rows.orderBy("run_index").write.option("escape", '"').csv(f"{where}/m", header=True)
    return tables.read_manifest(spark, f"{where}/m/*.csv").select(
        "pcap_name", "campaign_id", "scenario_id", "label_binary", "source_host", "run_index", "status"
    )


@query
def csv_records(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest with line breaks, commas and doubled quotes in its cells, in long records."""
    where = scratch_folder(spark, "records")
    note = F.concat(F.lit('two\nlines, "'), F.col("position").cast("string"), F.lit('"\n,'))
    rows = fx.manifest_rows(spark, folder).select(
        "pcap_name", note.alias("notes"), *[F.lit(f'"{n}",').alias(f"extra_{n}") for n in range(60)], "campaign_id", "status"
    )
    rows.repartition(3, "pcap_name").write.option("escape", '"').csv(f"{where}/m", header=True)
    found = tables.read_csv_by_header(spark, f"{where}/m/*.csv", ["pcap_name", "notes", "extra_59", "status", "absent"])
    return found.drop("_position")


@query
def campaign_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Three campaigns of flows: whole numbers, fractions, texts, and columns that only some have."""
    where = scratch_folder(spark, "campaign-flows")
    flows_ = fx.labeled_flows(spark, folder).select("flow_id", "capture_id", "campaign_id", "start_us", "p_milli", "protocol", "o_custkey")
    group = F.col("o_custkey") % 3
    parts = (
        flows_.where(group == 0).drop("o_custkey"),
        # As written by a tool that turns a column with a missing value into fractions.
        flows_.where(group == 1).withColumn("p_milli", F.when(F.col("p_milli") % 7 != 0, F.col("p_milli")).cast("double")).drop("protocol"),
        flows_.where(group == 2).withColumns({"p_milli": F.col("p_milli").cast("int"), "o_custkey": F.col("o_custkey").cast("string")}),
    )
    for number, part in enumerate(parts):
        part.write.parquet(f"{where}/campaign_{number}/flows.parquet")
    return tables.read_flows(spark, f"{where}/*/flows.parquet").select(
        "flow_id", "capture_id", "campaign_id", "start_us", "p_milli", "protocol", "o_custkey"
    )


@query
def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    return contract.contract_violations(fx.raw_feature_rows(spark, folder))


@query
def replay_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Two splits replayed without thresholds, whole and up to a limit."""
    plan, rows = _plan(spark, folder), fx.scored_flows(spark, folder)
    done = []
    for split in ("validation", "test"):
        chosen = splits.flows_of_split(rows, plan, split)
        for limit in (None, 100):
            replayed = detect.replay_rows(chosen, limit)
            counted = detect.replay_summary(detect.detect(replayed))
            done.append(counted.select(F.lit(split).alias("split"), F.lit(limit).cast("int").alias("replay_limit"), "*"))
    return reduce(DataFrame.unionByName, done)


# --- projections and filters -----------------------------------------------------------


@query
def protocol_name(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("l_quantity").cast("int") % 21
    named = fx.table(spark, folder, "lineitem").select(
        number.alias("protocol_number"), N.protocol_name(number).alias("protocol")
    )
    return named.groupBy("protocol_number", "protocol").agg(
        F.count(F.lit(1)).alias("packet_count")
    )


@query
def packet_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Some packets get blank addresses or DHCP ports first."""
    source = fx.packets(spark, folder).selectExpr(
        "seq",
        "if(seq % 37 = 0, '', src_ip) as src_ip",
        "dst_ip",
        "protocol",
        "if(seq % 3 = 0 and protocol = 'UDP', 68, src_port) as src_port",
        "if(seq % 3 = 0 and protocol = 'UDP', 67, dst_port) as dst_port",
    )
    return packets.keep_ip_traffic(source)


@query
def flow_key(spark: SparkSession, folder: str) -> DataFrame:
    keyed = packets.with_flow_key(fx.packets(spark, folder))
    return keyed.select("seq", "protocol", "a_ip", "a_port", "b_ip", "b_port", "from_a")


@query
def control_plane_filter(spark: SparkSession, folder: str) -> DataFrame:
    return packets.drop_control_plane(
        fx.packets_of_captures(spark, folder),
        fx.manifest(spark, folder),
        Settings.from_session(spark),
    )


@query
def capture_clean(spark: SparkSession, folder: str) -> DataFrame:
    return labeling.usable_captures(fx.captures(spark, folder)).select(
        "capture_id", "campaign_id", "scenario_id", "status"
    )


@query
def feature_projection(spark: SparkSession, folder: str) -> DataFrame:
    features = _features(spark, folder)
    return contract.project_features(features, keep=["flow_id"])


@query
def training_frame(spark: SparkSession, folder: str) -> DataFrame:
    labelled = _features(spark, folder).withColumn(
        TARGET, F.when(F.col("dst_port") == 22, "suspect").otherwise("normal")
    )
    return contract.training_frame(labelled)


@query
def flow_features(spark: SparkSession, folder: str) -> DataFrame:
    """The complete flow table: identity, the 31 features, finalisation order."""
    return _features(spark, folder).select("flow_id", "src_ip", "dst_ip", "start_us", *FEATURES)


# --- joins -----------------------------------------------------------------------------


@query
def label_flows(spark: SparkSession, folder: str) -> DataFrame:
    labelled = labeling.label_flows(fx.capture_flows(spark, folder), fx.manifest(spark, folder))
    return labelled.drop("o_orderkey", "o_custkey")


def _plan(spark: SparkSession, folder: str) -> DataFrame:
    clean = labeling.usable_captures(fx.captures(spark, folder))
    return splits.assign_splits(clean, splits.BY_SCENARIO, Settings.from_session(spark))


@query
def split_flows(spark: SparkSession, folder: str) -> DataFrame:
    flows_ = fx.labeled_flows(spark, folder).select("flow_id", "capture_id", "label_binary")
    return splits.flows_with_split(flows_, _plan(spark, folder))


@query
def campaign_semi(spark: SparkSession, folder: str) -> DataFrame:
    """Campaign four counts as failed altogether, so that the join drops something."""
    captures = fx.captures(spark, folder).withColumn(
        "status",
        F.when(F.col("campaign_id") == "camp_4", "scenario_error").otherwise(F.col("status")),
    )
    rows = fx.labeled_flows(spark, folder).select("flow_id", "campaign_id")
    return labeling.flows_of_campaigns(rows, captures)


@query
def excluded_captures(spark: SparkSession, folder: str) -> DataFrame:
    return labeling.excluded_captures(fx.captures(spark, folder)).select(
        "capture_id", "campaign_id", "status"
    )


@query
def flow_expiry_trigger(spark: SparkSession, folder: str) -> DataFrame:
    return _triggered(spark, folder).select(
        "flow_start_seq", "flow_last_seq", "deadline_us", "trigger_seq", "trigger_phase"
    )


@query
def split_label_flows(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_flow_distribution(
        fx.labeled_flows(spark, folder), _plan(spark, folder), "label_binary"
    )


@query
def split_family_flows(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_flow_distribution(
        fx.labeled_flows(spark, folder), _plan(spark, folder), "label_binary", "scenario_family"
    )


# --- aggregations ----------------------------------------------------------------------


@query
def flow_table(spark: SparkSession, folder: str) -> DataFrame:
    return _flows(spark, folder).select(*FLOW_TABLE_COLUMNS)


@query
def flow_len_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _flows(spark, folder).select(
        "flow_start_seq", "pkt_len_min", "pkt_len_max", "pkt_len_mean", "pkt_len_std"
    )


@query
def flow_iat_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _flows(spark, folder).select(
        "flow_start_seq", "iat_min_ms", "iat_max_ms", "iat_mean_ms", "iat_std_ms"
    )


@query
def flow_flag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _flows(spark, folder).select(
        "flow_start_seq",
        *[f"{flag}_count" for flag in ("syn", "ack", "rst", "fin", "psh")],
        "icmp_echo_req_count",
        "icmp_echo_reply_count",
    )


@query
def capture_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Packets kept after the controller filter and flows, per capture of the manifest."""
    settings = Settings.from_session(spark)
    manifest = fx.manifest(spark, folder)
    kept = packets.drop_control_plane(fx.packets_of_captures(spark, folder), manifest, settings)
    every = fx.captures(spark, folder).select("capture_id")
    listed = every.join(manifest, "capture_id", "left")
    return labeling.capture_summary(listed, kept, fx.capture_flows(spark, folder))


@query
def campaign_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = labeling.campaign_stats(fx.capture_counts(spark, folder))
    return stats.withColumn("label_counts", F.to_json("label_counts"))


@query
def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_summary(_plan(spark, folder))


@query
def split_family_presence(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_family_presence(_plan(spark, folder))


@query
def scenario_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.label_distribution(
        fx.labeled_flows(spark, folder), "scenario_id", "scenario_family"
    )


@query
def family_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.label_distribution(fx.labeled_flows(spark, folder), "scenario_family")


@query
def family_capture_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.capture_distribution(fx.capture_counts(spark, folder), "scenario_family")


@query
def scenario_capture_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.capture_distribution(
        fx.capture_counts(spark, folder), "scenario_id", "scenario_family"
    )


@query
def family_flow_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.flow_distribution(fx.labeled_flows(spark, folder), "scenario_family")


@query
def scenario_flow_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.flow_distribution(
        fx.labeled_flows(spark, folder), "scenario_id", "scenario_family"
    )


@query
def top3_label_share(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_share(fx.labeled_flows(spark, folder), "scenario_id", 3)


@query
def view_summary(spark: SparkSession, folder: str) -> DataFrame:
    every = fx.labeled_flows(spark, folder)
    train = splits.flows_of_split(every, _plan(spark, folder), "train")
    capped = durable(sampling.cap_captures(train, fx.CAPS))
    stages = {
        "all": every,
        "train_source": train,
        "train_capped": capped,
        "train_balanced": sampling.balance_labels(capped),
    }
    return profile.stage_summary(stages)


@query
def split_profile(spark: SparkSession, folder: str) -> DataFrame:
    plan = _plan(spark, folder)
    rows = fx.scored_flows(spark, folder).drop("probability")
    parts = [profile.split_profile(splits.flows_of_split(rows, plan, s), s) for s in SPLITS]
    return reduce(DataFrame.unionByName, parts)


@query
def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts(fx.scored_flows(spark, folder), "severity")


@query
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Values that do not fit the contract's types, campaign by campaign."""
    held = fx.raw_feature_rows(spark, folder, "concat('camp_', cast(l_orderkey % 5 as string)) as campaign_id")
    types = {"src_port": "bigint", "dst_port": "bigint", "duration_ms": "double", "packet_count_total": "bigint"}
    return profile.type_misfits(held, "campaign_id", types)


_PROFILED = [
    "p_milli",
    "src_port",
    "dst_port",
    "packet_count_total",
    "byte_count_total",
    "duration_ms",
    "rst_count",
]


@query
def feature_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.numeric_profile(fx.scored_flows(spark, folder), _PROFILED)


@query
def feature_profile_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every numeric feature of the contract over the complete flow table."""
    return profile.numeric_profile(_features(spark, folder), [c for c, kind in FEATURES.items() if kind != "string"])


@query
def categorical_top5(spark: SparkSession, folder: str) -> DataFrame:
    """One column holds nulls beside the text that stands for them."""
    family = F.when(F.col("p_milli") % 4 == 0, "None").otherwise(F.col("scenario_family"))
    rows = fx.scored_flows(spark, folder).withColumn("scenario_family", family)
    return profile.categorical_profile(rows, ["protocol", "src_ip", "scenario_id", "scenario_family"])


@query
def protocol_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts(fx.packets(spark, folder), "protocol")


@query
def top_dst_ports(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(fx.packets(spark, folder), "dst_port", 10)


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(fx.evaluated_flows(spark, folder))


@query
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.classification_metrics(fx.evaluated_flows(spark, folder))


@query
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.classification_report(fx.evaluated_flows(spark, folder))


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.roc_auc(fx.evaluated_flows(spark, folder), Settings.from_session(spark))


@query
def scenario_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    rows = metrics.scenario_breakdown(fx.evaluated_flows(spark, folder))
    rates = ["accuracy", "predicted_suspect_rate", "true_suspect_rate"]
    return rows.withColumns({c: F.round(c, 9) for c in rates})


@query
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """A candidate and a stricter baseline, on the splits of the plan."""
    rows = splits.flows_with_split(fx.evaluated_flows(spark, folder), _plan(spark, folder))
    both = rows.select(
        "split",
        "y_true",
        F.inline(
            F.array(
                F.struct(F.lit("candidate").alias("model"), "y_pred", "score"),
                F.struct(
                    F.lit("baseline").alias("model"),
                    F.when(F.col("p_milli") >= 800, "suspect").otherwise("normal").alias("y_pred"),
                    (F.col("p_milli").cast("long") - F.col("p_milli") % 100)
                    .cast("double")
                    .alias("score"),
                ),
            )
        ),
    )
    return metrics.model_comparison(both, Settings.from_session(spark))


def _detected(spark: SparkSession, folder: str) -> DataFrame:
    return detect.detect(
        fx.scored_flows(spark, folder),
        alert_threshold=0.95,
        block_threshold=0.99,
        threshold_source="live_runtime",
        decided_us=F.col("end_us") + 750_000,
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return detect.event_records(_detected(spark, folder))


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    return detect.alert_records(_events(spark, folder), F.col("event_us") + 1_250)


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return detect.blocking_records(_detected(spark, folder))


def _logs(spark: SparkSession, folder: str) -> DataFrame:
    return detect.log_records(_detected(spark, folder), _events(spark, folder))


def _journal(spark: SparkSession, folder: str) -> DataFrame:
    return detect.journal_lines(_detected(spark, folder))


@query
def runtime_status(spark: SparkSession, folder: str) -> DataFrame:
    parsed = packet_source.parse_packet_lines(fx.packet_lines(spark, folder))
    return views.runtime_status(_events(spark, folder), parsed)


@query
def alert_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return views.alert_kpis(_alerts(spark, folder))


@query
def severity_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return views.severity_histogram(views.alerts_view(_alerts(spark, folder)))


@query
def event_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return views.event_kpis(views.events_view(_events(spark, folder)))


@query
def journal_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return views.journal_kpis(_journal(spark, folder))


@query
def level_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return views.level_histogram(_journal(spark, folder))


@query
def overview_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return views.overview_kpis(runtime_status(spark, folder))


# --- windows and sequences -------------------------------------------------------------


def _keyed(source: DataFrame) -> DataFrame:
    """What cutting needs, and nothing else."""
    return packets.with_flow_key(source).select(
        *FLOW_KEY, *segments.ORDER, "psh", "fin", "rst"
    )


@query
def flow_segments(spark: SparkSession, folder: str) -> DataFrame:
    keyed = _keyed(fx.packets(spark, folder))
    cut = segments.assign_flows(keyed, Settings.from_session(spark))
    return cut.select("seq", "flow_start_seq", "flow_start_us", "gap_us", "is_last")


@query
def flow_segments_by_capture(spark: SparkSession, folder: str) -> DataFrame:
    keyed = _keyed(fx.packets(spark, folder, captures=4))
    cut = segments.assign_flows(keyed, Settings.from_session(spark))
    return cut.select("capture_id", "seq", "flow_start_seq")


@query
def flow_ids(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(spark, folder, []).select("flow_id", "flow_index", "flow_start_seq")


@query
def conn_rate(spark: SparkSession, folder: str) -> DataFrame:
    return _window(spark, folder, "connections_per_1s", "connections_per_5s")


@query
def distinct_ports_5s(spark: SparkSession, folder: str) -> DataFrame:
    return _window(spark, folder, "distinct_dst_ports_per_5s")


@query
def distinct_ips_5s(spark: SparkSession, folder: str) -> DataFrame:
    return _window(spark, folder, "distinct_dst_ips_per_5s")


@query
def icmp_rate(spark: SparkSession, folder: str) -> DataFrame:
    return _window(spark, folder, "icmp_packets_per_1s")


@query
def capture_cap(spark: SparkSession, folder: str) -> DataFrame:
    kept = sampling.cap_captures(fx.labeled_flows(spark, folder), fx.CAPS)
    return kept.select("flow_id", "capture_id", "scenario_id")


@query
def capture_cap_audit(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.cap_audit(fx.labeled_flows(spark, folder), fx.CAPS)


@query
def balance_labels(spark: SparkSession, folder: str) -> DataFrame:
    kept = sampling.training_view(fx.labeled_flows(spark, folder), fx.CAPS)
    return kept.select("flow_id", "label_binary")


@query
def split_plan_by_label(spark: SparkSession, folder: str) -> DataFrame:
    plan = splits.assign_splits(
        fx.captures(spark, folder), splits.BY_LABEL, Settings.from_session(spark)
    )
    return plan.select("capture_id", "label_binary", "split")


@query
def split_plan_by_scenario(spark: SparkSession, folder: str) -> DataFrame:
    return _plan(spark, folder).select("capture_id", "scenario_id", "split")


# --- orderings and feeds ---------------------------------------------------------------


@query
def flow_order(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.labeled_flows(spark, folder).select("flow_id", "start_us", "end_us")
    return rows.orderBy(*sampling.FLOW_ORDER)


@query
def latest_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return views.latest_with_total(_alerts(spark, folder), 100, "alert_id").select(
        "alert_id", "event_us", "severity", "total_available"
    )


@query
def overview_feed(spark: SparkSession, folder: str) -> DataFrame:
    feed = views.latest(_events(spark, folder), 6, "event_us", "event_id")
    return views.events_view(feed)


@query
def journal(spark: SparkSession, folder: str) -> DataFrame:
    return _journal(spark, folder).orderBy(F.desc("event_us"))


@query
def journal_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return views.filter_journal(_journal(spark, folder), "ALERTE")


@query
def runtime_log_feed(spark: SparkSession, folder: str) -> DataFrame:
    shown = views.logs_view(_logs(spark, folder), ["runtime", "blocking"])
    return views.latest(shown, 12, "event_us", "message")


@query
def blocking_feed(spark: SparkSession, folder: str) -> DataFrame:
    return views.blocking_view(_blocks(spark, folder))


@query
def events_filtered(spark: SparkSession, folder: str) -> DataFrame:
    shown = views.events_view(_events(spark, folder))
    return views.filter_events(shown, label="Normal", protocol="TCP", minimum_score=0.9)


@query
def alerts_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return views.filter_alerts(views.alerts_view(_alerts(spark, folder)), "Critique")


@query
def alert_pulse(spark: SparkSession, folder: str) -> DataFrame:
    return views.alert_pulse(_alerts(spark, folder), since="1999-01-01T00:00:00+00:00")


@query
def blocking_history(spark: SparkSession, folder: str) -> DataFrame:
    kept = _detected(spark, folder).where(detect.in_blocking_history())
    return kept.select("flow_id", "raw_label", "predicted_label")


# --- the same operators with every group as a huge one -----------------------------------


@query
def flow_segments_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """Flows cut by pointers instead of folds."""
    return flows.flow_table(fx.packets(spark, folder), _small_limits(spark)).select(*FLOW_TABLE_COLUMNS)


@query
def flow_features_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """Features of flows that were cut by pointers; all packets are of one capture here."""
    settings, source = _small_limits(spark), fx.packets(spark, folder)
    # Each step stands on a table, as in a job; one plan of all would only be hard to compile.
    numbered = durable(numbering.number_flows(flows.flow_table(source, settings), source, settings))
    found = behaviour.with_behaviour(numbered)
    return found.select("flow_id", "src_ip", "dst_ip", "start_us", *FEATURES)


@query
def written_tables(spark: SparkSession, folder: str) -> DataFrame:
    """What the writers write, read back: CSV, JSON summary, and history appended twice."""
    where = scratch_folder(spark, "written")
    counts = fx.captures(spark, folder).groupBy("scenario_id").agg(F.count(F.lit(1)).alias("capture_count"))
    tables.write_csv(counts, f"{where}/csv")
    tables.write_json_summary({"counts": counts}, f"{where}/json")
    for _ in range(2):
        tables.append_history(counts, f"{where}/history")
    read = {
        "csv": spark.read.csv(f"{where}/csv", header=True),
        "json": spark.read.json(f"{where}/json/counts"),
        "history": spark.read.parquet(f"{where}/history"),
    }
    shown = [
        frame.select(F.lit(name).alias("sink"), "scenario_id", F.col("capture_count").cast("long").alias("capture_count"))
        for name, frame in read.items()
    ]
    return reduce(DataFrame.unionByName, shown)


# --- scalar functions ------------------------------------------------------------------


@query
def failed_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return _flows(spark, folder).select(
        "flow_start_seq",
        N.failed_connection_ratio(
            F.col("protocol"), F.col("syn_count"), F.col("ack_count"), F.col("rst_count")
        ).alias("failed_connection_ratio"),
    )


@query
def scenario_defaults(spark: SparkSession, folder: str) -> DataFrame:
    scenario = F.col("scenario_id")
    return fx.captures(spark, folder).select(
        "capture_id",
        "scenario_id",
        labeling.default_family(scenario).alias("family"),
        labeling.default_severity(scenario).alias("severity"),
    )


@query
def event_severity(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("event_id", "severity")


@query
def attack_type(spark: SparkSession, folder: str) -> DataFrame:
    return detect.attack_types(_detected(spark, folder))


@query
def safe_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as numbers, with a default for what is none."""
    rows = fx.raw_feature_rows(spark, folder)
    return rows.groupBy(
        decisions.safe_int(F.col("dst_port"), -1).alias("dst_port"),
        decisions.safe_float(F.col("duration_ms"), -1.0).alias("duration_ms"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


@query
def tcp_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("event_id", "tcp_flags")


@query
def event_status(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("event_id", "action_taken", "status", "blocked")


@query
def rule_preview(spark: SparkSession, folder: str) -> DataFrame:
    flows_ = fx.scored_flows(spark, folder)
    preview = N.rule_preview(
        F.col("src_ip"), F.col("dst_ip"), F.col("protocol"), F.col("src_port"), F.col("dst_port")
    )
    return flows_.select("flow_id", preview.alias("command_preview"))


@query
def alert_latency(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts(spark, folder).select(
        "alert_id", "latency_from_flow_end_ms", "latency_from_finalization_ms"
    )


@query
def format_metrics(spark: SparkSession, folder: str) -> DataFrame:
    flows_ = fx.scored_flows(spark, folder)
    return flows_.select(
        "flow_id",
        display.compact_number(F.col("byte_count_total") * 1000).alias("bytes"),
        display.percent(F.col("p_milli"), F.col("packet_count_total") - 1).alias("share"),
        display.score(F.col("p_milli") / 1000).alias("score"),
        display.clock(F.col("end_us")).alias("time"),
        display.duration(F.col("byte_count_total") * 7).alias("duration"),
    )


@query
def display_labels(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    padded = F.concat(F.lit(" "), F.upper("status"))
    return events.select(
        "event_id",
        display.label(F.col("prediction_label")).alias("label"),
        display.severity(F.col("severity")).alias("severity"),
        display.action(F.col("action_taken")).alias("action"),
        display.event_status(padded).alias("status"),
        display.protocol(F.nullif(F.col("protocol"), F.lit("UDP"))).alias("protocol"),
        display.runtime_status(F.lower("status")).alias("runtime"),
    )


@query
def table_signature(spark: SparkSession, folder: str) -> DataFrame:
    return profile.table_signature(fx.labeled_flows(spark, folder))


# --- decisions and records -------------------------------------------------------------


@query
def alert_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return _detected(spark, folder).select(
        "flow_id", "raw_label", "predicted_label", "confidence", "alert_triggered"
    )


@query
def block_decision(spark: SparkSession, folder: str) -> DataFrame:
    return _detected(spark, folder).select("flow_id", "block_threshold_met", "blocking.*")


@query
def event_records(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder)


@query
def alert_records(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts(spark, folder)


@query
def blocking_records(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder)


@query
def log_records(spark: SparkSession, folder: str) -> DataFrame:
    return _logs(spark, folder)


# --- models ----------------------------------------------------------------------------


def _labelled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Flows of forty captures with all features and a label the features can explain."""
    source, settings = fx.packets(spark, folder, captures=40), Settings.from_session(spark)
    numbered = numbering.number_flows(flows.flow_table(source, settings), source, settings)
    features = behaviour.with_behaviour(numbered)
    suspicious = (F.col("dst_port") == 22) | (F.col("syn_count") >= 2)
    return durable(
        features.select(
            *features.columns, F.when(suspicious, "suspect").otherwise("normal").alias(TARGET)
        )
    )


def _feature_splits(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The labelled flows split by capture, never by row."""
    rows = _labelled_features(spark, folder)
    listed = rows.select("capture_id").distinct().select(
        "capture_id", F.lit("EVT").alias("campaign_id"), F.lit("X").alias("scenario_id")
    )
    plan = durable(splits.assign_splits(listed, splits.BY_SCENARIO, Settings.from_session(spark)))
    return {name: splits.flows_of_split(rows, plan, name) for name in SPLITS}


@query
def train_rf(spark: SparkSession, folder: str) -> DataFrame:
    trained = model.train(_feature_splits(spark, folder)["train"])
    return model.feature_importances(spark, trained)


@query
def score_flows(spark: SparkSession, folder: str) -> DataFrame:
    parts = _feature_splits(spark, folder)
    trained = model.train(parts["train"])
    return model.score(parts["test"], trained).select("flow_id", "raw_label", "probability")


@query
def encoded_features(spark: SparkSession, folder: str) -> DataFrame:
    """What the model sees of each flow: protocols as columns of zeros and ones, then numbers."""
    rows = durable(_features(spark, folder))
    stages = Pipeline(stages=model.feature_stages(contract.DEFAULT_CONTRACT)).fit(rows)
    trained = model.TrainedModel(PipelineModel([*stages.stages, None]), contract.DEFAULT_CONTRACT, ())
    found = model.encoded(rows, trained, "flow_id")
    return found.select("flow_id", F.array_join(F.transform("features", lambda x: F.format_string("%.6f", x)), "|").alias("features"))


@query
def model_check(spark: SparkSession, folder: str) -> DataFrame:
    """The trained forest against a walk over its stored nodes, and against itself reloaded."""
    parts = _feature_splits(spark, folder)
    trained = model.train(parts["train"])
    where = scratch_folder(spark, "model")
    model.save_model(spark, trained, where)
    rows = reduce(DataFrame.unionByName, [part.withColumn("split", F.lit(name)) for name, part in parts.items()])
    # Dealt out evenly: a row costs three ways down all trees, and the splits differ in size.
    rows = durable(rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "flow_id"))
    walked = model.walk_forest(model.encoded(rows, trained, "flow_id"), model.forest_table(spark, where), "flow_id")
    # Not a lambda over the labels, within which Spark would score the row again for each label.
    own = F.array(*[F.element_at("probability", F.lit(label)) for label in trained.labels])
    scored = durable(model.score(rows, trained).select("flow_id", "split", TARGET, "raw_label", own.alias("own")))
    again = model.score(rows, model.load_model(spark, where)).select("flow_id", own.alias("again"))
    both = scored.join(walked, "flow_id").join(again, "flow_id")
    apart = lambda one, other: F.count_if(F.exists(F.zip_with(one, other, lambda a, b: F.abs(a - b) > 1e-9), lambda x: x))
    right = F.count_if(F.col("raw_label") == F.col(TARGET)) / F.count(F.lit(1))
    return both.groupBy("split").agg(
        apart("own", "shares").alias("walk_mismatches"), apart("own", "again").alias("reload_mismatches"), (right > 0.5).alias("mostly_right")
    )


@query
def model_eval(spark: SparkSession, folder: str) -> DataFrame:
    """A forest against a weaker baseline, on all three splits."""
    parts = _feature_splits(spark, folder)
    full = contract.DEFAULT_CONTRACT
    stump = replace(full, parameters={**full.parameters, "n_estimators": 1, "max_depth": 1})
    models = {
        "candidate": model.train(parts["train"], full),
        "baseline": model.train(parts["train"], stump),
    }
    return model.evaluate(models, parts, Settings.from_session(spark))


@query
def impute_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.scored_flows(spark, folder).select(
        "flow_id",
        F.when(F.col("p_milli") % 7 != 0, F.col("p_milli")).alias("p_milli"),
        "finalized_us",
        "src_ip",
    )
    return model.impute_features(
        rows, ["p_milli", "finalized_us"], ["src_ip"], Settings.from_session(spark)
    )


@query
def blocking_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    """Labels decided elsewhere, some with their own confidence, in enforce mode."""
    requests = fx.scored_flows(spark, folder).select(
        "flow_id",
        F.col("raw_label").alias("predicted_label"),
        F.when(F.col("p_milli") % 2 == 0, F.lit(0.5)).alias("confidence"),
        "probability",
        "src_ip",
        "dst_ip",
        "src_port",
        "dst_port",
        "protocol",
    )
    decided = detect.evaluate_blocking(requests, mode="enforce", decided_us=F.lit(0))
    wanted = ["triggered", "mode", "confidence", "reason", "command_preview"]
    return decided.select("flow_id", *[f"blocking.{c}" for c in wanted])


# --- streams ---------------------------------------------------------------------------


_FILES = 8


def _packet_stream(spark: SparkSession, folder: str, where: str) -> DataFrame:
    """The packets as files in time order, a third per micro-batch, then a drain row."""
    source = durable(fx.packets(spark, folder))
    last = source.agg(F.max("ts_us")).first()[0]
    third = last // 3 + 1
    # Each third is several files, and a micro-batch reads as many as a third has.
    for part in range(3):
        rows = source.where(F.expr(f"ts_us div {third}") == part)
        rows.repartition(_FILES).write.mode("append").parquet(f"{where}/packets")
    # Far enough ahead to pass every deadline and the watermark delay.
    drain = source.orderBy("seq").limit(1).withColumns(
        {
            "ts_us": F.lit(last + 600_000_000).cast("long"),
            "protocol": F.lit(stream_flows_.CONTROL),
        }
    )
    drain.write.mode("append").parquet(f"{where}/packets")
    return (
        spark.readStream.schema(source.schema)
        .option("maxFilesPerTrigger", _FILES)
        .parquet(f"{where}/packets")
    )


@contextmanager
def _one_state_partition_per_core(spark: SparkSession):
    """A stream keeps its number of state partitions for life; cores bound what helps."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _by_size(flows_: DataFrame) -> DataFrame:
    """A stand-in classifier: the suspect probability follows from the byte count."""
    p = (F.col("byte_count_total") % 1001) / 1000
    return flows_.withColumns(
        {
            "raw_label": F.when(p >= 0.5, "suspect").otherwise("normal"),
            "probability": F.create_map(F.lit("normal"), 1 - p, F.lit("suspect"), p),
        }
    )


@query
def stream_packets(spark: SparkSession, folder: str) -> DataFrame:
    """Packet lines as a stream, with rejected lines as a table of their own."""
    where = scratch_folder(spark, "stream-packets")
    fx.packet_lines(spark, folder).select("value").repartition(3).write.text(f"{where}/lines")
    parsed = packet_source.parse_packet_lines(
        packet_source.packet_line_stream(spark, f"{where}/lines", "EVT")
    )
    kept = packet_source.accepted(live.observed_lines(parsed))
    writer = kept.writeStream.format("parquet").option("checkpointLocation", f"{where}/check")
    writer.trigger(availableNow=True).start(f"{where}/packets").awaitTermination()
    live.write_rejects(
        parsed, f"{where}/rejects", f"{where}/check-rejects", once=True
    ).awaitTermination()
    accepted = spark.read.parquet(f"{where}/packets").select(F.lit("accepted").alias("outcome"))
    rejects = spark.read.parquet(f"{where}/rejects").select(
        F.col("reject_reason").alias("outcome")
    )
    return accepted.unionByName(rejects).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("line_count")
    )


@query
def stream_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Flows cut on a stream: the same rows as the batch."""
    where = scratch_folder(spark, "stream-flows")
    source = _packet_stream(spark, folder, where)
    finished = stream_flows_.flow_stream(source, Settings.from_session(spark))
    writer = finished.writeStream.format("parquet").option("checkpointLocation", f"{where}/check")
    with _one_state_partition_per_core(spark):
        writer.trigger(availableNow=True).start(f"{where}/flows").awaitTermination()
    return spark.read.parquet(f"{where}/flows").select(*FLOW_TABLE_COLUMNS)


@query
def stream_detection(spark: SparkSession, folder: str) -> DataFrame:
    """The live run: flows, features, decisions and records per micro-batch, then counters."""
    where = scratch_folder(spark, "stream-detection")
    source = _packet_stream(spark, folder, where)
    settings = Settings.from_session(spark)
    with _one_state_partition_per_core(spark):
        running = live.run_live(
            source, f"{where}/out", f"{where}/check", _by_size, settings, once=True
        )
        running.awaitTermination()
    events = live.read_history(spark, f"{where}/out", "events")
    blocks = live.read_history(spark, f"{where}/out", "blocks")
    alerts = live.read_history(spark, f"{where}/out", "alerts")
    counts = events.agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_if("alert_triggered").alias("alerts"),
        F.count_if("blocked").alias("block_decisions"),
    )
    stored = alerts.agg(F.count(F.lit(1)).alias("alert_records")).unionByName(
        blocks.agg(F.count(F.lit(1)).alias("block_records")), allowMissingColumns=True
    )
    running_totals = live.totals(spark, f"{where}/out").select(
        F.col("finalized_flows").alias("total_flows"), F.col("alerts").alias("total_alerts")
    )
    both = counts.unionByName(stored, allowMissingColumns=True)
    both = both.unionByName(running_totals, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query
def stream_late_packets(spark: SparkSession, folder: str) -> DataFrame:
    """Every fiftieth packet comes once more after all others; most of these are too late.

    Both what is cut and what is late come from one operator: the packets of all flows and the
    late ones are those that were read.
    """
    where = scratch_folder(spark, "stream-late")
    source = durable(fx.packets(spark, folder))
    last = source.agg(F.max("ts_us")).first()[0]
    drain = source.orderBy("seq").limit(1).withColumns(
        {"ts_us": F.lit(last + 600_000_000).cast("long"), "protocol": F.lit(stream_flows_.CONTROL)}
    )
    source.limit(0).write.parquet(f"{where}/packets")
    stream = spark.readStream.schema(source.schema).parquet(f"{where}/packets")
    cut = stream_flows_.cut_stream(stream, Settings.from_session(spark))
    # Micro-batches of uneven size: a fifth, most of the rest, what comes again, the drain row.
    fifth = source.where(F.col("ts_us") * 5 < last)
    parts = (fifth, source.where(F.col("ts_us") * 5 >= last), source.where("seq % 50 = 0"), drain)
    with _one_state_partition_per_core(spark):
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(f"{where}/packets")
            writer = cut.writeStream.format("parquet").option("checkpointLocation", f"{where}/check")
            writer.trigger(availableNow=True).start(f"{where}/cut").awaitTermination()
    stored = spark.read.parquet(f"{where}/cut")
    late = stream_flows_.late_packets(stored).select("seq", "ts_us")
    in_flows = stored.where("not is_late").agg(F.sum("packet_count_total")).scalar()
    return late.select(
        "seq", "ts_us", (in_flows + late.agg(F.count(F.lit(1))).scalar()).alias("packets_in_all")
    )


@query
def stream_quiet(spark: SparkSession, folder: str) -> DataFrame:
    """A line that falls quiet: no packet and no drain row comes any more, only heartbeats."""
    where = scratch_folder(spark, "stream-quiet")
    source = durable(fx.packets(spark, folder))
    source.repartition(_FILES).write.parquet(f"{where}/packets")
    last = source.agg(F.max("ts_us")).first()[0]
    packets = spark.readStream.schema(source.schema).parquet(f"{where}/packets")
    # A clock that begins behind the packets and ticks half a minute per micro-batch.
    beats = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", 1)
        .option("numPartitions", 1)
        .option("startTimestamp", last // 1000 - 1000)
        .option("advanceMillisPerBatch", 30_000)
        .load()
    )
    finished = stream_flows_.flow_stream(stream_flows_.with_heartbeat(packets, beats), Settings.from_session(spark))
    writer = finished.writeStream.format("parquet").option("checkpointLocation", f"{where}/check")
    with _one_state_partition_per_core(spark):
        running = writer.trigger(processingTime="0 seconds").start(f"{where}/flows")
        # Six ticks lie behind every deadline and the watermark's delay.
        while running.isActive and (running.lastProgress is None or running.lastProgress["batchId"] < 6):
            time.sleep(0.2)
        if running.exception() is not None:
            raise running.exception()
        running.stop()
    return spark.read.parquet(f"{where}/flows").select(*FLOW_TABLE_COLUMNS)


@query
def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Features of flows that end with their first packet, so in the order in which they begin."""
    where = scratch_folder(spark, "stream-windows")
    source = durable(_one_packet_flows(spark, folder))
    last = source.agg(F.max("ts_us")).first()[0]
    # Files in the order of their packets, one per micro-batch.
    for part in range(3):
        source.where(F.expr(f"ts_us * 3 div {last + 1}") == part).coalesce(1).write.mode("append").parquet(f"{where}/packets")
    drain = source.limit(1).withColumns(
        {"ts_us": F.lit(last + 600_000_000).cast("long"), "protocol": F.lit(stream_flows_.CONTROL)}
    )
    drain.write.mode("append").parquet(f"{where}/packets")
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{where}/packets")
    with _one_state_partition_per_core(spark):
        live.run_live(stream, f"{where}/out", f"{where}/check", _by_size, Settings.from_session(spark), once=True).awaitTermination()
    return live.read_history(spark, f"{where}/out", "flows").select(
        F.col("flow_start_seq").alias("seq"), "start_us", "src_ip", *live.FEATURES, "failed_connection_ratio"
    )


def _one_packet_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Packets of which each closes its flow, close together: a probing host's resets."""
    packets = fx.packets(spark, folder).where("protocol = 'TCP'")
    return packets.withColumns({"rst": F.lit(1), "ts_us": F.col("ts_us").cast("long")})


@query
def stream_history(spark: SparkSession, folder: str) -> DataFrame:
    """Micro-batches of records, joined into a few folders, and the counters over all of them."""
    where = scratch_folder(spark, "stream-history")
    source = durable(fx.packets(spark, folder))
    last = source.agg(F.max("ts_us")).first()[0]
    cut = durable(_cut_of_batch(spark, source, last, where))
    settings = Settings.from_session(spark)
    for batch in range(_HISTORY):
        rows = cut.where(F.pmod(F.xxhash64("flow_start_seq"), F.lit(_HISTORY)) == batch)
        live.process_batch(rows, batch, f"{where}/out", _by_size, settings)
    folders = len(live._folders(spark, f"{where}/out", "events"))
    totals = live.totals(spark, f"{where}/out")
    newest = live.recent(spark, f"{where}/out", "events", 5).agg(
        F.count(F.lit(1)).alias("newest"), F.max("total_available").cast("long").alias("total_available")
    )
    events = live.read_history(spark, f"{where}/out", "events").agg(F.countDistinct("event_id").alias("events"))
    return totals.crossJoin(newest).crossJoin(events).withColumn("few_folders", F.lit(folders <= 3))


_HISTORY = 18


def _cut_of_batch(spark: SparkSession, source: DataFrame, last: int, where: str) -> DataFrame:
    """What the stream's two operators give for all packets in one micro-batch."""
    source.repartition(_FILES).write.parquet(f"{where}/packets")
    drain = source.limit(1).withColumns(
        {"ts_us": F.lit(last + 600_000_000).cast("long"), "protocol": F.lit(stream_flows_.CONTROL)}
    )
    drain.write.mode("append").parquet(f"{where}/packets")
    stream = spark.readStream.schema(source.schema).parquet(f"{where}/packets")
    settings = Settings.from_session(spark)
    rows = with_stream_windows(stream_flows_.cut_stream(stream, settings), settings)
    with _one_state_partition_per_core(spark):
        writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{where}/check")
        writer.trigger(availableNow=True).start(f"{where}/cut").awaitTermination()
    return spark.read.parquet(f"{where}/cut")


@query
def stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A stored split replayed file by file, without thresholds."""
    where = scratch_folder(spark, "stream-replay")
    rows = fx.scored_flows(spark, folder).drop("raw_label", "probability")
    stored = rows.withColumn("byte_count_total", F.col("p_milli"))
    stored.repartition(3).write.parquet(f"{where}/split")
    live.replay_stream(
        spark, f"{where}/split", f"{where}/events", f"{where}/check", _by_size
    ).awaitTermination()
    return spark.read.parquet(f"{where}/events").groupBy("prediction_label", "status").agg(
        F.count(F.lit(1)).alias("event_count")
    )
