"""Whole jobs from files to files: convert a campaign, split, build a view, train.

Folders follow one layout: ``<processed>/<campaign>/flows.parquet`` and
``<processed>/<campaign>/capture_summary.csv`` (a folder of part files each).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import (
    behaviour,
    flows,
    labeling,
    metrics,
    model,
    numbering,
    packets,
    profile,
    sampling,
    splits,
)
from tidewire.plans.durable import durable
from tidewire.schemas import CAPS_BY_SCENARIO_V2
from tidewire.settings import Settings
from tidewire.sources import packets as packet_source
from tidewire.sources import tables
from tidewire.sources.contract import DEFAULT_CONTRACT, FeatureContract


def captured_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per capture file, empty files included; contents are not read.

    A scan of any kind skips empty files, so the names come from the file index that Spark
    keeps on the driver for any file source.
    """
    found = [(name,) for name in spark.read.text(path).inputFiles()]
    names = spark.createDataFrame(found, "path string")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return names.select(stem.alias("capture_id"))


def convert_campaign(
    spark: SparkSession,
    lines_path: str,
    manifest_path: str,
    campaign_id: str,
    out: str,
    settings: Settings | None = None,
) -> None:
    """Dissected packet files to labelled flows, a capture summary and campaign counts."""
    settings = settings or Settings.from_session(spark)
    parsed = packet_source.parse_packet_lines(
        packet_source.read_packet_lines(spark, lines_path, campaign_id)
    )
    manifest = durable(tables.read_manifest(spark, manifest_path))
    usable = packets.keep_ip_traffic(packet_source.accepted(parsed))
    # Text is parsed once; every later step reads the kept packets.
    kept = durable(packets.drop_control_plane(usable, manifest, settings))
    numbered = numbering.number_flows(flows.flow_table(kept, settings), kept, settings)
    described = behaviour.with_behaviour(numbered)
    target = f"{out}/{campaign_id}"
    labelled = labeling.label_flows(described, manifest).drop("flow_index")
    labelled.write.mode("overwrite").parquet(f"{target}/flows.parquet")

    written = spark.read.parquet(f"{target}/flows.parquet").select("capture_id")
    listed = captured_files(spark, lines_path).join(
        manifest.drop("campaign_id", "packet_count"), "capture_id", "left"
    )
    listed = listed.withColumn("campaign_id", F.lit(campaign_id))
    summary = durable(labeling.capture_summary(listed, kept, written))
    tables.write_csv(summary, f"{target}/capture_summary.csv")
    tables.write_json_summary({"stats": labeling.campaign_stats(summary)}, target)


def prepare_splits(
    spark: SparkSession, processed: str, out: str, settings: Settings | None = None
) -> None:
    """Plan captures per label and write the flows of each split."""
    settings = settings or Settings.from_session(spark)
    captures = tables.read_capture_summaries(spark, f"{processed}/*/capture_summary.csv")
    every = tables.read_flows(spark, f"{processed}/*/flows.parquet")
    plan = durable(splits.assign_splits(captures, splits.BY_LABEL, settings))
    tables.write_csv(plan, f"{out}/capture_split_plan")
    tables.write_splits(splits.flows_with_split(every, plan), f"{out}/flows")
    tables.write_csv(splits.split_summary(plan), f"{out}/split_summary")
    for name, by in (("label", ["label_binary"]), ("family", ["label_binary", "scenario_family"])):
        counts = splits.split_flow_distribution(every, plan, *by)
        tables.write_csv(counts, f"{out}/split_{name}_flow_distribution")


def build_view(
    spark: SparkSession,
    processed: str,
    out: str,
    caps: dict[str, int] | None = None,
    settings: Settings | None = None,
) -> None:
    """Clean, split by scenario, cap and balance the training flows; report every stage."""
    settings = settings or Settings.from_session(spark)
    caps = CAPS_BY_SCENARIO_V2 if caps is None else caps
    summaries = tables.read_capture_summaries(spark, f"{processed}/*/capture_summary.csv")
    captures = durable(labeling.usable_captures(summaries))
    # The session of an offline flow is its campaign.
    stored = tables.read_flows(spark, f"{processed}/*/flows.parquet")
    stored = stored.withColumn("campaign_id", F.col("session_id"))
    every = labeling.flows_of_campaigns(stored, captures)
    plan = durable(splits.assign_splits(captures, splits.BY_SCENARIO, settings))
    train = splits.flows_of_split(every, plan, "train")
    capped = durable(sampling.cap_captures(train, caps))
    balanced = durable(sampling.balance_labels(capped))
    held_out = splits.flows_with_split(every, plan).where(F.col("split") != "train")
    rows = balanced.withColumn("split", F.lit("train")).unionByName(held_out)
    tables.write_splits(rows, f"{out}/flows")

    written = spark.read.parquet(f"{out}/flows")
    by_scenario = ("scenario_id", "scenario_family")
    reports = {
        "capture_split_plan": plan,
        "train_capture_caps": sampling.cap_audit(train, caps),
        "train_source_distribution": profile.label_distribution(train, *by_scenario),
        "train_capped_distribution": profile.label_distribution(capped, *by_scenario),
        "train_balanced_distribution": profile.label_distribution(balanced, *by_scenario),
        "split_family_presence": splits.split_family_presence(plan),
    }
    for name in ("train", "validation", "test"):
        part = written.where(F.col("split") == name)
        reports[f"{name}_family_distribution"] = profile.label_distribution(part, "scenario_family")
    for name, report in reports.items():
        tables.write_csv(report, f"{out}/{name}")
    stages = {"all": every, "train_source": train, "train_capped": capped}
    stages |= {
        name: written.where(F.col("split") == name) for name in ("train", "validation", "test")
    }
    tables.write_json_summary({"summary": profile.stage_summary(stages)}, out)


def train_and_report(
    spark: SparkSession,
    view: str,
    out: str,
    contract: FeatureContract = DEFAULT_CONTRACT,
    baseline_path: str | None = None,
    settings: Settings | None = None,
) -> model.TrainedModel:
    """Fit on the view's training split, store the model, and write its quality reports."""
    settings = settings or Settings.from_session(spark)
    parts = {
        name: tables.read_split(spark, f"{view}/flows", name)
        for name in ("train", "validation", "test")
    }
    trained = model.train(parts["train"], contract)
    model.save_model(spark, trained, f"{out}/model")
    models = {"candidate": trained}
    if baseline_path is not None:
        models["baseline"] = model.load_model(spark, baseline_path)
    quality = model.evaluate(models, parts, settings)
    rows = durable(model.evaluation_rows(model.score(parts["test"], trained), contract))
    tables.write_csv(quality, f"{out}/performance")
    tables.write_csv(metrics.confusion_matrix(rows), f"{out}/test_confusion")
    tables.write_csv(metrics.classification_report(rows), f"{out}/test_report")
    tables.write_csv(metrics.scenario_breakdown(rows), f"{out}/test_scenarios")
    return trained
