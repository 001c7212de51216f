from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidewire import Settings, jobs
from tidewire.operators import model
from tidewire.sources import tables
from tidewire.sources.contract import DEFAULT_CONTRACT


def line(at, src, dst, sport, dport, syn, rst):
    fields = [at, src, dst, sport, "", dport, "", 6, 60, syn, 1 - syn, rst, 0, 0, ""]
    return ",".join(f'"{f}"' for f in fields)


def campaign(folder, name, scenario, label, runs):
    """Capture files with a few flows each, one empty file, and a manifest."""
    lines = folder / name / "lines"
    lines.mkdir(parents=True)
    manifest = ["campaign_id,scenario_id,label_binary,source_host,pcap_name,status"]
    for run in range(runs):
        stem = f"{name}_{scenario}_{run:02d}"
        rows = []
        for n in range(30):
            scan = label == "suspect"
            rows.append(
                line(10 + n / 10, "172.30.1.23", "172.30.1.21", 2000 + n, 20 + n if scan else 80, int(scan), int(scan))
            )
        rows.append(line(20, "172.30.1.20", "172.30.1.23", 22, 4000, 0, 0))
        rows.append("garbage")
        (lines / f"{stem}.csv").write_text("\n".join(rows) + "\n")
        manifest.append(f"{name},{scenario},{label},172.30.1.23,{stem}.pcap,ok")
    (lines / f"{name}_empty.csv").write_text("")
    (folder / name / "manifest.csv").write_text("\n".join(manifest) + "\n")
    return str(lines), str(folder / name / "manifest.csv")


def test_from_packet_files_to_a_model(spark, tmp_path):
    processed = str(tmp_path / "processed")
    settings = Settings()
    for name, scenario, label in (("c1", "N20", "normal"), ("c2", "S20", "suspect"), ("smoke_c", "S01", "suspect")):
        lines, manifest = campaign(tmp_path / "raw", name, scenario, label, 4)
        jobs.convert_campaign(spark, lines, manifest, name, processed, settings)

    summary = tables.read_capture_summaries(spark, f"{processed}/*/capture_summary.csv")
    got = {r["capture_id"]: r for r in summary.collect()}
    assert len(got) == 15
    # Controller SSH is dropped from normal captures only.
    assert (got["c1_N20_00"]["packet_count"], got["c1_N20_00"]["flow_count"]) == (30, 30)
    assert got["c2_S20_00"]["packet_count"] == 31
    assert (got["c1_empty"]["flow_count"], got["c1_empty"]["label_binary"]) == (0, "unknown")
    stats = spark.read.json(f"{processed}/c1/stats").first()
    assert (stats["capture_count"], stats["flow_count"]) == (5, 120)

    jobs.prepare_splits(spark, processed, str(tmp_path / "splits"), settings)
    plan = spark.read.csv(str(tmp_path / "splits" / "capture_split_plan"), header=True)
    assert plan.count() == 15

    view = str(tmp_path / "view")
    jobs.build_view(spark, processed, view, {"S20": 10}, settings)
    stored = spark.read.parquet(f"{view}/flows")
    counts = {
        (r["split"], r["label_binary"]): r["count"]
        for r in stored.groupBy("split", "label_binary").count().collect()
    }
    assert counts["train", "normal"] == counts["train", "suspect"] == 20
    assert stored.where(F.col("campaign_id") == "smoke_c").count() == 0
    by_capture = stored.groupBy("capture_id").agg(F.countDistinct("split").alias("n"))
    assert by_capture.where("n > 1").count() == 0
    caps = spark.read.csv(f"{view}/train_capture_caps", header=True, inferSchema=True)
    assert caps.where("cap_applied = 10 and capped_flow_count = 10").count() == 2

    small = replace(
        DEFAULT_CONTRACT,
        parameters={"n_estimators": 3, "max_depth": 3, "min_samples_leaf": 1, "max_features": "sqrt"},
    )
    jobs.train_and_report(spark, view, str(tmp_path / "out"), small, settings=settings)
    again = model.load_model(spark, str(tmp_path / "out" / "model"))
    assert again.contract.inputs == DEFAULT_CONTRACT.inputs
    quality = spark.read.csv(str(tmp_path / "out" / "performance"), header=True, inferSchema=True)
    rows = {r["split"]: r for r in quality.collect()}
    assert set(rows) == {"train", "validation", "test"}
    # The controller flow of a suspect capture looks normal.
    assert rows["test"]["accuracy"] > 0.95
