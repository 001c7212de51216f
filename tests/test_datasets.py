from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewire import Settings
from tidewire import fixtures as fx
from tidewire.operators import metrics, model, sampling, splits

SETTINGS = Settings()


def dealt(total, later_first):
    """Split sizes by stepwise adjustment."""
    if total < 3:
        return (1, 0, total - 1)
    train, val = max(1, round(total * 0.7)), max(1, round(total * 0.15))
    test = max(1, total - train - val)
    while train + val + test > total:
        if train > 1 and (train > max(val, test) if later_first else train >= max(val, test)):
            train -= 1
        elif val >= test and val > 1:
            val -= 1
        else:
            test -= 1
    return (total - val - test, val, test)


def test_split_sizes_for_every_total(spark):
    numbers = spark.range(1, 301).selectExpr("id as total", "explode(sequence(1, id)) as rank")
    placed = numbers.select("total", splits.split_name(F.col("rank"), F.col("total")).alias("s"))
    got = Counter((r["total"], r["s"]) for r in placed.collect())
    for total in range(1, 301):
        sizes = tuple(got[total, name] for name in ("train", "validation", "test"))
        assert sizes == dealt(total, True) == dealt(total, False), total


@pytest.mark.parametrize("limit", [20, 10_000])
def test_splits_are_disjoint_and_complete(spark, folder, limit):
    captures = fx.captures(spark, folder)
    settings = Settings(max_group_rows=limit)
    plan = splits.assign_splits(captures, splits.BY_LABEL, settings)
    rows = plan.collect()
    assert len(rows) == len({r["capture_id"] for r in rows}) == captures.count()
    for label in ("normal", "suspect"):
        mine = [r for r in rows if r["label_binary"] == label]
        mine.sort(key=lambda r: (r["campaign_id"], r["scenario_id"], r["capture_id"]))
        train, val, test = dealt(len(mine), False)
        want = ["train"] * train + ["validation"] * val + ["test"] * test
        assert [r["split"] for r in mine] == want
    with pytest.raises(KeyError):
        splits.flows_of_split(captures, plan, "holdout")


@pytest.mark.parametrize("digits", [1, 5])
def test_balance_keeps_the_smallest_hashes(spark, folder, digits):
    import hashlib

    flows = fx.labeled_flows(spark, folder)
    kept = {r["flow_id"] for r in sampling.balance_labels(flows, digits).collect()}
    by_label: dict = {}
    for r in flows.collect():
        by_label.setdefault(r["label_binary"], []).append(r["flow_id"])
    target = min(map(len, by_label.values()))
    want = set()
    for ids in by_label.values():
        want |= set(sorted(ids, key=lambda i: hashlib.md5(i.encode()).hexdigest())[:target])
    assert kept == want


def test_caps(spark, folder):
    flows = fx.labeled_flows(spark, folder)
    counts = {r["capture_id"]: r for r in sampling.cap_audit(flows, fx.CAPS).collect()}
    kept = sampling.cap_captures(flows, fx.CAPS)
    got = {r["capture_id"]: r["count"] for r in kept.groupBy("capture_id").count().collect()}
    assert got == {c: r["capped_flow_count"] for c, r in counts.items()}
    assert sampling.cap_captures(flows, {}).count() == flows.count()


def evaluated(spark, rows):
    return spark.createDataFrame(rows, "y_true string, y_pred string, score double")


def test_metrics_without_positives(spark):
    rows = evaluated(spark, [("normal", "normal", 0.1), ("normal", "suspect", 0.9)])
    got = metrics.classification_metrics(rows).first()
    assert (got["precision_suspect"], got["recall_suspect"], got["f1_suspect"]) == (0, 0, 0)
    assert (got["balanced_accuracy"], got["false_positive_rate"]) == (0.5, 0.5)
    assert metrics.roc_auc(rows, SETTINGS).first()[0] is None
    matrix = metrics.confusion_matrix(rows).collect()
    assert {(r["y_true"], r["y_pred"]): r["row_count"] for r in matrix} == {
        ("normal", "normal"): 1,
        ("normal", "suspect"): 1,
        ("suspect", "normal"): 0,
        ("suspect", "suspect"): 0,
    }


@pytest.mark.parametrize("limit", [2, 1000])
def test_auc_counts_pairs(spark, limit):
    rows = [(["normal", "suspect"][n % 3 == 0], "normal", (n * 7 % 11) / 10) for n in range(60)]
    good = [s for y, _, s in rows if y == "suspect"]
    bad = [s for y, _, s in rows if y == "normal"]
    pairs = sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad)
    settings = Settings(max_group_rows=limit)
    assert metrics.roc_auc(evaluated(spark, rows), settings).first()[0] == round(pairs, 6)


def test_model_round_trip(spark, tmp_path):
    from dataclasses import replace

    from tidewire.sources import contract

    rows = spark.range(400).select(
        F.format_string("f%d", "id").alias("flow_id"),
        F.format_string("c%d", F.col("id") % 8).alias("capture_id"),
        *[
            (F.lit("TCP") if c == "protocol" else (F.col("id") % 13).cast("double")).alias(c)
            for c in contract.DEFAULT_CONTRACT.inputs
        ],
    )
    rows = rows.withColumn("protocol", F.when(F.col("dst_port") > 9, "UDP").otherwise("TCP"))
    rows = rows.withColumn("label_binary", F.when(F.col("dst_port") > 6, "suspect").otherwise("normal"))
    small = replace(
        contract.DEFAULT_CONTRACT,
        parameters={
            "n_estimators": 5,
            "max_depth": 4,
            "min_samples_leaf": 1,
            "max_features": "sqrt",
        },
    )
    trained = model.train(rows, small)
    path = str(tmp_path / "model")
    model.save_model(spark, trained, path)
    loaded = model.load_model(spark, path)
    assert loaded.labels == ("normal", "suspect")
    assert model.model_info(loaded)["feature_count"] == 31
    # A protocol the model has never seen is scored, as all zeros.
    fresh = rows.withColumn("protocol", F.lit("IP_47"))
    before = model.score(fresh, trained).orderBy("flow_id").collect()
    after = model.score(fresh, loaded).orderBy("flow_id").collect()
    assert [r["probability"] for r in before] == [r["probability"] for r in after]
    assert all(abs(sum(r["probability"].values()) - 1) < 1e-9 for r in after)
    quality = model.evaluate({"m": loaded}, {"train": rows}, SETTINGS).first()
    assert quality["accuracy"] > 0.95 and quality["roc_auc_suspect"] > 0.95
    deeper = replace(small, parameters={**small.parameters, "max_depth": 9})
    with pytest.raises(contract.ContractError, match="max_depth"):
        model.check_model(loaded.pipeline, deeper)
    with pytest.raises(contract.ContractError, match="model type"):
        model.check_model(loaded.pipeline, replace(small, model_type="GBTClassifier"))
    fewer = replace(small, features=dict(list(small.features.items())[:-1]))
    with pytest.raises(contract.ContractError, match="features"):
        model.check_model(loaded.pipeline, fewer)
    with pytest.raises(contract.ContractError, match="src_port"):
        model.score(rows.drop("src_port"), loaded)
