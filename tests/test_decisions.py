from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewire.functions import decisions as D
from tidewire.functions import display
from tidewire.operators import detect, views


def scored(spark, *rows):
    """(flow, raw label, P(suspect) or None)."""
    made = [
        (f, label, None if p is None else {"normal": 1 - p, "suspect": p}, "10.0.0.9", "TCP", 1, 0)
        for f, label, p in rows
    ]
    return spark.createDataFrame(
        made,
        "flow_id string, raw_label string, probability map<string,double>, src_ip string,"
        " protocol string, syn_count long, rst_count long",
    )


def decide(frame, **options):
    return {r["flow_id"]: r for r in detect.detect(frame, **options).collect()}


def test_weak_suspect_is_demoted(spark):
    row = decide(scored(spark, ("f", "suspect", 0.91)), alert_threshold=0.96)["f"]
    assert (row["predicted_label"], row["raw_label"]) == ("normal", "suspect")
    assert not row["alert_triggered"] and not row["blocking"]["triggered"]
    assert row["confidence"] == 0.91
    assert row["blocking"]["command_preview"] is None


def test_alert_without_block(spark):
    row = decide(scored(spark, ("f", "suspect", 0.97)), alert_threshold=0.95, block_threshold=0.99)
    assert row["f"]["alert_triggered"] and not row["f"]["blocking"]["triggered"]
    assert row["f"]["blocking"]["reason"] == D.REASON_BELOW
    assert row["f"]["blocking"]["command_preview"] == "iptables -I INPUT 1 -s 10.0.0.9 -j DROP"


def test_no_thresholds_and_no_probabilities(spark):
    rows = decide(scored(spark, ("a", "suspect", 0.2), ("b", "suspect", None), ("c", "normal", None)))
    assert rows["a"]["blocking"]["triggered"] and rows["b"]["blocking"]["triggered"]
    assert rows["b"]["confidence"] is None
    assert rows["c"]["blocking"]["reason"] == D.REASON_NOT_SUSPECT


def test_enforce_is_never_executed(spark):
    rows = decide(scored(spark, ("a", "suspect", 1.0), ("b", "normal", 0.0)), mode="enforce")
    assert rows["a"]["blocking"]["mode"] == "dry_run"
    assert rows["a"]["blocking"]["reason"] == D.REASON_NOT_ENFORCED
    assert rows["b"]["blocking"]["mode"] == "enforce"
    with pytest.raises(ValueError):
        detect.detect(scored(spark, ("a", "normal", 0.0)), mode="drop")


def test_best_other_label_takes_the_first_of_equals(spark):
    def best(entries):
        return spark.sql(f"SELECT map({entries}) AS p").select(D.best_other_label(F.col("p"))).first()[0]

    assert best("'suspect', 0.4D, 'b', 0.3D, 'a', 0.3D") == "b"
    assert best("'suspect', 0.4D, 'b', 0.2D, 'a', 0.4D") == "a"
    assert best("'suspect', 1D") == "normal"


def test_records_of_a_replayed_batch_keep_their_ids(spark):
    frame = scored(spark, ("f", "suspect", 0.995), ("g", "normal", 0.1))
    first, second = (
        detect.alert_records(detect.event_records(detect.detect(frame))).first()["alert_id"]
        for _ in range(2)
    )
    assert first == second


def test_records(spark):
    detected = detect.detect(
        scored(spark, ("f", "suspect", 0.995), ("g", "suspect", 0.5)),
        alert_threshold=0.95,
        block_threshold=0.99,
        decided_us=F.lit(5_000_000),
    )
    events = detect.event_records(detected)
    event = events.where("event_id = 'f'").first()
    assert (event["severity"], event["status"], event["action_taken"]) == (
        "critical",
        "blocked",
        "block_dry_run",
    )
    assert event["dst_ip"] == "unknown" and event["tcp_flags"] == "SYN"
    assert event["attack_type"] == "suspect_flow"
    # The demoted flow stays in the blocking history, with the status of an alert.
    assert {r["status"] for r in detect.blocking_records(detected).collect()} == {
        "simulated",
        "alert_only",
    }
    alert = detect.alert_records(events, F.col("event_us") + 2_500).first()
    assert alert["latency_from_flow_end_ms"] is None
    lines = views.journal(
        events,
        detect.alert_records(events),
        detect.blocking_records(detected),
        detect.log_records(detected, events),
    )
    levels = {r["level"]: r["line_count"] for r in views.level_histogram(lines).collect()}
    assert levels == {
        "WARNING": 2,
        "SUSPECT": 1,
        "NORMAL": 1,
        "ALERTE": 1,
        "BLOCAGE": 1,
        "ACTION": 1,
    }


def test_pulse_cursor(spark):
    events = detect.event_records(
        detect.detect(
            scored(spark, ("a", "suspect", 1.0), ("b", "suspect", 1.0)),
            decided_us=F.when(F.col("flow_id") == "a", 1_000_000).otherwise(2_000_000),
        )
    )
    alerts = detect.alert_records(events, F.col("event_us"))

    def count(since):
        return views.alert_pulse(alerts, since).first()["new_alert_count"]

    assert count(None) == 1
    assert count("1970-01-01T00:00:01+00:00") == 1
    assert count("1970-01-01T00:00:00+00:00") == 2
    assert count("not a time") == 0
    assert views.alert_pulse(alerts.limit(0)).first()["new_alert_count"] == 0


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_texts(spark):
    lit = F.lit
    assert one(spark, display.percent(lit(3), lit(12))) == "25,0 %"
    assert one(spark, display.percent(lit(3), lit(0))) == "0,0 %"
    assert one(spark, display.percent(lit("x"), lit(4))) == "0,0 %"
    assert one(spark, display.compact_number(lit(1234567))) == "1 234 567"
    assert one(spark, display.compact_number(lit("many"))) == "0"
    assert one(spark, display.score(lit(0.345))) == f"{0.345:.2f}"
    assert one(spark, display.score(lit(0.125))) == f"{0.125:.2f}"
    assert one(spark, display.score(lit(None).cast("double"))) == "-"
    assert one(spark, display.duration(lit(3_725.9))) == "01:02:05"
    assert one(spark, display.duration(lit(400_000))) == "111:06:40"
    assert one(spark, display.severity(lit(" HIGH "))) == "Elevee"
    assert one(spark, display.severity(lit("odd"))) == "odd"
    assert one(spark, display.label(lit(None).cast("string"))) == "Inconnu"
    assert one(spark, display.runtime_status(lit("idle"))) == "IDLE"


def test_uptime(spark):
    def uptime(started, stopped, running, now):
        args = [F.lit(v).cast("long") for v in (started, stopped)]
        return one(spark, views.uptime_seconds(*args, F.lit(running), F.lit(now)))

    assert uptime(1_000_000, None, True, 3_500_000) == 2.5
    assert uptime(1_000_000, 2_000_000, False, 9_000_000) == 1.0
    assert uptime(None, None, False, 9_000_000) == 0.0


def test_safe_numbers(spark):
    rows = spark.createDataFrame([("12",), (" 7.9 ",), ("x",), (None,), ("nan",), ("",)], "v string")
    got = rows.select(D.safe_int(F.col("v"), -1).alias("i"), D.safe_float(F.col("v"), 0.5).alias("f")).collect()
    assert [r["i"] for r in got] == [12, 7, -1, -1, -1, -1]
    assert [r["f"] for r in got] == [12.0, 7.9, 0.5, 0.5, 0.5, 0.5]


def test_journal_in_one_pass(spark):
    from tidewire import fixtures as fx

    detected = detect.detect(fx.scored_flows(spark, "/root/testdata/sf0.001"))
    events = detect.event_records(detected)
    stored = views.journal(
        events, detect.alert_records(events, F.col("event_us")), detect.blocking_records(detected), detect.log_records(detected, events)
    )
    got = detect.journal_lines(detected)
    assert got.columns == stored.columns
    # Decision times are the moment of the call for flows without one.
    shown = ["level", "type", "message"]
    assert got.select(shown).exceptAll(stored.select(shown)).count() == 0
    assert got.count() == stored.count()


def test_latest_counts_everything(spark):
    rows = spark.range(700).select(F.col("id").alias("event_us"), F.col("id").alias("k"))
    got = views.latest_with_total(rows, 3, "k").collect()
    assert [(r["event_us"], r["total_available"]) for r in got] == [(699, 700), (698, 700), (697, 700)]
