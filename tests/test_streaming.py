from __future__ import annotations

import random

import numpy as np
import pytest
from brute import packet, simulate
from pyspark.sql import functions as F

from tidewire import Settings
from tidewire import fixtures as fx
from tidewire.operators import flows
from tidewire.queries import _by_size
from tidewire.schemas import PACKETS
from tidewire.streaming import flows as stream
from tidewire.streaming import live, windows

SETTINGS = Settings()


def files(spark, path, batches):
    """One file per batch of rows, in order, then a drain row."""
    last = max(r["ts_us"] for rows in batches for r in rows)
    end = packet(10**9, last + 600_000_000, protocol=stream.CONTROL)
    for rows in [*batches, [end]]:
        made = [tuple(r[c] for c in PACKETS.fieldNames()) for r in rows]
        spark.createDataFrame(made, PACKETS).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(PACKETS).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_with_disorder(spark, tmp_path):
    """Packets of neighbouring files swap places, within the watermark delay."""
    rows = [
        packet(n, 1_000_000 + n * 700_000, sport=1000 + n % 3, psh=n % 2, fin=int(n % 17 == 0))
        for n in range(120)
    ]
    batches = [rows[:60], rows[60:]]
    batches[0].append(batches[1].pop(0))
    batches[1].insert(0, batches[0].pop(-3))
    source = files(spark, str(tmp_path / "in"), batches)
    query = (
        stream.flow_stream(source, SETTINGS)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = flows.flow_table(
        spark.createDataFrame([tuple(r[c] for c in PACKETS.fieldNames()) for r in rows], PACKETS),
        SETTINGS,
    )
    assert got.select(want.columns).exceptAll(want).count() == 0
    assert got.count() == want.count() == len(simulate(rows)[0][1])
    assert got.select("flow_id").distinct().count() == got.count()


def test_live_run_writes_every_record_once(spark, tmp_path):
    rows = [packet(n, 1_000_000 + n * 10_000, sport=2000 + n, syn=1, rst=1) for n in range(40)]
    rows += [packet(50, 9_000_000, sport=1, psh=1)]
    source = files(spark, str(tmp_path / "in"), [rows[:20], rows[20:]])

    def scorer(frame):
        sure = F.when(F.col("rst_count") > 0, 0.995).otherwise(0.1)
        return frame.withColumns(
            {
                "raw_label": F.when(sure > 0.5, "suspect").otherwise("normal"),
                "probability": F.create_map(F.lit("normal"), 1 - sure, F.lit("suspect"), sure),
            }
        )

    out = str(tmp_path / "out")
    live.run_live(source, out, str(tmp_path / "check"), scorer, SETTINGS, once=True).awaitTermination()
    events = live.read_history(spark, out, "events")
    assert events.count() == 41 and events.select("event_id").distinct().count() == 41
    alerts = live.read_history(spark, out, "alerts")
    assert alerts.count() == 40
    assert live.read_history(spark, out, "blocks").where("triggered").count() == 40
    # The context carries the source's rate from one micro-batch into the next.
    stored = live.read_history(spark, out, "flows")
    assert stored.agg(F.max("connections_per_5s")).first()[0] == 40
    newest = live.recent(spark, out, "alerts", 5)
    assert newest.count() == 5 and newest.first()["total_available"] == 40
    # A repeated micro-batch replaces its own records.
    batches = sorted(p.name for p in (tmp_path / "out" / "finished").iterdir())
    number = int(batches[0].split("=")[1])
    again = str(tmp_path / "again")
    spark.read.parquet(f"{out}/finished/batch_id={number}").write.parquet(again)
    live.process_batch(spark.read.parquet(again), number, out, scorer, SETTINGS)
    assert live.read_history(spark, out, "events").count() == 41


def test_replay_stream(spark, folder, tmp_path):
    rows = fx.scored_flows(spark, folder).drop("raw_label", "probability")
    rows.repartition(3).write.parquet(str(tmp_path / "split"))
    live.replay_stream(
        spark, str(tmp_path / "split"), str(tmp_path / "out"), str(tmp_path / "check"), _by_size
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_windows_of_a_source():
    """Counts against a look at all earlier flows of the source."""
    pick = random.Random(4)
    flows_ = sorted((pick.randrange(12_000_000), pick.randrange(4), f"h{pick.randrange(5)}", pick.randrange(3)) for _ in range(300))
    flows_ += [(flows_[-1][0] + at, 1, "h", 1) for at in (1_000_000, 1_000_001, 6_000_000, 6_000_001, 6_000_001)]
    for i, (found, (start, *_)) in enumerate(zip(windows.window_features(flows_), flows_)):
        one, five = ([f for f in flows_[: i + 1] if start - f[0] <= reach] for reach in (1_000_000, 5_000_000))
        assert found == (len(one), len(five), len({f[1] for f in five}), len({f[2] for f in five}), sum(f[3] for f in one))


def test_flows_of_folded_packets():
    """Packets folded a few at a time give the flows of folding them packet by packet."""
    pick = random.Random(9)
    processor = stream.FlowProcessor(3_000_000, 60_000_000)
    for tcp in (True, False):
        at, rows = 0, []
        for n in range(2_000):
            at += pick.choice([0, 1_000, 400_000, 2_000_000, 3_500_000, 16_000_000, 31_000_000])
            idle = -30_000_000 if tcp else 15_000_000
            flags = [int(pick.random() < p) for p in (0.1, 0.5, 0.01, 0.02, 0.2)]
            rows.append([at, n, pick.randrange(2), pick.randrange(40, 1500), *flags, pick.choice([-1, 0, 8]), idle])
        results = []
        for step in (1, 7, len(rows)):
            found, flow = [], None
            for i in range(0, len(rows), step):
                closed, flow = processor._fold(tcp, np.array(rows[i : i + step], np.int64), flow)
                found += closed
            results.append((found, flow))
        assert results[0] == results[1] == results[2] and len(results[0][0]) > 100
        assert sum(f["packet_count_total"] for f in results[0][0]) + (results[0][1] or {"packet_count_total": 0})["packet_count_total"] == len(rows)


def test_every_packet_is_in_a_flow_or_late(spark, tmp_path):
    first = [packet(n, 20_000_000 + n * 1_000_000) for n in range(5)]
    second = [packet(10, 18_000_000), packet(11, 18_900_000), packet(12, 23_000_000)]
    source = files(spark, str(tmp_path / "in"), [first, second])
    cut = stream.cut_stream(source, SETTINGS)
    writer = cut.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    late = stream.late_packets(stored)
    assert sorted((r["seq"], r["ts_us"], r["src_ip"]) for r in late.collect()) == [(p["seq"], p["ts_us"], p["src_ip"]) for p in second[:2]]
    assert set(late.columns) == set(PACKETS.fieldNames())
    assert stored.where("not is_late").agg(F.sum("packet_count_total")).first()[0] == 6


def test_history_is_joined_and_counted(spark, tmp_path):
    out, events = str(tmp_path), "events"
    with pytest.raises(FileNotFoundError):
        live.read_history(spark, out, events)
    assert live.totals(spark, out).first()["alerts"] == 0
    for batch in range(35):
        live.compact(spark, out, events, batch)
        live.compact(spark, out, events, batch)  # as when a micro-batch is run again
        rows = spark.createDataFrame([(f"e{batch}", batch * 1_000_000)], "event_id string, event_us long")
        rows.write.mode("overwrite").parquet(live._folder(out, events, batch))
    assert [name for *_, name in live._folders(spark, out, events)] == ["batches=0-15", "batches=16-31", "batch_id=32", "batch_id=33", "batch_id=34"]
    assert live.read_history(spark, out, events).count() == 35
    newest = live.recent(spark, out, events, 4).collect()
    assert [(r["event_id"], r["total_available"]) for r in newest] == [(f"e{n}", 35) for n in (34, 33, 32, 31)]
    # A joined folder counts before what it was made of is removed.
    spark.read.parquet(f"{out}/events/batches=0-15").limit(1).write.parquet(f"{out}/events/batch_id=3")
    assert live.read_history(spark, out, events).count() == 35
