from __future__ import annotations

import random
from dataclasses import replace

import pytest
from brute import packet, simulate, windows
from pyspark.sql import functions as F

from tidewire import Settings
from tidewire.operators import behaviour, flows, numbering, packets, segments
from tidewire.plans.blocks import with_look_back
from tidewire.schemas import PACKETS

SETTINGS = Settings()
# Every group is heavy: ordered scans are sliced and flow keys are cut by pointers.
SLICED = replace(SETTINGS, max_group_rows=3, max_fold_rows=3)


def frame(spark, rows):
    columns = PACKETS.fieldNames()
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], PACKETS)


def finished(spark, rows, settings=SETTINGS):
    source = frame(spark, rows)
    numbered = numbering.number_flows(flows.flow_table(source, settings), source, settings)
    described = behaviour.with_behaviour(numbered)
    return [r.asDict() for r in described.orderBy("capture_id", "flow_index").collect()]


def test_icmp_pair_is_one_flow(spark):
    rows = [
        packet(1, 0, sport=0, dport=0, protocol="ICMP", icmp_type=8),
        packet(2, 100_000, "10.0.0.2", "10.0.0.1", 0, 0, "ICMP", icmp_type=0),
    ]
    (flow,) = finished(spark, rows)
    assert flow["packet_count_total"] == 2
    assert (flow["packet_count_fwd"], flow["packet_count_bwd"]) == (1, 1)
    assert (flow["icmp_echo_req_count"], flow["icmp_echo_reply_count"]) == (1, 1)
    assert flow["connections_per_1s"] == 1 and flow["icmp_packets_per_1s"] == 2


def test_fin_ends_a_flow(spark):
    rows = [
        packet(1, 0, syn=1),
        packet(2, 50_000, "10.0.0.2", "10.0.0.1", 80, 1000, ack=1),
        packet(3, 100_000, fin=1, ack=1),
        packet(4, 110_000),
    ]
    first, second = finished(spark, rows)
    assert (first["fin_count"], first["ack_count"], first["duration_ms"]) == (1, 2, 100.0)
    assert (first["src_ip"], first["src_port"]) == ("10.0.0.1", 1000)
    assert second["packet_count_total"] == 1
    assert first["flow_id"] == "C__000000"


def test_port_scan_features(spark):
    rows = [packet(n, n * 1000, dport=p, syn=1, rst=1) for n, p in enumerate((22, 80, 443))]
    scan = finished(spark, rows)
    assert len(scan) == 3
    assert scan[-1]["connections_per_1s"] == 3
    assert scan[-1]["distinct_dst_ports_per_5s"] == 3
    assert scan[-1]["failed_connection_ratio"] == 1.0


def test_half_open_probe_expires_early(spark):
    answered = [packet(1, 0, syn=1), packet(2, 1000, "10.0.0.2", "10.0.0.1", 80, 1000, syn=1, ack=1)]
    assert len(finished(spark, [*answered, packet(3, 4_000_000)])) == 2
    # With a push among the first three packets the ordinary timeout applies.
    assert len(finished(spark, [*answered[:1], packet(2, 1000, psh=1), packet(3, 4_000_000)])) == 1


def test_exactly_the_maximum_duration(spark):
    steps = [packet(n, n * 10_000_000, protocol="UDP") for n in range(7)]
    more = [packet(7, 60_000_000, protocol="UDP"), packet(8, 61_000_000, protocol="UDP")]
    flows_ = finished(spark, steps + more)
    assert [f["packet_count_total"] for f in flows_] == [7, 2]


def test_syn_burst_makes_a_flow_per_packet(spark):
    rows = [packet(n, n * 10_000, sport=2000 + n, syn=1, rst=1) for n in range(40)]
    burst = finished(spark, rows)
    assert len(burst) == 40
    assert burst[-1]["connections_per_1s"] == 40


def random_packets(seed, count=500):
    """Few keys, ties, pauses around every timeout and long steady stretches."""
    rng = random.Random(seed)
    at, rows = 0, []
    pauses = [0, 1, 1000, 400_000, 1_000_000, 2_000_000, 3_000_000, 3_000_001, 5_000_000, 20_000_000]
    weights = [8, 3, 12, 20, 20, 12, 5, 3, 3, 1] if seed % 2 else [4, 2, 30, 30, 30, 2, 1, 1, 0, 0]
    quiet = seed % 3 == 0
    for seq in range(count):
        at += rng.choices(pauses, weights)[0]
        protocol = rng.choice(["TCP", "TCP", "UDP", "ICMP", "IP_47"])
        ports = (1000 + rng.randrange(2), 80) if protocol in ("TCP", "UDP") else (0, 0)
        ends = [("10.0.0.1", ports[0]), ("10.0.0.2", ports[1])]
        if rng.random() < 0.4:
            ends.reverse()
        flags = {}
        if protocol == "TCP" and not quiet:
            flags = {
                "psh": int(rng.random() < 0.1),
                "fin": int(rng.random() < 0.03),
                "rst": int(rng.random() < 0.02),
                "syn": int(rng.random() < 0.3),
            }
        rows.append(
            packet(
                seq,
                at,
                ends[0][0],
                ends[1][0],
                ends[0][1],
                ends[1][1],
                protocol,
                capture_id=rng.choice(["C1", "C2"]) if seed % 2 else "C1",
                packet_length=rng.randrange(40, 1500),
                **flags,
            )
        )
    return rows


@pytest.mark.parametrize(
    ("seed", "settings"),
    [(0, SETTINGS), (1, SETTINGS), (2, SETTINGS), (3, SETTINGS), (0, SLICED), (1, SLICED)],
)
def test_random_captures_match_the_event_loop(spark, seed, settings):
    rows = random_packets(seed, 400)
    source = frame(spark, rows)
    cut = segments.assign_flows(packets.with_flow_key(source), settings).collect()
    members: dict = {}
    for r in sorted(cut, key=lambda r: (r["ts_us"], r["seq"])):
        members.setdefault((r["capture_id"], r["flow_start_seq"]), []).append(r["seq"])
    assert sum(r["is_last"] for r in cut) == len(members)
    ids = numbering.number_flows(flows.flow_table(source, settings), source, settings).collect()
    ordered = {}
    for r in sorted(ids, key=lambda r: (r["capture_id"], r["flow_index"])):
        ordered.setdefault(r["capture_id"], []).append(members[r["capture_id"], r["flow_start_seq"]])
    assert sorted(ordered.items()) == simulate(rows)


def test_one_elephant_without_any_cut(spark):
    """A single steady key longer than many maximum durations, cut by pointers only."""
    rng = random.Random(1)
    at, rows = 0, []
    for seq in range(1500):
        at += rng.choice([100_000, 250_000, 1_000_000, 3_500_000])
        rows.append(packet(seq, at, ack=1))
    source = frame(spark, rows)
    cut = segments.assign_flows(packets.with_flow_key(source), SLICED).collect()
    members: dict = {}
    for r in sorted(cut, key=lambda r: r["seq"]):
        members.setdefault(r["flow_start_seq"], []).append(r["seq"])
    ((_, expected),) = simulate(rows)
    assert sorted(members.values()) == sorted(expected)
    assert len(members) > 10


def test_flow_invariants(spark, folder):
    from tidewire import fixtures as fx

    source = fx.packets(spark, folder)
    table = flows.flow_table(source, SETTINGS)
    total = table.groupBy().sum("packet_count_total", "byte_count_total").first()
    assert total[0] == source.count()
    assert total[1] == source.groupBy().sum("packet_length").first()[0]
    assert table.where("end_us - start_us > 60000000").count() == 0
    assert table.where("packet_count_fwd + packet_count_bwd <> packet_count_total").count() == 0
    assert table.where("packet_count_fwd < 1").count() == 0


def test_window_features_match_looking_back(spark):
    rng = random.Random(7)
    rows, at = [], 0
    for index in range(300):
        at += rng.choice([0, 0, 1, 200_000, 999_999, 1_000_000, 2_000_000, 5_000_001])
        rows.append(
            dict(
                session_id="S",
                capture_id="C",
                src_ip=rng.choice(["a", "a", "b"]),
                dst_ip=rng.choice(["x", "y", "z"]),
                dst_port=rng.randrange(4),
                protocol=rng.choice(["ICMP", "TCP"]),
                start_us=at,
                flow_index=index,
                packet_count_total=rng.randrange(1, 9),
            )
        )
    table = spark.createDataFrame(
        [tuple(r.values()) for r in rows],
        "session_id string, capture_id string, src_ip string, dst_ip string, dst_port long,"
        " protocol string, start_us long, flow_index long, packet_count_total long",
    )
    got = {
        r["flow_index"]: tuple(r[c] for c in behaviour.WINDOW_FEATURES)
        for r in behaviour.with_window_features(table).collect()
    }
    assert got == windows(rows)


def test_blocks_of_time(spark):
    """Every row is its own block's once, and stands in the next when that looks back on it."""
    rows = spark.createDataFrame([(t,) for t in (-1, 0, 69, 70, 99, 100, None)], "at long")
    placed = with_look_back(rows, F.col("at"), 100, 30)
    got = sorted((tuple(r) for r in placed.collect()), key=str)
    assert got == sorted(
        [
            (-1, -100, True),
            (-1, 0, False),
            (0, 0, True),
            (69, 0, True),
            (70, 0, True),
            (70, 100, False),
            (99, 0, True),
            (99, 100, False),
            (100, 100, True),
            (None, None, True),
        ],
        key=str,
    )


def test_only_wanted_features(spark):
    rows = [packet(n, n * 400_000, dport=p, syn=1, rst=1) for n, p in enumerate((22, 80, 22, 443))]
    source = frame(spark, rows)
    numbered = numbering.number_flows(flows.flow_table(source, SETTINGS), source, SETTINGS)
    few = behaviour.with_window_features(numbered, ["distinct_dst_ports_per_5s", "connections_per_1s"])
    assert few.columns == [*numbered.columns, "distinct_dst_ports_per_5s", "connections_per_1s"]
    assert [tuple(r[-2:]) for r in few.orderBy("flow_index").collect()] == [(1, 1), (2, 2), (2, 3), (3, 3)]
    assert behaviour.with_window_features(numbered, []) is numbered


@pytest.mark.parametrize("session", ["S", None])
def test_triggers_across_silent_blocks(spark, session):
    """The packet that ends a flow may come many blocks after its deadline, or not at all."""
    rows = [
        packet(1, -2_500_000, "b", "c"),
        packet(2, 0, protocol="UDP"),
        packet(3, 15_000_000, "b", "c", protocol="UDP"),
        packet(4, 3_600_000_000, "b", "d", protocol="UDP"),
        packet(5, 3_600_000_000, "b", "e", protocol="UDP"),
        packet(6, 3_600_000_001, "b", "f", fin=1),
    ]
    source = frame(spark, [{**r, "session_id": session} for r in rows])
    found = numbering.number_flows(flows.flow_table(source, SETTINGS), source, SETTINGS)
    got = [
        (r["flow_start_seq"], r["trigger_seq"], r["trigger_phase"])
        for r in found.orderBy("flow_index").collect()
    ]
    # A packet at the very deadline does not end a flow: 2 waits for 4.
    assert got == [(1, 3, 0), (2, 4, 0), (3, 4, 0), (6, 6, 1), (4, None, 0), (5, None, 0)]
    assert [r[0] for r in found.select("flow_index").orderBy("flow_index").collect()] == list(range(6))


def test_no_packets_no_numbers(spark):
    source = frame(spark, [])
    assert finished(spark, []) == []
    table = flows.flow_table(source, SETTINGS)
    assert numbering.with_expiry_trigger(table, source, SETTINGS).collect() == []
