"""Packets to flows on a stream, with the batch rules.

State is kept per flow key: packets the watermark has not passed yet, and the open flow.
Waiting packets lie in buckets of a fixed length of event time, each arrival as an entry of
its own, so arriving packets rewrite nothing and a timer reads only the buckets that are due.
When the watermark passes the end of a bucket, its packets are folded in event-time order, so
input that arrives out of order by less than the watermark delay gives the batch result. One
timer per key is armed, at the end of its first bucket or behind the deadline of its open
flow, whichever comes first; the one it replaces is deleted.

A packet whose bucket the watermark had passed before it came is late. The operator hands it
on instead of cutting it into a flow, so every packet is in exactly one of flows and late
packets, however micro-batches are made.

Event time moves with packets only. On a line that may fall quiet, ``with_heartbeat`` adds the
wall clock, as control rows that move the watermark and are dropped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire.functions.network import idle_timeout_us
from tidewire.operators.flows import describe_flows
from tidewire.operators.packets import with_flow_key
from tidewire.schemas import FLOW_KEY, PACKET_FLAGS
from tidewire.settings import Settings

# A control row of this protocol only moves the event clock, to drain open flows.
CONTROL = "END"

_PACKET = {
    "ts_us": "long",
    "seq": "long",
    "from_a": "boolean",
    "packet_length": "long",
    **{flag: "long" for flag in PACKET_FLAGS},
    "icmp_type": "long",
    "idle_us": "long",
}
_FLOW = {
    "flow_start_us": "long",
    "flow_start_seq": "long",
    "end_us": "long",
    "flow_last_seq": "long",
    "_first_from_a": "boolean",
    "packet_count_total": "long",
    "_packets_a": "long",
    "byte_count_total": "long",
    "_bytes_a": "long",
    "pkt_len_min": "long",
    "pkt_len_max": "long",
    "_len_sq": "long",
    "_gaps": "long",
    "_gap_min": "long",
    "_gap_max": "long",
    "_gap_sum": "long",
    "_gap_sq": "long",
    **{f"{flag}_count": "long" for flag in PACKET_FLAGS},
    "icmp_echo_req_count": "long",
    "icmp_echo_reply_count": "long",
    "idle_us": "long",
}
_KEY_TYPES = {**{k: "string" for k in FLOW_KEY}, "a_port": "int", "b_port": "int"}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


# Workers need not have this package installed: the processor travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a late packet keeps; its addresses are those of the key.
_LATE = {f"_late_{name}": kind for name, kind in _PACKET.items() if name != "idle_us"}
# A row is a flow or, if marked so, a late packet; the columns of the other are zeros, since
# whole numbers beside nulls would come to Python as fractions.
_OUTPUT = {**_KEY_TYPES, "is_late": "boolean", **_FLOW, "finalized_us": "long", **_LATE}
BUCKET_US = 250_000


class FlowProcessor(StatefulProcessor):
    """Open flow and waiting packets of one flow key."""

    def __init__(self, probe_us: int, max_duration_us: int) -> None:
        self.probe_us = probe_us
        self.max_duration_us = max_duration_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket bigint, part bigint", "packets binary")
        # Buckets that hold packets, and how many parts each has.
        self.buckets = handle.getValueState("buckets", "held binary")
        self.open = handle.getValueState("open", _ddl(_FLOW))
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any):
        passed = self._passed(timerValues)
        held = self._held()
        for frame in rows:
            packets = frame[list(_PACKET)].to_numpy(dtype=np.int64)
            bucket = packets[:, 0] // BUCKET_US
            late = bucket < passed
            if late.any():
                found = dict(zip(_LATE, packets[late].T.tolist()))
                yield self._rows(key, {**found, "is_late": [True] * int(late.sum())})
            for at in np.unique(bucket[~late]).tolist():
                part = held.get(at, 0)
                held[at] = part + 1
                self.waiting.updateValue((at, part), (packets[bucket == at].tobytes(),))
        self._hold(held)
        if held:
            self._wake(min(held) + 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any):
        passed = self._passed(timerValues)
        self.timer.clear()
        held = self._held()
        due, parts = sorted(at for at in held if at < passed), []
        for at in due:
            for part in range(held.pop(at)):
                parts.append(np.frombuffer(self.waiting.getValue((at, part))[0], np.int64).reshape(-1, len(_PACKET)))
                self.waiting.removeKey((at, part))
        flow = dict(zip(_FLOW, self.open.get())) if self.open.exists() else None
        closed: list[dict] = []
        if parts:
            packets = np.concatenate(parts)
            packets = packets[np.lexsort((packets[:, 1], packets[:, 0]))]
            closed, flow = self._fold(key[FLOW_KEY.index("protocol")] == "TCP", packets, flow)
        # No packet up to the deadline can come or wait any more.
        if flow is not None and self._deadline(flow) < passed * BUCKET_US:
            closed.append({**flow, "finalized_us": self._deadline(flow)})
            flow = None

        if due:
            self._hold(held)
        if flow is None:
            self.open.clear()
        else:
            self.open.update(tuple(flow[name] for name in _FLOW))
        upcoming = [min(held) + 1] if held else []
        if flow is not None:
            upcoming.append(self._deadline(flow) // BUCKET_US + 1)
        if upcoming:
            self._wake(min(upcoming))
        if closed:
            yield self._rows(key, {name: [f[name] for f in closed] for name in closed[0]})

    @staticmethod
    def _passed(timerValues: Any) -> int:
        """Buckets below this one lie behind the watermark."""
        return timerValues.getCurrentWatermarkInMs() * 1000 // BUCKET_US

    def _held(self) -> dict[int, int]:
        if not self.buckets.exists():
            return {}
        return dict(np.frombuffer(self.buckets.get()[0], np.int64).reshape(-1, 2).tolist())

    def _hold(self, held: dict[int, int]) -> None:
        if held:
            self.buckets.update((np.array(list(held.items()), np.int64).tobytes(),))
        else:
            self.buckets.clear()

    def _wake(self, bucket: int) -> None:
        """Arm the key's only timer for the beginning of a bucket, unless it rings before."""
        at = bucket * BUCKET_US // 1000
        if self.timer.exists():
            (armed,) = self.timer.get()
            if armed <= at:
                return
            self.handle.deleteTimer(armed)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    @staticmethod
    def _rows(key: Any, columns: dict[str, list]) -> pd.DataFrame:
        count = len(next(iter(columns.values())))
        filled = {**{name: [value] * count for name, value in zip(FLOW_KEY, key)}, **columns}
        frame = pd.DataFrame({name: filled.get(name, [0] * count) for name in _OUTPUT})
        return frame.astype({name: bool for name, kind in _OUTPUT.items() if kind == "boolean"})

    def _deadline(self, flow: dict) -> int:
        """Last instant at which a packet still belongs to the flow."""
        quiet = flow["psh_count"] + flow["fin_count"] + flow["rst_count"] == 0
        # Only TCP has a probe timeout; its flows carry a negative idle marker otherwise.
        probe = flow["idle_us"] < 0 and quiet and flow["packet_count_total"] <= 3
        idle = self.probe_us if probe else abs(flow["idle_us"])
        return min(flow["end_us"] + idle, flow["flow_start_us"] + self.max_duration_us)

    def _fold(self, tcp: bool, packets: np.ndarray, flow: dict | None) -> tuple[list[dict], dict | None]:
        """Cuts sorted packets into flows, the first of which may go on; closed ones, open one.

        Where flows begin and end is told packet by packet from a few numbers; what flows are
        made of is summed for all of them at once.
        """
        column = dict(zip(_PACKET, packets.T))
        ends = ((column["fin"] | column["rst"]) > 0) if tcp else np.zeros(len(packets), bool)
        loud = (column["psh"] + column["fin"] + column["rst"]) > 0
        begins: list[int] = []
        closed_at: list[int | None] = []
        deadline = count = start = 0
        quiet = True
        running = flow is not None
        if running:
            begins.append(0)
            start, count = flow["flow_start_us"], flow["packet_count_total"]
            quiet = flow["psh_count"] + flow["fin_count"] + flow["rst_count"] == 0
            deadline = self._deadline(flow)
        # The first packet may close the open flow before it takes any part in it.
        goes_on = running and int(packets[0, 0]) <= deadline
        rows = zip(column["ts_us"].tolist(), column["idle_us"].tolist(), ends.tolist(), loud.tolist())
        for i, (at, idle, final, speaks) in enumerate(rows):
            if running and at > deadline:
                closed_at.append(at)
                running = False
            if not running:
                begins.append(i)
                running, start, count, quiet = True, at, 0, True
            count += 1
            quiet = quiet and not speaks
            wait = self.probe_us if idle < 0 and quiet and count <= 3 else abs(idle)
            deadline = min(at + wait, start + self.max_duration_us)
            if final or at - start >= self.max_duration_us:
                closed_at.append(at)
                running = False
        if flow is not None and not goes_on:
            # Closed as it was; its place in the list has no packets.
            first = [{**flow, "finalized_us": closed_at.pop(0)}]
            begins.pop(0)
            made = self._summed(column, begins, None)
        else:
            first = []
            made = self._summed(column, begins, flow)
        closed = [{**f, "finalized_us": at} for f, at in zip(made, closed_at)]
        return first + closed, made[-1] if running else None

    @staticmethod
    def _summed(column: dict[str, np.ndarray], begins: list[int], flow: dict | None) -> list[dict]:
        """Totals of the flows that begin at these packets; ``flow`` is the first one so far."""
        heads = np.array(begins)
        ends = np.append(heads[1:], len(column["ts_us"]))
        at, length = column["ts_us"], column["packet_length"]
        gap = np.diff(at, prepend=at[0])
        gap[heads] = 0
        if flow is not None:
            gap[0] = at[0] - flow["end_us"]
        a = column["from_a"] > 0
        total = lambda values: np.add.reduceat(values.astype(np.int64), heads).tolist()
        sums = {
            "flow_start_us": at[heads].tolist(),
            "flow_start_seq": column["seq"][heads].tolist(),
            "end_us": at[ends - 1].tolist(),
            "flow_last_seq": column["seq"][ends - 1].tolist(),
            "_first_from_a": a[heads].tolist(),
            "packet_count_total": (ends - heads).tolist(),
            "_packets_a": total(a),
            "byte_count_total": total(length),
            "_bytes_a": total(np.where(a, length, 0)),
            "pkt_len_min": np.minimum.reduceat(length, heads).tolist(),
            "pkt_len_max": np.maximum.reduceat(length, heads).tolist(),
            "_len_sq": total(length * length),
            "_gaps": total(gap > 0),
            "_gap_min": np.minimum.reduceat(np.where(gap > 0, gap, np.iinfo(np.int64).max), heads).tolist(),
            "_gap_max": np.maximum.reduceat(gap, heads).tolist(),
            "_gap_sum": total(gap),
            "_gap_sq": total(gap * gap),
            **{f"{flag}_count": total(column[flag]) for flag in PACKET_FLAGS},
            "icmp_echo_req_count": total(column["icmp_type"] == 8),
            "icmp_echo_reply_count": total(column["icmp_type"] == 0),
            "idle_us": column["idle_us"][heads].tolist(),
        }
        made = [dict(zip(sums, values)) for values in zip(*sums.values())]
        for found in made:
            found["_gap_min"] = found["_gap_min"] if found["_gaps"] else 0
        if flow is not None:
            both = made[0]
            if flow["_gaps"]:
                both["_gap_min"] = min(flow["_gap_min"], both["_gap_min"]) if both["_gaps"] else flow["_gap_min"]
            for name in ("_gap_max", "pkt_len_max"):
                both[name] = max(both[name], flow[name])
            both["pkt_len_min"] = min(both["pkt_len_min"], flow["pkt_len_min"])
            for name in ("flow_start_us", "flow_start_seq", "_first_from_a", "idle_us"):
                both[name] = flow[name]
            kept = {"end_us", "flow_last_seq", "_gap_min", "_gap_max", "pkt_len_max", "pkt_len_min", "flow_start_us", "flow_start_seq", "_first_from_a", "idle_us"}
            for name in set(_FLOW) - kept:
                both[name] += flow[name]
        return made


def with_heartbeat(packets: DataFrame, beats: DataFrame) -> DataFrame:
    """``packets`` and, as control rows, the times of another stream (``timestamp``).

    On a live line the beats are ``spark.readStream.format("rate")``, which is the wall clock.
    """
    empty = {f.name: F.lit(None).cast(f.dataType) for f in packets.schema.fields}
    row = {
        **empty,
        "ts_us": F.unix_micros("timestamp"),
        "protocol": F.lit(CONTROL),
    }
    return packets.unionByName(beats.select(*[column.cast(packets.schema[name].dataType).alias(name) for name, column in row.items()]))


def timed_packets(packets: DataFrame, settings: Settings) -> DataFrame:
    """Keyed packets with the watermark; control rows have moved it and are gone."""
    delay = f"{round(settings.watermark_seconds * 1000)} milliseconds"
    timed = packets.withColumn("ts", F.timestamp_micros("ts_us")).withWatermark("ts", delay)
    # One condition on both columns: a test of the protocol alone would be pushed below
    # the watermark, which then never saw the control rows.
    control = (F.col("protocol") == CONTROL) & (F.col("ts") >= F.timestamp_micros(F.lit(0)))
    return with_flow_key(timed.where(~control))


def cut_stream(packets: DataFrame, settings: Settings) -> DataFrame:
    """Totals of flows as they are finalised, and late packets, from one stateful operator.

    Keyed state with timers needs the RocksDB state store, which is chosen here.
    """
    packets.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # The processor learns from the sign whether a flow has a probe timeout.
    idle = idle_timeout_us(F.col("protocol"), settings)
    signed = F.when(F.col("protocol") == "TCP", -idle).otherwise(idle)
    keyed = timed_packets(packets, settings).withColumn("idle_us", signed)
    # Without the column that carries the watermark: Spark would drop late rows by itself.
    inputs = keyed.select(
        *[F.col(k).cast(t).alias(k) for k, t in _KEY_TYPES.items()],
        *[F.col(c).cast(t).alias(c) for c, t in _PACKET.items()],
    )
    return inputs.groupBy(*FLOW_KEY).transformWithStateInPandas(
        statefulProcessor=FlowProcessor(settings.probe_us, settings.max_duration_us),
        outputStructType=_ddl(_OUTPUT),
        outputMode="Append",
        timeMode="EventTime",
    )


def finished_flows(cut: DataFrame, *more: str) -> DataFrame:
    """The flows of ``cut_stream``: the batch columns, ``flow_id`` and ``finalized_us``.

    Ids come from the flow's identity, because a number in finalisation order would
    need all keys in one place.
    """
    gaps = {c: F.when(F.col("_gaps") > 0, F.col(c)) for c in ("_gap_min", "_gap_max", "_gap_sum", "_gap_sq")}
    flows = cut.where("not is_late")
    described = describe_flows(
        flows.withColumns({**gaps, "_gaps": F.nullif(F.col("_gaps"), F.lit(0))}), "finalized_us", *more
    )
    identity = F.concat_ws("|", *FLOW_KEY, "start_us", "flow_start_seq")
    return described.withColumn("flow_id", F.sha2(identity, 256))


def late_packets(cut: DataFrame) -> DataFrame:
    """The packets of ``cut_stream`` that came too late, as packets."""
    late = cut.where("is_late")
    from_a = F.col("_late_from_a")

    def end(a: str, b: str, name: str):
        return F.when(from_a, F.col(a)).otherwise(F.col(b)).alias(name)

    rest = [n for n in _PACKET if n not in ("from_a", "idle_us")]
    return late.select(
        "session_id",
        "capture_id",
        end("a_ip", "b_ip", "src_ip"),
        end("b_ip", "a_ip", "dst_ip"),
        end("a_port", "b_port", "src_port"),
        end("b_port", "a_port", "dst_port"),
        "protocol",
        *[F.col(f"_late_{n}").alias(n) for n in rest],
    )


def flow_stream(packets: DataFrame, settings: Settings) -> DataFrame:
    """Flows of a packet stream as they are finalised."""
    return finished_flows(cut_stream(packets, settings))
