"""Sliding-window features on a stream, as a stateful operator behind the one that cuts flows.

State is kept per source host of a capture: what a window can still reach, that is flows that
began within 5.1 seconds of the source's newest one. A flow's windows hold the flows of its
source that are finished by then and began no later than itself, so where flows finish in the
order in which they began the features are those of a batch. Flows that finish in the same
micro-batch see each other. A source is forgotten once the watermark is so far behind its
newest flow that no flow can be finished any more whose windows reach it.
"""

from __future__ import annotations

import json
import sys
from collections import Counter
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire.schemas import CAPTURE, SESSION
from tidewire.settings import Settings

# Workers need not have this package installed: the processor travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = (
    "connections_per_1s",
    "connections_per_5s",
    "distinct_dst_ports_per_5s",
    "distinct_dst_ips_per_5s",
    "icmp_packets_per_1s",
)
ONE_US, FIVE_US, KEPT_US = 1_000_000, 5_000_000, 5_100_000


def window_features(flows: list[tuple[int, int, str, int]]) -> list[tuple[int, int, int, int, int]]:
    """The five counts at every flow of (start, destination port and address, ICMP packets),
    sorted by start; windows include both ends."""
    ports, addresses = Counter(), Counter()
    first_one = first_five = icmp = 0
    found = []
    for i, (start, port, address, packets) in enumerate(flows):
        ports[port] += 1
        addresses[address] += 1
        icmp += packets
        while start - flows[first_one][0] > ONE_US:
            icmp -= flows[first_one][3]
            first_one += 1
        while start - flows[first_five][0] > FIVE_US:
            for held, value in ((ports, flows[first_five][1]), (addresses, flows[first_five][2])):
                held[value] -= 1
                if not held[value]:
                    del held[value]
            first_five += 1
        found.append((i - first_one + 1, i - first_five + 1, len(ports), len(addresses), icmp))
    return found


class WindowProcessor(StatefulProcessor):
    """The recent flows of one source."""

    def __init__(self, names: list[str], forgotten_us: int) -> None:
        self.names = names
        self.forgotten_us = forgotten_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", "flows string")
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any):
        frame = pd.concat(list(rows), ignore_index=True)
        late = frame["is_late"].astype(bool)
        if late.any():
            yield frame[late].assign(**dict.fromkeys(FEATURES, 0))[[*self.names, *FEATURES]]
        fresh = frame[~late].sort_values(["flow_start_us", "finalized_us", "flow_start_seq"], kind="stable")
        if fresh.empty:
            return
        icmp = fresh["packet_count_total"].where(fresh["protocol"] == "ICMP", 0)
        own = zip(*(fresh[c].tolist() for c in ("flow_start_us", "dst_port", "dst_ip")), icmp.tolist())
        known = [tuple(f) for f in json.loads(self.recent.get()[0])] if self.recent.exists() else []
        # Of flows that began at the same instant, those known before come first.
        merged = sorted([(f[0], 0, i, f) for i, f in enumerate(known)] + [(f[0], 1, i, f) for i, f in enumerate(own)])
        counts = window_features([f for *_, f in merged])
        added = [c for (_, new, _, _), c in zip(merged, counts) if new]
        yield fresh.assign(**dict(zip(FEATURES, map(list, zip(*added)))))[[*self.names, *FEATURES]]
        newest = merged[-1][0]
        self.recent.update((json.dumps([f for start, _, _, f in merged if start >= newest - KEPT_US]),))
        at = (newest + self.forgotten_us) // 1000
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any):
        self.recent.clear()
        self.timer.clear()
        return iter([])


def with_stream_windows(cut: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``cut_stream`` with the five counts; late packets pass with zeros."""
    forward = F.when(F.col("is_late"), F.col("_late_from_a")).otherwise(F.col("_first_from_a"))

    def end(one: str, other: str):
        return F.when(forward, F.col(one)).otherwise(F.col(other))

    # Names with a leading underscore do not survive the way into a processor.
    plain = [f"x{name}" if name.startswith("_") else name for name in cut.columns]
    placed = cut.withColumns(
        {"src_ip": end("a_ip", "b_ip"), "dst_ip": end("b_ip", "a_ip"), "dst_port": end("b_port", "a_port").cast("long")}
    )
    sent = placed.select(*[F.col(n).alias(p) for n, p in zip(cut.columns, plain)], "src_ip", "dst_ip", "dst_port")
    fields = ", ".join(f"`{p}` {f.dataType.simpleString()}" for p, f in zip(plain, cut.schema.fields))
    counted = sent.groupBy(SESSION, CAPTURE, "src_ip").transformWithStateInPandas(
        # A flow is finished, at the latest, so long after it began.
        statefulProcessor=WindowProcessor(plain, settings.max_duration_us + 2 * KEPT_US),
        outputStructType=f"{fields}, " + ", ".join(f"{name} bigint" for name in FEATURES),
        outputMode="Append",
        timeMode="EventTime",
    )
    return counted.select(*[F.col(p).alias(n) for n, p in zip(cut.columns, plain)], *FEATURES)
