"""Cutting the packets of a flow key into flows.

A packet starts a new flow when it is the key's first, follows a closing packet
(TCP FIN/RST), comes after more than the idle timeout, comes after more than the
probe timeout while the TCP flow is still a bare probe (at most three packets, no
payload push), comes more than the maximum duration after the flow's start, or
follows the packet that reached exactly that duration.

The first three conditions do not depend on where the current flow began, so a
window finds those *hard cuts* for all packets at once. What lies between two hard
cuts is a segment. Nearly every segment is one flow; only segments that last as
long as the maximum duration, or pause longer than the probe timeout, need the
state, and those are folded with ``aggregate``. Keys too large for one task take
the pointer plan of :mod:`tidewire.operators.elephants`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.network import closes_flow, idle_timeout_us
from tidewire.operators.elephants import cut_by_pointers
from tidewire.plans.ordered import by_group_size
from tidewire.schemas import FLOW_KEY
from tidewire.settings import Settings

ORDER = ["ts_us", "seq"]


def assign_flows(packets: DataFrame, settings: Settings) -> DataFrame:
    """Add ``flow_start_us``, ``flow_start_seq``, ``gap_us``, ``is_last`` to keyed packets.

    ``gap_us`` is the time since the previous packet of the same flow, null on its
    first; ``is_last`` marks the flow's last packet. ``(FLOW_KEY, flow_start_seq)``
    identifies a flow.
    """

    def build(rows: DataFrame, heavy: bool) -> DataFrame:
        return cut_by_pointers(rows, settings) if heavy else _cut_by_fold(rows, settings)

    return by_group_size(packets, FLOW_KEY, settings.max_fold_rows, build)


def _cut_by_fold(packets: DataFrame, settings: Settings) -> DataFrame:
    by_key = Window.partitionBy(*FLOW_KEY).orderBy(*ORDER)
    idle = idle_timeout_us(F.col("protocol"), settings)
    gap = F.col("ts_us") - F.lag("ts_us").over(by_key)
    after_close = F.lag(closes_flow()).over(by_key)
    marked = packets.select("*", gap.alias("_gap"), after_close.alias("_after_close"))
    cut = F.col("_gap").isNull() | F.col("_after_close") | (F.col("_gap") > idle)
    marked = marked.withColumn("_cut", cut).withColumn(
        "_segment", F.sum(F.col("_cut").cast("long")).over(by_key)
    )

    by_segment = Window.partitionBy(*FLOW_KEY, "_segment")
    pause = F.when(~F.col("_cut") & (F.col("protocol") == "TCP"), F.col("_gap"))
    marked = marked.select(
        "*",
        F.min(F.struct(*ORDER)).over(by_segment).alias("_first"),
        F.max(F.struct(*ORDER)).over(by_segment).alias("_last"),
        F.coalesce(F.max(pause).over(by_segment), F.lit(0)).alias("_pause"),
    )
    stateful = (
        F.col("_last.ts_us") - F.col("_first.ts_us") >= settings.max_duration_us
    ) | (
        F.col("_pause") > settings.probe_us
    )

    carried = [c for c in packets.columns if c not in FLOW_KEY]
    plain = marked.where(~stateful).select(
        *FLOW_KEY,
        *carried,
        F.col("_first.ts_us").alias("flow_start_us"),
        F.col("_first.seq").alias("flow_start_seq"),
        F.when(~F.col("_cut"), F.col("_gap")).alias("gap_us"),
        (F.col("seq") == F.col("_last.seq")).alias("is_last"),
    )
    return plain.unionByName(_fold_segments(marked.where(stateful), carried, settings))


def _fold_segments(marked: DataFrame, carried: list[str], settings: Settings) -> DataFrame:
    """Replay the few stateful segments; each is bounded by ``max_fold_rows`` packets."""
    rest = [c for c in carried if c not in ORDER]
    lists = marked.groupBy(*FLOW_KEY, "_segment").agg(
        F.sort_array(
            F.collect_list(F.struct(*ORDER, F.col("_gap"), *rest))
        ).alias("_packets")
    )
    zero = F.struct(
        F.lit(None).cast("long").alias("start"),
        F.lit(None).cast("long").alias("last"),
        F.lit(0).alias("count"),
        F.lit(False).alias("pushed"),
        F.lit(0).alias("position"),
        F.array().cast("array<int>").alias("heads"),
    )
    is_tcp = F.col("protocol") == "TCP"

    def step(state: Column, packet: Column) -> Column:
        probe = is_tcp & (state["count"] <= 3) & ~state["pushed"]
        begins = (
            state["start"].isNull()
            | (state["last"] - state["start"] >= settings.max_duration_us)
            | (packet["ts_us"] - state["start"] > settings.max_duration_us)
            | (probe & (packet["_gap"] > settings.probe_us))
        )
        push = packet["psh"] > 0
        position = state["position"] + 1
        return F.struct(
            F.when(begins, packet["ts_us"]).otherwise(state["start"]).alias("start"),
            packet["ts_us"].alias("last"),
            F.when(begins, 1).otherwise(state["count"] + 1).alias("count"),
            F.when(begins, push).otherwise(state["pushed"] | push).alias("pushed"),
            position.alias("position"),
            F.when(begins, F.concat(state["heads"], F.array(position)))
            .otherwise(state["heads"])
            .alias("heads"),
        )

    heads = F.aggregate("_packets", zero, step, lambda state: state["heads"])
    folded = lists.withColumn("_heads", heads)

    def members(head: Column, index: Column) -> Column:
        end = F.coalesce(F.get(F.col("_heads"), index + 1), F.size("_packets") + 1)
        return F.slice("_packets", head, end - head)

    flows = folded.select(
        *FLOW_KEY, F.explode(F.transform("_heads", members)).alias("_flow")
    )
    first, last = F.col("_flow")[0], F.element_at("_flow", -1)
    rows = flows.select(
        *FLOW_KEY,
        first["ts_us"].alias("flow_start_us"),
        first["seq"].alias("flow_start_seq"),
        last["seq"].alias("_last_seq"),
        F.explode("_flow").alias("_packet"),
    )
    starts = F.col("_packet.seq") == F.col("flow_start_seq")
    return rows.select(
        *FLOW_KEY,
        *[F.col(f"_packet.{c}").alias(c) for c in carried],
        "flow_start_us",
        "flow_start_seq",
        F.when(~starts, F.col("_packet._gap")).alias("gap_us"),
        (F.col("_packet.seq") == F.col("_last_seq")).alias("is_last"),
    )
