"""Finalisation order: which packet closed a flow, and the flow numbers that follow.

Captures are worked on in blocks of one second, so one capture may hold any share of
the packets. Two things cross a block: the first packet of a later block, and the number of
flows in earlier ones. Both are found on one small row per capture and block and
enter the block as a row at its border. Only keys are sorted; the flows themselves
are joined back at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.network import flow_timeout_us
from tidewire.plans.blocks import BLOCK, block_start
from tidewire.plans.durable import durable
from tidewire.schemas import CAPTURE, SESSION
from tidewire.settings import Settings

_SCOPE = [SESSION, CAPTURE]
_WIDTH = 1_000_000
_ROW = "_row"
# Columns of a flow that decide its number.
INPUTS = [
    *_SCOPE,
    "flow_start_seq",
    "flow_last_seq",
    "protocol",
    "start_us",
    "end_us",
    "packet_count_total",
    "psh_count",
    "fin_count",
    "rst_count",
]
_TRIGGER = ["deadline_us", "trigger_us", "trigger_seq", "trigger_phase"]


def with_expiry_trigger(
    flows: DataFrame, packets: DataFrame, settings: Settings
) -> DataFrame:
    """Add the packet that finalised each flow.

    A flow that closed itself (FIN/RST, or exactly the maximum duration) was finalised
    by its own last packet, in phase 1. Any other flow is finalised by the first packet
    of the capture after its deadline, in phase 0, or by the end of the capture (null).
    """
    stored = _with_rows(flows)
    keys = _triggers(stored, packets, settings).select(_ROW, *_TRIGGER)
    return stored.join(keys, _ROW).select(*flows.columns, *_TRIGGER)


def number_flows(flows: DataFrame, packets: DataFrame, settings: Settings) -> DataFrame:
    """Add the finalising packet and number flows per capture in finalisation order.

    Ids read ``<capture>__000000``. Flows are stored once, so a caller that wants few
    columns passes those and ``INPUTS``.
    """
    stored = _with_rows(flows)
    # Counted and numbered from the same rows.
    keys = _numbers(durable(_triggers(stored, packets, settings)))
    return stored.join(keys, _ROW).select(
        F.format_string("%s__%06d", F.col(CAPTURE), F.col("flow_index")).alias("flow_id"),
        *flows.columns,
        *_TRIGGER,
        "flow_index",
    )


def _with_rows(flows: DataFrame) -> DataFrame:
    """Flows as a table, with a number per row to join on; retries see the same numbers."""
    return durable(flows.withColumn(_ROW, F.monotonically_increasing_id()))


def _triggers(stored: DataFrame, packets: DataFrame, settings: Settings) -> DataFrame:
    """Keys of flows with their deadlines and triggers."""
    closed = (F.col("protocol") == "TCP") & ((F.col("fin_count") > 0) | (F.col("rst_count") > 0))
    expired_at = F.least(
        F.col("end_us") + flow_timeout_us(None, settings),
        F.col("start_us") + settings.max_duration_us,
    )
    itself = F.coalesce(
        closed | (F.col("end_us") - F.col("start_us") >= settings.max_duration_us), F.lit(False)
    )
    names = [_ROW, "start_us", "flow_start_seq", "deadline_us"]
    keys = stored.select(
        *_SCOPE,
        _ROW,
        "start_us",
        "flow_start_seq",
        expired_at.alias("deadline_us"),
        F.struct(F.col("end_us").alias("ts_us"), F.col("flow_last_seq").alias("seq")).alias("_own"),
        itself.alias("_self"),
    )
    own = keys.where("_self").select(*_SCOPE, *names, F.col("_own").alias("_packet"), F.lit(1).alias("trigger_phase"))
    waiting = keys.where(~F.col("_self"))
    found = _next_packets(waiting, packets, names).withColumn("trigger_phase", F.lit(0))
    return own.unionByName(found).select(
        *_SCOPE,
        *names,
        F.col("_packet.ts_us").alias("trigger_us"),
        F.col("_packet.seq").alias("trigger_seq"),
        "trigger_phase",
    )


def _next_packets(waiting: DataFrame, packets: DataFrame, names: list[str]) -> DataFrame:
    """First packet of the capture strictly after each deadline, null when there is none."""
    flow = F.struct(*names)
    packet = F.struct("ts_us", "seq")
    arrivals = packets.select(
        *_SCOPE, block_start(F.col("ts_us"), _WIDTH).alias(BLOCK), packet.alias("_packet")
    )
    deadlines = waiting.select(
        *_SCOPE, block_start(F.col("deadline_us"), _WIDTH).alias(BLOCK), flow.alias("_flow")
    )
    none = F.lit(None).cast(arrivals.schema["_packet"].dataType)
    no_flow = F.lit(None).cast(deadlines.schema["_flow"].dataType)

    firsts = (
        arrivals.unionByName(deadlines.select(*_SCOPE, BLOCK, none.alias("_packet")))
        .groupBy(*_SCOPE, BLOCK)
        .agg(F.min("_packet").alias("_first"))
    )
    later = (
        Window.partitionBy(*_SCOPE)
        .orderBy(F.col(BLOCK).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    borders = firsts.select(*_SCOPE, BLOCK, F.last("_first", ignorenulls=True).over(later).alias("_packet"))

    def events(rows: DataFrame, at: Column, kind: int, of: Column, on: Column) -> DataFrame:
        return rows.select(
            *_SCOPE,
            BLOCK,
            at.alias("_at"),
            F.lit(kind).alias("_kind"),
            of.alias("_packet"),
            on.alias("_flow"),
        )

    # Packets sort before the deadlines of the same instant: expiry needs a later one.
    line = (
        events(arrivals, F.col("_packet.ts_us"), 0, F.col("_packet"), no_flow)
        .unionByName(events(deadlines, F.col("_flow.deadline_us"), 1, none, F.col("_flow")))
        .unionByName(events(borders, F.col(BLOCK) + _WIDTH, 2, F.col("_packet"), no_flow))
    )
    # From the far end: a frame that starts there grows by one row per step.
    after = (
        Window.partitionBy(*_SCOPE, BLOCK)
        .orderBy(F.col("_at").desc(), F.col("_kind").desc(), F.col("_packet").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        line.select(*_SCOPE, "_kind", "_flow", F.last("_packet", ignorenulls=True).over(after).alias("_packet"))
        .where("_kind = 1")
        .select(*_SCOPE, "_flow.*", "_packet")
    )


def _numbers(keys: DataFrame) -> DataFrame:
    """Place of each flow in its capture; flows open at the end come last."""
    placed = keys.withColumns(
        {
            "_open": F.col("trigger_us").isNull(),
            BLOCK: block_start(F.coalesce("trigger_us", "start_us"), _WIDTH),
        }
    )
    group = [*_SCOPE, "_open", BLOCK]
    earlier = (
        Window.partitionBy(*_SCOPE)
        .orderBy("_open", BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    # The border row stands first in its block, for all flows of the blocks before.
    borders = counts.select(
        *group, F.lit(0).alias("_kind"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n")
    )
    flows = placed.select(
        *group,
        F.lit(1).alias("_kind"),
        F.lit(1).cast("long").alias("_n"),
        _ROW,
        "start_us",
        "flow_start_seq",
        *_TRIGGER,
    )
    so_far = (
        Window.partitionBy(*group)
        .orderBy("_kind", "trigger_us", "trigger_seq", "trigger_phase", "start_us", "flow_start_seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = flows.unionByName(borders, allowMissingColumns=True)
    return (
        counted.select(_ROW, *_TRIGGER, "_kind", (F.sum("_n").over(so_far) - 1).alias("flow_index"))
        .where("_kind = 1")
        .drop("_kind")
    )
