"""Cutting a flow key that is too large for one task, exactly and in parallel.

Where a flow ends depends only on where it began. So every packet gets a pointer to
the packet that would start the *next* flow if a flow started here; that takes ordered
scans but no state. The real flow starts are what the pointers reach from the hard
cuts, and following them one by one would be sequential. Instead:

* going up, pointers are composed: at level ``l`` a pointer leads to the first start
  outside its block of ``2**l`` widths, and one self-join makes the next level. Blocks
  start out no wider than the shortest jump, so one hop per level is enough. Once blocks
  are wider than the longest jump, only packets near the start of a block can be the
  first start in it, so every level holds half as many pointers as the one before;
* going down, the starts known per block yield, in one join, those of the half blocks.

The number of rounds is the logarithm of the time covered, the work is that of a few
passes over the packets of heavy keys, and all joins are on (key, packet rank), which
spreads a single key evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.network import closes_flow, idle_timeout_us
from tidewire.plans.durable import durable
from tidewire.plans.ordered import (
    SLICE,
    following,
    latest,
    lay_out,
    previous,
    running_sum,
)
from tidewire.schemas import FLOW_KEY
from tidewire.settings import Settings

_ORDER = ["ts_us", "seq"]


def cut_by_pointers(packets: DataFrame, settings: Settings) -> DataFrame:
    """Same result as the fold over segments, for keys of any size."""
    laid = lay_out(packets, FLOW_KEY, _ORDER, True)
    before = F.struct(F.col("ts_us").alias("at"), closes_flow().alias("closing"))
    laid = previous(laid, FLOW_KEY, _ORDER, "_before", before, True)
    idle = idle_timeout_us(F.col("protocol"), settings)
    gap = F.col("ts_us") - F.col("_before.at")
    cut = F.col("_before").isNull() | F.col("_before.closing") | (gap > idle)
    laid = laid.select(*packets.columns, SLICE, gap.alias("_gap"), cut.alias("_cut"))
    marked = durable(running_sum(laid, FLOW_KEY, _ORDER, {"_rank": F.lit(1)}, True))

    starts = _reached(durable(_pointers(marked, settings)), settings)
    heads = starts.select(*FLOW_KEY, "_rank", F.lit(True).alias("_head"))
    joined = marked.join(heads, [*FLOW_KEY, "_rank"], "left").withColumn(
        "_head", F.coalesce("_head", F.lit(False))
    )
    start = F.when(F.col("_head"), F.struct("ts_us", "seq"))
    joined = latest(joined, FLOW_KEY, _ORDER, "_start", start, True)
    joined = following(joined, FLOW_KEY, _ORDER, "_next_head", F.col("_head"), True)
    return joined.select(
        *packets.columns,
        F.col("_start.ts_us").alias("flow_start_us"),
        F.col("_start.seq").alias("flow_start_seq"),
        F.when(~F.col("_head"), F.col("_gap")).alias("gap_us"),
        F.coalesce("_next_head", F.lit(True)).alias("is_last"),
    )


def _pointers(marked: DataFrame, settings: Settings) -> DataFrame:
    """Per packet: rank and time of the next flow start if a flow started here.

    Null when the next hard cut comes first.
    """
    is_tcp = F.col("protocol") == "TCP"
    here = F.struct(F.col("_rank").alias("rank"), F.col("ts_us").alias("at"))
    loud = (F.col("psh") > 0) | (F.col("fin") > 0) | (F.col("rst") > 0)
    pause = is_tcp & ~F.col("_cut") & (F.col("_gap") > settings.probe_us)
    rows = marked.select(
        *FLOW_KEY, *_ORDER, SLICE, "_rank", "_cut", loud.alias("_is_loud"),
        pause.alias("_is_pause"), here.alias("_here"),
    )

    def ahead(df: DataFrame, name: str, value: Column) -> DataFrame:
        return following(df, FLOW_KEY, _ORDER, name, value, True)

    rank = F.col("_rank")
    rows = ahead(rows, "_pause", F.when(F.col("_is_pause"), F.col("_here")))
    rows = ahead(rows, "_loud", F.when(F.col("_is_loud"), rank))
    rows = ahead(rows, "_wall", F.when(F.col("_cut"), rank))
    rows = ahead(rows, "_next_us", F.col("ts_us"))

    first_loud = F.when(F.col("_is_loud"), rank).otherwise(F.col("_loud"))
    quiet = F.coalesce(first_loud >= F.col("_pause.rank"), F.lit(True))
    probe_end = F.when((F.col("_pause.rank") - rank <= 3) & quiet, F.col("_pause"))

    # The packet that reaches the maximum duration: markers sort before packets of the
    # same instant, and find the first packet behind them.
    packet = F.struct("_here", F.col("_next_us"))
    origin = F.struct(
        "_here", F.col("_cut").alias("root"), F.col("_wall"), probe_end.alias("probe_end")
    )
    shape = rows.select(packet.alias("p"), origin.alias("o")).schema
    no_packet, no_origin = F.lit(None).cast(shape["p"].dataType), F.lit(None).cast(shape["o"].dataType)

    def event(at: Column, kind: int, seen: Column, source: Column) -> Column:
        return F.struct(
            at.alias("_at"),
            F.lit(kind).alias("_kind"),
            rank.alias("_tie"),
            seen.alias("_seen"),
            source.alias("_origin"),
        )

    events = F.array(
        event(F.col("ts_us"), 1, packet, no_origin),
        event(F.col("ts_us") + settings.max_duration_us, 0, no_packet, origin),
    )
    order = ["_at", "_kind", "_tie"]
    laid = lay_out(rows.select(*FLOW_KEY, F.inline(events)), FLOW_KEY, order, True)
    found = following(laid, FLOW_KEY, order, "_hit", F.col("_seen"), True).where("_kind = 0")

    hit = F.col("_hit._here")
    # Reaching the duration exactly belongs to the flow; the packet after it does not.
    after_hit = F.when(
        F.col("_hit._next_us").isNotNull(),
        F.struct((hit["rank"] + 1).alias("rank"), F.col("_hit._next_us").alias("at")),
    )
    too_long = F.when(hit["at"] > F.col("_at"), hit).otherwise(after_hit)
    target = F.least(F.col("_origin.probe_end"), too_long)
    inside = F.coalesce(target["rank"] < F.col("_origin._wall"), F.lit(True))
    step = F.when(inside, target)
    return found.select(
        *FLOW_KEY,
        F.col("_origin._here.rank").alias("_rank"),
        F.col("_origin._here.at").alias("at"),
        F.col("_origin.root").alias("root"),
        step["rank"].alias("next_rank"),
        step["at"].alias("next_at"),
    )


def _reached(pointers: DataFrame, settings: Settings) -> DataFrame:
    """Hard cuts and every packet their pointers lead to."""
    base, last = pointers.agg(F.min("at"), F.max("at")).first()
    longest_jump = settings.max_duration_us + settings.longest_idle_us

    def block(column: str, width: int) -> Column:
        return F.expr(f"({column} - {base}) div {width}")

    def follow(left: DataFrame, right: DataFrame) -> DataFrame:
        """Rows of ``left`` with what their ``next`` packet points to."""
        target = right.select(
            *[F.col(k).alias(f"to_{k}") for k in FLOW_KEY],
            F.col("_rank").alias("to_rank"),
            F.col("next_rank").alias("hop_rank"),
            F.col("next_at").alias("hop_at"),
        )
        match = left["next_rank"] == target["to_rank"]
        for key in FLOW_KEY:
            match = match & left[key].eqNullSafe(target[f"to_{key}"])
        return left.join(target, match)

    live = pointers.where(F.col("next_rank").isNotNull())
    levels: list[tuple[int, DataFrame]] = []
    width = min(settings.probe_us, settings.max_duration_us)
    while width <= last - base:
        levels.append((width, live))
        width *= 2
        stays = block("at", width) == block("next_at", width)
        hopped = follow(live.where(stays), live).select(
            *FLOW_KEY,
            "_rank",
            "at",
            "root",
            F.col("hop_rank").alias("next_rank"),
            F.col("hop_at").alias("next_at"),
        )
        live = live.where(~stays).unionByName(hopped)
        if width >= longest_jump:
            near = F.expr(f"(at - {base}) % {width}") <= longest_jump
            live = live.where(F.col("root") | near)
        live = durable(live)

    reached = pointers.where("root").select(*FLOW_KEY, "_rank", "at")
    for width, level in reversed(levels):
        step = reached.select(*FLOW_KEY, F.col("_rank").alias("next_rank"), "at")
        found = follow(step, level).where(
            block("at", 2 * width) == block("hop_at", 2 * width)
        )
        further = found.select(
            *FLOW_KEY, F.col("hop_rank").alias("_rank"), F.col("hop_at").alias("at")
        )
        reached = durable(reached.unionByName(further))
    return reached
