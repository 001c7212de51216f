"""Sliding-window behaviour of a source host, exact and without window lists.

Every flow becomes one arrival and an expiry per window length (one and five seconds
later, plus a microsecond, because the windows include both ends). Each event carries
what it adds to or removes from the wanted features, and a running sum over the
source's events is the answer. For distinct values a flow adds one only when the same
value was not seen in the five seconds before, and removes one only when it is not
seen in the five seconds after. Cost is one sort, whatever the windows hold; a frame
of the source's flows would cost its size per row in exactly the floods these features
are for.

No window looks back further than five seconds, so a source is cut into blocks of
twenty seconds that also get the last five of the block before: a source with half of
all flows is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.network import failed_connection_ratio
from tidewire.plans.blocks import BLOCK, with_look_back
from tidewire.schemas import CAPTURE, SESSION

_ONE = 1_000_000
_FIVE = 5_000_000
_WIDTH = 20_000_000
_GROUP = [SESSION, CAPTURE, "src_ip", BLOCK]

# Feature -> length of its window.
WINDOW_FEATURES = {
    "connections_per_1s": _ONE,
    "connections_per_5s": _FIVE,
    "distinct_dst_ports_per_5s": _FIVE,
    "distinct_dst_ips_per_5s": _FIVE,
    "icmp_packets_per_1s": _ONE,
}
_VALUES = {"distinct_dst_ports_per_5s": "dst_port", "distinct_dst_ips_per_5s": "dst_ip"}


def _with_edges(df: DataFrame, feature: str) -> DataFrame:
    """1 where a value enters its window, 1 where it leaves for good."""
    order = Window.partitionBy(*_GROUP, _VALUES[feature]).orderBy("start_us", "flow_index")
    at, span = F.col("start_us"), WINDOW_FEATURES[feature]
    entered = F.coalesce(at - F.lag(at).over(order) > span, F.lit(True))
    left = F.coalesce(F.lead(at).over(order) - at > span, F.lit(True))
    return df.select(
        "*",
        entered.cast("long").alias(f"_enters_{feature}"),
        left.cast("long").alias(f"_leaves_{feature}"),
    )


def _change(feature: str, arrives: bool) -> Column:
    """What a flow adds to the feature when it arrives or removes when it expires."""
    if feature in _VALUES:
        return F.col(f"_enters_{feature}") if arrives else -F.col(f"_leaves_{feature}")
    amount = F.lit(1)
    if feature == "icmp_packets_per_1s":
        amount = F.when(F.col("protocol") == "ICMP", F.col("packet_count_total")).otherwise(0)
    return (amount if arrives else -amount).cast("long")


def with_window_features(
    flows: DataFrame, wanted: Sequence[str] = tuple(WINDOW_FEATURES)
) -> DataFrame:
    """Add the sliding-window counts named in ``wanted``.

    Equal start times count in flow-index order. Without wanted features the flows come
    back as they are; an empty table gives no rows.
    """
    if not wanted:
        return flows
    # One shuffle serves the per-value and the per-source windows alike.
    marked = with_look_back(flows, F.col("start_us"), _WIDTH, _FIVE).repartition(*_GROUP)
    for feature in wanted:
        if feature in _VALUES:
            marked = _with_edges(marked, feature)

    row = F.struct(*[F.col(c) for c in flows.columns])
    none = F.lit(None).cast(flows.select(row).schema[0].dataType)

    def event(at: Column, kind: int, flow: Column, changes: dict[str, Column]) -> Column:
        return F.struct(
            at.alias("_at"),
            F.lit(kind).alias("_kind"),
            F.col("flow_index").alias("_tie"),
            *[changes.get(f, F.lit(0).cast("long")).alias(f"_by_{f}") for f in wanted],
            flow.alias("_flow"),
        )

    at = F.col("start_us")
    arrival = event(at, 1, F.when(F.col("_own"), row), {f: _change(f, True) for f in wanted})
    expiries = []
    for span in sorted({WINDOW_FEATURES[f] for f in wanted}):
        ending = [f for f in wanted if WINDOW_FEATURES[f] == span]
        expiries.append(event(at + span + 1, 0, none, {f: _change(f, False) for f in ending}))
    events = marked.select(*_GROUP, F.inline(F.array(arrival, *expiries)))

    so_far = (
        Window.partitionBy(*_GROUP)
        .orderBy("_at", "_kind", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = events.select("_flow", *[F.sum(f"_by_{f}").over(so_far).alias(f) for f in wanted])
    return summed.where(F.col("_flow").isNotNull()).select("_flow.*", *wanted)


def with_behaviour(flows: DataFrame) -> DataFrame:
    """The five window counts and the failed-connection ratio."""
    ratio = failed_connection_ratio(
        F.col("protocol"), F.col("syn_count"), F.col("ack_count"), F.col("rst_count")
    )
    return with_window_features(flows).withColumn("failed_connection_ratio", ratio)
