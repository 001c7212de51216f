"""Flow rows: one aggregation over packets that know their flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.network import iso_utc
from tidewire.functions.numbers import rounded_ratio
from tidewire.operators.packets import with_flow_key
from tidewire.operators.segments import assign_flows
from tidewire.schemas import FLOW_KEY, PACKET_FLAGS
from tidewire.settings import Settings

_FLOW_ID = [*FLOW_KEY, "flow_start_us", "flow_start_seq"]


def aggregate_flows(packets: DataFrame) -> DataFrame:
    """Per-flow totals. All sums are over integers, so any order gives the same bits."""
    length = F.col("packet_length").cast("long")
    is_first = F.col("seq") == F.col("flow_start_seq")
    gap = F.when(F.col("gap_us") > 0, F.col("gap_us"))
    sums = packets.groupBy(*_FLOW_ID).agg(
        F.max("ts_us").alias("end_us"),
        F.max(F.when(F.col("is_last"), F.col("seq"))).alias("flow_last_seq"),
        F.max(F.when(is_first, F.col("from_a"))).alias("_first_from_a"),
        F.count(F.lit(1)).alias("packet_count_total"),
        F.count_if("from_a").alias("_packets_a"),
        F.sum(length).alias("byte_count_total"),
        F.sum(F.when(F.col("from_a"), length).otherwise(0)).alias("_bytes_a"),
        F.min(length).alias("pkt_len_min"),
        F.max(length).alias("pkt_len_max"),
        F.sum(length * length).alias("_len_sq"),
        F.count(gap).alias("_gaps"),
        F.min(gap).alias("_gap_min"),
        F.max(gap).alias("_gap_max"),
        F.sum(gap).alias("_gap_sum"),
        F.sum(gap * gap).alias("_gap_sq"),
        *[
            F.sum(flag).cast("long").alias(f"{flag}_count")
            for flag in PACKET_FLAGS
        ],
        F.count_if(F.col("icmp_type") == 8).alias("icmp_echo_req_count"),
        F.count_if(F.col("icmp_type") == 0).alias("icmp_echo_reply_count"),
    )
    return describe_flows(sums)


def describe_flows(sums: DataFrame, *keep: str) -> DataFrame:
    """Flow columns from integer totals, which a batch or a stream has summed up."""
    n = F.col("packet_count_total")
    forward_is_a = F.col("_first_from_a")

    def endpoint(forward: str, backward: str) -> Column:
        return F.when(forward_is_a, F.col(forward)).otherwise(F.col(backward))

    mean = F.col("byte_count_total") / n
    variance = F.greatest(F.lit(0.0), F.col("_len_sq") / n - mean * mean)
    gap_mean = F.col("_gap_sum") / F.col("_gaps")
    gap_variance = F.greatest(F.lit(0.0), F.col("_gap_sq") / F.col("_gaps") - gap_mean * gap_mean)

    # Milliseconds with six digits: a thousand steps to the microsecond.
    gap_mean_ms = rounded_ratio(F.col("_gap_sum"), F.col("_gaps") * 1000, 6)

    def ms(micros: Column) -> Column:
        return F.round(F.coalesce(micros / 1000, F.lit(0.0)), 6)

    packets_fwd = F.when(forward_is_a, F.col("_packets_a")).otherwise(n - F.col("_packets_a"))
    bytes_fwd = F.when(forward_is_a, F.col("_bytes_a")).otherwise(
        F.col("byte_count_total") - F.col("_bytes_a")
    )
    return sums.select(
        *FLOW_KEY,
        *keep,
        "flow_start_seq",
        "flow_last_seq",
        F.col("flow_start_us").alias("start_us"),
        "end_us",
        (F.col("flow_start_us") / 1_000_000).alias("start_ts"),
        (F.col("end_us") / 1_000_000).alias("end_ts"),
        iso_utc(F.col("flow_start_us")).alias("start_time"),
        iso_utc(F.col("end_us")).alias("end_time"),
        endpoint("a_ip", "b_ip").alias("src_ip"),
        endpoint("b_ip", "a_ip").alias("dst_ip"),
        endpoint("a_port", "b_port").cast("long").alias("src_port"),
        endpoint("b_port", "a_port").cast("long").alias("dst_port"),
        F.round((F.col("end_us") - F.col("flow_start_us")) / 1000, 3).alias("duration_ms"),
        "packet_count_total",
        packets_fwd.alias("packet_count_fwd"),
        (n - packets_fwd).alias("packet_count_bwd"),
        "byte_count_total",
        bytes_fwd.alias("byte_count_fwd"),
        (F.col("byte_count_total") - bytes_fwd).alias("byte_count_bwd"),
        "pkt_len_min",
        "pkt_len_max",
        rounded_ratio(F.col("byte_count_total"), n, 6).alias("pkt_len_mean"),
        F.round(F.sqrt(variance), 6).alias("pkt_len_std"),
        ms(F.col("_gap_min")).alias("iat_min_ms"),
        ms(F.col("_gap_max")).alias("iat_max_ms"),
        F.coalesce(gap_mean_ms, F.lit(0.0)).alias("iat_mean_ms"),
        ms(F.sqrt(gap_variance)).alias("iat_std_ms"),
        "syn_count",
        "ack_count",
        "rst_count",
        "fin_count",
        "psh_count",
        "icmp_echo_req_count",
        "icmp_echo_reply_count",
    )


def flow_table(packets: DataFrame, settings: Settings) -> DataFrame:
    """Packets to flows: key, cut, aggregate.

    Only what the aggregation needs travels, the same in every branch of the cut, so the
    branches share one shuffle.
    """
    keyed = with_flow_key(packets).select(
        *FLOW_KEY, "ts_us", "seq", "from_a", "packet_length", *PACKET_FLAGS, "icmp_type"
    )
    return aggregate_flows(assign_flows(keyed, settings))
