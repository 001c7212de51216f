"""Packet-level filters and the canonical flow key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.settings import Settings

# Ports of the address-configuration protocols left out of a capture.
_BOOTSTRAP_PORTS = (67, 68)


def keep_ip_traffic(packets: DataFrame) -> DataFrame:
    """Packets with both addresses that are not DHCP/BOOTP."""
    bootstrap = (
        (F.col("protocol") == "UDP")
        & F.col("src_port").isin(*_BOOTSTRAP_PORTS)
        & F.col("dst_port").isin(*_BOOTSTRAP_PORTS)
    )
    present = (F.col("src_ip") != "") & (F.col("dst_ip") != "")
    return packets.where(present & ~bootstrap)


def with_flow_key(packets: DataFrame) -> DataFrame:
    """Both directions of a conversation get the same (a, b) endpoints."""
    forward = (F.col("src_ip") < F.col("dst_ip")) | (
        (F.col("src_ip") == F.col("dst_ip")) & (F.col("src_port") <= F.col("dst_port"))
    )

    def pick(first: str, second: str) -> Column:
        return F.when(F.col("from_a"), F.col(first)).otherwise(F.col(second))

    return packets.withColumn("from_a", forward).select(
        "*",
        pick("src_ip", "dst_ip").alias("a_ip"),
        pick("src_port", "dst_port").alias("a_port"),
        pick("dst_ip", "src_ip").alias("b_ip"),
        pick("dst_port", "src_port").alias("b_port"),
    )


def is_control_plane(controller: str) -> Column:
    """SSH between the controller and the traffic source of a normal capture."""
    source = F.trim(F.coalesce("source_host", F.lit("")))
    to_source = (F.col("src_ip") == controller) & (F.col("dst_ip") == source)
    from_source = (F.col("src_ip") == source) & (F.col("dst_ip") == controller)
    return (
        (F.coalesce("label_binary", F.lit("")) == "normal")
        & (source != "")
        & (source != controller)
        & (to_source | from_source)
        & (F.col("protocol") == "TCP")
        & ((F.col("src_port") == 22) | (F.col("dst_port") == 22))
    )


def drop_control_plane(
    packets: DataFrame, manifest: DataFrame, settings: Settings
) -> DataFrame:
    """Remove controller traffic; captures without a manifest row keep every packet."""
    hosts = manifest.select("capture_id", "label_binary", "source_host")
    joined = packets.join(hosts, "capture_id", "left")
    kept = joined.where(~is_control_plane(settings.controller_host))
    return kept.select(*packets.columns)
