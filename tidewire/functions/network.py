"""Packet- and flow-level expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.settings import Settings


def protocol_name(number: Column) -> Column:
    # IANA protocol numbers with a name of their own.
    return (
        F.when(number == 1, "ICMP")
        .when(number == 6, "TCP")
        .when(number == 17, "UDP")
        .otherwise(F.concat(F.lit("IP_"), number.cast("string")))
    )


def lenient_double(text: Column, default: float) -> Column:
    return F.coalesce(F.trim(text).try_cast("double"), F.lit(default))


def lenient_int(text: Column, default: int) -> Column:
    """Blank or garbage gives the default; ``60.9`` truncates to 60."""
    return F.coalesce(F.trim(text).try_cast("double").try_cast("int"), F.lit(default))


def flag_value(text: Column, strict_numeric: bool = False) -> Column:
    """0/1 flags; captures may also spell them true/false, which strict mode reads as 0."""
    number = lenient_int(text, 0)
    if strict_numeric:
        return number
    return F.when(F.lower(F.trim(text)) == "true", 1).otherwise(number)


def idle_timeout_us(protocol: Column, settings: Settings) -> Column:
    return (
        F.when(protocol == "TCP", settings.tcp_idle_us)
        .when(protocol == "ICMP", settings.icmp_idle_us)
        .otherwise(settings.udp_idle_us)
        .cast("long")
    )


def closes_flow() -> Column:
    """Whether the packet ends its TCP flow."""
    return (F.col("protocol") == "TCP") & ((F.col("fin") > 0) | (F.col("rst") > 0))


def flow_timeout_us(flow: Column | None, settings: Settings) -> Column:
    """Idle timeout of a finished flow row: short for a TCP probe that carried nothing."""

    def get(name: str) -> Column:
        return F.col(name) if flow is None else flow[name]

    probe = (
        (get("protocol") == "TCP")
        & (get("packet_count_total") <= 3)
        & (get("psh_count") == 0)
        & (get("fin_count") == 0)
        & (get("rst_count") == 0)
    )
    return F.when(probe, F.lit(settings.probe_us).cast("long")).otherwise(
        idle_timeout_us(get("protocol"), settings)
    )


def failed_connection_ratio(
    protocol: Column, syn: Column, ack: Column, rst: Column
) -> Column:
    ratio = F.least(F.lit(1.0), rst / F.greatest(syn, F.lit(1)))
    return F.round(
        F.when(protocol != "TCP", 0.0).when((syn > 0) & (ack == 0), 1.0).otherwise(ratio), 6
    )


def iso_utc(micros: Column) -> Column:
    """ISO-8601 with offset; the fraction is left out when it is zero. Needs a UTC session."""
    stamp = F.timestamp_micros(micros)
    return F.when(
        F.pmod(micros, F.lit(1_000_000)) == 0,
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
    ).otherwise(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def tcp_flags(counts: dict[str, Column]) -> Column:
    """Comma list of the flags whose count is positive, null when none is."""
    # Flag order.
    order = ["SYN", "ACK", "FIN", "RST", "PSH", "URG"]
    parts = [F.when(counts[name] > 0, name) for name in order if name in counts]
    return F.nullif(F.concat_ws(",", *parts), F.lit(""))


def rule_preview(
    src_ip: Column, dst_ip: Column, protocol: Column, src_port: Column, dst_port: Column
) -> Column:
    """Text of the firewall rule a block would need. Never executed."""
    proto = F.lower(F.nullif(protocol, F.lit("")))
    has_src = F.coalesce(src_ip, F.lit("")) != ""
    has_dst = F.coalesce(dst_ip, F.lit("")) != ""
    with_dport = proto.isNotNull() & dst_port.isNotNull()
    # Rule formats.
    return (
        F.when(has_src, F.format_string("iptables -I INPUT 1 -s %s -j DROP", src_ip))
        .when(
            has_dst & with_dport,
            F.format_string(
                "iptables -I OUTPUT 1 -d %s -p %s --dport %d -j DROP", dst_ip, proto, dst_port
            ),
        )
        .when(
            with_dport,
            F.format_string("iptables -I INPUT 1 -p %s --dport %d -j DROP", proto, dst_port),
        )
        .when(
            proto.isNotNull() & src_port.isNotNull(),
            F.format_string("iptables -I INPUT 1 -p %s --sport %d -j DROP", proto, src_port),
        )
    )
