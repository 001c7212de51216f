"""Tunable limits. Every field can be set per session as ``spark.tidewire.<field>``."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

MICROS = 1_000_000


@dataclass(frozen=True)
class Settings:
    tcp_idle_timeout_seconds: float = 30.0
    tcp_probe_timeout_seconds: float = 3.0
    udp_idle_timeout_seconds: float = 15.0
    icmp_idle_timeout_seconds: float = 5.0
    max_flow_duration_seconds: float = 60.0
    flush_interval_seconds: float = 0.5
    watermark_seconds: float = 5.0
    alert_confidence_threshold: float = 0.95
    block_confidence_threshold: float = 0.99
    blocking_mode: str = "dry_run"
    controller_host: str = "172.30.1.20"
    # A group with more rows than this is sorted by many tasks instead of one.
    max_group_rows: int = 4_000_000
    # A flow key with more packets than this is cut by pointers instead of being folded.
    max_fold_rows: int = 200_000

    @classmethod
    def from_session(cls, spark: SparkSession) -> Settings:
        given = {}
        for field in fields(cls):
            text = spark.conf.get(f"spark.tidewire.{field.name}", None)
            if text is not None:
                given[field.name] = type(field.default)(text)
        return cls(**given)

    @property
    def tcp_idle_us(self) -> int:
        return round(self.tcp_idle_timeout_seconds * MICROS)

    @property
    def probe_us(self) -> int:
        """A half-open probe never waits longer than an ordinary TCP flow."""
        return round(min(self.tcp_probe_timeout_seconds, self.tcp_idle_timeout_seconds) * MICROS)

    @property
    def udp_idle_us(self) -> int:
        return round(self.udp_idle_timeout_seconds * MICROS)

    @property
    def icmp_idle_us(self) -> int:
        return round(self.icmp_idle_timeout_seconds * MICROS)

    @property
    def max_duration_us(self) -> int:
        return round(self.max_flow_duration_seconds * MICROS)

    @property
    def longest_idle_us(self) -> int:
        return max(self.tcp_idle_us, self.udp_idle_us, self.icmp_idle_us)
