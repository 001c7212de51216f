"""Network-flow analytics as Spark DataFrame, SQL and Structured Streaming jobs."""

from tidewire.settings import Settings

__all__ = ["Settings"]
