"""Ratios that round the same way everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` of non-negative whole numbers, rounded half up to ``digits``.

    The rounding is done on whole numbers: on a double, a tie falls to the side its
    binary value happens to lie on. Null when ``whole`` is null or zero.
    """
    scale = 10**digits
    doubled = part.cast("long") * (2 * scale) + whole.cast("long")
    steps = F.call_function("div", doubled, F.nullif(whole.cast("long") * 2, F.lit(0)))
    return steps / scale
